"""Running values over arrays, in work proportional to their length.

Spark's fold copies the array it builds at every step.  Here folds build blocks of
``BLOCK`` values only, and blocks get what lies before them from a fold over the blocks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Values in a block, and blocks in a block of blocks.
BLOCK = 64
#: Levels of blocks: arrays of ``BLOCK ** (LEVELS + 1)`` values cost ``BLOCK`` steps a value.
LEVELS = 2


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """For each int of an array, ``join`` over all before it, from 0 on; it must be associative."""
    none = F.array().cast("array<int>")

    def fold(block: Column, first: Column) -> Column:
        def step(done: Column, value: Column) -> Column:
            return F.struct(
                join(done["at"], value).alias("at"), F.concat(done["out"], F.array(done["at"])).alias("out")
            )

        return F.aggregate(block, F.struct(first.alias("at"), none.alias("out")), step, lambda done: done["out"])

    def level(values: Column, deeper: int) -> Column:
        if not deeper:
            return fold(values, F.lit(0))
        starts = F.sequence(F.lit(1), F.size(values), F.lit(BLOCK))
        blocks = F.transform(starts, lambda first: F.slice(values, first, F.lit(BLOCK)))

        def joined(blocks: Column) -> Column:
            before = bound(totals(blocks), lambda values: level(values, deeper - 1))
            return F.flatten(F.zip_with(blocks, before, fold))

        return bound(blocks, joined)

    def totals(blocks: Column) -> Column:
        return F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), join))

    return bound(values, lambda values: F.when(F.size(values) > 0, level(values, LEVELS)).otherwise(none))


def running_sum(values: Column) -> Column:
    """The sum of the ints before each."""
    return running(values, lambda a, b: a + b)


def running_max(values: Column) -> Column:
    """The largest of the ints before each, 0 at least."""
    return running(values, lambda a, b: F.greatest(a, b))
