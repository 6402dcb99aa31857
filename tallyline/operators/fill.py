"""Filling merges: per measure the newest value that is not NULL, since the last delete.

Unlike coalescing the latest row onto a stored one, the result is a function of the set
of events alone, however they are cut into batches and in whatever order they come.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.schema import CONTROL, DELETED, EVENT_ORDER


def _newest(value: Column, given: Column, at: Column) -> Column:
    return F.max_by(value, F.when(given, at))


def deciding_rows(
    events: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[str] = EVENT_ORDER
) -> DataFrame:
    """The events that decide each key: its last, its last delete, and per measure the one
    with its newest value since that delete.  At most two more than there are measures."""
    columns, at, upsert = events.columns, F.struct(*order), ~F.col(DELETED)
    row = F.struct(at.alias("_at"), *[c for c in columns if c not in keys])
    newest = [_newest(row, upsert & F.col(v).isNotNull(), at).alias(f"_newest_{i}") for i, v in enumerate(values)]
    last, gone = F.max_by(row, at).alias("_last"), _newest(row, F.col(DELETED), at).alias("_gone")
    found = events.groupBy(*keys).agg(last, gone, *newest)
    # a measure's newest value counts unless a delete came after it
    since = F.col("_gone").isNull()
    alive = [F.when(since | (F.col(f"_newest_{i}._at") > F.col("_gone._at")), F.col(f"_newest_{i}")) for i in range(len(newest))]
    found = found.select(*keys, F.array_compact(F.array("_last", "_gone", *alive)).alias("_rows"))

    def first(r: Column, i: Column) -> Column:
        return ~F.exists(F.slice("_rows", 1, i), lambda other: other["_at"] == r["_at"])

    return found.select(*keys, F.inline(F.filter("_rows", first))).select(*columns)


def filled(
    events: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[str] = EVENT_ORDER
) -> DataFrame:
    """One row per key: its filled measures and its last event's control columns."""
    columns, at, upsert = events.columns, F.struct(*order), ~F.col(DELETED)
    newest = [
        _newest(F.struct(at.alias("_at"), F.col(v).alias("_value")), upsert & F.col(v).isNotNull(), at).alias(f"_newest_{i}")
        for i, v in enumerate(values)
    ]
    last, gone = F.max_by(F.struct(*CONTROL), at).alias("_control"), F.max(F.when(F.col(DELETED), at)).alias("_gone")
    found = events.groupBy(*keys).agg(last, gone, *newest)
    taken = [
        F.when(F.col("_gone").isNull() | (F.col(f"_newest_{i}._at") > F.col("_gone")), F.col(f"_newest_{i}._value")).alias(v)
        for i, v in enumerate(values)
    ]
    merged = found.select(*keys, *taken, "_control.*")
    return merged.select(*[c for c in columns if c in merged.columns])
