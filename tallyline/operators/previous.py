"""Previous-row values over an ordered group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_previous(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    columns: Sequence[str],
    chunk: Column | None = None,
    prefix: str = "_prev_",
) -> DataFrame:
    """Adds ``{prefix}{c}``: the value of ``c`` in the row before, inside ``by``.

    Without ``chunk`` one task sorts a whole group.  That fits statements, where
    a company has one row per period label.  For groups without such a bound
    give ``chunk``, an expression that never decreases along ``order`` (the day
    of a timestamp; a struct of leading order columns works too): the group is
    then spread over its chunks, and only each chunk's last row, found by partial
    aggregation, travels to the next one.  One task sorts one chunk, and one
    task sees one row per chunk of a group, so both numbers should be moderate.
    """
    by = list(by)
    if chunk is None:
        w = Window.partitionBy(*by).orderBy(*order)
        return df.select("*", *[F.lag(c).over(w).alias(prefix + c) for c in columns])

    names = df.columns
    rank = [f"_ord{i}" for i in range(len(order))]
    rows = df.select(
        "*",
        chunk.alias("_chunk"),
        *[o.alias(r) for o, r in zip(order, rank)],
        F.lit(False).alias("_carried"),
    )
    last = rows.groupBy(*by, "_chunk").agg(
        F.max_by(F.struct(*columns), F.struct(*rank)).alias("_last")
    )
    before = F.lag("_last").over(Window.partitionBy(*by).orderBy("_chunk"))
    carried = (
        last.select(*by, "_chunk", before.alias("_last"))
        .filter(F.col("_last").isNotNull())
        .select(*by, "_chunk", *[F.col(f"_last.`{c}`").alias(c) for c in columns if c not in by])
        .withColumn("_carried", F.lit(True))
    )
    # The carried row stands before its chunk's own rows, so a plain lag sees it.
    w = Window.partitionBy(*by, "_chunk").orderBy(F.col("_carried").desc(), *rank)
    return (
        rows.unionByName(carried, allowMissingColumns=True)
        .select(*names, "_carried", *[F.lag(c).over(w).alias(prefix + c) for c in columns])
        .filter(~F.col("_carried"))
        .drop("_carried")
    )
