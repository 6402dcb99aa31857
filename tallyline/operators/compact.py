"""Latest row per key.

Both forms reduce each task's rows to one per key before the shuffle, so a key
that holds a third of the log costs its shuffle partition one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.schema import EVENT_ORDER


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = EVENT_ORDER,
    method: str = "aggregate",
) -> DataFrame:
    """Keeps, per key, the row with the greatest ``order`` tuple (NULLs lowest).

    ``window``     ``row_number() = 1``; Spark limits each group before the shuffle.
    ``aggregate``  ``max_by`` over the rest of the row; partial aggregation.
    """
    keys = list(keys)
    if method == "window":
        newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
        ranked = df.withColumn("_rn", F.row_number().over(newest))
        return ranked.filter(F.col("_rn") == 1).drop("_rn")
    if method == "aggregate":
        rest = [c for c in df.columns if c not in keys]
        newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
        return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)
    raise ValueError(f"unknown method: {method!r}")


def compact(
    events: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = EVENT_ORDER,
    method: str = "aggregate",
) -> DataFrame:
    """Last event of every key, deletes included.

    A key whose last event is a delete leaves with ``_deleted`` set, so a
    re-inserted key survives and a late older delete is ignored.
    """
    return latest_per_key(events, keys, order, method)
