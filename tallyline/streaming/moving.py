"""Averages moved by each event's old and new image; no stored row is read.

Sums commute, so events may come late and in any order: every event takes its old image out
and puts its new one in.  That asks for whole old images in the log and for each event
exactly once, which the query's checkpoint gives.  The state is one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyline.functions.numbers import exact_sums, round_to
from tallyline.functions.periods import is_trailing
from tallyline.operators.decode import parse_envelopes
from tallyline.schema import AVERAGE_LABEL, MEASURES, PERIOD


def moved_sums(
    changes: DataFrame, row: T.StructType, keys: Sequence[str], measures: Sequence[str] = MEASURES, scale: int = 4
) -> DataFrame:
    """One row: per measure the moves of its sum and its count, and how many moved values
    are no decimals of ``scale`` places.

    Unreadable records, images without a whole key, trailing rows and average rows move
    nothing.  ``changes`` may be a stream: the row is then its running state.
    """
    events = parse_envelopes(changes, row, keys, images=True)
    moves = F.array(
        F.struct(F.lit(-1).alias("sign"), F.col("event.before").alias("image")),
        F.struct(F.lit(1).alias("sign"), F.col("event.after").alias("image")),
    )
    images = events.select(F.inline(moves)).select("sign", "image.*").dropna(subset=list(keys))
    images = images.filter(~is_trailing(PERIOD) & (F.col(PERIOD) != AVERAGE_LABEL))
    sums = []
    for m in measures:
        value = F.col(m).cast("double")
        exact, inexact = exact_sums(value, scale, F.col("sign"))
        sums.append(F.sum(value * F.col("sign")).alias(f"sum_{m}"))
        sums.append(F.sum(F.when(value.isNotNull(), F.col("sign"))).alias(f"n_{m}"))
        sums.append(exact.alias(f"exact_{m}"))
        sums.append(inexact.alias(f"inexact_{m}"))
    return images.agg(*sums)


def moved_average(sums: DataFrame, measures: Sequence[str] = MEASURES, digits: int | None = None) -> DataFrame:
    """The average row of summed-up moves; no values left give NULL.

    Where a value was no decimal of the scale, the floating sum is used: what was added and
    taken out again may leave its rounding there.
    """
    means = []
    for m in measures:
        total = F.when(F.col(f"inexact_{m}") == 0, F.col(f"exact_{m}").cast("double")).otherwise(F.col(f"sum_{m}"))
        mean = F.try_divide(total, F.col(f"n_{m}").cast("double"))
        means.append(round_to(mean, digits).alias(m))
    return sums.select(F.lit(AVERAGE_LABEL).alias(PERIOD), *means)


def run_moving_average(
    changes: DataFrame,
    row: T.StructType,
    keys: Sequence[str],
    path: str,
    checkpoint: str,
    measures: Sequence[str] = MEASURES,
    scale: int = 4,
    every: str | None = None,
) -> StreamingQuery:
    """Keeps the summed-up moves of a log at ``path``, a folder per micro-batch, the newest
    of which is the state (:func:`newest_sums`)."""

    def store(sums: DataFrame, batch_id: int) -> None:
        sums.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    sums = moved_sums(changes, row, keys, measures, scale)
    writer = sums.writeStream.outputMode("complete").foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def newest_sums(rows: DataFrame) -> DataFrame:
    """The row of the last micro-batch, of the folder :func:`run_moving_average` writes."""
    newest = F.max_by(F.struct(*[c for c in rows.columns if c != "batch"]), "batch").alias("_row")
    return rows.agg(newest).select("_row.*")
