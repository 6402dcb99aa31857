"""Average rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.numbers import decimal_mean, round_to
from tallyline.functions.periods import is_trailing
from tallyline.schema import AVERAGE_LABEL, MEASURES, PERIOD


def averages(
    df: DataFrame,
    columns: Sequence[str] = MEASURES,
    digits: int | None = None,
    by: Sequence[str] = (),
    scale: int | None = None,
    prefix: str = "avg_",
) -> DataFrame:
    """Means of ``columns``, over everything or per ``by`` group.

    One aggregation for all columns; partial sums are built before the shuffle.
    ``scale`` makes the sums decimal, see ``decimal_mean``.
    """
    means = [round_to(decimal_mean(c, scale), digits).alias(prefix + c) for c in columns]
    return df.groupBy(*by).agg(*means) if by else df.agg(*means)


def average_rows(
    df: DataFrame,
    columns: Sequence[str] = MEASURES,
    label: str = AVERAGE_LABEL,
    digits: int | None = None,
    by: Sequence[str] = (),
    period: str = PERIOD,
    scale: int | None = None,
) -> DataFrame:
    """The average in row form, labelled in the period column.

    Trailing rows and earlier average rows do not count.
    """
    base = df.filter(~is_trailing(period) & (F.col(period) != label))
    means = averages(base, columns, digits, by, scale, prefix="")
    return means.select(F.lit(label).alias(period), *by, *columns)


def append_summary(
    df: DataFrame,
    columns: Sequence[str] = MEASURES,
    label: str = AVERAGE_LABEL,
    digits: int | None = None,
    by: Sequence[str] = (),
    period: str = PERIOD,
    scale: int | None = None,
) -> DataFrame:
    """``df`` without its old average rows, followed by fresh ones.

    ``df`` is read twice; behind an expensive plan store it first.
    """
    rows = df.filter(~F.col(period).eqNullSafe(F.lit(label)))
    summary = average_rows(df, columns, label, digits, by, period, scale)
    return rows.unionByName(summary, allowMissingColumns=True)
