"""Row filters and orderings used around the merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.periods import is_trailing, period_order
from tallyline.schema import AVERAGE_LABEL, COMPANY, PERIOD, TRAILING_PREFIX


def keyed_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is whole."""
    return df.dropna(how="any", subset=list(keys))


def exclude_prefix(df: DataFrame, column: str = PERIOD, prefix: str = TRAILING_PREFIX) -> DataFrame:
    """Drops labels with the prefix, and NULL labels with them."""
    return df.filter(~is_trailing(column, prefix))


def complete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with no NULL in ``columns`` (default: any column)."""
    return df.dropna(how="any", subset=list(columns) if columns else None)


def order_statements(
    df: DataFrame, company: str = COMPANY, period: str = PERIOD, by: str = "calendar"
) -> DataFrame:
    """Total order by company and period, for ordered files only.

    The sort ranges over both columns, so a large company spans many tasks.
    """
    return df.orderBy(F.col(company).asc_nulls_first(), *period_order(period, by))


def order_summary_last(
    df: DataFrame,
    period: str = PERIOD,
    label: str = AVERAGE_LABEL,
    leading: Sequence[str] = (),
) -> DataFrame:
    """Summary rows after the others; inside each part by ``leading`` and period."""
    is_summary = F.col(period).eqNullSafe(F.lit(label)).cast("int")
    return df.orderBy(is_summary, *leading, *period_order(period))
