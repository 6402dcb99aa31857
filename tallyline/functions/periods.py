"""Period labels such as ``Mar 2013``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline.schema import PERIOD, TRAILING_PREFIX


def period_end(label: Column | str = PERIOD) -> Column:
    """Last day of the labelled month; NULL for labels that name no month."""
    text = F.col(label) if isinstance(label, str) else label
    return F.last_day(F.try_to_timestamp(text, F.lit("MMM yyyy")).cast("date"))


def period_order(label: Column | str = PERIOD, by: str = "calendar") -> list[Column]:
    """Sort expressions for periods.

    ``calendar`` orders by month end, then label, so companies with different
    year ends stay in time order.  ``label`` is plain text order, which agrees
    with it only while all labels share one month.
    """
    text = F.col(label) if isinstance(label, str) else label
    if by == "label":
        return [text]
    if by == "calendar":
        return [period_end(text), text]
    raise ValueError(f"unknown period order: {by!r}")


def is_trailing(label: Column | str = PERIOD, prefix: str = TRAILING_PREFIX) -> Column:
    """Trailing-twelve-months labels; NULL for a NULL label, so a filter drops it."""
    text = F.col(label) if isinstance(label, str) else label
    return text.startswith(prefix)
