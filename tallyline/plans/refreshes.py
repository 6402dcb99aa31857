"""The three refreshes: one statement with averages, many companies, indicators.

Each takes the stored rows and decoded events and returns the new table; the
caller picks the sink.  Merging is one shuffle by key per side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from tallyline.operators.compact import compact
from tallyline.operators.filters import complete_rows, exclude_prefix
from tallyline.operators.indicators import STANDARD, Spec, with_indicators
from tallyline.operators.merge import merge_state
from tallyline.operators.summary import append_summary
from tallyline.schema import COMPANY, MEASURES, PERIOD


def average_statement(
    existing: DataFrame,
    events: DataFrame,
    keys: Sequence[str] = (PERIOD,),
    measures: Sequence[str] = MEASURES,
    mode: str = "coalesce",
    keep_existing: bool = True,
    keep_trailing: bool = True,
    digits: int | None = None,
    scale: int | None = None,
    store: str | None = None,
) -> DataFrame:
    """Merged rows followed by their average; incomplete rows are left out.

    The rows are named twice; with ``store``, a new folder, they are written there once
    and read from there, so that the merge runs once.

    ``keep_trailing`` leaves trailing-twelve-months rows in the output; they
    never count towards the average.
    """
    merged = merge_state(existing, compact(events, keys), keys, mode, keep_existing)
    if not keep_trailing:
        merged = exclude_prefix(merged)
    if store:
        merged.write.parquet(store)
        merged = existing.sparkSession.read.parquet(store)
    summed = append_summary(merged, measures, digits=digits, scale=scale)
    return complete_rows(summed, [PERIOD, *measures])


def company_statement(
    existing: DataFrame,
    events: DataFrame,
    keys: Sequence[str] = (PERIOD, COMPANY),
    mode: str = "coalesce",
    keep_existing: bool = True,
) -> DataFrame:
    """Merged rows of many companies without trailing rows."""
    merged = merge_state(existing, compact(events, keys), keys, mode, keep_existing)
    return exclude_prefix(merged)


def indicator_statement(
    existing: DataFrame,
    events: DataFrame,
    keys: Sequence[str] = (PERIOD, COMPANY),
    specs: Sequence[Spec] = STANDARD,
    mode: str = "coalesce",
    order: Sequence[Column] | None = None,
    chunk: Column | None = None,
) -> DataFrame:
    """Merged rows with indicators.

    Trailing rows go before growth is computed, so they are never anybody's
    previous period.
    """
    rows = company_statement(existing, events, keys, mode)
    return with_indicators(rows, specs, by=[COMPANY], order=order, chunk=chunk)
