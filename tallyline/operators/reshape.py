"""Long and wide forms of statements, and numeric clean-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.numbers import parse_number
from tallyline.functions.text import normalise_name
from tallyline.schema import MEASURES, PERIOD


def transpose_statement(
    cells: DataFrame,
    items: Sequence[str] = MEASURES,
    ids: Sequence[str] = ("page_id",),
    period: str = PERIOD,
    value: str = "value",
) -> DataFrame:
    """Long cells to one row per period with a column per line item.

    The item list is given, so no job runs to find it, and the aggregation keeps
    one small buffer per output cell.  The first row wins for a repeated item;
    items outside the list are in :func:`unlisted_items`.
    """
    item = normalise_name("line_item")
    named = cells.select(*ids, "row_no", "col_no", "period", value, item.alias("_item"))
    picks = [
        F.min_by(F.when(F.col("_item") == i, F.col(value)),
                 F.when(F.col("_item") == i, F.col("row_no"))).alias(i)
        for i in items
    ]
    wide = named.groupBy(*ids, "col_no", "period").agg(*picks)
    return wide.select(*ids, F.col("period").alias(period), *items)


def unlisted_items(cells: DataFrame, items: Sequence[str] = MEASURES) -> DataFrame:
    """Cells whose line item has no column in the wide form."""
    return cells.filter(~normalise_name("line_item").isin(list(items)))


def unpivot_statement(
    df: DataFrame,
    ids: Sequence[str],
    items: Sequence[str] = MEASURES,
    name: str = "line_item",
    value: str = "value",
) -> DataFrame:
    """One row per id and line item."""
    typed = df.select(*ids, *[F.col(i).cast("double").alias(i) for i in items])
    return typed.unpivot(list(ids), list(items), name, value)


def clean_numbers(df: DataFrame, columns: Sequence[str], fill: float | None = None) -> DataFrame:
    """Text columns to doubles; ``fill`` replaces missing and unreadable cells."""
    cleaned = df.withColumns({c: parse_number(c) for c in columns})
    return cleaned if fill is None else cleaned.fillna(float(fill), subset=list(columns))


def rename_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Column headings to normalised names, the same rule as ``normalise_name``."""
    renamed = {c: _normalise_heading(c) for c in df.columns if c not in keep}
    return df.withColumnsRenamed(renamed)


def _normalise_heading(heading: str) -> str:
    text = heading.strip().lower().replace(" ", "_").replace("\u00a0", "_")
    return text.replace("+", "").replace("%", "percent").strip().rstrip("_")


def concatenate(frames: Sequence[DataFrame]) -> DataFrame:
    """Stacks frames by column name; a column a frame lacks is NULL there."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first
