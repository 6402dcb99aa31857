"""Statement tables out of stored pages, without leaving the JVM."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.numbers import parse_number
from tallyline.functions.text import decode_entities, normalise_name
from tallyline.operators.tolerant import tolerant_tables
from tallyline.schema import MEASURES, PERIOD

# The sections that hold a statement table.
PROFIT_LOSS = "profit-loss"
BALANCE_SHEET = "balance-sheet"
# Fixed value: the name the first column gets.
LINE_ITEM_HEADER = "Narration"

# Stand for the tags of tables inside cells.
_INNER, _INNER_END = "\u0002", "\u0003"

# Stands for a table tag; the tag's letter follows, after a slash in an end tag.
_TAG = "\u0001"
# Rest of a tag: an end sign inside quotes does not end it, a lone quote does not matter.
_QUOTED = "(?:\"[^\"]*+\"|'[^']*+')"
_REST = f"(?:[^>\"']*+(?:{_QUOTED}[^>\"']*+)*+|[^>]*)>"


def _behind_first_table(html: Column, section_id: str) -> Column:
    """What follows the section's first table tag, up to the end of the section.

    The loops step from one ``<`` to the next and never go back, so a page costs
    one pass whatever its length.
    """
    name = f"(?-i:{re.escape(section_id)})"
    opening = f"<section\\b[^>]*?\\bid\\s*=\\s*[\"']?{name}[\"']?(?=[\\s>/]){_REST}"
    before = "(?:[^<]++|<(?!/section\\b|table\\b))*+"
    inside = "((?:[^<]++|<(?!/section\\b))*+)"
    return F.regexp_extract(html, f"(?is){opening}{before}<table\\b{_REST}{inside}", 1)


def _without(text: Column, *marks: str) -> Column:
    """The text without some plain strings; where there are none, a search of its bytes."""
    for mark in marks:
        text = F.replace(text, F.lit(mark), F.lit(""))
    return text


def _marked(table: Column) -> Column:
    """Table markup to text with one mark per table, row and cell tag."""
    text = _without(table, _TAG, _INNER, _INNER_END)
    hidden = F.regexp_replace(text, "(?is)<!--.*?-->|<(script|style)\\b[^>]*>.*?</\\1\\s*>", "")
    low = F.lower(text)
    some = low.contains("<!--") | low.contains("<script") | low.contains("<style")
    text = F.when(some, hidden).otherwise(text)
    text = F.regexp_replace(text, f"(?i)<table(?=[\\s>/]){_REST}", _INNER)
    text = F.regexp_replace(text, f"(?i)</table(?=[\\s>/]){_REST}", _INNER_END)
    # Without a table inside, nothing behind the first end is of interest.
    text = F.when(text.contains(_INNER), text).otherwise(F.substring_index(text, _INNER_END, 1))
    text = F.regexp_replace(text, f"(?i)<(/?t[rhd])(?:>|(?=[\\s/]){_REST})", f"{_TAG}$1")
    return F.regexp_replace(text, f"</?[A-Za-z]{_REST}", "")


def _depths(tags: Column) -> Column:
    """Tables open behind each place of a text of table marks, less those closed.

    Sums of blocks come first, so that a place counts the marks of its own block only, as
    bytes: the work grows with the length to the power 1.5.
    """

    def opened(marks: Column) -> Column:
        return 2 * F.length(F.replace(marks, F.lit(_INNER_END), F.lit(""))) - F.length(marks)

    width = F.ceil(F.sqrt(F.length(tags))).cast("int")
    blocks = F.transform(
        F.sequence(F.lit(1), F.length(tags), width), lambda first: F.substr(tags, first, width)
    )
    sums = F.transform(blocks, opened)
    before = F.transform(
        sums, lambda _, i: F.aggregate(F.slice(sums, F.lit(1), i), F.lit(0), lambda a, b: a + b)
    )

    def within(pair: Column) -> Column:
        places = F.sequence(F.lit(1), F.length(pair["block"]))
        return F.transform(places, lambda i: pair["before"] + opened(F.substr(pair["block"], F.lit(1), i)))

    return F.flatten(F.transform(F.arrays_zip(blocks.alias("block"), before.alias("before")), within))


def _unnested(tables: DataFrame, carry: Sequence[str]) -> DataFrame:
    """The first table alone, with the text of tables in its cells but not their rows and cells.

    The depth at each table tag is a running sum (:func:`_depths`), so tables may be nested to any depth; a
    table that is never closed reaches to the end of the section.
    """
    nested = F.col("_t").contains(_INNER)
    parts = F.when(nested, F.split("_t", f"(?=[{_INNER}{_INNER_END}])", -1))
    tables = tables.select(*carry, "_t", parts.alias("_parts"))
    tags = F.when(nested, F.regexp_replace("_t", f"[^{_INNER}{_INNER_END}]+", ""))
    tables = tables.select(*carry, "_t", "_parts", tags.alias("_tags"))
    tables = tables.select(*carry, "_t", "_parts", _depths(F.col("_tags")).alias("_depths"))

    def piece(part: Column, i: Column) -> Column:
        plain = _without(part, _INNER, _INNER_END)
        first = (i == 0) | (F.get("_depths", i - 1) == 0)
        return F.when(first, F.replace(plain, F.lit(_TAG), F.lit(_INNER))).otherwise(plain)

    # The first table ends where the sum falls below nought.
    end = F.array_position("_depths", -1).cast("int")
    kept = F.slice("_parts", F.lit(1), F.when(end > 0, end).otherwise(F.size("_parts")))
    # The first table's own marks step aside while all others become blanks.
    text = F.regexp_replace(F.array_join(F.transform(kept, piece), ""), f"(?i){_TAG}/?t[rhd]", " ")
    text = F.replace(text, F.lit(_INNER), F.lit(_TAG))
    plain = _without(F.col("_t"), _INNER, _INNER_END)
    text = F.when(F.col("_parts").isNull(), plain).otherwise(text)
    # Closes a last cell that lacks its end tag.
    return tables.select(*carry, F.concat(text, F.lit(f"{_TAG}/tr")).alias("_t"))


def _all(text: Column, letter: str) -> Column:
    pattern = f"(?i){_TAG}t{letter}([^{_TAG}]*)"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def _tables(
    pages: DataFrame, section_id: str, carry: Sequence[str], tolerant: bool = False
) -> DataFrame:
    """One row per page with a table: ``headers`` and ``lines`` (``row_no, cells``).

    Every stage is a projection over one page, so the extraction is a single
    narrow stage whatever the number of pages.  Markup and character references
    are worked off once per table rather than once per cell.  Arrays are built
    inside the generators that unfold them: a filter or generator over a
    projected array would make the optimiser evaluate the patterns twice.
    """
    if tolerant:
        return tolerant_tables(pages, section_id, carry)
    # A page without the words skips the patterns.  A filter of its own would be pushed below
    # whatever made the page, which would then be made twice.
    html = F.col("html")
    found = F.array(F.when(F.contains(html, F.lit(section_id)), _behind_first_table(html, section_id)))
    tables = pages.select(*carry, F.explode(F.filter(found, lambda t: t != "")).alias("_t"))
    tables = _unnested(tables.select(*carry, _marked(F.col("_t")).alias("_t")), carry)
    tables = tables.select(*carry, decode_entities(F.col("_t")).alias("_t"))
    trimmed = F.regexp_replace("_t", f"(?i)[\\s\\u00a0]*({_TAG}/?t[rhd])[\\s\\u00a0]*", "$1")
    tables = tables.select(*carry, trimmed.alias("_t"))
    headers = F.transform(
        _all(F.col("_t"), "h"),
        lambda h, i: F.when(h == "", F.concat(F.lit("Column_"), i.cast("string"))).otherwise(h),
    )
    # What precedes the first row mark is no row, and the first row holds the headers.
    pieces = F.split("_t", f"(?i){_TAG}tr", -1)
    rows = F.slice(pieces, F.lit(3), F.size(pieces))
    lines = F.transform(
        rows, lambda r, i: F.struct(i.alias("row_no"), _all(r, "d").alias("cells"))
    )
    return tables.select(*carry, headers.alias("headers"), lines.alias("lines"))


def _body(fits: bool) -> Column:
    """Body rows as wide as the header, or the other ones."""
    width = F.nullif(F.size("headers"), F.lit(0))
    return F.filter("lines", lambda r: F.size(r["cells"]).eqNullSafe(width) == F.lit(fits))


def _body_rows(
    pages: DataFrame, section_id: str, carry: Sequence[str], tolerant: bool, fits: bool = True
) -> DataFrame:
    tables = _tables(pages, section_id, carry, tolerant)
    return tables.select(*carry, "headers", F.inline(_body(fits)))


def extract_statement(
    pages: DataFrame,
    section_id: str = PROFIT_LOSS,
    carry: Sequence[str] = ("page_id",),
    tolerant: bool = False,
) -> DataFrame:
    """Long form of each page's statement: one row per cell.

    ``row_no`` counts body rows, ``col_no`` columns from 1; the column at 0 is
    the line item.  Rows with another number of cells than headers are left
    out, :func:`rejected_rows` has them.  ``tolerant`` parses the pages in
    Python workers instead, for markup that tags alone do not settle.
    """
    rows = _body_rows(pages, section_id, carry, tolerant)
    pairs = F.arrays_zip(F.col("headers").alias("period"), F.col("cells").alias("raw"))
    cells = rows.select(
        *carry,
        "row_no",
        F.element_at("cells", 1).alias("line_item"),
        F.posexplode(pairs).alias("col_no", "_cell"),
    )
    return cells.filter(F.col("col_no") > 0).select(
        *carry,
        "row_no",
        "line_item",
        "col_no",
        F.col("_cell.period").alias("period"),
        F.col("_cell.raw").alias("raw"),
        parse_number(F.col("_cell.raw")).alias("value"),
    )


def rejected_rows(
    pages: DataFrame,
    section_id: str = PROFIT_LOSS,
    carry: Sequence[str] = ("page_id",),
    tolerant: bool = False,
) -> DataFrame:
    """Body rows whose cell count differs from the header count."""
    rows = _body_rows(pages, section_id, carry, tolerant, fits=False)
    return rows.select(
        *carry, "row_no", F.size("headers").alias("expected"), "cells"
    )


def statement_matrix(
    pages: DataFrame,
    section_id: str = PROFIT_LOSS,
    carry: Sequence[str] = ("page_id",),
    tolerant: bool = False,
) -> DataFrame:
    """The table as it stands on the page: ``Narration`` and an array of cell texts."""
    rows = _body_rows(pages, section_id, carry, tolerant)
    return rows.select(
        *carry,
        "row_no",
        F.element_at("cells", 1).alias(LINE_ITEM_HEADER),
        F.slice("headers", F.lit(2), F.greatest(F.size("headers"), F.lit(0))).alias("periods"),
        F.slice("cells", F.lit(2), F.size("cells")).alias("values"),
    )


def load_statements(
    pages: DataFrame,
    company: str,
    section_id: str = PROFIT_LOSS,
    items: Sequence[str] = MEASURES,
    fill: float | None = None,
    period: str = PERIOD,
    tolerant: bool = False,
) -> DataFrame:
    """Pages straight to statement rows: ``period``, one column per item, ``company``.

    A page holds its whole table, so turning it is a per-page array lookup and
    nothing is shuffled.  A repeated line item counts where it stands first; a
    repeated period keeps one row per column.  ``fill`` replaces missing cells.
    """
    tables = _tables(pages, section_id, [company], tolerant)
    whole = tables.select(company, "headers", _body(True).alias("_rows"))
    names = F.transform("_rows", lambda r: normalise_name(F.element_at(r["cells"], 1)))
    whole = whole.select(company, "headers", "_rows", names.alias("_names"))
    found = [F.array_position("_names", item).cast("int") - 1 for item in items]
    lines = F.array(*[F.get("_rows", at)["cells"] for at in found])
    whole = whole.select(company, "headers", "_rows", lines.alias("_lines"))

    def cell(item: str, col_no: Column) -> Column:
        return F.get(F.get("_lines", F.lit(list(items).index(item))), col_no).alias(item)

    periods = F.slice("headers", F.lit(2), F.greatest(F.size("headers"), F.lit(0)))
    turned = F.transform(
        periods, lambda h, i: F.struct(h.alias(period), *[cell(item, i + 1) for item in items])
    )
    rows = whole.select(company, F.inline(F.when(F.size("_rows") > 0, turned)))

    def number(item: str) -> Column:
        value = parse_number(item)
        return (value if fill is None else F.coalesce(value, F.lit(float(fill)))).alias(item)

    return rows.select(period, *[number(i) for i in items], company)
