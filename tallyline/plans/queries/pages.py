"""Statement pages, reshaping and text clean-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.numbers import parse_number
from tallyline.functions.text import normalise_name
from tallyline.operators.extract import (
    BALANCE_SHEET,
    extract_statement,
    load_statements,
    rejected_rows,
    statement_matrix,
)
from tallyline.operators.reshape import (
    clean_numbers,
    concatenate,
    transpose_statement,
    unlisted_items,
    unpivot_statement,
)
from tallyline.plans import derived
from tallyline.plans.queries import sql
from tallyline.schema import COMPANY, MEASURES, PERIOD
from tallyline.sources import read_pages


def _pages(spark: SparkSession, sf: str, section: str = "profit-loss") -> DataFrame:
    return derived.statement_pages(derived.statements(spark, sf), section_id=section)


def html_statement_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return load_statements(_pages(spark, sf), COMPANY)


def html_statement_tolerant(spark: SparkSession, sf: str) -> DataFrame:
    """The same pages through the HTML parser in the Python workers."""
    return load_statements(_pages(spark, sf), COMPANY, tolerant=True)


def html_balance_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """The other section, with missing items filled."""
    items = ["sales", "net_profit", "reserves"]
    return load_statements(_pages(spark, sf, BALANCE_SHEET), COMPANY, BALANCE_SHEET, items, fill=0)


def html_statement_cells(spark: SparkSession, sf: str) -> DataFrame:
    cells = extract_statement(_pages(spark, sf), carry=[COMPANY])
    return cells.select(
        COMPANY, "row_no", normalise_name("line_item").alias("line_item"), "col_no", "period", "value"
    )


def html_statement_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Cells per table row, counted and put back as text."""
    rows = statement_matrix(_pages(spark, sf), carry=[COMPANY])
    return rows.select(
        COMPANY,
        "row_no",
        normalise_name("Narration").alias("line_item"),
        F.size("values").alias("n_values"),
        F.array_join(F.transform("values", lambda v: F.format_number(parse_number(v), 2)), "|").alias("texts"),
        F.array_join("periods", "|").alias("periods"),
    )


def html_nested_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The same pages with tables in tables in the first cell of every row."""
    inner = "<table><tr><td><table><tr><th></th></tr></table></td><td> </td></tr></table>"
    nested = F.regexp_replace("html", '(<td class="text">[^<]*)', f"$1{inner}")
    pages = _pages(spark, sf).withColumn("html", nested)
    return load_statements(pages, COMPANY)


def html_deep_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The same pages with tables nested 1 to 12 deep, one page this deep, the next that."""
    row, nests = "<tr><td>{}</td><td> </td></tr>", [""]
    for _ in range(12):
        nests.append(f"<TABLE class='a>b'>{row.format(nests[-1])}<tr><th></th></tr></TABLE >")
    depth = F.pmod(F.crc32(COMPANY), F.lit(12)).cast("int") + 2
    nest = F.concat(F.lit("$1"), F.element_at(F.array(*map(F.lit, nests)), depth))
    nested = F.regexp_replace("html", F.lit('(<td class="text">[^<]*)'), nest)
    pages = _pages(spark, sf).withColumn("html", nested)
    return load_statements(pages, COMPANY)


def html_unlisted_items(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of the line items that a load of two items leaves out."""
    cells = extract_statement(_pages(spark, sf), carry=[COMPANY])
    left = unlisted_items(cells, ["sales", "net_profit"])
    return left.select(COMPANY, normalise_name("line_item").alias("line_item"), "period", "value")


def html_rejected_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = rejected_rows(_pages(spark, sf), carry=[COMPANY])
    return rows.select(COMPANY, "row_no", "expected", F.array_join("cells", "|").alias("text"))


def html_statement_in_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Statement sections set into the bodies of the stored pages, found again."""
    statements = derived.statement_pages(derived.statements(spark, sf)).select(
        COMPANY, F.col("html").alias("section")
    )
    number = F.col("page_id").cast("string")
    padded = F.lpad(number, F.greatest(F.length(number), F.lit(9)), F.lit("0"))
    key = F.concat(F.lit("Customer#"), padded)
    stored = read_pages(spark, f"{sf}/pages.parquet").select(key.alias(COMPANY), "page_id", "html")
    # Before the last end of a body, or at the end of a page without one.
    head = F.regexp_extract("html", "(?is)^(.*)</body>", 1)
    head = F.when(F.col("html").rlike("(?i)</body>"), head).otherwise(F.col("html"))
    tail = F.substr(F.col("html"), F.length(head) + 1, F.length("html"))
    body = F.concat(head, F.coalesce("section", F.lit("")), tail)
    pages = stored.join(statements, COMPANY, "left").select("page_id", body.alias("html"))
    return load_statements(pages, "page_id")


def statement_transpose(spark: SparkSession, sf: str) -> DataFrame:
    cells = extract_statement(_pages(spark, sf), carry=[COMPANY])
    return transpose_statement(cells, MEASURES, [COMPANY]).select(PERIOD, *MEASURES, COMPANY)


def statement_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    return unpivot_statement(derived.statements(spark, sf), [PERIOD, COMPANY])


def concatenate_frames(spark: SparkSession, sf: str) -> DataFrame:
    """Frames with different measures, one below the other."""
    final = derived.statements(spark, sf, "F", ["sales", "interest"])
    still_open = derived.statements(spark, sf, "O", ["sales", "net_profit"])
    return concatenate([final, still_open])


def clean_number_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Formatted amounts, percentages and words, cleaned with and without filling."""
    orders = derived.table(spark, sf, "orders")
    raw = orders.select(
        "o_orderkey",
        F.format_number("o_totalprice", 2).alias("amount"),
        F.concat(F.substring("o_orderpriority", 1, 1), F.lit("%")).alias("percent"),
        F.col("o_orderpriority").alias("words"),
        F.col("o_orderstatus").alias("filled"),
    )
    cleaned = clean_numbers(raw, ["amount", "percent", "words"])
    return clean_numbers(cleaned, ["filled"], fill=0)


def normalise_names(spark: SparkSession, sf: str) -> DataFrame:
    part = derived.table(spark, sf, "part")
    return part.select(
        "p_partkey",
        normalise_name(F.concat("p_type", F.lit(" +"))).alias("type_name"),
        normalise_name(F.concat(F.lit(" "), "p_brand", F.lit(" %"))).alias("brand_name"),
        normalise_name("p_name").alias("part_name"),
    )


_STMT = sql.stmt()
_COLS = ", ".join(["date", *MEASURES, "company_name"])
_LONG = " union all ".join(
    f"select company_name, {i} as row_no, '{m}' as line_item, date, {m} as value from stmt"
    for i, m in enumerate(MEASURES)
)
_NUMBERED = f"""cols as (
  select company_name, date, row_number() over (partition by company_name
    order by {sql.period_end()} nulls last, date) as col_no from stmt)"""

_NAME_SQL = (
    "regexp_replace(replace(translate(lower(trim({x}, ' ' || chr(160) || chr(9) || chr(10))), "
    "' ' || chr(160), '__'), '+', ''), '_+$', '')"
)


def _name(expr: str) -> str:
    return _NAME_SQL.format(x=f"replace({expr}, '%', 'percent')")


QUERIES = {
    "html_statement_roundtrip": (
        html_statement_roundtrip,
        f"with {_STMT} select {_COLS} from stmt",
    ),
    "html_statement_tolerant": (
        html_statement_tolerant,
        f"with {_STMT} select {_COLS} from stmt",
    ),
    "html_balance_sheet": (
        html_balance_sheet,
        f"""with {_STMT} select date, sales, net_profit, cast(0 as double) as reserves,
        company_name from stmt""",
    ),
    "html_statement_cells": (
        html_statement_cells,
        f"""with {_STMT}, {_NUMBERED}, long as ({_LONG})
        select l.company_name, l.row_no, l.line_item, c.col_no, l.date as period, l.value
        from long l join cols c on l.company_name = c.company_name and l.date = c.date""",
    ),
    "html_statement_matrix": (
        html_statement_matrix,
        f"""with {_STMT}, {_NUMBERED}, long as ({_LONG})
        select l.company_name, l.row_no, l.line_item, count(*) as n_values,
               string_agg(l.date, '|' order by c.col_no) as periods,
               string_agg(format('{{:,.2f}}', l.value), '|' order by c.col_no) as texts
        from long l join cols c on l.company_name = c.company_name and l.date = c.date
        group by 1, 2, 3""",
    ),
    "html_nested_tables": (html_nested_tables, f"with {_STMT} select {_COLS} from stmt"),
    "html_deep_tables": (html_deep_tables, f"with {_STMT} select {_COLS} from stmt"),
    "html_unlisted_items": (
        html_unlisted_items,
        f"""with {_STMT}, long as ({_LONG}) select company_name, line_item, date as period, value
        from long where line_item not in ('sales', 'net_profit')""",
    ),
    "html_rejected_rows": (
        html_rejected_rows,
        f"""with {_STMT} select company_name, {len(MEASURES)} as row_no, count(*) + 1 as expected,
        'Notes & remarks' as text from stmt group by company_name""",
    ),
    "html_statement_in_pages": (
        html_statement_in_pages,
        f"""with {_STMT} select date, {', '.join(MEASURES)}, page_id from stmt
        join pages on company_name = 'Customer#' || lpad(cast(page_id as varchar), 9, '0')""",
    ),
    "statement_transpose": (statement_transpose, f"with {_STMT} select {_COLS} from stmt"),
    "statement_unpivot": (
        statement_unpivot,
        f"with {_STMT}, long as ({_LONG}) select date, company_name, line_item, value from long",
    ),
    "concatenate_frames": (
        concatenate_frames,
        f"""with {sql.stmt('f', 'F')}, {sql.stmt('o', 'O')}
        select date, sales, interest, company_name, null as net_profit from f union all
        select date, sales, null, company_name, net_profit from o""",
    ),
    "clean_numbers": (
        clean_number_texts,
        """select o_orderkey, o_totalprice as amount,
        try_cast(substr(o_orderpriority, 1, 1) as double) as percent,
        try_cast(o_orderpriority as double) as words,
        coalesce(try_cast(o_orderstatus as double), 0) as filled from orders""",
    ),
    "normalise_names": (
        normalise_names,
        f"""select p_partkey, {_name("p_type || chr(160) || '+'")} as type_name,
        {_name("' ' || p_brand || ' %'")} as brand_name, {_name("p_name")} as part_name from part""",
    ),
}
