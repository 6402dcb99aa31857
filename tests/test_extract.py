from __future__ import annotations

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st

from conftest import plan_of, rows_of
from tallyline.functions import normalise_name
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
    rename_columns,
    transpose_statement,
    unlisted_items,
    unpivot_statement,
)
from tallyline.plans import derived
from tallyline.plans.queries.pages import html_deep_tables, html_statement_roundtrip, html_statement_tolerant
from tallyline.schema import COMPANY, MEASURES, statement_schema
from tallyline.sources import read_pages

PAGE = """<!DOCTYPE html><html><body><p>profit-loss</p>
<section id="quarters"><table><tr><th></th><th>Jun 2020</th></tr>
<tr><td>Sales</td><td>999</td></tr></table></section>
<SECTION class="card" ID='profit-loss'>
 <h2>Profit &amp; Loss</h2>
 <table class="data-table">
  <thead><tr><th class="text"></th><th>Mar 2013</th>
   <th><b>Mar</b> 2014 </th><th>TTM</th></tr></thead>
  <tbody>
  <tr class="stripe"><td class="text"><button>Sales&nbsp;<span>+</span></button></td>
   <td>27,004</td><td> 29,234</td><td>&#49;&#x32;</td></tr>
  <tr><td>OPM %</td><td>16%</td><td><!-- <td>7</td> -->16%</td><td></td></tr>
  <tr><td>Short</td><td>1</td></tr>
  <tr><td>Net Profit&#160;+</td><td>3,839</td><td>n/a</td><td>5<script>var x="</td>";</script></td></tr>
  </tbody></table>
 <table><tr><th></th><th>Mar 1999</th></tr><tr><td>Sales</td><td>1</td></tr></table>
</SECTION></body></html>"""


@pytest.fixture()
def pages(spark):
    rows = [
        (1, "u1", PAGE),
        (2, "u2", "<html><p>profit-loss</p><table><tr><th>x</th></tr></table></html>"),
        (3, "u3", '<section id="profit-loss"><p>no table</p></section>'),
        (4, "u4", '<section id="profit-loss-old"><table><tr><th></th><th>a</th></tr>'
         "<tr><td>Sales</td><td>1</td></tr></table></section>"),
        (5, "u5", '<section id=profit-loss><table><tr><th>&nbsp;<th>Mar 2015<tr><td>Sales<td>7</table>'),
        (6, "u6", None),
        (7, "u7", '<p>profit-loss</p><section id="PROFIT-LOSS"><table><tr><th></th><th>A</th></tr>'
         "<tr><td>Sales</td><td>7</td></tr></table></section>"),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


@pytest.mark.parametrize("tolerant", [False, True])
def test_cells(pages, tolerant):
    cells = extract_statement(pages.filter("page_id = 1"), tolerant=tolerant)
    assert rows_of(cells, "row_no", "line_item", "col_no", "period", "raw", "value") == sorted(
        [
            (0, "Sales +", 1, "Mar 2013", "27,004", 27004.0),
            (0, "Sales +", 2, "Mar 2014", "29,234", 29234.0),
            (0, "Sales +", 3, "TTM", "12", 12.0),
            (1, "OPM %", 1, "Mar 2013", "16%", 16.0),
            (1, "OPM %", 2, "Mar 2014", "16%", 16.0),
            (1, "OPM %", 3, "TTM", "", None),
            (3, "Net Profit +", 1, "Mar 2013", "3,839", 3839.0),
            (3, "Net Profit +", 2, "Mar 2014", "n/a", None),
            (3, "Net Profit +", 3, "TTM", "5", 5.0),
        ],
        key=repr,
    )


@pytest.mark.parametrize("tolerant", [False, True])
def test_only_the_named_section_counts(pages, tolerant):
    found = extract_statement(pages, tolerant=tolerant)
    assert rows_of(found.select("page_id").distinct()) == [(1,), (5,)]
    assert extract_statement(pages, BALANCE_SHEET).count() == 0


def test_end_tags_may_be_missing(pages):
    cells = extract_statement(pages.filter("page_id = 5"))
    assert rows_of(cells, "line_item", "period", "value") == [("Sales", "Mar 2015", 7.0)]


@pytest.mark.parametrize("tolerant", [False, True])
def test_rejected_rows(pages, tolerant):
    assert rows_of(rejected_rows(pages, tolerant=tolerant), "page_id", "row_no", "expected", "cells") == [
        (1, 2, 4, ["Short", "1"])
    ]


def test_blank_headers_get_a_name(pages, spark):
    html = '<section id="profit-loss"><table><tr><th></th><th> </th><th>B</th></tr>' \
        "<tr><td>x</td><td>1</td><td>2</td></tr></table></section>"
    page = spark.createDataFrame([(1, html)], "page_id long, html string")
    row = statement_matrix(page).collect()[0]
    assert (row.Narration, row.periods, row["values"]) == ("x", ["Column_1", "B"], ["1", "2"])


def test_load_is_narrow_and_agrees_with_the_transpose(pages):
    items = ["sales", "opm_percent", "net_profit", "missing"]
    loaded = load_statements(pages, "page_id", items=items)
    want = [
        ("Mar 2013", 27004.0, 16.0, 3839.0, None, 1),
        ("Mar 2014", 29234.0, 16.0, None, None, 1),
        ("Mar 2015", 7.0, None, None, None, 5),
        ("TTM", 12.0, None, 5.0, None, 1),
    ]
    assert rows_of(loaded) == want
    assert "Exchange" not in plan_of(loaded)
    turned = transpose_statement(extract_statement(pages), items)
    assert rows_of(turned, "date", *items, "page_id") == want
    filled = load_statements(pages, "page_id", items=items, fill=0)
    assert rows_of(filled.filter("date = 'TTM'")) == [("TTM", 12.0, 0.0, 5.0, 0.0, 1)]


def test_repeated_periods_and_items(spark):
    html = '<section id="profit-loss"><table><tr><th></th><th>A</th><th>A</th></tr>' \
        "<tr><td>Sales</td><td>1</td><td>2</td></tr><tr><td>Sales</td><td>3</td><td>4</td></tr>" \
        "<tr><td>Other</td><td>3</td><td>4</td></tr></table></section>"
    page = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert rows_of(load_statements(page, "page_id", items=["sales"])) == [("A", 1.0, 1), ("A", 2.0, 1)]
    cells = extract_statement(page)
    assert rows_of(transpose_statement(cells, ["sales"]), "date", "sales") == [("A", 1.0), ("A", 2.0)]
    assert unlisted_items(cells, ["sales"]).count() == 2


def test_rendered_pages_come_back(spark):
    row = tuple([float(i) * 1234.5 for i in range(len(MEASURES))])
    rows = [(p, *row, c) for c in ("A & B", "C") for p in ("Mar 2013", "Mar 2014", "TTM")]
    df = spark.createDataFrame(rows, statement_schema())
    assert rows_of(load_statements(derived.statement_pages(df), COMPANY)) == rows_of(df)


def test_names(spark):
    # Page labels and the columns they must become.
    labels = {
        "Sales\u00a0+": "sales",
        "Sales +": "sales",
        "Operating Profit": "operating_profit",
        "OPM %": "opm_percent",
        "Profit before tax": "profit_before_tax",
        "EPS in Rs": "eps_in_rs",
        "Dividend Payout %": "dividend_payout_percent",
        "  Tax % ": "tax_percent",
    }
    df = spark.createDataFrame([(k,) for k in labels], "label string")
    assert [r[0] for r in df.select(normalise_name("label")).collect()] == list(labels.values())
    headed = spark.createDataFrame([tuple("x" * 3)], ["Sales +", "OPM %", "Date"])
    assert rename_columns(headed, keep=["Date"]).columns == ["sales", "opm_percent", "Date"]


def test_reshape(spark):
    df = spark.createDataFrame([("A", "1,0", "5%"), ("B", "x", None)], "id string, p string, q string")
    assert rows_of(clean_numbers(df, ["p", "q"])) == [("A", 10.0, 5.0), ("B", None, None)]
    assert rows_of(clean_numbers(df, ["p", "q"], fill=0)) == [("A", 10.0, 5.0), ("B", 0.0, 0.0)]
    long = unpivot_statement(clean_numbers(df, ["p", "q"]), ["id"], ["p", "q"])
    assert rows_of(long) == [("A", "p", 10.0), ("A", "q", 5.0), ("B", "p", None), ("B", "q", None)]
    other = spark.createDataFrame([("C", 1.0)], "id string, r double")
    assert rows_of(concatenate([df, other])) == [
        ("A", "1,0", "5%", None), ("B", "x", None, None), ("C", None, None, 1.0)
    ]


def test_page_sources(spark, tmp_path, pages):
    pages.write.parquet(str(tmp_path / "p"))
    assert read_pages(spark, str(tmp_path / "p")).count() == 7
    folder = tmp_path / "html"
    folder.mkdir()
    (folder / "one.html").write_text(PAGE)
    (folder / "two.html").write_text("<p>\n\n</p>")
    files = read_pages(spark, str(folder), "text")
    assert files.count() == 2
    assert rows_of(load_statements(files, "url", items=["sales"]), "date", "sales") == [
        ("Mar 2013", 27004.0), ("Mar 2014", 29234.0), ("TTM", 12.0)
    ]


BLANKS = st.sampled_from(["", " ", "\n  ", "&nbsp;"])
TEXTS = st.sampled_from(["Sales +", "OPM %", "1,234", "7%", "", "a &amp; b", "&lt;x&gt;", "&#8377;5", "-3", "Zß"])
WRAPS = st.sampled_from(["{}", "<b>{}</b>", "<span class='x > y'>{}</span>", "<!-- n -->{}", "{}<br/>"])


@st.composite
def markup(draw):
    def cell(tag):
        upper = draw(st.booleans())
        inner = draw(BLANKS) + draw(WRAPS).format(draw(TEXTS)) + draw(BLANKS)
        end = draw(st.sampled_from([f"</{tag}>", f"</{tag} >", ""]))
        opening = f"<{tag} class=c>" if draw(st.booleans()) else f"<{tag}>"
        return (opening.upper() if upper else opening) + inner + end

    def line(tag, n):
        return "<tr>" + "".join(cell(tag) for _ in range(n)) + draw(st.sampled_from(["</tr>", ""]))

    width = draw(st.integers(0, 4))
    lines = [line("th", width)]
    lines += [line("td", draw(st.sampled_from([width, width, 1, 3]))) for _ in range(draw(st.integers(0, 4)))]
    quote = draw(st.sampled_from(["'", '"', ""]))
    table = "<table>" + "".join(lines) + "</table>" if draw(st.integers(0, 9)) else ""
    after = draw(st.sampled_from(["", "<table><tr><th>z</th></tr><tr><td>1</td></tr></table>"]))
    return f"<p>x</p><section a=b id={quote}profit-loss{quote}>{table}{after}</section>"


@settings(
    max_examples=6,
    deadline=None,
    phases=[Phase.generate],
    print_blob=False,
    suppress_health_check=list(HealthCheck),
)
@given(st.lists(markup(), min_size=20, max_size=40))
def test_both_forms_agree(spark, texts):
    pages = spark.createDataFrame(list(enumerate(texts)), "page_id long, html string")
    for read in (extract_statement, rejected_rows, statement_matrix):
        assert rows_of(read(pages)) == rows_of(read(pages, tolerant=True))
    items = ["sales", "opm_percent"]
    assert rows_of(load_statements(pages, "page_id", items=items)) == rows_of(
        load_statements(pages, "page_id", items=items, tolerant=True)
    )


def test_tables_inside_cells_need_the_tolerant_form(spark):
    inner = "<table><tr><td>9</td></tr></table>"
    html = '<section id="profit-loss"><table><tr><th></th><th>A</th></tr>' \
        f"<tr><td>Sales{inner}</td><td>1<script>'</td></table>'</script></td></tr>" \
        "<tr><td>Interest</td><td>&ne;2</td></tr></table></section>"
    page = spark.createDataFrame([(1, html)], "page_id long, html string")
    got = extract_statement(page, tolerant=True)
    assert rows_of(got, "line_item", "raw") == [("Interest", "\u22602"), ("Sales9", "1")]


def test_very_long_pages(spark):
    """Megabytes of markup before, inside and after the section, in one pass."""
    filler = "<p>x < y <b>section</b></p>" * 100_000
    body = "<tr><td>Sales</td><td>" + "<i>1</i>" * 50_000 + "</td></tr>"
    html = f'{filler}<section id="profit-loss">{filler}<table><tr><th></th><th>A</th></tr>{body}'
    page = spark.createDataFrame([(1, html + "</table>" + filler)], "page_id long, html string")
    row = extract_statement(page).collect()[0]
    assert (row.line_item, row.raw) == ("Sales", "1" * 50_000)


def nest(depth, text="x"):
    return f"<table><tr><td>{text}</td><th>y</th></tr>{nest(depth - 1)}</table>" if depth else ""


@pytest.mark.parametrize("inner", [nest(30), nest(1) * 3000, nest(2) + "<!-- </table> -->" + nest(7)])
def test_rows_behind_tables_of_any_depth_are_kept(spark, inner):
    html = (
        f"<section id='profit-loss'><p>x</p><table><tr><th>{inner}</th><th>Mar 2015</th></tr>"
        f"<tr><td>Sales</td><td>7{inner}</td></tr><tr><td>Interest</td><td>8</td></tr></table>"
        "<table><tr><td>Interest</td><td>9</td></tr></table></section>"
    )
    pages = spark.createDataFrame([("c", html)], f"{COMPANY} string, html string")
    cells = extract_statement(pages, carry=[COMPANY]).collect()
    texts = inner.count("<td>x")
    assert [(r["line_item"], r["raw"].count("x"), r["raw"][0]) for r in cells] == [("Sales", texts, "7"), ("Interest", 0, "8")]


def test_a_table_that_is_never_closed_reaches_to_the_end_of_the_section(spark):
    html = (
        "<section id='profit-loss'><table><tr><th></th><th>Mar 2015</th></tr><tr><td>Sales</td><td>7<table></td></tr>"
        "</table><tr><td>Interest</td><td>8</td></tr></section><table><tr><td>Tax</td><td>9</td></tr></table>"
    )
    pages = spark.createDataFrame([("c", html)], f"{COMPANY} string, html string")
    assert [(r["line_item"], r["raw"]) for r in extract_statement(pages, carry=[COMPANY]).collect()] == [
        ("Sales", "7"),
        ("Interest", "8"),
    ]


@pytest.mark.parametrize("query", [html_statement_roundtrip, html_deep_tables, html_statement_tolerant])
def test_pages_are_made_once(spark, query):
    # a filter on the page would be pushed below what makes it, and make it again
    assert plan_of(query(spark, "/root/testdata/sf0.001")).count("Statement</h2>") == 1
