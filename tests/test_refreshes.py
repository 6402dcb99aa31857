"""The three refreshes end to end on small tables."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from conftest import rows_of
from test_decode import envelope, log
from tallyline.operators.decode import decode_changes
from tallyline.plans.refreshes import average_statement, company_statement, indicator_statement
from tallyline.schema import (
    COMPANY,
    INDICATORS,
    MEASURES,
    PERIOD,
    statement_schema,
    whole_number_schema,
)


def row(period, value, company=None, **other):
    image = {PERIOD: period} | {m: value for m in MEASURES} | other
    return image | ({COMPANY: company} if company else {})


def stored(spark, images, with_company):
    schema = statement_schema(with_company)
    rows = [tuple(r.get(n) if n in (PERIOD, COMPANY) else _float(r[n]) for n in schema.names) for r in images]
    return spark.createDataFrame(rows, schema)


def _float(value):
    return None if value is None else float(value)


@pytest.fixture()
def one_company(spark):
    existing = stored(
        spark,
        [row("Mar 2011", 1), row("Mar 2012", 2), row("Mar 2013", 3), row("TTM", 100), row("Average", 55)],
        False,
    )
    changes = log(
        spark,
        [
            envelope(None, row("Mar 2014", 6), 1),
            envelope(row("Mar 2012", 2), row("Mar 2012", None, sales=20), 1),
            envelope(row("Mar 2013", 3), None, 1),
            envelope(None, row("Mar 2015", None, sales=8), 1),
            None,
        ],
    )
    return existing, decode_changes(changes, whole_number_schema(), [PERIOD])


def test_average_refresh(one_company):
    got = rows_of(average_statement(*one_company), PERIOD, "sales", "interest")
    assert got == [
        ("Average", (1 + 20 + 6 + 8) / 4, (1 + 2 + 6) / 3),
        ("Mar 2011", 1.0, 1.0),
        ("Mar 2012", 20.0, 2.0),
        ("Mar 2014", 6.0, 6.0),
        ("TTM", 100.0, 100.0),
    ]


def test_average_refresh_rounded_without_trailing(one_company):
    got = average_statement(*one_company, keep_trailing=False, digits=2, scale=4)
    assert rows_of(got, PERIOD, "sales") == [
        ("Average", 8.75), ("Mar 2011", 1.0), ("Mar 2012", 20.0), ("Mar 2014", 6.0)
    ]


def test_average_refresh_of_touched_rows(one_company):
    got = average_statement(*one_company, keep_existing=False)
    assert rows_of(got, PERIOD, "sales") == [
        ("Average", (20 + 6 + 8) / 3), ("Mar 2012", 20.0), ("Mar 2014", 6.0)
    ]


@pytest.fixture()
def companies(spark):
    existing = stored(
        spark,
        [row("Mar 2013", 10, "A"), row("Mar 2014", 20, "A"), row("Mar 2014", 5, "B"), row("TTM", 9, "B")],
        True,
    )
    changes = log(
        spark,
        [
            envelope(row("Mar 2014", 5, "B"), None, 2),
            envelope(None, row("Mar 2015", 30, "A"), 2),
            envelope(row("Mar 2015", 30, "A"), row("Mar 2015", 40, "A"), 3),
            envelope(None, row("TTM", 50, "A"), 3),
            envelope(None, row("Mar 2013", 0, "C"), 1),
        ],
    )
    return existing, decode_changes(changes, statement_schema(), [PERIOD, COMPANY])


def test_company_refresh_deletes_one_company_only(companies):
    got = company_statement(*companies)
    assert rows_of(got, COMPANY, PERIOD, "sales") == [
        ("A", "Mar 2013", 10.0), ("A", "Mar 2014", 20.0), ("A", "Mar 2015", 40.0), ("C", "Mar 2013", 0.0)
    ]


def test_indicator_refresh(companies):
    got = indicator_statement(*companies)
    assert got.columns == statement_schema().names + INDICATORS
    picked = rows_of(got, COMPANY, PERIOD, "net_profit_margin", "yoy_sales_growth")
    assert picked == [
        ("A", "Mar 2013", 100.0, None),
        ("A", "Mar 2014", 100.0, 100.0),
        ("A", "Mar 2015", 100.0, 100.0),
        ("C", "Mar 2013", None, None),
    ]


def test_refreshes_are_repeatable(companies):
    existing, events = companies
    once = company_statement(existing, events)
    assert rows_of(company_statement(once, events)) == rows_of(once)
    assert once.schema["sales"].dataType == T.DoubleType()
