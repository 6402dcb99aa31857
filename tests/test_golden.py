"""Indicators against recorded results.

The rows below are fixed values.  The complete recorded tables are not part of
this repository; point ``STATEMENTS_CSV``, ``INDICATORS_CSV`` and ``LEGACY_CSV`` at
them to compare every cell.
"""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions import is_trailing
from tallyline.operators.decode import decode_changes
from tallyline.operators.filters import exclude_prefix
from tallyline.operators.indicators import LEGACY, STANDARD, with_indicators
from tallyline.plans import derived
from tallyline.plans.refreshes import indicator_statement
from tallyline.schema import COMPANY, INDICATORS, PERIOD, indicator_schema, statement_schema
from tallyline.sources import read_statements_csv

# Statement rows in table order.
STATEMENTS = [
    ("Mar 2013", 27004, 22784, 4220, 16, 1123, 26, 251, 5066, 24.0, 3839, 17.71, 104.0, "HINDUNILVR"),
    ("Mar 2014", 29234, 24475, 4759, 16, 792, 41, 296, 5215, 24.0, 3956, 18.24, 71.0, "HINDUNILVR"),
    ("Mar 2013", 6185, 5765, 421, 7, 52, 41, 73, 358, 27.0, 260, 10.85, 39.0, "BRITANNIA"),
    ("Mar 2014", 6913, 6286, 627, 9, 34, 8, 83, 569, 30.0, 395, 16.48, 36.0, "BRITANNIA"),
]
# Their indicators, in output order.
EXPECTED = {
    ("BRITANNIA", "Mar 2013"): (4.2, 6.81, 96.66, 4.23, 10.27, None, None),
    ("BRITANNIA", "Mar 2014"): (5.71, 9.07, 170.7, 5.93, 78.38, 11.77, 51.92),
}
# Growth of the other company's second year.
EXPECTED_GROWTH = {("HINDUNILVR", "Mar 2013"): (None, None), ("HINDUNILVR", "Mar 2014"): (8.26, 3.05)}


@pytest.fixture(scope="module")
def statements(spark):
    rows = [tuple(float(v) if isinstance(v, int) else v for v in r) for r in STATEMENTS]
    return spark.createDataFrame(rows, statement_schema())


def _by_key(df, columns):
    return {(r[COMPANY], r[PERIOD]): tuple(r[c] for c in columns) for r in df.collect()}


def test_recorded_rows(statements):
    got = _by_key(with_indicators(statements), INDICATORS)
    for key, values in EXPECTED.items():
        assert got[key] == values
    for key, values in EXPECTED_GROWTH.items():
        assert got[key][5:] == values


def test_recorded_rows_through_the_change_log(spark, statements):
    empty = spark.createDataFrame([], statement_schema())
    log = derived.statement_log(statements)
    events = decode_changes(log, statement_schema(), [PERIOD, COMPANY])
    got = _by_key(indicator_statement(empty, events), INDICATORS)
    for key, values in EXPECTED.items():
        assert got[key] == values


def test_decimal_money_gives_the_same_indicators(statements):
    kind = T.DecimalType(18, 2)
    exact = statement_schema(measure_type=kind)
    cast = statements.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in exact])
    plain = _by_key(with_indicators(statements), INDICATORS)
    assert _by_key(with_indicators(cast), INDICATORS) == plain
    log = derived.statement_log(statements)
    decoded = decode_changes(log, exact, [PERIOD, COMPANY])
    assert decoded.schema["sales"].dataType == kind
    empty = statements.sparkSession.createDataFrame([], exact)
    assert _by_key(indicator_statement(empty, decoded), INDICATORS) == plain


def _csv(variable: str) -> str:
    path = os.environ.get(variable)
    if not path:
        pytest.skip(f"{variable} is not set")
    return path


def test_all_recorded_indicators(spark):
    rows = read_statements_csv(spark, _csv("STATEMENTS_CSV"))
    want = read_statements_csv(spark, _csv("INDICATORS_CSV"), indicator_schema())
    for got in (
        with_indicators(exclude_prefix(rows)),
        indicator_statement(
            spark.createDataFrame([], statement_schema()),
            decode_changes(derived.statement_log(rows), statement_schema(), [PERIOD, COMPANY]),
        ),
    ):
        got = got.select(*want.columns)
        assert got.count() == want.count() > 0
        assert got.exceptAll(want).count() == 0


def test_all_recorded_legacy_indicators(spark):
    """Columns 15-17, 19, 21 and 22 of the older headless table."""
    rows = read_statements_csv(spark, _csv("STATEMENTS_CSV"))
    fields = [f for f in statement_schema()] + [
        T.StructField(f"c{i}", T.DoubleType()) for i in range(15, 27)
    ]
    want = spark.read.schema(T.StructType(fields)).csv(_csv("LEGACY_CSV"))
    got = with_indicators(rows, [*STANDARD[:2], LEGACY[0], STANDARD[2], LEGACY[1], STANDARD[4]])
    want = want.select(*got.columns[:14], "c15", "c16", "c17", "c19", "c21", "c22").toDF(*got.columns)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0


def test_trailing_rows_never_serve_as_base(spark, statements):
    trailing = statements.filter(F.col(PERIOD) == "Mar 2014").withColumn(PERIOD, F.lit("TTM"))
    rows = exclude_prefix(statements.unionByName(trailing))
    assert rows.filter(is_trailing()).count() == 0
    assert _by_key(with_indicators(rows), INDICATORS)[("BRITANNIA", "Mar 2014")][5] == 11.77
