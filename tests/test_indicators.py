from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows_of
from tallyline.functions import decimal_mean, parse_number, period_end, round_to
from tallyline.operators.filters import (
    complete_rows,
    exclude_prefix,
    keyed_rows,
    order_statements,
    order_summary_last,
)
from tallyline.operators.indicators import Growth, Ratio, with_indicators
from tallyline.operators.previous import with_previous
from tallyline.operators.summary import append_summary, average_rows, averages


def statement(spark, rows):
    return spark.createDataFrame(rows, "date string, company_name string, sales double, interest double")


def test_zero_base_is_null(spark):
    df = statement(spark, [("Mar 2013", "A", 0.0, 0.0), ("Mar 2014", "A", 5.0, 1.0)])
    specs = [Ratio("r", "sales", "interest"), Growth("g", "sales")]
    assert rows_of(with_indicators(df, specs), "date", "r", "g") == [
        ("Mar 2013", None, None),
        ("Mar 2014", 5.0, None),
    ]


def test_growth_keeps_the_sign_of_a_negative_base(spark):
    df = statement(spark, [("Mar 2016", "A", -37.0, 0.0), ("Mar 2017", "A", 455.0, 0.0)])
    got = rows_of(with_indicators(df, [Growth("g", "sales")]), "date", "g")
    assert got[1] == ("Mar 2017", -1329.73)


def test_growth_follows_the_calendar_not_the_label(spark):
    df = statement(
        spark,
        [("Jun 2013", "A", 100.0, 0.0), ("Dec 2012", "A", 50.0, 0.0), ("Mar 2014", "A", 110.0, 0.0)],
    )
    got = dict(rows_of(with_indicators(df, [Growth("g", "sales")]), "date", "g"))
    assert got == {"Dec 2012": None, "Jun 2013": 100.0, "Mar 2014": 10.0}


def test_no_growth_means_no_shuffle(spark):
    df = statement(spark, [("Mar 2013", "A", 1.0, 1.0)])
    plan = plan_of(with_indicators(df, [Ratio("r", "sales", "interest")]))
    assert "Exchange" not in plan and "Window" not in plan
    grown = plan_of(with_indicators(df, [Growth("g", "sales"), Growth("h", "interest")]))
    assert grown.count("Exchange") == 1 and grown.count("Window [") == 1


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_chunked_previous_equals_plain(spark, seed):
    rng = random.Random(seed)
    ids = rng.sample(range(2000), 300)
    rows = [(rng.choice(["a", "a", "a", "b", None]), i, rng.choice([None, float(i)])) for i in ids]
    df = spark.createDataFrame(rows, "g string, t long, v double")
    plain = with_previous(df, ["g"], [F.col("t")], ["v"])
    for width in (7, 100, 5000):
        chunk = (F.col("t") / width).cast("long")
        spread = with_previous(df, ["g"], [F.col("t")], ["v"], chunk=chunk)
        assert spread.columns == plain.columns
        assert rows_of(spread) == rows_of(plain)


def test_rounding_is_half_up_on_the_text(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,), (0.125,)], "x double")
    got = [r[0] for r in df.select(round_to(F.col("x"), 2)).collect()]
    assert got == [1.01, 2.68, -1.01, 0.13]


def test_period_end(spark):
    df = spark.createDataFrame([("Mar 2013",), ("Feb 2016",), ("TTM",), (None,), ("P3",)], "d string")
    got = [str(r[0]) for r in df.select(period_end("d")).collect()]
    assert got == ["2013-03-31", "2016-02-29", "None", "None", "None"]


def test_parse_number(spark):
    texts = ["1,234", "24%", "", " ", "-1,2.5", "(3)", "x", None, "1e3", "12,34,567.8"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parse_number("t")).collect()]
    assert got == [1234.0, 24.0, None, None, -12.5, None, None, None, 1000.0, 1234567.8]


def test_filters(spark):
    df = statement(
        spark,
        [("Mar 2013", "A", 1.0, None), ("TTM", "A", 2.0, 1.0), (None, "A", 3.0, 1.0), ("Average", None, 4.0, 1.0)],
    )
    assert rows_of(exclude_prefix(df), "sales") == [(1.0,), (4.0,)]
    assert rows_of(complete_rows(df, ["date", "sales", "interest"]), "sales") == [(2.0,), (4.0,)]
    assert rows_of(keyed_rows(df, ["date", "company_name"]), "sales") == [(1.0,), (2.0,)]
    ordered = [r.date for r in order_summary_last(df).collect()]
    assert ordered[-1] == "Average"
    assert [r.sales for r in order_statements(df.filter("date is not null")).collect()] == [4.0, 2.0, 1.0]


def test_average_rows(spark):
    df = statement(
        spark,
        [("Mar 2013", "A", 1.0, 2.0), ("Mar 2014", "A", 2.0, None), ("Mar 2014", "B", 4.0, 0.005),
         ("TTM", "A", 100.0, 100.0), ("Average", None, 50.0, 50.0)],
    )
    cols = ["sales", "interest"]
    assert rows_of(average_rows(df, cols, digits=2)) == [("Average", 2.33, 1.0)]
    assert rows_of(average_rows(df, cols, by=["company_name"])) == [
        ("Average", "A", 1.5, 2.0), ("Average", "B", 4.0, 0.005)
    ]
    summed = append_summary(df, cols, digits=2)
    assert summed.filter("date = 'Average'").count() == 1
    assert summed.count() == 5
    assert rows_of(append_summary(summed, cols, digits=2)) == rows_of(summed)


def test_decimal_mean_does_not_depend_on_partitioning(spark):
    rng = random.Random(5)
    rows = [(round(rng.uniform(-1e6, 1e6), 2),) for _ in range(5000)]
    df = spark.createDataFrame(rows, "x double")
    means = {df.repartition(n).agg(decimal_mean("x", 2)).collect()[0][0] for n in (1, 2, 7, 16)}
    assert len(means) == 1


def test_average_of_nothing_is_null(spark):
    assert rows_of(averages(statement(spark, []), ["sales"], digits=2)) == [(None,)]
