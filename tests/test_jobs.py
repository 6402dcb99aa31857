"""The programs, run inside the test session."""

from __future__ import annotations

import pytest

from conftest import rows_of
from test_decode import envelope
from test_extract import PAGE
from test_refreshes import row
from tallyline.jobs import pages as pages_job
from tallyline.jobs import refresh as refresh_job
from tallyline.schema import COMPANY, PERIOD, indicator_schema, statement_schema
from tallyline.sources import read_statements_csv
from tallyline.sources.readers import CHANGE_SCHEMA


def write_log(spark, path, values):
    records = [(v, 0, i) for i, v in enumerate(values)]
    spark.createDataFrame(records, CHANGE_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(spark, tmp_path, kind, *extra):
    args = refresh_job.arguments(
        ["--kind", kind, "--base", str(tmp_path / "base"), "--log-format", "parquet",
         "--log-path", str(tmp_path / "log"), "--option", "maxFilesPerTrigger=1",
         "--buckets", "4", "--csv", str(tmp_path / "csv"), *extra]
    )
    query, refresh = refresh_job.start(spark, args)
    query.awaitTermination()
    refresh_job.write_result(args, refresh)


def test_indicator_job(spark, tmp_path):
    log = str(tmp_path / "log")
    write_log(spark, log, [envelope(None, row("Mar 2013", 10, "A"), 1), envelope(None, row("TTM", 9, "A"), 1)])
    write_log(spark, log, [envelope(None, row("Mar 2014", 15, "A"), 2), "junk"])
    run(spark, tmp_path, "indicators")
    got = read_statements_csv(spark, str(tmp_path / "csv"), indicator_schema())
    assert rows_of(got, PERIOD, "sales", "yoy_sales_growth") == [
        ("Mar 2013", 10.0, None), ("Mar 2014", 15.0, 50.0)
    ]
    write_log(spark, log, [envelope(row("Mar 2013", 10, "A"), row("Mar 2013", 30, "A"), 3)])
    run(spark, tmp_path, "indicators")
    got = read_statements_csv(spark, str(tmp_path / "csv"), indicator_schema())
    assert rows_of(got, PERIOD, "yoy_sales_growth") == [("Mar 2013", None), ("Mar 2014", -50.0)]


def test_job_starts_from_stored_rows(spark, tmp_path):
    stored = [(f"Mar 201{i}", *[10.0 * (i + 1)] * 12, "A") for i in range(3)]
    spark.createDataFrame(stored, statement_schema()).write.parquet(str(tmp_path / "stored"))
    log = str(tmp_path / "log")
    write_log(spark, log, [envelope(None, row("Mar 2012", 60, "A"), 3)])
    for _ in range(2):  # a second start loads nothing anew
        run(spark, tmp_path, "indicators", "--load", str(tmp_path / "stored"))
        got = read_statements_csv(spark, str(tmp_path / "csv"), indicator_schema())
        assert rows_of(got, PERIOD, "sales", "yoy_sales_growth") == [
            ("Mar 2010", 10.0, None), ("Mar 2011", 20.0, 100.0), ("Mar 2012", 60.0, 200.0)
        ]


def test_company_job_applies_deletes(spark, tmp_path):
    log = str(tmp_path / "log")
    write_log(spark, log, [envelope(None, row("Mar 2013", v, c), 1) for v, c in ((1, "A"), (2, "B"))])
    write_log(spark, log, [envelope(row("Mar 2013", 1, "A"), None, 2)])
    run(spark, tmp_path, "company")
    got = read_statements_csv(spark, str(tmp_path / "csv"))
    assert rows_of(got, COMPANY, "sales") == [("B", 2.0)]


@pytest.mark.parametrize("whole", [False, True])
def test_average_job(spark, tmp_path, whole):
    log = str(tmp_path / "log")
    values = [envelope(None, row(f"Mar 201{i}", i), 1) for i in range(4)]
    write_log(spark, log, [*values, envelope(None, row("TTM", 50), 1)])
    run(spark, tmp_path, "average", *(["--whole-numbers"] if whole else []))
    got = read_statements_csv(spark, str(tmp_path / "csv"), statement_schema(False))
    assert [r[PERIOD] for r in got.collect()][-1] == "Average"
    assert rows_of(got, PERIOD, "net_profit")[0] == ("Average", 1.5)
    assert got.count() == 5


def test_pages_job(spark, tmp_path):
    pages = spark.createDataFrame([(1, "A", PAGE)], "page_id long, url string, html string")
    pages.write.parquet(str(tmp_path / "pages"))
    base = ["--pages", str(tmp_path / "pages"), "--items", "sales", "net_profit", "--fill", "0"]
    rejected = str(tmp_path / "rejected")
    out = str(tmp_path / "out")
    pages_job.run(spark, pages_job.arguments([*base, "--out", out, "--rejected", rejected]))
    assert rows_of(spark.read.parquet(out)) == [
        ("Mar 2013", 27004.0, 3839.0, "A"), ("Mar 2014", 29234.0, 0.0, "A"), ("TTM", 12.0, 5.0, "A")
    ]
    assert spark.read.parquet(rejected).count() == 1
    csv = str(tmp_path / "csv")
    pages_job.run(spark, pages_job.arguments([*base, "--csv", csv, "--tolerant"]))
    assert spark.read.option("header", "true").csv(csv).count() == 3
    pages_job.run(spark, pages_job.arguments([*base, "--table", "t_pages"]))
    assert spark.table("t_pages").count() == 3
