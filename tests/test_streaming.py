from __future__ import annotations

import decimal
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows_of
from test_decode import KEYS, ROW, envelope, image
from tallyline.functions.numbers import exact_sums
from tallyline.operators.compact import compact
from tallyline.operators.decode import (
    decode_changes,
    keyed_events,
    parse_envelopes,
    unkeyed_records,
    upserts,
    without_keyed_text,
)
from tallyline.operators.filters import exclude_prefix
from tallyline.operators.indicators import Growth, Ratio, with_indicators
from tallyline.operators.summary import average_rows
from tallyline.plans.queries.refresh import _stored_log
from tallyline.schema import COMPANY, CONTROL, PERIOD
from tallyline.sinks import Snapshot
from tallyline.sources import read_changes
from tallyline.sources.readers import CHANGE_SCHEMA
from tallyline.streaming import (
    Averages,
    ChangedIndicators,
    Indicators,
    Refresh,
    moved_average,
    moved_sums,
    run_refresh,
)

ROW_ORDER = [PERIOD, "sales", "interest", COMPANY]
SPECS = [Ratio("r", "sales", "interest"), Growth("g", "sales")]


def random_log(seed, n=120):
    rng = random.Random(seed)
    values = []
    for _ in range(n):
        key = (f"Mar 20{rng.randint(10, 14)}", rng.choice("ABC"))
        if rng.random() < 0.05:
            key = ("TTM", key[1])
        row = image(*key, sales=float(rng.randint(0, 9)), interest=float(rng.randint(0, 3)))
        kind = rng.random()
        ts = rng.randint(1, 40)
        if kind < 0.2:
            values.append(envelope(row, None, ts))
        elif kind < 0.25:
            values.append(rng.choice([None, "junk", json.dumps({"payload": None})]))
        else:
            values.append(envelope(row if kind < 0.6 else None, row, ts))
    return [(v, 0, i) for i, v in enumerate(values)]


def write_files(spark, records, path, files):
    """One file per call, so that micro-batches get them one by one."""
    step = -(-len(records) // files)
    for start in range(0, len(records), step):
        part = spark.createDataFrame(records[start : start + step], CHANGE_SCHEMA)
        part.coalesce(1).write.mode("append").parquet(path)


def batch_result(spark, records):
    log = spark.createDataFrame(records, CHANGE_SCHEMA)
    return upserts(compact(decode_changes(log, ROW, KEYS), KEYS)).drop(*CONTROL)


@pytest.fixture()
def places(tmp_path):
    return {n: str(tmp_path / n) for n in ("log", "state", "ind", "avg", "check", "dead")}


def start(spark, places, after=(), state=None):
    snap = state or Snapshot(spark, places["state"], ROW, KEYS, 4, bucket_by=[COMPANY])
    changes = read_changes(spark, "parquet", places["log"], streaming=True, maxFilesPerTrigger="1")
    refresh = Refresh(snap, ROW, KEYS, dead_letter_path=places["dead"], after=list(after))
    query = run_refresh(changes, refresh, places["check"])
    query.awaitTermination()
    return snap


def test_stream_equals_batch_and_resumes(spark, places):
    records = random_log(1)
    shuffled = records[:]
    random.Random(7).shuffle(shuffled)
    write_files(spark, shuffled[:80], places["log"], 2)
    after = [
        Indicators(spark, places["ind"], ROW, 4, SPECS),
        Averages(spark, places["avg"], ["sales", "interest"], 4),
    ]
    snap = start(spark, places, after)
    first = snap.version()
    assert rows_of(snap.read()) == rows_of(batch_result(spark, shuffled[:80]))
    # Nothing new: the checkpoint knows, no version is written.
    start(spark, places, after)
    assert snap.version() == first
    write_files(spark, shuffled[80:], places["log"], 1)
    start(spark, places, after)
    want = batch_result(spark, records)
    assert rows_of(snap.read()) == rows_of(want)
    indicators, averages = after
    assert rows_of(indicators.read()) == rows_of(with_indicators(exclude_prefix(want), SPECS))
    cols = ["sales", "interest"]
    assert rows_of(averages.average(2)) == rows_of(average_rows(want, cols, digits=2, scale=4))
    letters = spark.read.parquet(places["dead"])
    junk = sum(1 for v, *_ in records if v is not None and '"source"' not in v)
    assert letters.count() == junk


def test_a_failed_step_stops_the_query_and_a_restart_repairs(spark, places):
    write_files(spark, random_log(2), places["log"], 2)
    indicators = Indicators(spark, places["ind"], ROW, 4, SPECS)

    def broken(snapshot, version):
        raise RuntimeError("sink is down")

    with pytest.raises(Exception, match="sink is down"):
        start(spark, places, [broken, indicators])
    snap = start(spark, places, [indicators])
    want = batch_result(spark, random_log(2))
    assert rows_of(snap.read()) == rows_of(want)
    assert rows_of(indicators.read()) == rows_of(with_indicators(exclude_prefix(want), SPECS))


def test_indicators_need_the_snapshot_bucketed_by_company(spark, places):
    write_files(spark, random_log(3, 20), places["log"], 1)
    wrong = Snapshot(spark, places["state"], ROW, KEYS, 4)
    with pytest.raises(Exception, match="buckets"):
        start(spark, places, [Indicators(spark, places["ind"], ROW, 4, SPECS)], wrong)


def test_a_running_query_picks_up_new_files(spark, places):
    records = random_log(4, 60)
    write_files(spark, records[:30], places["log"], 1)
    snap = Snapshot(spark, places["state"], ROW, KEYS, 4)
    changes = read_changes(spark, "parquet", places["log"], streaming=True)
    query = run_refresh(changes, Refresh(snap, ROW, KEYS), places["check"], every="1 second")
    try:
        query.processAllAvailable()
        assert rows_of(snap.read()) == rows_of(batch_result(spark, records[:30]))
        write_files(spark, records[30:], places["log"], 1)
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows_of(snap.read()) == rows_of(batch_result(spark, records))


def test_coalesce_mode_in_order(spark, places):
    """Batches in event order: a NULL keeps the stored value across batches."""
    first = [(envelope(None, image("Mar 2013", "A", 1.0, 2.0), 1), 0, 0)]
    second = [(envelope(None, image("Mar 2013", "A", None, 3.0), 2), 0, 1)]
    write_files(spark, first, places["log"], 1)
    write_files(spark, second, places["log"], 1)
    snap = Snapshot(spark, places["state"], ROW, KEYS, 4)
    changes = read_changes(spark, "parquet", places["log"], streaming=True, maxFilesPerTrigger="1")
    refresh = Refresh(snap, ROW, KEYS, "coalesce", keep_versions=1)
    run_refresh(changes, refresh, places["check"]).awaitTermination()
    assert snap.versions() == [2]
    assert rows_of(snap.read(), "sales", "interest") == [(1.0, 3.0)]


def test_tables_that_follow_catch_up(spark, places):
    """After a load, when added late, and when they expire with the snapshot."""
    rows = [(f"Mar 20{10 + i % 5}", float(i), 1.0, f"C{i // 5}") for i in range(50)]
    stored = spark.createDataFrame(rows, ROW_ORDER).select(*ROW.names)
    snap = Snapshot(spark, places["state"], ROW, KEYS, 4, bucket_by=[COMPANY])
    snap.load(stored)
    write_files(spark, random_log(5, 60), places["log"], 3)
    early = Indicators(spark, places["ind"], ROW, 4, SPECS)
    start(spark, places, [early], snap)
    late = Averages(spark, places["avg"], ["sales", "interest"], 4, scale=4)
    late(snap, snap.version())
    want = snap.read()
    assert want.count() > 50
    assert rows_of(early.read()) == rows_of(with_indicators(exclude_prefix(want), SPECS))
    cols = ["sales", "interest"]
    assert rows_of(late.average(2)) == rows_of(average_rows(want, cols, digits=2, scale=4))
    changes = read_changes(spark, "parquet", places["log"], streaming=True, maxFilesPerTrigger="1")
    write_files(spark, random_log(6, 40), places["log"], 4)
    refresh = Refresh(snap, ROW, KEYS, keep_versions=2, after=[early, late])
    run_refresh(changes, refresh, places["check"]).awaitTermination()
    assert len(snap.versions()) == len(early.table.versions()) == len(late.table.versions()) == 2
    assert rows_of(early.read()) == rows_of(with_indicators(exclude_prefix(snap.read()), SPECS))


def test_buckets_that_empty_leave_the_following_table(spark, places):
    snap = Snapshot(spark, places["state"], ROW, KEYS, 4, bucket_by=[COMPANY])
    indicators = Indicators(spark, places["ind"], ROW, 4, SPECS)
    some = [("Mar 2013", 1.0, 1.0, c) for c in "ABCDEFGH"]
    indicators(snap, snap.load(spark.createDataFrame(some, ROW_ORDER).select(*ROW.names)))
    indicators(snap, snap.load(spark.createDataFrame(some[:1], ROW_ORDER).select(*ROW.names)))
    assert rows_of(indicators.read(), COMPANY) == [("A",)]


@pytest.mark.parametrize("scale", [None, 4])
def test_averages_of_large_and_small_values(spark, places, scale):
    snap = Snapshot(spark, places["state"], ROW, KEYS, 4, bucket_by=[COMPANY])
    rows = [("Mar 2013", 1e25, 0.00004, "A"), ("Mar 2014", 3e25, 0.00004, "B")]
    averages = Averages(spark, places["avg"], ["sales", "interest"], 4, scale=scale)
    averages(snap, snap.load(spark.createDataFrame(rows, ROW_ORDER).select(*ROW.names)))
    [got] = averages.average().collect()
    assert got["sales"] == pytest.approx(2e25) and got["interest"] == pytest.approx(0.00004)


@pytest.mark.parametrize("scale", [0, 2, 4, 9])
def test_exact_sums_against_decimals(spark, scale, monkeypatch):
    """Whole units, values with more places, too large ones and no numbers, by sign."""
    rng = random.Random(scale)
    values = [rng.randint(-(10**15), 10**15) / 10 ** rng.randint(0, 8) for _ in range(300)]
    values += [float(rng.randint(-999, 999) * 10**17) for _ in range(50)]
    values += [None, float("nan"), float("inf"), -0.0, 1e300, 0.1 + 0.2, 2.675, 999999999999999.9]
    rows = spark.createDataFrame([(i % 40, v, 1 - 2 * (i % 2)) for i, v in enumerate(values)], "g int, v double, s int")
    sums = [c.alias(n) for n, c in zip(("total", "others"), exact_sums(F.col("v"), scale, F.col("s")), strict=True)]
    unit = decimal.Decimal(1).scaleb(-scale)
    monkeypatch.setattr(decimal.getcontext(), "prec", 60)
    for g, total, others in rows.groupBy("g").agg(*sums).collect():
        mine = [(v, 1 - 2 * (i % 2)) for i, v in enumerate(values) if i % 40 == g and v is not None]
        want, beyond = [], 0
        for v, sign in mine:
            exact = decimal.Decimal(repr(v)) if math.isfinite(v) and abs(v) < 10.0 ** (28 - scale) else None
            held = exact is not None and float(exact.quantize(unit, decimal.ROUND_HALF_UP)) == v
            want += [sign * exact.quantize(unit, decimal.ROUND_HALF_UP)] if held else []
            beyond += not held
        assert (total, others) == (sum(want) if want else None, beyond)


def test_small_values_are_summed_without_a_decimal_each(spark):
    """A decimal per value and measure took most of the time of an average."""
    exact, _ = exact_sums(F.col("v"), 4)
    summed = exact.alias("total")
    plan = plan_of(spark.range(3).select((F.col("id") / 4).alias("v")).agg(summed))
    assert "shiftright(" in plan


def test_a_quarter_of_the_log_has_a_file_per_core(spark):
    log = spark.range(2000).select(F.lit("x").alias("value"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    path, quarter = _stored_log(spark, log)
    cores = spark.sparkContext.defaultParallelism
    assert int(quarter) >= cores and len(spark.read.parquet(path).inputFiles()) == 4 * int(quarter)
    assert spark.read.parquet(path).count() == 2000


def test_keyed_records_are_kept_without_their_text(spark):
    parsed = parse_envelopes(spark.createDataFrame(random_log(3), CHANGE_SCHEMA), ROW, KEYS)
    held = without_keyed_text(parsed, KEYS)
    assert rows_of(unkeyed_records(held, KEYS)) == rows_of(unkeyed_records(parsed, KEYS))
    assert rows_of(keyed_events(held, ROW, KEYS)) == rows_of(keyed_events(parsed, ROW, KEYS))
    assert held.filter("value is not null and event.after.date is not null").count() == 0


def test_only_changed_periods_and_their_successors_move(spark, places):
    snap = Snapshot(spark, places["state"], ROW, KEYS, 4, bucket_by=[COMPANY])
    rows = [(f"Mar 20{10 + i % 8}", float(i + 1), 1.0, f"C{i // 8}") for i in range(40)]
    stored = spark.createDataFrame(rows, ROW_ORDER).select(*ROW.names)
    moved = ChangedIndicators(spark, places["ind"], ROW, KEYS, 4, SPECS)
    moved(snap, snap.load(stored))

    def after(*records):
        log = spark.createDataFrame([(v, 0, i) for i, v in enumerate(records)], CHANGE_SCHEMA)
        last = snap.version()
        version = snap.apply(decode_changes(log, ROW, KEYS))
        sent = rows_of(moved.changes(snap, last, version), PERIOD, COMPANY, "_deleted")
        moved(snap, version)
        moved(snap, version)
        assert rows_of(moved.read()) == rows_of(with_indicators(exclude_prefix(snap.read()), SPECS))
        return sent

    one = image("Mar 2012", "C1", 99.0, 1.0)
    assert after(envelope(None, one, 1)) == [("Mar 2012", "C1", False), ("Mar 2013", "C1", False)]
    assert after(envelope(one, one, 2)) == []
    # interest alone changes no growth
    assert after(envelope(one, image("Mar 2012", "C1", 99.0, 7.0), 3)) == [("Mar 2012", "C1", False)]
    assert after(envelope(one, None, 4)) == [("Mar 2012", "C1", True), ("Mar 2013", "C1", False)]
    # between two periods, and a first one that has no value
    assert after(envelope(None, image("Mar 2012", "C1", None, 1.0), 5)) == [
        ("Mar 2012", "C1", False), ("Mar 2013", "C1", False)
    ]
    last = image("Mar 2017", "C2", 1.0, 1.0)
    assert after(envelope(last, None, 6), envelope(None, image("TTM", "C2", 1.0, 1.0), 6)) == [("Mar 2017", "C2", True)]
    # the version it was built from has gone: built anew
    snap.apply(decode_changes(spark.createDataFrame([(envelope(None, last, 7), 0, 0)], CHANGE_SCHEMA), ROW, KEYS))
    snap.expire(1)
    moved(snap, snap.version())
    assert rows_of(moved.read()) == rows_of(with_indicators(exclude_prefix(snap.read()), SPECS))


def test_averages_move_by_images_in_any_order(spark):
    a, b = image("Mar 2013", "A", 0.1, 3.0), image("Mar 2013", "A", 0.3, None)
    c, ttm = image("Mar 2014", "B", 0.2, 5.0), image("TTM", "A", 99.0, 99.0)
    average = image("Average", "A", 99.0, 99.0)
    records = [
        envelope(None, a, 1), envelope(a, b, 2), envelope(None, c, 3), envelope(None, ttm, 3),
        envelope(None, average, 3), None, "junk", json.dumps({"payload": None}),
    ]
    cols = ["sales", "interest"]

    def averaged(values, scale=4):
        log = spark.createDataFrame([(v, 0, i) for i, v in enumerate(values)], CHANGE_SCHEMA)
        return rows_of(moved_average(moved_sums(log, ROW, KEYS, cols, scale), cols))

    assert averaged(records) == averaged(records[::-1]) == [("Average", 0.25, 5.0)]
    assert averaged([*records, envelope(c, None, 4)]) == [("Average", 0.3, None)]
    assert averaged([*records, envelope(c, None, 4), envelope(b, None, 5)]) == [("Average", None, None)]
    assert averaged([]) == [("Average", None, None)]
    assert averaged(records, scale=0)[0][1] == pytest.approx(0.25)
