"""State in bucketed tables: plans, versions, late events."""

from __future__ import annotations

import uuid

import pytest

from conftest import plan_of, rows_of
from pyspark.sql import functions as F
from tallyline.operators.decode import decode_changes
from tallyline.plans import derived
from tallyline.plans.derived import EVENT_KEYS, EVENT_ROW
from tallyline.schema import CONTROL, DELETED, EVENT_TIME, state_schema
from tallyline.sinks import BucketedState


@pytest.fixture()
def state(spark):
    row = spark.createDataFrame([], "k long, c string, v double").schema
    return BucketedState(spark, f"state_{uuid.uuid4().hex}", row, ["k", "c"], buckets=4)


def events(spark, state, *rows):
    """Rows of key, value, deleted and event time."""
    blank = {f.name: F.lit(None).cast(f.dataType) for f in state_schema(state.row) if f.name in CONTROL}
    given = spark.createDataFrame(rows, "k long, c string, v double, gone boolean, at long")
    given = given.withColumns(blank).withColumns({DELETED: F.col("gone"), EVENT_TIME: F.col("at")})
    return given.select(*state.schema.names)


@pytest.mark.parametrize("shuffle_partitions", ["4", "200"])
@pytest.mark.parametrize("mode", ["replace", "coalesce"])
def test_only_the_changes_are_exchanged(spark, state, mode, shuffle_partitions):
    state.load(spark.range(1000).selectExpr("id as k", "'x' as c", "1.0d as v"))
    spark.conf.set("spark.sql.shuffle.partitions", shuffle_partitions)
    try:
        plan = plan_of(state.merged(events(spark, state, (1, "x", 2.0, False, 5)), mode))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    lines = plan[plan.index("SortMergeJoin") :].splitlines()[1:]
    stored = "\n".join(x for x in lines if x.lstrip().startswith(":"))
    changes = "\n".join(x for x in lines if not x.lstrip().startswith(":"))
    assert "Bucketed: true" in stored and "Exchange" not in stored
    assert "Exchange" in changes and "Bucketed: true" not in changes


def test_versions_late_events_and_repeats(spark, state):
    assert state.version() == 0 and state.read().collect() == []
    state.apply(events(spark, state, (1, "x", 1.0, False, 10), (2, "x", 1.0, False, 10)), tag="it's 0")
    assert state.apply(events(spark, state, (9, "x", 1.0, False, 10)), tag="it's 0") == 1
    state.apply(events(spark, state, (1, "x", None, True, 20), (3, "x", 3.0, False, 5)), tag="1")
    earlier = state.rows()
    state.apply(events(spark, state, (1, "x", 7.0, False, 15), (3, "x", 4.0, False, 4)), tag="2")
    assert rows_of(state.read()) == [(2, "x", 1.0), (3, "x", 3.0)]
    state.apply(events(spark, state, (1, "x", 8.0, False, 30)))
    assert rows_of(state.read()) == [(1, "x", 8.0), (2, "x", 1.0), (3, "x", 3.0)]
    assert len(rows_of(earlier)) == 3
    assert len(state.tables()) == state.version() == 4
    state.expire(2)
    assert [t.split("_v")[1][0] for t in state.tables()] == ["4", "3"]
    assert len(state.read().collect()) == 3


def test_old_delete_markers_leave(spark, state):
    state.apply(events(spark, state, (1, "x", None, True, 10), (2, "x", 1.0, False, 10)))
    state.apply(events(spark, state, (3, "x", 1.0, False, 1000)), keep_deletes_ms=500)
    assert sorted(r["k"] for r in state.rows().collect()) == [2, 3]


def test_agrees_with_the_merge_of_the_whole_log(spark):
    sf = "/root/testdata/sf0.001"
    state = BucketedState(spark, f"state_{uuid.uuid4().hex}", EVENT_ROW, EVENT_KEYS, 4)
    state.load(derived.stored_accounts(spark, sf))
    log = decode_changes(derived.change_log(spark, sf), EVENT_ROW, EVENT_KEYS)
    whole = rows_of(state.merged(log).where("not _deleted").select(*EVENT_ROW.names))
    half = F.col("offset") % 2 == 0 if "offset" in log.columns else F.xxhash64(*EVENT_KEYS) % 2 == 0
    state.apply(log.where(half))
    state.apply(log.where(~half))
    assert rows_of(state.read()) == whole
