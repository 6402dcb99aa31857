from __future__ import annotations

import itertools
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import plan_of, rows_of
from tallyline.operators.compact import compact, latest_per_key
from tallyline.operators.fill import deciding_rows, filled
from tallyline.operators.merge import drop_keys, live_rows, merge_state, merge_versioned
from tallyline.schema import CONTROL, DELETED, state_schema
from tallyline.sinks import Snapshot

ROW = T.StructType(
    [
        T.StructField("k", T.StringType()),
        T.StructField("a", T.DoubleType()),
        T.StructField("b", T.DoubleType()),
    ]
)
FEW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def state(spark, rows):
    return spark.createDataFrame(rows, ROW)


def events(spark, rows):
    return spark.createDataFrame(rows, state_schema(ROW))


def latest_by_hand(rows):
    best = {}
    for r in rows:
        if r[0] not in best or r[3:6] > best[r[0]][3:6]:
            best[r[0]] = r
    return best


EVENT = st.tuples(
    st.sampled_from("uvwxyz"),
    st.one_of(st.none(), st.integers(0, 9).map(float)),
    st.one_of(st.none(), st.integers(0, 9).map(float)),
    st.integers(1, 5),
    st.integers(0, 1),
    st.integers(0, 10_000),
    st.booleans(),
)
LOG = st.lists(EVENT, max_size=30, unique_by=lambda r: r[3:6])


@FEW
@given(LOG)
def test_latest_agrees_with_brute_force(spark, rows):
    want = sorted(latest_by_hand(rows).values(), key=repr)
    for method in ("aggregate", "window"):
        assert rows_of(latest_per_key(events(spark, rows), ["k"], method=method)) == want


@pytest.fixture()
def existing(spark):
    return state(spark, [("e", 1.0, 1.0), ("u", 2.0, 2.0), ("d", 3.0, 3.0)])


@pytest.fixture()
def incoming(spark):
    return events(
        spark,
        [
            ("u", None, 9.0, 1, 0, 1, False),
            ("n", 5.0, None, 1, 0, 2, False),
            ("d", None, None, 1, 0, 3, True),
            ("x", None, None, 1, 0, 4, True),
        ],
    )


@pytest.mark.parametrize(
    ("mode", "keep", "want"),
    [
        ("coalesce", True, [("e", 1.0, 1.0), ("n", 5.0, None), ("u", 2.0, 9.0)]),
        ("replace", True, [("e", 1.0, 1.0), ("n", 5.0, None), ("u", None, 9.0)]),
        ("coalesce", False, [("n", 5.0, None), ("u", 2.0, 9.0)]),
        ("replace", False, [("n", 5.0, None), ("u", None, 9.0)]),
    ],
)
def test_merge_modes(existing, incoming, mode, keep, want):
    assert rows_of(merge_state(existing, incoming, ["k"], mode, keep)) == want


def test_merge_without_a_delete_flag(existing, incoming):
    plain = incoming.filter(~F.col(DELETED)).drop(*CONTROL)
    assert merge_state(existing, plain, ["k"]).count() == 4


def test_unknown_mode_is_refused(existing, incoming):
    with pytest.raises(ValueError):
        merge_state(existing, incoming, ["k"], "other")


def test_applying_twice_changes_nothing(existing, incoming):
    once = merge_state(existing, incoming, ["k"])
    assert rows_of(merge_state(once, incoming, ["k"])) == rows_of(once)


@FEW
@given(LOG, st.integers(0, 2**16))
def test_any_split_of_the_log_gives_the_same_state(spark, rows, seed):
    """Whole-row mode: batches in any order end in the state of the whole log."""
    shuffled = rows[:]
    random.Random(seed).shuffle(shuffled)
    cut = len(shuffled) // 2
    current = events(spark, [])
    for part in (shuffled[:cut], shuffled[cut:]):
        current = merge_versioned(current, compact(events(spark, part), ["k"]), ["k"])
    want = [(r[0],) + r[1:3] for r in latest_by_hand(rows).values() if not r[6]]
    assert rows_of(live_rows(current)) == sorted(want, key=repr)


def test_versioned_coalesce_in_order(spark):
    first = compact(events(spark, [("a", 1.0, 2.0, 1, 0, 1, False)]), ["k"])
    second = compact(events(spark, [("a", None, 3.0, 2, 0, 2, False)]), ["k"])
    late = compact(events(spark, [("a", 9.0, 9.0, 0, 0, 3, False)]), ["k"])
    current = events(spark, [])
    for batch in (first, second, late):
        current = merge_versioned(current, batch, ["k"], "coalesce")
    assert rows_of(live_rows(current)) == [("a", 1.0, 3.0)]


def test_reinsert_after_a_stored_delete_starts_afresh(spark):
    steps = [
        [("a", 1.0, 2.0, 1, 0, 1, False)],
        [("a", None, None, 2, 0, 2, True)],
        [("a", None, 5.0, 3, 0, 3, False)],
    ]
    current = events(spark, [])
    for step in steps:
        current = merge_versioned(current, compact(events(spark, step), ["k"]), ["k"], "coalesce")
    assert rows_of(live_rows(current)) == [("a", None, 5.0)]


def test_stored_rows_without_event_time_give_way(spark):
    loaded = events(spark, [("a", 1.0, 1.0, None, None, None, False)])
    batch = compact(events(spark, [("a", 2.0, None, 0, 0, 0, False)]), ["k"])
    assert rows_of(live_rows(merge_versioned(loaded, batch, ["k"]))) == [("a", 2.0, None)]


def test_drop_keys_and_nulls(spark):
    kinds = T.StructType([T.StructField("k", T.StringType()), T.StructField("c", T.StringType())])
    rows = spark.createDataFrame([("a", "x"), ("a", None), (None, None), ("b", "x")], kinds)
    gone = spark.createDataFrame([("a", "x"), ("a", None)], kinds)
    plain = [("a", None), ("b", "x"), (None, None)]
    assert rows_of(drop_keys(rows, gone, ["k", "c"])) == sorted(plain, key=repr)
    strict = [("b", "x"), (None, None)]
    assert rows_of(drop_keys(rows, gone, ["k", "c"], null_safe=True)) == sorted(strict, key=repr)
    nothing = gone.limit(0)
    assert drop_keys(rows, nothing, ["k", "c"]).count() == 4


def test_every_order_of_three_versions(spark):
    versions = [("a", float(i), None, i, 0, i, i == 2) for i in range(3)]
    for order in itertools.permutations(versions):
        current = events(spark, [])
        for version in order:
            current = merge_versioned(current, events(spark, [version]), ["k"])
        assert rows_of(live_rows(current)) == []


def filled_by_hand(rows):
    out = {}
    for key in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == key), key=lambda r: r[3:6])
        values = [None, None]
        for r in own:
            if r[6]:
                values = [None, None]
            else:
                values = [b if b is not None else a for a, b in zip(values, r[1:3], strict=True)]
        if not own[-1][6]:
            out[key] = (key, *values)
    return sorted(out.values(), key=repr)


@FEW
@given(LOG, st.integers(0, 2**16))
def test_any_split_of_the_log_fills_the_same_values(spark, tmp_path_factory, rows, seed):
    """Filling: batches in any order end in the values of the whole log."""
    rows = list({r[3:6]: r for r in rows}.values())
    shuffled = rows[:]
    random.Random(seed).shuffle(shuffled)
    cut = len(shuffled) // 2
    snap = Snapshot(spark, str(tmp_path_factory.mktemp("fill")), ROW, ["k"], 2)
    for part in (shuffled[:cut], shuffled[cut:]):
        snap.apply(events(spark, part), "fill")
    assert rows_of(snap.read()) == filled_by_hand(rows)


def test_filling_keeps_stored_values_until_a_delete(spark, tmp_path):
    snap = Snapshot(spark, str(tmp_path / "s"), ROW, ["k"], 2)
    snap.load(state(spark, [("a", 1.0, 2.0), ("b", 1.0, 2.0)]))
    snap.apply(events(spark, [("a", None, 5.0, 1, 0, 1, False), ("b", None, None, 1, 0, 2, True)]), "fill")
    snap.apply(events(spark, [("b", None, 7.0, 2, 0, 3, False), ("a", 3.0, 4.0, 0, 0, 0, False)]), "fill")
    assert rows_of(snap.read()) == [("a", 3.0, 5.0), ("b", None, 7.0)]
    snap.apply(events(spark, [("a", 9.0, None, 3, 0, 4, False)]), "replace")
    assert rows_of(snap.read()) == [("a", 9.0, None), ("b", None, 7.0)]


def test_filling_takes_one_aggregation(spark):
    """Windows over keys and salts sorted and shuffled every event twice."""
    rows = events(spark, [("a", 1.0, None, 1, 0, 1, False)])
    for made in (deciding_rows(rows, ["k"], ["a", "b"]), filled(rows, ["k"], ["a", "b"])):
        plan = plan_of(made)
        assert "Window" not in plan and plan.count("Exchange") == 1


def test_deciding_rows_are_one_per_position(spark):
    log = [
        ("a", 1.0, 2.0, 1, 0, 1, False),
        ("a", None, None, 2, 0, 2, True),
        ("a", 5.0, None, 3, 0, 3, False),
        ("a", 6.0, 7.0, 4, 0, 4, False),
        ("b", None, None, 1, 0, 1, True),
        (None, 1.0, None, 1, 0, 1, False),
        (None, None, 2.0, 2, 0, 2, False),
    ]
    made = deciding_rows(events(spark, [*log, log[3]]), ["k"], ["a", "b"])
    assert rows_of(made) == sorted((log[i] for i in (1, 3, 4, 5, 6)), key=repr)
