from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from test_merge import ROW, events, state
from tallyline.schema import state_schema, statement_schema
from tallyline.sinks import (
    Snapshot,
    assert_unique,
    create_table,
    duplicate_keys,
    load_table,
    merge_table,
    scratch_dir,
    upsert_jdbc,
    upsert_statement,
    write_csv,
    write_single_csv,
)
from tallyline.sinks.jdbc import delete_statement, overwrite_jdbc, replace_statement, table_statement
from tallyline.sinks.snapshot import VersionedTable
from tallyline.sources import read_state_jdbc, read_statements_csv
from tallyline.streaming import DatabaseCopy


def snapshot(spark, path, **options):
    return Snapshot(spark, str(path), ROW, ["k"], buckets=4, **options)


def test_csv_folder_and_single_file(spark, tmp_path):
    rows = [(f"Mar {y}", *[float(y)] * 11, None, "A") for y in (2015, 2013, 2014)]
    df = spark.createDataFrame(rows, statement_schema()).repartition(3)
    write_csv(df, str(tmp_path / "many"))
    assert rows_of(read_statements_csv(spark, str(tmp_path / "many"))) == rows_of(df)
    one = str(tmp_path / "one")
    write_single_csv(df, one, order=[F.col("date")])
    files = glob.glob(f"{one}/*.csv")
    assert len(files) == 1
    lines = open(files[0]).read().splitlines()
    assert lines[0].startswith("date,sales") and [x[:8] for x in lines[1:]] == [
        "Mar 2013", "Mar 2014", "Mar 2015"
    ]


def test_tables_and_key_check(spark):
    create_table(spark, "t_statements", ROW)
    create_table(spark, "t_statements", ROW)
    assert spark.table("t_statements").schema.names == ROW.names
    load_table(state(spark, [("a", 1.0, None)]), "t_statements")
    load_table(state(spark, [("b", 2.0, None), ("b", 3.0, None)]), "t_statements")
    stored = spark.table("t_statements")
    assert rows_of(duplicate_keys(stored, ["k"])) == [("b", 2)]
    with pytest.raises(ValueError):
        assert_unique(stored, ["k"])
    assert_unique(stored, ["k", "a"])


def test_merge_needs_a_format_that_supports_it(spark):
    """No such format here: the statement resolves and is then refused."""
    create_table(spark, "t_plain", ROW)
    batch = events(spark, [("a", 1.0, 1.0, 1, 0, 1, False)])
    create_table(spark, "t_versioned", state_schema(ROW))
    for table in ("t_plain", "t_versioned"):
        for mode in ("replace", "coalesce"):
            with pytest.raises(Exception, match="MERGE INTO"):
                merge_table(batch, table, ["k"], mode)
    with pytest.raises(ValueError, match="mode"):
        merge_table(batch, "t_plain", ["k"], "other")


def test_snapshot_upserts_deletes_and_versions(spark, tmp_path):
    snap = snapshot(spark, tmp_path / "s")
    assert snap.version() == 0 and snap.read().count() == 0
    assert snap.load(state(spark, [("e", 1.0, 1.0), ("u", 2.0, 2.0), ("d", 3.0, 3.0)])) == 1
    batch = [
        ("u", None, 9.0, 5, 0, 1, False),
        ("d", None, None, 5, 0, 2, True),
        ("n", 7.0, 7.0, 5, 0, 3, False),
    ]
    assert snap.apply(events(spark, batch)) == 2
    assert rows_of(snap.read()) == [("e", 1.0, 1.0), ("n", 7.0, 7.0), ("u", None, 9.0)]
    # The earlier version still reads as it was.
    assert rows_of(snap.read(1)) == [("d", 3.0, 3.0), ("e", 1.0, 1.0), ("u", 2.0, 2.0)]
    # Late and repeated events lose or change nothing.
    snap.apply(events(spark, [("d", 8.0, 8.0, 4, 0, 0, False)]))
    snap.apply(events(spark, batch))
    assert rows_of(snap.read()) == [("e", 1.0, 1.0), ("n", 7.0, 7.0), ("u", None, 9.0)]


@pytest.mark.parametrize("mode", ["coalesce", "replace"])
def test_snapshot_modes(spark, tmp_path, mode):
    snap = snapshot(spark, tmp_path / "s")
    snap.apply(events(spark, [(f"k{i}", float(i), 1.0, 1, 0, i, False) for i in range(50)]), mode)
    changes = [(f"k{i}", None, 2.0, 2, 0, i, i % 5 == 0) for i in range(40, 60)]
    snap.apply(events(spark, changes), mode)
    kept = {f"k{i}": (float(i), 1.0) for i in range(50)}
    for i in range(40, 60):
        if i % 5 == 0:
            kept.pop(f"k{i}", None)
        else:
            old = kept.get(f"k{i}", (None, None))[0] if mode == "coalesce" else None
            kept[f"k{i}"] = (old, 2.0)
    assert rows_of(snap.read()) == sorted(((k, *v) for k, v in kept.items()), key=repr)


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    snap = snapshot(spark, tmp_path / "s")
    snap.load(state(spark, [(f"k{i}", 1.0, 1.0) for i in range(40)]))
    snap.apply(events(spark, [("k1", 5.0, 5.0, 1, 0, 1, False)]))
    assert sorted(snap.pointer().held.values()) == [1, 1, 1, 2]
    assert len(snap.pointer().since(1)) == 1
    # The version is plain Parquet: the touched bucket, whole.
    [bucket] = glob.glob(f"{tmp_path}/s/data/_version=2/_bucket=*")
    whole = spark.read.parquet(f"{tmp_path}/s/data/_version=2")
    was = spark.read.parquet(bucket.replace("_version=2", "_version=1"))
    assert 1 < whole.count() == was.count() < 40
    assert rows_of(snap.read(), "k", "a")[1] == ("k1", 5.0) and snap.read().count() == 40


def test_another_layout_is_refused_until_rows_move(spark, tmp_path):
    snap = snapshot(spark, tmp_path / "s")
    snap.load(state(spark, [(f"k{i}", 1.0, 1.0) for i in range(50)]))
    update = events(spark, [(f"k{i}", 2.0, 2.0, 1, 0, i, False) for i in range(50)])
    other = Snapshot(spark, str(tmp_path / "s"), ROW, ["k"], buckets=16)
    with pytest.raises(ValueError, match="layout"):
        other.apply(update)
    snap.relayout(16)
    other.apply(update)
    assert rows_of(other.read()) == sorted([(f"k{i}", 2.0, 2.0) for i in range(50)], key=repr)
    with pytest.raises(ValueError, match="layout"):
        snapshot(spark, tmp_path / "s").apply(update)


def test_pointers_are_read_once_and_without_a_job(spark, tmp_path):
    snap = snapshot(spark, tmp_path / "s")
    snap.load(state(spark, [("a", 1.0, 1.0)]))
    for i in range(1, 4):
        snap.apply(events(spark, [("a", float(i), None, i, 0, i, False)]))
    fresh = snapshot(spark, tmp_path / "s")
    spark.sparkContext.setJobGroup("pointers", "none expected")
    try:
        assert [fresh.pointer(v) for v in fresh.versions()] == [snap.pointer(v) for v in (4, 3, 2, 1)]
        assert fresh.pointer(2) is fresh.pointer(2)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("pointers")


def test_a_repeated_tag_is_applied_once(spark, tmp_path):
    snap = snapshot(spark, tmp_path / "s")
    first = events(spark, [("a", 1.0, 1.0, 1, 0, 1, False)])
    assert snap.apply(first, tag="q#0") == 1
    assert snap.apply(first, tag="q#0") == 1
    assert snap.apply(first, tag="q#1") == 2


def test_an_unfinished_commit_is_not_seen(spark, tmp_path):
    snap = snapshot(spark, tmp_path / "s")
    snap.load(state(spark, [("a", 1.0, 1.0)]))
    snap.apply(events(spark, [("a", 2.0, 2.0, 1, 0, 1, False)]))
    # As if the writer had died before its pointer was complete.
    pointer = tmp_path / "s" / "pointer" / "00000002.json"
    for half in (pointer.read_text()[:-9], ""):
        pointer.write_text(half)
        (pointer.parent / ".00000002.json.crc").unlink(missing_ok=True)
        snap = snapshot(spark, tmp_path / "s")
        assert snap.version() == 1
        assert rows_of(snap.read()) == [("a", 1.0, 1.0)]
    assert snap.apply(events(spark, [("b", 2.0, 2.0, 1, 0, 1, False)])) == 2
    assert rows_of(snap.read()) == [("a", 1.0, 1.0), ("b", 2.0, 2.0)]


def test_delete_markers_stay_until_forgotten(spark, tmp_path):
    snap = snapshot(spark, tmp_path / "s")
    snap.apply(events(spark, [("a", 1.0, 1.0, 1, 0, 1, False), ("a", None, None, 2, 0, 2, True)]))
    assert snap.read().count() == 0 and snap.rows().count() == 1
    snap.apply(events(spark, [("a", 5.0, 5.0, 1, 0, 0, False)]), keep_deletes_ms=0)
    assert snap.read().count() == 0 and snap.rows().count() == 1
    # One row with a clock far ahead makes no marker go ...
    batch = [(f"n{i}", 1.0, 1.0, 10, 0, i, False) for i in range(20)]
    batch.append(("future", 1.0, 1.0, 10**15, 0, 9, False))
    snap.apply(events(spark, batch), keep_deletes_ms=9)
    assert snap.rows().filter("k = 'a'").count() == 1
    # ... the time most rows have does.
    snap.apply(events(spark, batch), keep_deletes_ms=7)
    assert snap.rows().filter("k = 'a'").count() == 0 and snap.read().count() == 21


def test_expired_versions_leave_the_newest_whole(spark, tmp_path):
    snap = snapshot(spark, tmp_path / "s")
    snap.load(state(spark, [(f"k{i}", 1.0, 1.0) for i in range(40)]))
    for i in range(1, 5):
        snap.apply(events(spark, [("k1", float(i), None, i, 0, i, False)]))
    before, older = rows_of(snap.read()), rows_of(snap.read(4))
    snap.expire(keep=2)
    assert snap.versions() == [5, 4]
    assert rows_of(snap.read()) == before and rows_of(snap.read(4)) == older
    assert len(glob.glob(f"{tmp_path}/s/data/_version=1/_bucket=*")) == 3
    snap.relayout(3)
    before = rows_of(snap.read())
    fresh = snapshot(spark, tmp_path / "s")
    fresh.expire(keep=1)
    assert fresh.versions() == [6] and rows_of(fresh.read()) == before
    held = {int(p.rsplit("=", 1)[1]) for p in glob.glob(f"{tmp_path}/s/data/*")}
    assert held == {6}


def test_bucket_columns_must_be_key_columns(spark, tmp_path):
    with pytest.raises(ValueError):
        Snapshot(spark, str(tmp_path), ROW, ["k"], bucket_by=["a"])


def test_versioned_table_replaces_all_by_default(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), state_schema(ROW), ["k"], 4)
    table.replace(events(spark, [("a", 1.0, None, 1, 0, 1, False)]))
    table.replace(events(spark, [("b", 1.0, None, 1, 0, 1, False)]))
    assert rows_of(table.rows(), "k") == [("b",)]


def test_scratch_dir_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(shared) and first != second


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        scratch_dir(Session(), "x")


def test_upsert_text():
    assert upsert_statement("s.t", "s.t_staging", ["k", "c", "a"], ["k", "c"]) == (
        "INSERT INTO s.t (k, c, a) SELECT k, c, a FROM s.t_staging "
        "ON CONFLICT (k, c) DO UPDATE SET a = EXCLUDED.a"
    )
    assert upsert_statement("t", "u", ["k"], ["k"]).endswith("ON CONFLICT (k) DO NOTHING")
    assert delete_statement("t", "g", ["k", "c"]) == (
        "DELETE FROM t t USING g s WHERE t.k = s.k AND t.c = s.c"
    )
    assert replace_statement("s.t", "s.g", ["k", "a"]) == (
        "BEGIN; DELETE FROM s.t; INSERT INTO s.t (k, a) SELECT k, a FROM s.g; DROP TABLE s.g; COMMIT;"
    )
    assert table_statement("s.t", statement_schema(), ["date", "company_name"]).startswith(
        "CREATE TABLE IF NOT EXISTS s.t (date TEXT NOT NULL, sales DOUBLE PRECISION, "
    )
    assert table_statement("t", ROW, ["k"]).endswith(", PRIMARY KEY (k))")


@pytest.fixture()
def database(monkeypatch):
    """No database here: writes and statements are recorded instead of sent."""
    from tallyline.sinks import jdbc

    sent, staged = [], []
    monkeypatch.setattr(
        jdbc, "_write", lambda df, url, table, mode, options: staged.append((table, mode, rows_of(df)))
    )
    return sent, staged


def test_upsert_stages_rows_then_sends_one_transaction(spark, database):
    sent, staged = database
    df = state(spark, [("a", 1.0, 1.0), ("b", 1.0, 1.0)])
    gone = state(spark, [("c", None, None)])
    for _ in range(2):
        upsert_jdbc(df, "jdbc:x", "t", ["k"], sent.append, removed=gone, user="u")
    assert [(mode, len(rows)) for _, mode, rows in staged] == [("overwrite", 2), ("overwrite", 1)] * 2
    # Calls never share a staging table, and each drops its own.
    assert len({table for table, *_ in staged}) == 4
    assert [s.split()[0] for s in sent[0].split("; ")] == ["BEGIN", "INSERT", "DROP", "DELETE", "DROP", "COMMIT;"]
    assert all(table in sent[i // 2] for i, (table, *_) in enumerate(staged))
    overwrite_jdbc(df, "jdbc:x", "t", sent.append)
    assert staged[-1][1] == "overwrite" and "DROP TABLE t;" not in sent[-1] and "DELETE FROM t;" in sent[-1]


def test_database_copy_follows_the_snapshot(spark, tmp_path, database):
    sent, staged = database
    snap = snapshot(spark, tmp_path / "s")
    snap.load(state(spark, [("a", 1.0, 1.0), ("b", 2.0, 2.0)]))
    version = snap.apply(events(spark, [("b", None, None, 1, 0, 1, True)]))
    copy = DatabaseCopy("jdbc:x", "t", sent.append)
    copy(snap, version)
    assert sent[0].startswith("CREATE TABLE IF NOT EXISTS t (k TEXT NOT NULL")
    assert [rows for *_, rows in staged] == [[("a", 1.0, 1.0)], [("b",)]]
    version = snap.apply(events(spark, [("n", 5.0, 5.0, 2, 0, 2, False)]))
    copy(snap, version)
    assert ("n", 5.0, 5.0) in staged[2][2] and len(sent) == 3


def test_partitioned_jdbc_reads_need_bounds(spark):
    with pytest.raises(ValueError):
        read_state_jdbc(spark, "jdbc:x", "t", partition_column="id")
