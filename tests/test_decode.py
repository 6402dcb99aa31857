from __future__ import annotations

import json

import pytest
from pyspark.sql import types as T

from conftest import rows_of
from tallyline.operators.compact import compact
from tallyline.operators.decode import (
    dead_letters,
    decode_changes,
    delete_keys,
    star_after,
    upserts,
)
from tallyline.schema import COMPANY, DELETED, PERIOD, statement_schema, whole_number_schema
from tallyline.sources import as_changes, read_changes
from tallyline.sources.readers import CHANGE_SCHEMA

ROW = T.StructType(
    [
        T.StructField(PERIOD, T.StringType()),
        T.StructField("sales", T.DoubleType()),
        T.StructField("interest", T.DoubleType()),
        T.StructField(COMPANY, T.StringType()),
    ]
)
KEYS = [PERIOD, COMPANY]


def image(period, company, sales=None, interest=None):
    return {"date": period, "company_name": company, "sales": sales, "interest": interest}


def envelope(before, after, ts):
    return json.dumps({"payload": {"before": before, "after": after, "source": {"ts_ms": ts}}})


def log(spark, values, partition=0):
    records = [(v, partition, i) for i, v in enumerate(values)]
    return spark.createDataFrame(records, CHANGE_SCHEMA)


def test_insert_update_delete(spark):
    a = image("Mar 2013", "A", 1.0)
    b = image("Mar 2013", "A", 2.5)
    events = decode_changes(
        log(spark, [envelope(None, a, 1), envelope(a, b, 2), envelope(b, None, 3)]), ROW, KEYS
    )
    assert rows_of(events, PERIOD, COMPANY, "sales", "_ts_ms", "_offset", DELETED) == [
        ("Mar 2013", "A", 1.0, 1, 0, False),
        ("Mar 2013", "A", 2.5, 2, 1, False),
        ("Mar 2013", "A", None, 3, 2, True),
    ]
    assert rows_of(delete_keys(events, KEYS)) == [("Mar 2013", "A")]
    assert upserts(events).count() == 2


def test_a_delete_takes_the_whole_key_from_the_old_image(spark):
    events = decode_changes(
        log(spark, [envelope(image("Mar 2013", "A"), None, 1), envelope(None, image("Mar 2013", "B"), 1)]),
        ROW,
        KEYS,
    )
    assert rows_of(delete_keys(events, KEYS)) == [("Mar 2013", "A")]


def test_tombstones_and_garbage(spark):
    good = envelope(None, image("Mar 2013", "A", 1.0), 1)
    no_company = envelope(None, {"date": "Mar 2014", "sales": 3.0}, 1)
    changes = log(spark, [None, "not json", "{}", "[1]", good, no_company])
    assert decode_changes(changes, ROW, KEYS).count() == 1
    letters = dead_letters(changes, ROW, KEYS)
    assert rows_of(letters, "value") == sorted(
        [("not json",), ("{}",), ("[1]",), (no_company,)], key=repr
    )


def test_decimal_in_a_whole_number_field_spares_its_siblings(spark):
    after = {"date": "Mar 2013", "sales": 12.5, "expenses": 7, "tax_percent": 24.5}
    events = decode_changes(log(spark, [envelope(None, after, 1)]), whole_number_schema(), [PERIOD])
    row = events.collect()[0]
    assert (row.sales, row.expenses, row.tax_percent) == (None, 7, 24.5)


def test_star_expansion(spark):
    changes = log(spark, [envelope(None, image("Mar 2013", "A", 1.0, 2.0), 1)])
    assert rows_of(star_after(changes, ROW, KEYS)) == [("Mar 2013", 1.0, 2.0, "A")]


@pytest.mark.parametrize("method", ["aggregate", "window"])
def test_compaction_cases(spark, method):
    def at(k, sales, ts):
        return envelope(None, image(k, "A", sales), ts)

    gone = {k: envelope(image(k, "A"), None, 5) for k in "dr"}
    values = [
        at("n", 1.0, 1), at("n", 2.0, 2),           # newer wins
        at("o", 1.0, 9), at("o", 2.0, 3),           # older arriving late loses
        at("t", 1.0, 4), at("t", 2.0, 4),           # same time: higher offset
        at("d", 1.0, 1), gone["d"],                 # deleted
        at("d", 3.0, 2),                            # late event does not revive it
        at("r", 1.0, 1), gone["r"], at("r", 7.0, 6),  # deleted, then inserted again
    ]
    compacted = compact(decode_changes(log(spark, values), ROW, KEYS), KEYS, method=method)
    assert rows_of(compacted, PERIOD, "sales", DELETED) == [
        ("d", None, True),
        ("n", 2.0, False),
        ("o", 1.0, False),
        ("r", 7.0, False),
        ("t", 2.0, False),
    ]


def test_kafka_shaped_frames(spark):
    binary = T.StructType(
        [
            T.StructField("key", T.BinaryType()),
            T.StructField("value", T.BinaryType()),
            T.StructField("topic", T.StringType()),
            T.StructField("partition", T.IntegerType()),
            T.StructField("offset", T.LongType()),
        ]
    )
    text = envelope(None, image("Mar 2013", "A", 1.0), 1)
    frame = spark.createDataFrame([(None, bytearray(text, "utf8"), "t", 3, 17)], binary)
    row = decode_changes(as_changes(frame), ROW, KEYS).collect()[0]
    assert (row.sales, row._partition, row._offset) == (1.0, 3, 17)


@pytest.mark.parametrize("format", ["parquet", "json", "text"])
def test_file_logs(spark, tmp_path, format):
    changes = log(spark, [envelope(None, image("Mar 2013", c, 1.0), 1) for c in "ABC"])
    path = str(tmp_path / format)
    (changes.select("value") if format == "text" else changes).write.format(format).save(path)
    read = read_changes(spark, format, path)
    assert read.schema.names == ["value", "partition", "offset"]
    assert rows_of(decode_changes(read, ROW, KEYS), COMPANY) == [("A",), ("B",), ("C",)]
    again = read_changes(spark, format, path)
    assert read.exceptAll(again).count() == 0


def test_unknown_formats_are_refused(spark):
    with pytest.raises(ValueError):
        read_changes(spark, "avro", "x")
    with pytest.raises(ValueError):
        read_changes(spark, "parquet")


def test_full_statement_layout(spark):
    after = {f.name: 1.5 for f in statement_schema()} | {PERIOD: "Mar 2013", COMPANY: "A"}
    events = decode_changes(log(spark, [envelope(None, after, 1)]), statement_schema(), KEYS)
    row = events.collect()[0].asDict()
    assert all(row[name] == value for name, value in after.items())
