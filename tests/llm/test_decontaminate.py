"""Leaks: whole, re-parameterised and chance matches; against plain loops."""

from __future__ import annotations

import random
import re

import pytest
from corpora import awkward_rows, frame, sentence

from conftest import plan_of
from tallyline.llm.decontaminate import WINDOW, benchmark_windows, clean_documents, leaks

ITEM = "A train with 12 cars leaves Boston at 9 and meets Alice who drives 45 km to see 12 boats near Boston today"
ITEMS = "item_id long, text string"


def found(spark, texts, items, **parameters):
    docs = frame(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    rows = leaks(docs, spark.createDataFrame(list(enumerate(items)), ITEMS), **parameters).collect()
    return {(r["doc_id"], r["item_id"]) for r in rows}


@pytest.mark.parametrize(
    ("text", "leaked"),
    [
        (ITEM, True),
        (f"before {ITEM} behind", True),
        (ITEM.replace(" ", "  \n").replace("Boston", "Boston,"), True),
        # other numbers, names and units in the same roles
        (ITEM.replace("12", "1,250").replace("Boston", "Paris").replace("Alice", "Bob").replace("45 km", "3.5 miles"), True),
        # one number where the question had two
        (ITEM.replace("9", "12").replace("45", "12"), False),
        # two names where the question had one
        (ITEM.replace("near Boston", "near Paris"), False),
        (ITEM.replace("train", "bus").replace("meets", "sees").replace("near", "by"), False),
        (sentence(random.Random(1), 40), False),
        ("Aa Bb Cc Dd Ee Ff Gg Hh Ii Jj Kk Ll Mm Nn 1 2 3 4 5 6 7 8 9", False),
    ],
)
def test_templates_and_slots(spark, text, leaked):
    # the window as long as the item: every slot must agree
    size = len(ITEM.split())
    assert found(spark, [text], [ITEM], window=size) == ({(0, 0)} if leaked else set())


SERIES = "3 5 7 9 11 13 15 17 19 21 23 25 what comes next"


@pytest.mark.parametrize(
    ("text", "item", "leaked"),
    [
        (ITEM.lower(), ITEM, True),
        (f"and then {ITEM.upper()} behind", ITEM, True),
        (ITEM.lower().replace("12", "14").replace("45", "3"), ITEM, True),
        (SERIES, SERIES, True),
        (f"The test: {SERIES}?", SERIES, True),
        ("1 2 3 4 5 6 7 8 9 10 11 12 what comes next", SERIES, False),
        ("Lima is the capital of Peru", "Paris is the capital of France", False),
        ("so paris is the capital of FRANCE", "Paris is the capital of France", True),
        ("He has 7 apples and 4 pears today", "He has 3 apples and 9 pears today", True),
    ],
)
def test_case_series_and_short_items(spark, text, item, leaked):
    assert found(spark, [text], [item]) == ({(0, 0)} if leaked else set())


def test_parameters_reach_shorter_items(spark):
    assert found(spark, ["well too short then"], ["Too short"]) == set()
    assert found(spark, ["well too short then"], ["Too short"], least=2) == {(0, 0)}


def plain(rows, items, window):
    def words(text):
        return re.findall(r"[^\W_]+", (text or "").lower())

    held = {}
    for item, text in items:
        own = words(text)
        size = min(window, len(own))
        for p in range(len(own) - size + 1):
            held.setdefault(tuple(own[p : p + size]), set()).add(item)
    out: dict = {}
    for doc, text, *_ in rows:
        own = words(text)
        for size in {len(k) for k in held}:
            for p in range(len(own) - size + 1):
                for item in held.get(tuple(own[p : p + size]), ()):
                    if doc is not None:
                        out.setdefault((doc, item), set()).add(p)
    return sorted((d, i, len(at), min(at)) for (d, i), at in out.items())


@pytest.mark.parametrize("block_rows", [200_000, 7])
def test_awkward_rows_against_loops(spark, block_rows):
    rng = random.Random(7)
    rows = awkward_rows()
    first = rows[3][1].split()
    items = [
        (0, " ".join(first[10:40])), (1, sentence(rng, 20)), (2, " ".join(first[50:58])), (3, None), (4, ""),
        (5, "too short"), (6, " ".join(rows[13][1].split()[-30:])), (0, " ".join(first[10:40])),
    ]
    got = leaks(frame(spark, rows), spark.createDataFrame(items, ITEMS), block_rows=block_rows).collect()
    want = plain(rows, [(i, t) for i, t in items if t and len(t.split()) >= 6], WINDOW)
    # rows of one id are one document
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [w[:2] for w in want]
    once = {(r["doc_id"], r["item_id"]): (r["n_windows"], r["first_word"]) for r in got if r["doc_id"] not in (5, 17)}
    assert once == {(d, i): (n, f) for d, i, n, f in want if d not in (5, 17)}


def test_clean_documents_keep_their_columns(spark):
    rows = [(1, ITEM, 1.5), (2, "clean words only", 2.5), (None, ITEM, 3.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id double")
    items = spark.createDataFrame([(1, ITEM)], ITEMS)
    kept = clean_documents(docs, items)
    assert kept.columns == docs.columns
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == sorted(map(tuple, rows[1:]), key=repr)


def test_empty_tables(spark):
    none = spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, ITEM)], ITEMS)
    assert leaks(frame(spark, []), some).collect() == []
    assert leaks(frame(spark, awkward_rows()), none).collect() == []
    assert benchmark_windows(none).collect() == []


def test_no_python_in_the_plan(spark):
    plan = plan_of(leaks(frame(spark, awkward_rows()), spark.createDataFrame([(1, ITEM)], ITEMS)))
    assert not re.search("Python|Pandas|Arrow", plan)


def test_no_rows_are_made_in_python(spark, tmp_path):
    frame(spark, awkward_rows()).write.parquet(f"{tmp_path}/docs")
    spark.createDataFrame([(1, ITEM)], ITEMS).write.parquet(f"{tmp_path}/items")
    docs, items = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("docs", "items"))
    for df in (benchmark_windows(items), leaks(docs, items)):
        assert "ExistingRDD" not in plan_of(df)
