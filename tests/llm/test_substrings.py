"""Removal of repeated passages against a table of all windows."""

from __future__ import annotations

import pytest
from corpora import awkward_rows, frame, many

from tallyline.llm.substrings import remove_repeats


def expected(rows, size):
    docs = [(r[0], (r[1] or "").split(None)) for r in rows]
    first: dict[tuple, int] = {}
    for doc, words in docs:
        for p in range(len(words) - size + 1):
            key = tuple(words[p : p + size])
            if doc is not None:
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, words in docs:
        gone = [False] * len(words)
        for p in range(len(words) - size + 1):
            if doc is not None and first[tuple(words[p : p + size])] < doc:
                gone[p : p + size] = [True] * size
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((doc, len(words), sum(gone), kept))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept").collect()), key=repr)


@pytest.mark.parametrize("size", [50, 13])
def test_awkward_rows(spark, size):
    rows = awkward_rows()
    assert result(remove_repeats(frame(spark, rows), size)) == expected(rows, size)


def test_random_corpus(spark):
    rows = many(150)
    assert result(remove_repeats(frame(spark, rows), 20)) == expected(rows, 20)


def test_longest_repeat_doubles_until_nothing_is_left(spark):
    long = " ".join(f"w{i}" for i in range(230))
    rows = [(1, f"a {long} b", "en", "s", 1), (2, f"c {long} d", "en", "s", 1), (3, long, "en", "s", 1), (4, long, "en", "s", 1)]
    found = {r["doc_id"]: r for r in remove_repeats(frame(spark, rows), 50).collect()}
    assert found[1]["longest_repeat"] == found[2]["longest_repeat"] == 200
    assert (found[2]["n_removed"], found[2]["kept"]) == (230, "c d")
    assert found[4]["longest_repeat"] == found[4]["n_removed"] == 230


def test_empty_table_and_extra_columns(spark):
    assert remove_repeats(frame(spark, []), 50).collect() == []
    rows = [(1, "a b c", "x", 1, "y"), (2, "a b c d", "x", 2, "y")]
    clashing = frame(spark, rows, "doc_id long, text string, kept string, _c int, first string")
    found = remove_repeats(clashing, 3).collect()
    assert sorted((r["doc_id"], r["kept"]) for r in found) == [(1, "a b c"), (2, "d")]
