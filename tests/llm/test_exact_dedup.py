"""Exact duplicates against a dictionary of whole texts."""

from __future__ import annotations

import hashlib

import pytest
from corpora import awkward_rows, frame, many

from tallyline.llm.exact_dedup import ContentTable, distinct_documents, exact_duplicates


def expected(rows, largest=True):
    groups: dict[str, list] = {}
    for row in rows:
        groups.setdefault(row[1] or "", []).append(row[0])
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = (max if largest else min)(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        first = True
        for i in ids:
            out.append((i, keep, len(ids), i == keep and first, sha))
            first = first and i != keep
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


SMALL = {"table_bytes": 200, "table_rows": 3, "fan_out": 2}


@pytest.mark.parametrize("sizes", [{}, SMALL, {"table_bytes": 1, "table_rows": 1, "fan_out": 1}])
def test_awkward_rows(spark, sizes):
    rows = awkward_rows()
    assert result(exact_duplicates(frame(spark, rows).repartition(2), **sizes)) == expected(rows)
    found = exact_duplicates(frame(spark, rows), keep="smallest", **sizes)
    assert result(found) == expected(rows, largest=False)


def test_random_corpus_through_several_levels(spark):
    rows = many(200) + [(1000 + i, "one hot text", "en", "s", 1) for i in range(300)]
    assert result(exact_duplicates(frame(spark, rows), table_bytes=2000, table_rows=20, fan_out=3)) == expected(rows)


def test_table_tells_equal_hashes_apart():
    table = ContentTable()
    texts = [f"text {i}" for i in range(3000)]
    for number, text in enumerate(texts):
        entry, slot = table.find(7, text)
        assert entry == -1
        assert table.add(7, text, slot) == number
        if number > 60:
            break
    assert [table.find(7, t)[0] for t in texts[:61]] == list(range(61))
    for text in texts:
        entry, slot = table.find(hash(text), text)
        if entry < 0:
            table.add(hash(text), text, slot)
    assert all(table.contents[table.find(hash(t), t)[0]] == t for t in texts[100:])


def test_distinct_documents_keep_all_columns(spark):
    rows = [(1, "a", "x"), (2, "a", "y"), (3, None, "z"), (3, "", "z"), (4, "a ", None), (None, "q", "w")]
    docs = frame(spark, rows, "doc_id long, text string, sha string")
    found = distinct_documents(docs)
    assert found.columns == docs.columns
    kept = sorted((r["doc_id"] or 0, r["text"] or "") for r in found.collect())
    assert kept == [(0, "q"), (2, "a"), (3, ""), (4, "a ")]


def test_empty_table_and_extra_columns(spark):
    assert exact_duplicates(frame(spark, [])).collect() == []
    rows = [(1, "a", 1, "y", [1]), (2, "a", 2, "y", None)]
    clashing = frame(spark, rows, "doc_id long, text string, part long, of string, ids array<int>")
    assert [r[:4] for r in result(exact_duplicates(clashing))] == [(1, 2, 2, False), (2, 2, 2, True)]
    with pytest.raises(ValueError):
        exact_duplicates(clashing, keep="first")
