"""Collocations against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from corpora import awkward_rows, frame

import tallyline.llm.collocations as module
from tallyline.llm.collocations import _unpacked, best_cut, collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, least, top):
    counts: dict[str, Counter] = {}
    totals: Counter = Counter()
    for row in rows:
        lang = "und" if row[2] is None else row[2]
        mine = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (row[1] or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    mine[tuple(words[i : i + size])] += 1
    out = []
    for lang, mine in counts.items():
        n = totals[lang]
        candidates = {p for p, a in mine.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p in candidates:
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    part = p[i : i + size]
                    inside[part] = max(inside[part], mine[p])
        scored = []
        for p in candidates:
            a = mine[p]
            if 100 * inside[p] >= 100 * a:
                continue
            cuts = [(1000 * a * n // (mine[p[:k]] * mine[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), mine[p[:k]], mine[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def corpus(n, seed=5):
    rng = random.Random(seed)
    words = [f"W{i}" for i in range(14)] + ["of", "the", "ünd", "a\x01b", "a"]
    fixed = ["new york city hall", "of the", "a b c d e f", "One\x01 two"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(30)):
            parts.append(rng.choice(fixed) if rng.random() < 0.3 else rng.choice(words))
            parts.append(rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", " \x1c "]))
        rows.append((i, "".join(parts), rng.choice(["en", "en", "de", None]), "s", 1))
    return rows


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


SIZES = [
    {},
    {"block_words": 50, "bucket_windows": 1 << 20},
    {"block_words": 300, "bucket_windows": 16},
    {"block_words": 1 << 20, "bucket_windows": 200},
]


@pytest.mark.parametrize("sizes", SIZES)
def test_random_corpus(spark, sizes):
    rows = corpus(300)
    want = expected(rows, 4, 60)
    assert len(want) > 100
    assert result(collocations(frame(spark, rows).repartition(3), 4, 60, **sizes)) == want


def test_awkward_rows_with_ties_and_one_hot_pair(spark):
    rows = awkward_rows() + [(100 + i, f"hot pair x{i % 40} y{i % 7} z{i % 3}", "en", "s", 1) for i in range(400)]
    assert result(collocations(frame(spark, rows), 2, 50, bucket_windows=64)) == expected(rows, 2, 50)


def test_cut_is_exact_beyond_64_bits():
    a, n = 3 * 10**13 + 1, 7 * 10**15
    left, right = a + 3, a + 5
    assert best_cut(a, n, [left], [right]) == (1000 * a * n // (left * right), left, right)
    assert best_cut(10, 100, [50, 10], [25, 20]) == (1000 * 1000 // 1000, 50, 20)


def test_empty_table_and_extra_columns(spark):
    assert collocations(frame(spark, []), 1).collect() == []
    assert collocations(frame(spark, [(1, "one. two. three", "en", "s", 1)]), 1).collect() == []
    rows = [(1, "a b", "x", 1), (2, "A  b", "x", 2)]
    clashing = frame(spark, rows, "ids long, text string, lang string, f long")
    assert result(collocations(clashing, 2)) == [("x", 1, "a b", 2, 2, 2, 4, 2000)]


def test_only_frequent_pairs_make_windows(spark, monkeypatch):
    sent, runs = [], module._runs

    def spied(blocks, packing, *more):
        out = runs(blocks, packing, *more)
        sent.extend(_unpacked(r["data"], packing.columns + 1)[-1].sum() for r in out.collect())
        return out

    monkeypatch.setattr(module, "_runs", spied)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    # every word is frequent, but no pair of them
    rows = [(i, " ".join(rng.choices(words, k=200)) + ". new york city", "en", "s", 1) for i in range(100)]
    assert result(collocations(frame(spark, rows), 40, 50, block_words=3000)) == expected(rows, 40, 50)
    assert sum(sent) == 200
