"""The stored model against one kept in dictionaries."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from corpora import awkward_rows, frame, many

from tallyline.llm import language_model
from tallyline.llm.language_model import discounts, held_out_scores, score_texts, shared_path, train_model

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
FOLD = "pmod(crc32(cast(doc_id as string)), 7) = 2"


def tokens(text):
    return [*(text or "").encode().translate(LOWER).split(), None]


class Plain:
    def __init__(self, texts):
        self.words = Counter(w for t in texts for w in tokens(t))
        self.total = sum(self.words.values())
        pairs: Counter = Counter()
        for t in texts:
            left = 0
            for w in tokens(t):
                pairs[left, w] += 1
                left = w
        self.pairs, self.left = pairs, Counter()
        of = Counter(pairs.values())
        self.d = discounts([of[k] for k in range(1, 5)])
        self.before = Counter(w for _, w in pairs)
        of = Counter(self.before.values())
        self.e = discounts([of[k] for k in range(1, 5)])
        self.rest: dict = defaultdict(float)
        for (v, _), n in pairs.items():
            self.left[v] += n
            self.rest[v] += self.d[min(n, 3) - 1]

    def lower(self, w):
        kinds = len(self.pairs)
        if not kinds:
            return 1.0
        left_over = sum(self.e[min(n, 3) - 1] for n in self.before.values()) / kinds
        n = self.before[w]
        return (n - self.e[min(n, 3) - 1] if n else 0) / kinds + left_over / (len(self.words) + 1)

    def share(self, v, w):
        if not self.left[v]:
            return self.lower(w)
        n = self.pairs[v, w]
        return (max(n - self.d[min(n, 3) - 1], 0) if n else 0) / self.left[v] + self.rest[v] / self.left[v] * self.lower(w)

    def score(self, text):
        left, out = 0, 0.0
        for w in tokens(text):
            out += math.log10(self.share(left, w))
            left = w
        return out

    def base(self, text):
        return sum(math.log10((self.words[w] + 1) / (self.total + len(self.words) + 1)) for w in tokens(text))


@pytest.mark.parametrize("rows", [awkward_rows(), many(120, seed=5)], ids=["awkward", "random"])
def test_scores_against_dictionaries(spark, rows):
    def held(doc):
        return doc is None or zlib.crc32(str(doc).encode()) % 7 == 2

    plain = Plain([r[1] for r in rows if not held(r[0])])
    want = Counter()
    for doc, text, *_ in rows:
        known = sum(plain.words[w] > 0 for w in tokens(text))
        want[doc, held(doc), len(tokens(text)), known, plain.total, f"{plain.base(text):.5f}", f"{plain.score(text):.5f}"] += 1
    found = held_out_scores(frame(spark, rows), FOLD).collect()
    assert Counter((*tuple(r)[:5], f"{r[5]:.5f}", f"{r[6]:.5f}") for r in found) == want


def test_probabilities_add_up_over_shards(spark):
    rows = many(60, seed=9)
    model = train_model(frame(spark, rows), shard_rows=300)
    assert model.word_shards > 1
    assert model.pair_shards > 1
    plain = Plain([r[1] for r in rows])
    words = [w for w in plain.words if w is not None]
    # one text per next word: what the word adds to a text's score
    for left in (words[0], words[1]):
        texts = [(i, f"{left.decode()} {w.decode()}", "x") for i, w in enumerate([*words, b"never-seen"])]
        scored = score_texts(spark.createDataFrame(texts, "doc_id long, text string, score2 string"), model).collect()
        for r in scored:
            assert r["score"] == pytest.approx(plain.score(texts[r["doc_id"]][1]), abs=1e-9)
        shares = sum(plain.share(left, w) for w in [*plain.words, b"never-seen"])
        assert shares == pytest.approx(1.0)


@pytest.mark.parametrize("most", [language_model.ROW_PAIRS, 7])
def test_bigrams_travel_packed_by_shard(spark, monkeypatch, most):
    monkeypatch.setattr(language_model, "ROW_PAIRS", most)
    docs = frame(spark, many(60, seed=9)).repartition(3).select("text").localCheckpoint()
    model = train_model(docs, shard_rows=300)
    plain = Plain([r["text"] for r in docs.collect()])
    rows = language_model._count_pairs(docs, model).collect()
    keys = [np.frombuffer(r["keys"], np.uint64) for r in rows]
    counts = [np.frombuffer(r["counts"], np.uint32) for r in rows]
    found = Counter()
    for row, k, n in zip(rows, keys, counts, strict=True):
        assert 0 < len(k) == len(n) <= most
        found.update({(row["shard"], key): count for key, count in zip(k.tolist(), n.tolist(), strict=True)})
    assert sorted(found.values()) == sorted(plain.pairs.values())
    assert len(found) == len({key for _, key in found}) == model.pairs
    # a row per shard and piece of text, and one more per row that is full
    assert len(rows) <= 3 * model.pair_shards + sum(map(len, keys)) // most
    scored = score_texts(docs.withColumnRenamed("text", "t").selectExpr("t", "t as text"), model).collect()
    assert all(r["score"] == pytest.approx(plain.score(r["t"]), abs=1e-9) for r in scored)


def test_shards_are_put_together_over_batches():
    def batch(shards, values):
        return pa.RecordBatch.from_pydict({"shard": pa.array(shards, pa.int32()), "v": pa.array(values, pa.int64())})

    batches = [batch([3, 3, 5], [1, 2, 3]), batch([], []), batch([5, 5], [4, 5]), batch([5, 6, 7], [6, 7, 8]), batch([7], [9])]
    found = [(at, language_model._column(parts, "v").tolist()) for at, parts in language_model._by_shard(iter(batches))]
    assert found == [(3, [1, 2]), (5, [3, 4, 5, 6]), (6, [7]), (7, [8, 9])]
    assert list(language_model._by_shard(iter([batch([], [])]))) == []


def test_packed_values_come_back_from_slices():
    values = np.arange(10, dtype=np.uint64) << np.uint64(40)
    edges = np.array([0, 3, 4, 10])
    rows = pa.RecordBatch.from_arrays([language_model._packed(values, edges)], ["x"])
    assert [len(x.as_py()) for x in rows.column("x")] == [24, 8, 48]
    assert language_model._unpacked([rows.slice(2), rows.slice(0, 2)], "x", np.uint64).tolist() == [*values[4:], *values[:4]]


def test_nothing_to_learn_from(spark):
    assert held_out_scores(frame(spark, []), FOLD).collect() == []
    rows = [(i, "a b", "en", "s", 1) for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2]
    found = held_out_scores(frame(spark, rows), FOLD).collect()
    assert {(r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in found} == {(True, 3, 0, 0)}


def test_discounts_stay_in_bounds():
    for counts in ([0, 0, 0, 0], [5, 0, 1, 0], [1, 90, 3, 70], [100, 40, 20, 10]):
        assert all(0 < d <= k for k, d in enumerate(discounts(counts), 1))


def test_shared_folder_must_be_mounted():
    assert shared_path("file:///a/b") == "/a/b" == shared_path("/a/b")
    with pytest.raises(ValueError, match="mounted"):
        shared_path("s3a://bucket/a")
