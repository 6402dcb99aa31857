"""Top-k search against scoring every pair."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tallyline.llm.queries import op8_exact_top_k
from tallyline.llm.search import best_of, top_k, usable_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows, every, k):
    held = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, v, _ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in held:
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in held if i != q)
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def result(spark, rows, every=5, k=5, **sizes):
    vectors = usable_vectors(spark.createDataFrame(rows, SCHEMA))
    found = top_k(vectors, vectors.where(f"vec_id % {every} = 0"), k, **sizes)
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("sizes", [{}, {"chunk_rows": 17, "block_rows": 3, "rows_at_a_time": 2}])
def test_random_vectors_with_ties(spark, sizes):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.1]) for _ in range(6)], 1) for i in range(120)]
    assert result(spark, rows, **sizes) == expected(rows, 5, 5)


def test_unusable_and_ragged_vectors(spark):
    rows = [
        (0, [1.0, 2.0], 1), (5, None, 1), (10, [1.0, None], 1), (15, [float("nan"), 1.0], 1),
        (20, [float("inf"), 1.0], 1), (None, [1.0, 1.0], 1), (25, [], 1), (30, [1.0], 1), (31, [0.0, 0.0, 9.0], None),
        (32, [-0.001, 0.001], 1),
    ]
    assert result(spark, rows) == expected(rows, 5, 5)


def test_few_candidates_and_empty_table(spark):
    assert result(spark, [(0, [1.0], 1)]) == []
    assert result(spark, [(0, [1.0], 1), (1, [2.0], 1)]) == [(0, 1, 1, 256 * 512)]
    assert result(spark, []) == []


def test_best_of_takes_smaller_ids_in_ties():
    ids, scores = best_of(np.array([3, 5, 5, 5, 1]), np.array([9, 8, 4, 6, 2]), 6, 2)
    assert (ids.tolist(), scores.tolist()) == ([4, 8], [5, 5])


@pytest.mark.parametrize("sizes", [{}, {"chunk_rows": 3, "block_rows": 2}])
def test_repeated_ids_lose_no_candidate(spark, sizes):
    rows = [(0, [0.5, 0.25], 1)] * 7 + [(i, [0.1 * i, 1.0], 1) for i in range(1, 6)] + [(3, [2.0, 2.0], 1)]
    found = result(spark, rows, **sizes)
    assert [r for r in found if r[0] == 0] == sorted({r for r in expected(rows, 5, 5) if r[0] == 0})
    rows = [(5, [1.0, 0.0], 1), (5, [0.0, 1.0], 1), (1, [0.5, 0.25], 1), (2, [0.25, 0.5], 1)]
    assert result(spark, rows, **sizes) == [(5, 1, 2, 128 * 256), (5, 2, 1, 64 * 256)]


def test_query_asks_every_row_against_every_other(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, [rng.choice([-0.5, 0.25, 2.0]) for _ in range(4)], 1) for i in range(60)]
    rows += [rows[0], rows[0], (50, [4.0, 0.0, 0.0, 1.0], 1), (50, [0.0, 4.0, 1.0, 0.0], 1), rows[7]]
    rows += [(None, [9.0, 9.0, 9.0, 9.0], 1), (None, [-9.0, -9.0, -9.0, 9.0], 1), (3, None, 1), (100, [None], 1)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    held = [(i, [math.floor(256 * x) for x in v]) for i, v, _ in rows if v is not None and None not in v]
    want = []
    for at, (q, a) in enumerate(held):
        if q is not None and q % 50 == 0:
            others = [(sum(x * y for x, y in zip(a, b, strict=True)), i) for n, (i, b) in enumerate(held) if n != at]
            best = sorted(others, key=lambda r: (-r[0], r[1] is None, r[1] or 0))[:5]
            want += [(q, n, i, s) for n, (s, i) in enumerate(best, 1)]
    found = [tuple(r) for r in op8_exact_top_k(spark, str(tmp_path)).collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert len(want) == 5 * 6
