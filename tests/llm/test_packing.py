"""Packing: every piece once, nothing overlaps, few sequences; against encoding whole texts."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from corpora import awkward_rows, frame
from tokenizers import Tokenizer

from tallyline.llm.packing import configurations, linear_groups, pack_pieces, packed_documents, plan_bins
from tallyline.llm.tokens import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")


def checked(histogram, capacity, **parameters):
    plan = plan_bins(histogram, capacity, **parameters)
    held: Counter = Counter()
    for times, kinds in plan:
        assert times > 0
        assert sum(k * n for k, n in kinds.items()) <= capacity
        for k, n in kinds.items():
            held[k] += times * n
    assert held == Counter({k: n for k, n in histogram.items() if n})
    return sum(times for times, _ in plan)


@pytest.mark.parametrize("seed", range(6))
def test_plan_holds_every_piece_once(seed):
    rng = random.Random(seed)
    histogram = {rng.randrange(1, 101): rng.randrange(0, 400) for _ in range(rng.randrange(1, 80))}
    checked(histogram, 100, groups=rng.choice([1, 5, 30, 500]), small=rng.choice([5, 20, 33, 100]))


def test_plan_is_close_to_the_bound():
    lengths = np.minimum(np.random.default_rng(1).lognormal(6.4, 1.1, 20_000).astype(int) + 1, 40_000)
    histogram = Counter(np.where(lengths % 1024, lengths % 1024, 1024).tolist())
    bound = -(-sum(k * n for k, n in histogram.items()) // 1024)
    assert checked(histogram, 1024) <= 1.005 * bound


def test_short_pieces_share_sequences():
    assert checked({344: 1000, 340: 2000}, 1024) == 1000
    assert checked({344: 6000, 340: 6000}, 1024) <= 4501
    lengths = Counter(np.random.default_rng(2).integers(129, 451, 20_000).tolist())
    assert checked(lengths, 1024) <= checked(lengths, 1024, small=450)


def test_empty_plan():
    assert plan_bins({}) == []
    assert checked({1024: 3, 1: 1}, 1024) == 4


def test_groups_are_equal_and_rounded_up():
    groups = linear_groups({900: 3, 700: 2, 500: 5}, 5)
    assert [(size, sum(n for _, n in real)) for size, real in groups] == [(900, 2), (900, 2), (700, 2), (500, 2), (500, 2)]
    assert all(length <= size for size, real in groups for length, _ in real)


def test_configurations_pair_what_fits():
    found = configurations([600, 400], [10, 10], 1000)
    assert sum(t for t, _ in found) == 10
    assert all(p == [1, 1] for _, p in found)


def test_documents_against_whole_encoding(spark):
    rows = awkward_rows()
    tokenizer = Tokenizer.from_file(PATH)
    want = Counter()
    for doc, text, *_ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 100 or 100
        cuts = [0, *range(first, len(ids), 100), len(ids)] if len(ids) > 100 else [0, len(ids)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[doc, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    found = packed_documents(frame(spark, rows), PATH, 100).collect()
    assert Counter(tuple(r)[:5] for r in found) == want
    sequences: dict[int, list] = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 100


def test_hot_length_is_spread(spark):
    rows = [(i, 0, 0, 7, 1) for i in range(500)] + [(1000 + i, 0, 0, i % 99 + 1, 1) for i in range(200)]
    pieces = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    found = pack_pieces(pieces, 100, salt_rows=20).collect()
    taken = Counter()
    for r in found:
        for place in range(r["offset"], r["offset"] + r["length"]):
            taken[r["sequence_id"], place] += 1
    assert len(found) == 700
    assert max(taken.values()) == 1


def test_empty_table_and_clashing_columns(spark):
    assert packed_documents(frame(spark, []), PATH).collect() == []
    clash = spark.createDataFrame([(1, "a b", 5, 6)], "doc_id long, text string, length long, sequence_id long")
    [row] = packed_documents(clash, PATH).collect()
    assert (row["length"], row["offset"]) == (3, 0)
