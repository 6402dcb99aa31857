"""Similar documents against comparing every pair."""

from __future__ import annotations

import random

import numpy as np
import pytest
from corpora import awkward_rows, frame, many, sentence

from tallyline.llm import jaccard
from tallyline.llm.components import components
from tallyline.llm.jaccard import Bands, similar_documents

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text, size):
    words = (text or "").encode().translate(LOWER).split()
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def expected(rows, size, percent):
    sets = [(r[0], shingles(r[1], size)) for r in rows]
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (a, x) in enumerate(sets):
        for j in range(i):
            b, y = sets[j]
            if x and y and a is not None and b is not None and 100 * len(x & y) >= percent * len(x | y):
                parent[find(i)] = find(j)
    smallest: dict[int, int] = {}
    for i, (doc, _) in enumerate(sets):
        if doc is not None:
            smallest[find(i)] = min(smallest.get(find(i), doc), doc)
    return sorted(((d, len(s), smallest.get(find(i))) for i, (d, s) in enumerate(sets)), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def test_awkward_rows(spark):
    # the two texts of doc 5 are two nodes that share a name
    rows = [r for r in awkward_rows() if r[0] != 5]
    assert result(similar_documents(frame(spark, rows), 4, 85)) == expected(rows, 4, 85)


@pytest.mark.parametrize(("size", "percent", "few"), [(4, 85, 32), (1, 80, 2), (2, 60, 2), (2, 70, 3), (5, 95, 2)])
def test_random_corpus(spark, monkeypatch, size, percent, few):
    monkeypatch.setattr(jaccard, "FEW_MEMBERS", few)
    monkeypatch.setattr(jaccard, "CHUNK_MEMBERS", 3)
    rows = many(130, seed=size)
    found = similar_documents(frame(spark, rows), size, percent)
    assert result(found) == expected(rows, size, percent)


def test_family_around_one_text(spark, monkeypatch):
    """Copies with few or many edits: some are linked through others only, some not at all."""
    monkeypatch.setattr(jaccard, "FEW_MEMBERS", 4)
    monkeypatch.setattr(jaccard, "CHUNK_MEMBERS", 20)
    rng = random.Random(5)
    first = sentence(rng, 120).split()
    rows = []
    for i in range(150):
        words = first[:]
        for _ in range(rng.randrange(1, 7)):
            words[rng.randrange(len(words))] = f"edit{rng.randrange(9)}"
        rows.append((i, " ".join(words), "en", "s", 1))
    found = similar_documents(frame(spark, rows), 4, 85)
    assert result(found) == expected(rows, 4, 85)


def test_common_passage_with_few_own_words(spark):
    """Many documents around one passage: sketch words of the passage alone are common."""
    rng = random.Random(8)
    passage = sentence(rng, 40)
    rows = [(i, f"{passage} {sentence(rng, rng.randrange(2, 30), 'q')}", "en", "s", 1) for i in range(120)]
    rows += [(200 + i, f"{r[1]} tail{i}", "en", "s", 1) for i, r in enumerate(rows[:40])]
    found = similar_documents(frame(spark, rows), 2, 85)
    assert result(found) == expected(rows, 2, 85)


def sketch_places(text, length):
    data = np.frombuffer(text.encode(), np.uint8)
    hashes, _ = jaccard.shingle_sets(jaccard.Words(data, np.array([0, len(data)]), lower=True), 4)
    spread = jaccard.mixed(hashes ^ np.uint64(3)) >> np.uint64(32)
    return set((spread * np.uint64(length) >> np.uint64(32)).tolist())


def test_sets_in_one_sketch_word_meet(spark):
    """Six shingles in one sketch word, and the same with a shingle in another word."""
    length, _ = Bands(85).shape(Bands(85).of(6)[0])
    texts = (" ".join(f"v{i}x{j}" for j in range(9)) for i in range(100_000))
    text = next(t for t in texts if len(sketch_places(t, length)) == 1)
    longer = next(t for i in range(100) if len(sketch_places(t := f"{text} y{i}", length)) == 2)
    rows = [(1, text, "en", "s", 1), (2, longer, "en", "s", 1)]
    assert result(similar_documents(frame(spark, rows), 4, 85)) == [(1, 6, 1), (2, 7, 1)]


def test_bands_cover_every_linkable_pair():
    for percent in (60, 85, 95):
        bands = Bands(percent)
        for a in range(1, 400):
            for b in range(a + 1, bands.reach(a) + 1):
                band = max(bands.of(a))
                assert band in bands.of(b), (a, b)
                differ = (100 - percent) * (a + b) // (100 + percent)
                assert bands.shape(band)[0] >= differ + 1 + bands.shape(band)[1]


def test_empty_table(spark):
    assert similar_documents(frame(spark, []), 4, 85).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (500, 400)]
    rng = random.Random(2)
    rng.shuffle(links)
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {400: 400, 500: 400}
    assert found == want
