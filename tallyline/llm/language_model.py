"""Interpolated modified Kneser-Ney bigram model: counted in Spark, scored from files.

The model is sorted arrays in the shared folder, written by tasks and memory-mapped by
the workers that score, so neither a worker's nor the driver's memory grows with it:

* vocabulary shards: sorted 64-bit word hashes; a word's id is its place over all shards;
  beside them, per word, its count, its left neighbours and its right neighbours' kinds;
* bigram shards: sorted keys ``left id << 32 | right id`` and their counts.

Bigrams are dealt to shards by their left word, a frequent left word being spread over as
many shards as its count needs, so no shard grows beyond its size however the words are
distributed.  Counts of a piece of text travel packed, a row per shard, and a task stores
one shard after the other.  Discounts need the counts of counts only.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.words import Words, mixed, pieces, tidy
from tallyline.sinks.workspace import scratch_dir

#: Stand for the end of a text (a token) and its start (a context only).
END_HASH = np.uint64(0x656E64)
START_ID = (1 << 32) - 1
#: Rows of a vocabulary or bigram shard, about.
SHARD_ROWS = 1_000_000
#: Text bytes counted at a time in a task; counts of one piece are combined before the shuffle.
COUNT_BYTES = 1 << 21
#: Bigrams packed into one row at most.
ROW_PAIRS = 1 << 18
#: Per-word figures: kinds of right neighbours seen once, twice and more, kinds of left neighbours.
FIGURES = ("one", "two", "more", "before")


def shared_path(folder: str) -> str:
    """The path of a shared folder as files; memory mapping needs it mounted."""
    if folder.startswith("file:"):
        return "/" + folder.removeprefix("file:").lstrip("/")
    if "://" in folder:
        raise ValueError(f"{folder}: the model is memory-mapped, so the shared folder must be mounted")
    return folder


def _save(path: str, array: np.ndarray) -> None:
    """Writes a file at once, so that a repeated task leaves the same file."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as file:
        np.save(file, array)
    os.replace(part, path)


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts, first)


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words and ends of all texts in a row, and where each text's begin."""
    words = Words(data, offsets, lower=True)
    places = words.first + np.arange(len(words.first))
    hashes = np.full(places[-1], END_HASH)
    body = np.ones(len(hashes), bool)
    body[places[1:] - 1] = False
    hashes[body] = words.hashes
    return hashes, places


def _left(values: np.ndarray, places: np.ndarray, start: int) -> np.ndarray:
    """The value of each token's left neighbour, ``start`` before a text's first."""
    left = np.empty_like(values)
    left[1:] = values[:-1]
    left[places[:-1]] = start
    return left


@dataclass
class Model:
    """What driver and workers know of a stored model."""

    folder: str
    words: int = 0
    tokens: int = 0
    texts: int = 0
    word_shards: int = 1
    first_ids: list[int] = field(default_factory=list)
    pair_shards: int = 1
    pairs: int = 0
    start: tuple[int, int, int] = (0, 0, 0)
    pair_discounts: tuple[float, float, float] = (0.0, 0.0, 0.0)
    word_discounts: tuple[float, float, float] = (0.0, 0.0, 0.0)
    word_left: float = 1.0

    def word_shard(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes >> np.uint64(32)) * np.uint64(self.word_shards) >> np.uint64(32)).astype(np.int64)

    def pair_shard(self, left: np.ndarray, right: np.ndarray, left_count: np.ndarray) -> np.ndarray:
        spread = -(-left_count // SHARD_ROWS)
        deal = left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        deal = mixed(deal + (right % np.maximum(spread, 1)).astype(np.uint64))
        return ((deal >> np.uint64(32)) * np.uint64(self.pair_shards) >> np.uint64(32)).astype(np.int64)


class Stored:
    """A worker's memory-mapped view of a model's files."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.files: dict[str, np.ndarray] = {}

    def file(self, name: str) -> np.ndarray:
        if name not in self.files:
            path = f"{self.model.folder}/{name}.npy"
            empty = os.path.getsize(path) <= 128 if os.path.exists(path) else True
            self.files[name] = np.zeros(0, np.int64) if empty else np.load(path, mmap_mode="r")
        return self.files[name]

    def words(self, hashes: np.ndarray, figures: tuple[str, ...] = ()) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Ids of words, -1 for those not in the vocabulary, and per-word figures, 0 for them."""
        keys, which = np.unique(hashes, return_inverse=True)
        ids = np.full(len(keys), -1, np.int64)
        out = {name: np.zeros(len(keys), np.int64) for name in figures}
        shards = self.model.word_shard(keys)
        for shard in np.unique(shards):
            mine = np.flatnonzero(shards == shard)
            held = self.file(f"words/{shard}")
            if len(held):
                at = np.minimum(np.searchsorted(held, keys[mine]), len(held) - 1)
                same = held[at] == keys[mine]
                ids[mine[same]] = at[same] + self.model.first_ids[shard]
                for name in figures:
                    out[name][mine[same]] = self.file(f"{name}/{shard}")[at[same]]
        return ids[which], {name: values[which] for name, values in out.items()}

    def pair_counts(self, left: np.ndarray, right: np.ndarray, left_count: np.ndarray) -> np.ndarray:
        """Counts of bigrams of known ids."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        keys, first, which = np.unique(keys, return_index=True, return_inverse=True)
        out = np.zeros(len(keys), np.int64)
        shards = self.model.pair_shard(left[first], right[first], left_count[first])
        order = np.argsort(shards, kind="stable")
        for mine in np.split(order, np.flatnonzero(np.diff(shards[order])) + 1):
            if not len(mine):
                continue
            held = self.file(f"pairs/{shards[mine[0]]}")
            if len(held):
                at = np.minimum(np.searchsorted(held, keys[mine]), len(held) - 1)
                same = held[at] == keys[mine]
                out[mine[same]] = self.file(f"pair-counts/{shards[mine[0]]}")[at[same]]
        return out[which]


_STORED: dict[str, Stored] = {}


def _stored(model: Model) -> Stored:
    if model.folder not in _STORED:
        _STORED.clear()
        _STORED[model.folder] = Stored(model)
    return _STORED[model.folder]


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more, from counts of counts.

    Where a small corpus lacks a count of counts, half a count is taken off.
    """
    n1, n2, n3, n4 = n
    if not n1 or not n2:
        return (0.5, 0.5, 0.5)
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.5]
    return tuple(min(max(d, 0.05), k) for d, k in zip(raw, (1.0, 2.0, 3.0), strict=True))


def _dealt(rows: DataFrame, shards: int) -> DataFrame:
    """Rows dealt to tasks by ``shard``, those of a shard one after the other."""
    return rows.repartition(shards, "shard").sortWithinPartitions("shard")


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Each shard of dealt rows with all of its rows."""
    now, held = None, []
    for batch in batches:
        shard = batch.column("shard").to_numpy()
        edges = np.flatnonzero(shard[1:] != shard[:-1]) + 1
        for begin, end in pairwise([0, *edges.tolist(), len(shard)]):
            if begin == end:
                continue
            if shard[begin] != now:
                if held:
                    yield now, held
                now, held = int(shard[begin]), []
            held.append(batch.slice(begin, end - begin))
    if held:
        yield now, held


def _column(parts: list[pa.RecordBatch], name: str) -> np.ndarray:
    return np.concatenate([part.column(name).to_numpy() for part in parts])


def _packed(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """A row of bytes for the values between each two edges."""
    ends = (edges * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(edges) - 1, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))]
    )


def _unpacked(parts: list[pa.RecordBatch], name: str, kind: type) -> np.ndarray:
    """The values of all packed rows."""
    out = []
    for part in parts:
        column = part.column(name).cast(pa.large_binary())
        _, places, data = column.buffers()
        ends = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
        out.append(np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(kind))
    return np.concatenate(out)


def _count_words(train: DataFrame) -> DataFrame:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in pieces(batch, most=COUNT_BYTES):
                hashes, _ = _tokens(data, offsets)
                keys, n = np.unique(hashes, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(n)], ["h", "n"]
                )

    return train.mapInArrow(tidy(emit), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def _store_words(counts: DataFrame, model: Model) -> DataFrame:
    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("h").to_numpy().view(np.uint64)
            yield batch.append_column("shard", pa.array(model.word_shard(hashes)))

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, parts in _by_shard(batches):
            hashes = _column(parts, "h").view(np.uint64)
            order = np.argsort(hashes)
            n = _column(parts, "n")[order]
            _save(f"{model.folder}/words/{at}.npy", hashes[order])
            _save(f"{model.folder}/word-counts/{at}.npy", n)
            yield pa.RecordBatch.from_pydict({"shard": [at], "rows": [len(n)], "total": [int(n.sum())]})

    dealt = _dealt(counts.mapInArrow(tidy(shard), "h long, n long, shard long"), model.word_shards)
    return dealt.mapInArrow(tidy(store), "shard long, rows long, total long")


def _count_pairs(train: DataFrame, model: Model) -> DataFrame:
    """``shard, keys, counts``: bigrams of a piece of text, packed by shard."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stored = _stored(model)
        for batch in batches:
            for _, _, data, offsets in pieces(batch, most=COUNT_BYTES):
                hashes, places = _tokens(data, offsets)
                ids, figures = stored.words(hashes, ("word-counts",))
                keys, first, n = np.unique(
                    _left(ids, places, START_ID).astype(np.uint64) << np.uint64(32) | ids.astype(np.uint64),
                    return_index=True,
                    return_counts=True,
                )
                left, right = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(START_ID)).astype(np.int64)
                count = _left(figures["word-counts"], places, model.texts)[first]
                shard = model.pair_shard(left, right, count)
                order = np.argsort(shard, kind="stable")
                shard, keys, n = shard[order], keys[order], n[order].astype(np.uint32)
                for begin in range(0, len(keys), ROW_PAIRS):
                    mine = shard[begin : begin + ROW_PAIRS]
                    edges = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1], [True]]))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(mine[edges[:-1]].astype(np.int32)),
                            _packed(keys[begin : begin + ROW_PAIRS], edges),
                            _packed(n[begin : begin + ROW_PAIRS], edges),
                        ],
                        ["shard", "keys", "counts"],
                    )

    return train.mapInArrow(tidy(emit), "shard int, keys binary, counts binary")


def _store_pairs(rows: DataFrame, model: Model) -> DataFrame:
    """Stores bigram shards; returns figures of words seen in each.

    ``kind`` 0: a word's ``FIGURES``; 1: how many bigrams occur ``id`` times, as ``one``.
    """

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, parts in _by_shard(batches):
            keys, n = _merged(_unpacked(parts, "keys", np.uint64), _unpacked(parts, "counts", np.uint32).astype(np.int64))
            parts.clear()
            _save(f"{model.folder}/pairs/{at}.npy", keys)
            _save(f"{model.folder}/pair-counts/{at}.npy", n.astype(np.uint32))
            left, first = np.unique(keys >> np.uint64(32), return_index=True)
            right, neighbours = np.unique(keys & np.uint64(START_ID), return_counts=True)
            ids = np.union1d(left, right)
            lefts, rights = np.searchsorted(ids, left), np.searchsorted(ids, right)
            figures = {name: np.zeros(len(ids) + 4, np.int32) for name in FIGURES}
            for name, seen in (("one", n == 1), ("two", n == 2), ("more", n >= 3)):
                figures[name][lefts] = np.add.reduceat(seen.astype(np.int32), first)
            figures["before"][rights] = neighbours
            figures["one"][len(ids) :] = [np.count_nonzero(n == k) for k in range(1, 5)]
            kind = np.repeat(np.array([0, 1], np.int32), [len(ids), 4])
            out = pa.RecordBatch.from_pydict(
                {"kind": kind, "id": np.append(ids.astype(np.int64), range(1, 5)), **figures}
            )
            yield from (out.slice(begin, 1 << 16) for begin in range(0, out.num_rows, 1 << 16))

    columns = ", ".join(f"{name} int" for name in FIGURES)
    return (
        _dealt(rows, model.pair_shards)
        .mapInArrow(tidy(store), f"kind int, id long, {columns}")
        .groupBy("kind", "id")
        .agg(*[F.sum(name).alias(name) for name in FIGURES])
    )


def _store_figures(figures: DataFrame, model: Model, sizes: dict[int, int]) -> int:
    """Writes per-word figures beside the vocabulary shards."""
    first = np.array(model.first_ids)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = np.searchsorted(first, batch.column("id").to_numpy(), "right") - 1
            yield batch.append_column("shard", pa.array(shard))

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, parts in _by_shard(batches):
            place = _column(parts, "id") - first[at]
            for name in FIGURES:
                out = np.zeros(sizes[at], np.int64)
                out[place] = _column(parts, name)
                _save(f"{model.folder}/{name}/{at}.npy", out)
            yield pa.RecordBatch.from_pydict({"shard": [at]})

    columns = ", ".join(f"{name} long" for name in FIGURES)
    dealt = figures.select("id", *FIGURES).mapInArrow(tidy(deal), f"id long, {columns}, shard long")
    return _dealt(dealt, model.word_shards).mapInArrow(tidy(store), "shard long").count()


def train_model(train: DataFrame, shard_rows: int = SHARD_ROWS) -> Model:
    """Counts ``text`` (whole, lower-cased A-Z; null is empty) and stores the model.

    The driver sees one row per shard and the counts of counts.
    """
    spark = train.sparkSession
    base = scratch_dir(spark, "model")
    model = Model(shared_path(base) + "/arrays")
    os.makedirs(model.folder, exist_ok=True)
    train = train.select(F.col("text").cast("string").alias("text"))
    model.texts = train.count()
    _count_words(train).write.parquet(f"{base}/words")
    counts = spark.read.parquet(f"{base}/words")
    model.words = counts.count()
    model.word_shards = max(1, -(-model.words // shard_rows))
    shards = {r["shard"]: (r["rows"], r["total"]) for r in _store_words(counts, model).collect()}
    sizes = {s: shards.get(s, (0, 0))[0] for s in range(model.word_shards)}
    model.first_ids = np.concatenate([[0], np.cumsum(list(sizes.values()))])[:-1].tolist()
    model.tokens = sum(total for _, total in shards.values())
    model.pair_shards = max(1, -(-model.tokens // shard_rows))

    _store_pairs(_count_pairs(train, model), model).write.parquet(f"{base}/figures")
    figures = spark.read.parquet(f"{base}/figures")
    of_counts = {r["id"]: r["one"] for r in figures.where("kind = 1").collect()}
    model.pair_discounts = discounts([of_counts.get(k, 0) for k in range(1, 5)])
    start = figures.where(f"kind = 0 and id = {START_ID}").collect()
    model.start = tuple(start[0][c] for c in FIGURES[:3]) if start else (0, 0, 0)
    rights = figures.where("kind = 0 and before > 0").groupBy(F.expr("least(before, 5)").alias("k"))
    kinds = {r["k"]: (r["n"], r["total"]) for r in rights.agg(F.count("before").alias("n"), F.sum("before").alias("total")).collect()}
    model.word_discounts = discounts([kinds.get(k, (0, 0))[0] for k in range(1, 5)])
    model.pairs = sum(total for _, total in kinds.values())
    many = sum(n for k, (n, _) in kinds.items() if k >= 3)
    d1, d2, d3 = model.word_discounts
    if model.pairs:
        model.word_left = (d1 * kinds.get(1, (0, 0))[0] + d2 * kinds.get(2, (0, 0))[0] + d3 * many) / model.pairs
    _store_figures(figures.where(f"kind = 0 and id < {START_ID}"), model, sizes)
    return model


def _off(counts: np.ndarray, by: tuple[float, float, float]) -> np.ndarray:
    """Counts less their discount, 0 for 0."""
    less = np.array([0.0, *by])
    return np.maximum(counts - less[np.minimum(counts, 3)], 0.0)


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """Adds ``n_tokens, n_known, base_score, score`` to documents.

    Null texts are empty and consist of the end.  ``score`` is the sum of log10
    probabilities: the discounted share of the bigram plus the left word's remainder times
    the word's share of distinct left neighbours, which itself leaves a remainder for one
    uniform share of all words and one unknown.  After an unknown word, the second part
    alone.  ``base_score`` is the add-one unigram's.
    """
    keep = [c for c in docs.columns if c != "text"]
    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join(f"`{c}` {fields[c]}" for c in keep)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stored = _stored(model)
        for batch in batches:
            for row, stop, data, offsets in pieces(batch):
                hashes, places = _tokens(data, offsets)
                ids, figures = stored.words(hashes, ("word-counts", "before", "one", "two", "more"))
                count = figures["word-counts"]
                left, seen = _left(ids, places, START_ID), _left(count, places, model.texts)
                rest = np.zeros(len(ids))
                for name, d, s in zip(("one", "two", "more"), model.pair_discounts, model.start, strict=True):
                    rest += d * _left(figures[name], places, s)
                lower = _off(figures["before"], model.word_discounts) / max(model.pairs, 1)
                lower += model.word_left / (model.words + 1)
                both = np.flatnonzero((ids >= 0) & (left >= 0) & (seen > 0))
                pair = np.zeros(len(ids), np.int64)
                pair[both] = stored.pair_counts(left[both], ids[both], seen[both])
                total = np.maximum(seen, 1)
                share = np.where(seen > 0, _off(pair, model.pair_discounts) / total + rest / total * lower, lower)
                base = np.log10((count + 1) / (model.tokens + model.words + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).slice(row, stop - row) for c in keep],
                        pa.array(np.diff(places)),
                        pa.array(np.add.reduceat((count > 0).astype(np.int64), places[:-1])),
                        pa.array(np.add.reduceat(base, places[:-1])),
                        pa.array(np.add.reduceat(np.log10(share), places[:-1])),
                    ],
                    [*keep, "n_tokens", "n_known", "base_score", "score"],
                )

    columns = "n_tokens long, n_known long, base_score double, score double"
    return docs.mapInArrow(tidy(emit), f"{schema}, {columns}" if keep else columns)


def held_out_scores(docs: DataFrame, fold: str) -> DataFrame:
    """Learns from documents where ``fold`` (SQL over ``doc_id``) is false, scores all.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.
    A null ``doc_id`` is held out.  Rows that repeat are counted and scored each.
    """
    docs = docs.select(
        F.col("doc_id").cast("long"),
        F.col("text").cast("string"),
        F.coalesce(F.expr(fold), F.lit(True)).alias("held_out"),
    )
    model = train_model(docs.where("not held_out"))
    scored = score_texts(docs, model)
    return scored.withColumn("train_tokens", F.lit(model.tokens).cast("long")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
