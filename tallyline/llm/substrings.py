"""Removal of word passages repeated across documents, by level-wise doubling.

Windows of half the asked length come first.  Only where such a window is repeated in
another document are windows of the full length looked at, only where two repeated
windows of one length lie end to end is the window of twice that length looked at, and
so on until no candidate survives.  The asked length decides what is removed; the levels
above give each document the length of its longest repeat.

The first level keeps one window per stretch: of the half windows in each full window
the one with the smallest hash.  Equal full windows have equal half windows, so they
choose the same one, and no repeat is lost; a thirteenth of the windows is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.words import Words, mixed, pieces
from tallyline.sinks.workspace import scratch_dir

#: A row of the input is known by its id and its text's checksum.
KEY = ["doc_id", "_c"]
_KEYS = "doc_id long, _c int"
_NONE = "cast(null as array<int>)"


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("_c", F.expr("cast(crc32(text) - 2147483648 as int)"))


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours, by doubling."""
    span, least = 1, values
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = width - span
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def _anchors(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of all windows of ``size``, and the anchor hash of each."""
    half = size // 2
    full = words.windows(size)
    if not len(full):
        return full, np.zeros(0, np.uint64)
    hashes = np.zeros(len(words.hashes), np.uint64)
    short = words.windows(half)
    hashes[short] = words.spans(short, short + half)
    return full, _smallest(hashes, size - half + 1)[full]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _rows(batch: pa.RecordBatch, rows: np.ndarray, **columns: pa.Array) -> pa.RecordBatch:
    taken = pa.array(rows)
    arrays = [batch.column(k).take(taken) for k in KEY]
    return pa.RecordBatch.from_arrays([*arrays, *columns.values()], [*KEY, *columns])


def _first_level(docs: DataFrame, size: int) -> DataFrame:
    """Anchors (``h2`` 0) of every document, and one row for its whole word sequence."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, _, data, offsets in pieces(batch):
                words = Words(data, offsets)
                full, anchor = _anchors(words, size)
                owner = words.owner()[full]
                new = np.ones(len(full), bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
                long = np.flatnonzero(words.counts() >= size)
                h1 = np.concatenate([anchor[new], words.whole(long)])
                h2 = np.concatenate([np.zeros(int(new.sum()), np.uint64), words.whole(long, 1) | np.uint64(1)])
                rows = row + np.concatenate([owner[new], long])
                yield _rows(batch, rows, h1=_signed(h1), h2=_signed(h2))

    return docs.mapInArrow(emit, f"{_KEYS}, h1 long, h2 long")


def _repeated(rows: DataFrame, folder: str) -> DataFrame:
    """Rows whose hashes occur in two documents, with the smallest one's id as ``first``.

    Counting combines in the map tasks.  Its result is stored, so that the join back is
    one of two plain exchanges, which Spark splits where a passage is in very many documents.
    """
    firsts = rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("_last"))
    firsts.where("first < _last").drop("_last").write.parquet(folder)
    return rows.join(rows.sparkSession.read.parquet(folder), ["h1", "h2"])


def _full_windows(docs: DataFrame, size: int) -> DataFrame:
    """Windows of ``size`` words whose anchor is among the document's ``anchors``."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("anchors")
            places = np.asarray(lists.offsets)
            known = np.asarray(lists.values).view(np.uint64)
            for row, stop, data, offsets in pieces(batch):
                words = Words(data, offsets)
                full, anchor = _anchors(words, size)
                # an anchor repeated for one document is repeated for every one
                at = full[np.isin(anchor, known[places[row] : places[stop]])]
                owner = words.owner()[at]
                yield _rows(
                    batch,
                    row + owner,
                    pos=pa.array((at - words.first[owner]).astype(np.int32)),
                    h1=_signed(words.spans(at, at + size)),
                    h2=_signed(words.spans(at, at + size, 1)),
                )

    return docs.mapInArrow(emit, f"{_KEYS}, pos int, h1 long, h2 long")


def _doubled(table: DataFrame, size: int) -> DataFrame:
    """Windows of ``2 * size`` made of two stored windows of ``size`` end to end."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("windows")
            ends = np.asarray(lists.offsets).astype(np.int64)
            pos = np.asarray(lists.values.field("pos")).astype(np.int64)[ends[0] : ends[-1]]
            hashes = np.asarray(lists.values.field("h1")).view(np.uint64)[ends[0] : ends[-1]]
            if not len(pos):
                continue
            owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            place = owner * (int(pos.max()) + size + 1) + pos
            order = np.argsort(place)
            place, owner, pos, hashes = place[order], owner[order], pos[order], hashes[order]
            after = np.minimum(np.searchsorted(place, place + size), len(place) - 1)
            both = np.flatnonzero((place[after] == place + size) & (owner[after] == owner))
            joined = mixed(hashes[both] * np.uint64(0x9E3779B97F4A7C15) ^ hashes[after[both]])
            yield _rows(
                batch,
                owner[both],
                pos=pa.array(pos[both].astype(np.int32)),
                h1=_signed(joined),
                h2=_signed(np.zeros(len(both), np.uint64)),
            )

    return table.select(*KEY, "windows").mapInArrow(emit, f"{_KEYS}, pos int, h1 long, h2 long")


def _kept(marked: DataFrame, size: int) -> DataFrame:
    """Counts words and drops those under the windows at ``removed``."""
    schema = "doc_id long, n_words long, n_removed long, kept string, longest_repeat long"

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("removed")
            places = np.asarray(lists.offsets)
            starts = np.asarray(lists.values)
            copy = np.asarray(batch.column("copy"))
            longest = np.asarray(batch.column("longest"))
            for row, stop, data, offsets in pieces(batch):
                raw = data.tobytes()
                n_words, n_removed, kept = [], [], []
                for i in range(row, stop):
                    words = raw[offsets[i - row] : offsets[i - row + 1]].split()
                    n = len(words)
                    at = starts[places[i] : places[i + 1]]
                    gone = 0
                    if copy[i]:
                        words, gone = [], n
                    elif len(at):
                        cover = np.zeros(n + 1, np.int32)
                        np.add.at(cover, at, 1)
                        np.add.at(cover, at + size, -1)
                        stay = np.cumsum(cover[:-1]) == 0
                        gone = n - int(stay.sum())
                        words = list(compress(words, stay))
                    n_words.append(n)
                    n_removed.append(gone)
                    kept.append(b" ".join(words).decode("utf-8"))
                most = np.where(copy[row:stop], n_words, longest[row:stop])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, stop - row),
                        pa.array(n_words, pa.int64()),
                        pa.array(n_removed, pa.int64()),
                        pa.array(kept, pa.string()),
                        pa.array(most, pa.int64()),
                    ],
                    ["doc_id", "n_words", "n_removed", "kept", "longest_repeat"],
                )

    return marked.mapInArrow(emit, schema)


def remove_repeats(docs: DataFrame, size: int = 50) -> DataFrame:
    """``doc_id, n_words, n_removed, kept, longest_repeat`` of every document.

    Words are runs outside space and 0x09-0x0D of the whole ``text``.  A word goes if a
    window of ``size`` words over it also starts in a document with a smaller ``doc_id``,
    judged on the input.  ``kept`` joins the words that stay by one space.
    ``longest_repeat`` is the longest level (``size``, doubled any number of times) at
    which a window of the document is in another one that is no copy, all its words for a
    whole copy of an earlier document, or 0.

    A null text has no words.  A row with a null ``doc_id`` is neither before nor behind
    any other: it keeps everything.  Rows of one ``doc_id`` are one document, so they take
    nothing from each other.  Other columns of ``docs`` are ignored.  Windows are compared
    by 128-bit hashes.
    """
    spark = docs.sparkSession
    base = scratch_dir(spark, "repeats")
    keyed = _keyed(docs)

    found = (
        _repeated(_first_level(keyed.where("doc_id is not null"), size), f"{base}/repeated-anchors")
        .groupBy(*KEY)
        .agg(
            F.max(F.expr("h2 != 0 and first < doc_id")).alias("copy"),
            F.collect_set(F.expr("if(h2 = 0, h1, null)")).alias("anchors"),
        )
    )
    found.write.parquet(f"{base}/found")
    found = spark.read.parquet(f"{base}/found")

    inner = keyed.join(found.where("not copy and size(anchors) > 0").drop("copy"), KEY)
    rows = _full_windows(inner, size)
    notes = [found.where("copy").selectExpr(*KEY, "copy", f"{_NONE} as removed", "0 as longest")]
    level = size
    while True:
        held = F.struct("pos", "h1", F.expr("first < doc_id").alias("gone"))
        folder = f"{base}/level-{level}"
        _repeated(rows, f"{base}/repeated-{level}").groupBy(*KEY).agg(F.collect_list(held).alias("windows")).write.parquet(folder)
        table = spark.read.parquet(folder)
        if table.isEmpty():
            break
        removed = "transform(filter(windows, w -> w.gone), w -> w.pos)" if level == size else _NONE
        notes.append(table.selectExpr(*KEY, "false as copy", f"{removed} as removed", f"{level} as longest"))
        rows = _doubled(table, level)
        level *= 2
    marks = notes[0]
    for note in notes[1:]:
        marks = marks.unionByName(note)
    marks = marks.groupBy(*KEY).agg(
        F.max("copy").alias("copy"),
        F.flatten(F.collect_list("removed")).alias("removed"),
        F.max("longest").alias("longest"),
    )
    marked = keyed.join(marks, KEY, "left").select(
        "doc_id",
        "text",
        F.coalesce("copy", F.lit(False)).alias("copy"),
        F.coalesce("removed", F.expr("cast(array() as array<int>)")).alias("removed"),
        F.coalesce(F.col("longest").cast("long"), F.lit(0)).alias("longest"),
    )
    return _kept(marked, size)
