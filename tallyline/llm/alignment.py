"""Token alignment of two tokenizers over the same bytes, with corpus-wide link counts.

The texts are cut before each space that follows neither white space nor a text's start.
No token of either tokenizer reaches across such a place, so ids and alignment of a text
are those of its chunks in a row, and each distinct chunk is encoded and aligned once.

A chunk is aligned by two dictionaries from cumulative byte ends to token places.  The ends
in both, sorted, cut the id lists into groups, and inside a group every pair of tokens
whose bytes overlap is a link.

How many documents hold a pair is known for the whole corpus only.  Texts are therefore
stored as blocks: each lists its distinct pairs once, these are counted and joined back to
the blocks, and a document's sums are taken from its block's short list.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate, count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tallyline.llm.tokens import _wide_space
from tallyline.llm.words import _SPACE, _ranges, pieces, run_hashes
from tallyline.sinks.workspace import scratch_dir

#: Bytes of text in a block.
BLOCK_BYTES = 2 << 20
#: Chunks and links remembered per worker; only a cache, emptied when full.
CACHED_CHUNKS = 400_000
CACHED_LINKS = 8_000_000

_DOCS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "sha", "entries"]
_BLOCKS = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
    "n_links array<long>, sha array<string>, entries array<long>, places binary, times binary, "
    "pairs array<long>, held array<long>"
)


def _byte_level() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(0x100) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def byte_level_tokens(tokenizer: Tokenizer) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary."""
    letters = _byte_level()
    names = (tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size()))
    return [bytes(letters[c] for c in x) if all(c in letters for c in x) else x.encode() for x in names]


def piece_tokens(model: SentencePieceProcessor) -> list[bytes]:
    """The bytes of each id of a piece vocabulary."""
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            out.append(bytes([int(piece[1:-1], 16)]))
        else:
            out.append(piece.replace("▁", " ").encode())
    return out


def aligned(a_sizes: list[int], b_sizes: list[int]) -> list[tuple[int, int, int, int]]:
    """Groups of two tokenizations of the same bytes, as ranges of token places of A and of B."""
    first = dict(zip(accumulate(a_sizes), count(1), strict=False))
    second = dict(zip(accumulate(b_sizes), count(1), strict=False))
    groups, a, b = [], 0, 0
    for end in sorted(first.keys() & second.keys()):
        groups.append((a, a := first[end], b, b := second[end]))
    return groups


def links_inside(a_sizes: list[int], b_sizes: list[int]) -> list[tuple[int, int]]:
    """Places of overlapping tokens inside one group, where only the last ends meet."""
    if len(a_sizes) == 1 or len(b_sizes) == 1:
        return [(x, y) for x in range(len(a_sizes)) for y in range(len(b_sizes))]
    links, x, y = [], 0, 0
    x_end, y_end = a_sizes[0], b_sizes[0]
    while True:
        links.append((x, y))
        if x_end < y_end:
            x += 1
            x_end += a_sizes[x]
        elif y_end < x_end:
            y += 1
            y_end += b_sizes[y]
        else:
            return links


class Aligner:
    """Aligned chunks of texts for a byte-level file (A) and a piece model (B)."""

    def __init__(self, byte_level: str, piece_model: str) -> None:
        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=piece_model)
        self.a_bytes, self.b_bytes = byte_level_tokens(self.a), piece_tokens(self.b)
        inner = (x.lstrip(b" ") for x in self.b_bytes)
        if any(b" " in x for x in inner):
            raise ValueError(f"pieces of {piece_model} reach across spaces")
        self.a_sizes, self.b_sizes = list(map(len, self.a_bytes)), list(map(len, self.b_bytes))
        self.shown = [str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.space = [self.b.piece_to_id("▁")]
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.slots = np.zeros(0, np.int64)
        #: for each slot: tokens of A and B, groups, links, whether the bytes are the text's
        self.facts = np.zeros((0, 5), np.int64)
        self.begin = np.zeros(0, np.int64)
        self.links = np.zeros(0, np.int64)
        self.groups: list[str] = []

    def _chunk(self, chunk: bytes, a: list[int], b: list[int], links: list[int]) -> tuple[int, int, int, int, int]:
        """Facts of one chunk; its links and its groups as text are put behind the others."""
        joined = b"".join(map(self.a_bytes.__getitem__, a)), b"".join(map(self.b_bytes.__getitem__, b))
        if not joined[0] == joined[1] == chunk:
            self.groups.append("")
            return 0, 0, 0, 0, 0
        before, shown, text = len(links), [], self.shown
        left, right = [self.a_sizes[i] for i in a], [self.b_sizes[i] for i in b]
        for a_from, a_to, b_from, b_to in aligned(left, right):
            if a_to - a_from == 1:
                x = a[a_from]
                if b_to - b_from == 1:
                    y = b[b_from]
                    shown.append(f"{text[x]}|{text[y]}")
                    links.append(x << 32 | y)
                    continue
                some = b[b_from:b_to]
                shown.append(f"{text[x]}|{','.join([text[y] for y in some])}")
                links += [x << 32 | y for y in some]
                continue
            one, other = a[a_from:a_to], b[b_from:b_to]
            shown.append(f"{','.join([text[x] for x in one])}|{','.join([text[y] for y in other])}")
            links += [one[i] << 32 | other[j] for i, j in links_inside(left[a_from:a_to], right[b_from:b_to])]
        self.groups.append(";".join(shown))
        return len(a), len(b), len(shown), len(links) - before, 1

    def _learn(self, keys: np.ndarray, chunks: list[bytes]) -> None:
        facts, links = [], []
        for start in range(0, len(chunks), 4000):
            some = chunks[start : start + 4000]
            texts = [c.decode("utf-8") for c in some]
            firsts = self.a.encode_batch_fast(texts, add_special_tokens=False)
            # the model puts a space in front by itself, but not of nothing
            others = self.b.encode([t[1:] for t in texts], num_threads=1)
            for chunk, a, b in zip(some, firsts, others, strict=True):
                facts.append(self._chunk(chunk, a.ids, b if len(chunk) > 1 else self.space, links))
        new = np.array(facts, np.int64).reshape(-1, 5)
        slots = len(self.begin) + np.arange(len(new))
        self.begin = np.append(self.begin, len(self.links) + np.cumsum(new[:, 3]) - new[:, 3])
        self.facts = np.concatenate([self.facts, new])
        self.links = np.append(self.links, np.array(links, np.int64))
        at = np.searchsorted(self.keys, keys)
        self.keys, self.slots = np.insert(self.keys, at, keys), np.insert(self.slots, at, slots)

    def _known(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] == keys

    def chunks(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slots of the chunks of all texts in a row, and where each text's begin.

        Every text in ``data`` begins with the space put before it.
        """
        closed = _SPACE[data]
        wide = _wide_space(data)
        closed[wide + np.where(data[wide] == 0xC2, 1, 2)] = True
        first = (data == 0x20) & ~np.roll(closed, 1)
        first[offsets[:-1]] = True
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(data))
        hashes = run_hashes(data, starts, ends)
        keys, where, which = np.unique(hashes, return_index=True, return_inverse=True)
        new = ~self._known(keys)
        if len(self.keys) + int(new.sum()) > CACHED_CHUNKS or len(self.links) > CACHED_LINKS:
            self._clear()
            new[:] = True
        if new.any():
            raw, at = data.tobytes(), where[new]
            self._learn(keys[new], [raw[x:y] for x, y in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
        slots = self.slots[np.searchsorted(self.keys, keys)][which]
        return slots, np.searchsorted(starts, offsets)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(byte_level: str, piece_model: str) -> Aligner:
    """One aligner per worker process and pair of files."""
    if (key := (byte_level, piece_model)) not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(*key)
    return _ALIGNERS[key]


def _summed(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.append(0, np.cumsum(values))[offsets])


def _block(work: Aligner, docs: pa.Array, data: np.ndarray, offsets: np.ndarray) -> dict:
    """One block: facts of its documents, their pairs with how often, and the distinct pairs."""
    empty = np.diff(offsets) == 0
    spaced = np.insert(data, offsets[:-1][~empty], 0x20)
    offsets = offsets + np.append(0, np.cumsum(~empty))
    row = {"doc_id": docs.to_pylist()}
    n = len(offsets) - 1
    facts, slots, owner = np.zeros((n, 5), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    sound, shas = np.zeros(n, bool), [""] * n
    if len(spaced):
        full = np.flatnonzero(~empty)
        slots, at = work.chunks(spaced, np.append(offsets[full], len(spaced)))
        every = work.facts[slots]
        sound[full] = _summed(every[:, 4], at) == np.diff(at)
        for i in range(4):
            facts[full, i] = _summed(every[:, i], at)
        facts[~sound] = 0
        owner = np.repeat(full, np.diff(at))
        groups = np.array(work.groups, object)[slots].tolist()
        for doc, a, b in zip(full, at[:-1], at[1:], strict=True):
            if sound[doc]:
                shas[doc] = hashlib.sha256(";".join(groups[a:b]).encode()).hexdigest()
        slots, owner = slots[sound[owner]], owner[sound[owner]]
    # each chunk of a document once, then each pair of it once
    used, which = np.unique(slots, return_inverse=True)
    held, often = np.unique(owner * max(1, len(used)) + which, return_counts=True)
    owner, slot = held // max(1, len(used)), used[held % max(1, len(used))]
    size = work.facts[slot, 3]
    links = work.links[_ranges(work.begin[slot], size)]
    pairs, place = np.unique(links, return_inverse=True)
    entry = np.repeat(owner, size) * max(1, len(pairs)) + place
    entry, which = np.unique(entry, return_inverse=True)
    times = np.bincount(which, np.repeat(often, size), len(entry)).astype(np.uint32)
    owner, place = entry // max(1, len(pairs)), entry % max(1, len(pairs))
    columns = {name: facts[:, i] for i, name in enumerate(("n_a", "n_b", "n_groups", "n_links"))}
    return row | columns | {
        "sha": shas,
        "entries": np.bincount(owner, minlength=n),
        "places": place.astype(np.uint32).tobytes(),
        "times": times.tobytes(),
        "pairs": pairs,
        "held": np.bincount(place, minlength=len(pairs)),
    }


def _blocks(docs: DataFrame, byte_level: str, piece_model: str, block_bytes: int) -> DataFrame:
    longs, texts = pa.list_(pa.int64()), pa.list_(pa.string())
    kinds = {"block": pa.int64(), "sha": texts, "places": pa.binary(), "times": pa.binary()}
    names = [c.split()[0] for c in _BLOCKS.split(", ")]
    schema = pa.schema([(c, kinds.get(c, longs)) for c in names])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = aligner(byte_level, piece_model)
        block = TaskContext.get().partitionId() << 40
        for batch in batches:
            for start, stop, data, offsets in pieces(batch, most=block_bytes):
                ids = batch.column("doc_id").slice(start, stop - start)
                row = {"block": block} | _block(work, ids, data, offsets)
                yield pa.RecordBatch.from_pylist([row], schema)
                block += 1

    return docs.mapInArrow(emit, _BLOCKS)


def _totals(blocks: DataFrame) -> DataFrame:
    """One row per document: sums over its links of what is known of their pairs."""
    schema = (
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
        "count_sum long, groups_sha256 string"
    )

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                docs = {c: batch.column(c)[i].values for c in _DOCS}
                counts, best = np.zeros((2, len(batch.column("pairs")[i])), np.int64)
                if batch.column("known")[i].is_valid:
                    known = batch.column("known")[i].values
                    at = np.asarray(known.field("pos"))
                    counts[at] = np.asarray(known.field("count"))
                    best[at] = np.asarray(known.field("best"))
                place = np.frombuffer(batch.column("places")[i].as_py(), np.uint32)
                times = np.frombuffer(batch.column("times")[i].as_py(), np.uint32).astype(np.int64)
                ends = np.append(0, np.cumsum(np.asarray(docs["entries"])))
                sums = [pa.array(_summed(times * x[place], ends)) for x in (best, counts)]
                shown = [docs[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
                yield pa.RecordBatch.from_arrays(
                    [*shown, *sums, docs["sha"]],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
                )

    return blocks.mapInArrow(emit, schema)


def aligned_documents(
    docs: DataFrame, byte_level: str, piece_model: str, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Alignment facts of every row: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    A encodes a space and the text by the ``byte_level`` file, B the text by the
    ``piece_model``, which adds the space; neither adds special tokens, and their names
    inside a text are plain text.  Places where tokens of both end cut the ids into
    groups; ``groups_sha256`` is over ``a1,a2|b1;a3|b2,b3``.  Links are all pairs of an A
    and a B token whose bytes overlap.  A pair's count is the number of rows of ``docs`` that
    hold it; ``n_best`` is how many links have the largest count of their A id, ties
    included, ``count_sum`` the sum of the counts over all links.

    Null and empty texts, and texts that the tokens of A or B don't give back byte by byte,
    have no tokens: zeros and ''.  Rows that share an id are rows of their own.  Other
    columns are ignored.
    """
    base = scratch_dir(docs.sparkSession, "alignment")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    _blocks(rows, byte_level, piece_model, block_bytes).write.parquet(f"{base}/blocks")
    blocks = docs.sparkSession.read.schema(_BLOCKS).parquet(f"{base}/blocks")
    pairs = pair_counts(blocks)
    pairs.write.parquet(f"{base}/pairs")
    pairs = docs.sparkSession.read.parquet(f"{base}/pairs")
    known = blocks.select("block", F.posexplode("pairs").alias("pos", "pair")).join(pairs, "pair")
    known = known.groupBy("block").agg(F.collect_list(F.struct("pos", "count", "best")).alias("known"))
    return _totals(blocks.drop("held").join(known, "block", "left"))


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair`` (A id and B id in one number), ``count``, and whether no pair of its A id has more."""
    held = blocks.select(F.inline(F.arrays_zip("pairs", "held")))
    counts = held.groupBy(F.col("pairs").alias("pair")).agg(F.sum("held").alias("count"))
    most = F.max("count").over(Window.partitionBy(F.shiftright("pair", 32)))
    return counts.select("pair", "count", (F.col("count") == most).alias("best"))
