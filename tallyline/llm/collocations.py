"""Word phrases that stand together, from sorted streams of phrase counts.

Counting.  Texts become blocks of word codes with a dictionary each; word counts give the
vocabulary, and every block learns the numbers of its frequent words by a join.  Blocks
also learn which of their pairs of neighbours may be frequent: they send the pairs' hashes,
cut to a few bits, to be counted, and get a bit back for each.  Hashes that coincide only
count too much, and a frequent phrase has no other pairs, so nothing is lost.  Each place
gives one window of up to five frequent words, as far as its pairs go on being frequent,
from which all shorter phrases are read off: sorted windows hold the phrases of every
length next to each other.  Blocks send sorted runs of windows, packed, to buckets by
their first words; a bucket merges its runs and keeps the phrases that are frequent enough.

Scoring.  The stream of frequent phrases is put in prefix order, where a phrase's first
parts and its extensions to the right are its neighbours, and then in suffix order, where
that holds for its last parts and extensions to the left.  One lockstep pass over each,
with a stack as deep as the phrase is long, gives all counts; nothing is looked up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm.words import _LOWER, mixed, pieces, run_hashes, tidy
from tallyline.sinks.workspace import scratch_dir

#: Words of a phrase at most.
LONGEST = 5
#: Words of a block of text.
BLOCK_WORDS = 1 << 20
#: Windows a bucket is laid out for, and holds before it collapses them.
BUCKET_WINDOWS = 1 << 20
#: First words of more than this part of all places are spread over buckets.
HOT_PART = 512
#: Pairs are counted in buckets of so many places, by this many bits of their hashes.
PAIR_PLACES = 1 << 22
PAIR_BITS = 20
#: Vocabulary numbers are dealt in this many groups.
_GROUPS = 1024
_ROW_WINDOWS = 1 << 15
_ZSTD = pa.Codec("zstd", 1)

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True

_BLOCKS = (
    "block long, lang string, n long, words array<string>, counts array<long>, hashes binary, "
    "codes binary, heavy array<struct<size:int,hash:long,n:long>>"
)


def _split(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Starts, ends and texts of the words, and whether a word begins a piece."""
    solid = ~_GAP[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before, after = np.ones(len(data), bool), np.ones(len(data), bool)
    before[1:], after[:-1] = ~solid[:-1], ~solid[1:]
    starts = np.flatnonzero(solid & (before | cut[:-1]))
    ends = np.flatnonzero(solid & (after | cut[1:])) + 1
    owner = np.searchsorted(offsets, starts, "right") - 1
    breaks = np.cumsum(_BREAK[data])
    first = np.ones(len(starts), bool)
    first[1:] = (breaks[starts[1:]] != breaks[ends[:-1] - 1]) | (owner[1:] != owner[:-1])
    return starts, ends, owner, first


def _ahead(x: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros_like(x)
    out[: max(0, len(x) - n)] = x[n:]
    return out


def _prefix_hashes(hashes: np.ndarray) -> Iterator[np.ndarray]:
    """For each place the hash of 2, 3, … words from it on; meaningless past a gap."""
    value = hashes
    for n in range(1, LONGEST):
        value = mixed(value * np.uint64(0x9E3779B97F4A7C15) ^ _ahead(hashes, n))
        yield value


def _counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(values, return_counts=True)


def _heavy(hashes: np.ndarray, words: int) -> list[tuple]:
    """Frequent first words of a block: number of words, hash, count."""
    found: list[tuple] = []
    inside = hashes != 0
    for size, value in zip(range(2, LONGEST), _prefix_hashes(hashes), strict=False):
        inside = inside & _ahead(hashes != 0, size - 1)
        keys, counts = _counted(value[inside])
        at = np.flatnonzero(counts * 2 * HOT_PART >= words)
        found += [(size, k, n) for k, n in zip(keys[at].view(np.int64).tolist(), counts[at].tolist(), strict=True)]
    return found


def _blocks(docs: DataFrame, block_words: int) -> DataFrame:
    """Blocks of one language: dictionary, codes of all words (0 between pieces).

    The commonest words come first, so codes compress well.  ``hashes`` has 32 bits for
    each word, by which pairs and first words are dealt, never told apart.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 40
        langs: dict[str, int] = {}
        held: list[tuple] = []
        n = size = 0

        def emptied() -> Iterator[pa.RecordBatch]:
            nonlocal block
            data = np.concatenate([x[0] for x in held])
            starts, ends, lang, first, hashes = (np.concatenate([x[i] for x in held]) for i in range(1, 6))
            for name, code in langs.items():
                mine = np.flatnonzero(lang == code)
                if not len(mine):
                    continue
                keys, at, which, counts = np.unique(
                    hashes[mine], return_index=True, return_inverse=True, return_counts=True
                )
                order = np.argsort(-counts, kind="stable")
                keys, at, counts = keys[order], mine[at[order]], counts[order]
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                place = np.arange(len(mine)) + np.cumsum(first[mine])
                codes = np.zeros(int(place[-1]) + 1, np.uint32)
                codes[place] = rank[which] + 1
                short = np.maximum(keys >> np.uint64(32), np.uint64(1)).astype("<u4")
                spread = np.append(np.uint64(0), short.astype(np.uint64))[codes]
                words = [data[a:b].tobytes().decode("utf-8") for a, b in zip(starts[at], ends[at], strict=True)]
                row = {
                    "block": block, "lang": name, "n": len(mine), "words": words, "counts": counts,
                    "hashes": short.tobytes(), "codes": _packed_codes(codes),
                    "heavy": [dict(zip(("size", "hash", "n"), x, strict=True)) for x in _heavy(spread, len(mine))],
                }
                block += 1
                yield pa.RecordBatch.from_pylist([row], _schema)

        _schema = pa.schema(
            [
                ("block", pa.int64()), ("lang", pa.string()), ("n", pa.int64()),
                ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())),
                ("hashes", pa.binary()), ("codes", pa.binary()),
                ("heavy", pa.list_(pa.struct([("size", pa.int32()), ("hash", pa.int64()), ("n", pa.int64())]))),
            ]
        )
        for batch in batches:
            names = batch.column("lang").to_pylist()
            for row, stop, data, offsets in pieces(batch):
                data = _LOWER[data]
                starts, ends, owner, first = _split(data, offsets)
                if not len(starts):
                    continue
                codes = np.array([langs.setdefault(x, len(langs)) for x in names[row:stop]])
                hashes = run_hashes(data, starts, ends)
                hashes[hashes == 0] = 1
                held.append((data, starts + size, ends + size, codes[owner], first, hashes))
                n, size = n + len(starts), size + len(data)
                if n >= block_words:
                    yield from emptied()
                    held, n, size, langs = [], 0, 0, {}
        if held:
            yield from emptied()

    return docs.mapInArrow(tidy(emit), _BLOCKS)


class _Packing:
    """Vocabulary numbers side by side in 63-bit columns, so that few columns are sorted."""

    def __init__(self, largest: int) -> None:
        self.bits = max(1, int(largest).bit_length())
        self.per = max(1, 63 // self.bits)
        self.columns = -(-LONGEST // self.per)

    def pack(self, ids: list[np.ndarray]) -> list[np.ndarray]:
        out = []
        for at in range(0, LONGEST, self.per):
            value = np.zeros(len(ids[0]), np.uint64)
            for i in range(at, at + self.per):
                value = value << np.uint64(self.bits)
                if i < LONGEST:
                    value = value | ids[i]
            out.append(value)
        return out

    def word(self, columns: list[np.ndarray], i: int) -> np.ndarray:
        shift = np.uint64(self.bits * (self.per - 1 - i % self.per))
        return columns[i // self.per] >> shift & np.uint64((1 << self.bits) - 1)


def _merged(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted, each window once with its count."""
    if not len(counts):
        return columns, counts
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    at = np.flatnonzero(new)
    return [c[at] for c in columns], np.add.reduceat(counts[order], at)


def _packed(columns: list[np.ndarray]) -> bytes:
    """Sorted columns as steps of the first and byte by byte, which then compress well."""
    first = np.diff(columns[0], prepend=columns[0].dtype.type(0))
    planes = np.stack([first, *columns[1:]]).astype("<u8")
    planes = np.ascontiguousarray(planes.view(np.uint8).reshape(len(columns), -1, 8).transpose(0, 2, 1))
    return len(first).to_bytes(4, "little") + _ZSTD.compress(planes, asbytes=True)


def _unpacked(data: bytes, columns: int) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    planes = np.frombuffer(_ZSTD.decompress(data[4:], 8 * n * columns, asbytes=True), np.uint8)
    values = planes.reshape(columns, 8, n).transpose(0, 2, 1).copy().view("<u8").reshape(columns, n)
    values[0] = np.cumsum(values[0])
    return values


def _packed_codes(codes: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(codes).to_bytes(4, "little") + _ZSTD.compress(planes, asbytes=True)


def _placed(codes: bytes, hashes: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Codes and hashes of a block's places."""
    n = int.from_bytes(codes[:4], "little")
    planes = np.frombuffer(_ZSTD.decompress(codes[4:], 4 * n, asbytes=True), np.uint8)
    codes = planes.reshape(4, n).T.copy().view("<u4").reshape(n)
    return codes, np.append(np.uint64(0), np.frombuffer(hashes, "<u4").astype(np.uint64))[codes]


def _pairs(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a pair of neighbours begins, and its bucket and hash bits there."""
    at = np.flatnonzero((hashes != 0) & (_ahead(hashes, 1) != 0))
    value = next(_prefix_hashes(hashes))[at]
    bits = np.uint64(PAIR_BITS)
    return at, (value >> bits) % np.uint64(buckets) << bits | value & np.uint64((1 << PAIR_BITS) - 1)


def _pair_answers(blocks: DataFrame, buckets: int, parts: int, least: int) -> DataFrame:
    """``block, pairs``: for each bucket a bit per distinct pair of the block, in order,
    whether pairs of its hash occur ``least`` times in all blocks."""
    asked = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("data", pa.binary())])
    answer = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("bits", pa.binary())])
    low = np.uint64((1 << PAIR_BITS) - 1)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                _, hashes = _placed(batch.column("codes")[i].as_py(), batch.column("hashes")[i].as_py())
                keys, counts = _counted(_pairs(hashes, buckets)[1])
                if not len(keys):
                    continue
                bucket = (keys >> np.uint64(PAIR_BITS)).astype(np.int64)
                first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
                last = np.append(first[1:], len(keys))
                data = [_packed([keys[a:b] & low, counts[a:b]]) for a, b in zip(first, last, strict=True)]
                block = [batch.column("block")[i].as_py()] * len(first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[first]), pa.array(block, pa.int64()), pa.array(data, pa.binary())], schema=asked
                )

    def told(bucket: int, total: np.ndarray, held: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        enough = total >= least
        for begin in range(0, len(held), 1000):
            some = held[begin : begin + 1000]
            bits = [np.packbits(enough[_unpacked(data, 2)[0].astype(np.int64)]).tobytes() for _, data in some]
            rows = [{"block": b, "bucket": bucket, "bits": x} for (b, _), x in zip(some, bits, strict=True)]
            yield pa.RecordBatch.from_pylist(rows, answer)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        total = np.zeros(1 << PAIR_BITS, np.int64)
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("bucket", "block", "data"))
            for bucket, block, data in zip(*columns, strict=True):
                if bucket != now:
                    yield from told(now, total, held)
                    now, held = bucket, []
                    total[:] = 0
                slots, counts = _unpacked(data, 2)
                total[slots.astype(np.int64)] += counts.astype(np.int64)
                held.append((block, data))
        yield from told(now, total, held)

    rows = blocks.select("block", "codes", "hashes").mapInArrow(tidy(ask), "bucket long, block long, data binary")
    dealt = rows.repartition(parts, "bucket").sortWithinPartitions("bucket")
    told_rows = dealt.mapInArrow(tidy(count), "block long, bucket long, bits binary")
    return told_rows.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("pairs"))


def _frequent_pairs(hashes: np.ndarray, buckets: int, pairs: list[dict]) -> np.ndarray:
    """Whether a pair that may be frequent begins at each place."""
    at, key = _pairs(hashes, buckets)
    keys, which = np.unique(key, return_inverse=True)
    enough = np.zeros(len(keys), bool)
    for x in pairs:
        edge = np.array([x["bucket"], x["bucket"] + 1], np.uint64) << np.uint64(PAIR_BITS)
        a, b = np.searchsorted(keys, edge)
        enough[a:b] = np.unpackbits(np.frombuffer(x["bits"], np.uint8), count=b - a)
    out = np.zeros(len(hashes), bool)
    out[at] = enough[which]
    return out


def _runs(
    blocks: DataFrame, packing: _Packing, hot: dict[int, list[int]], buckets: int, pair_buckets: int
) -> DataFrame:
    """Sorted windows of each block, packed by bucket.

    ``split`` is how many first words decide on the bucket: phrases of at least so many
    words are counted in one bucket alone.
    """
    wanted = {k: np.sort(np.array(v, np.int64).view(np.uint64)) for k, v in hot.items()}

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                codes, hashes = _placed(batch.column("codes")[i].as_py(), batch.column("hashes")[i].as_py())
                known = batch.column("known")[i].values
                number = np.zeros(int(codes.max(initial=0)) + 1, np.uint64)
                number[np.asarray(known.field("pos")) + 1] = np.asarray(known.field("id")).astype(np.uint64)
                ids = number[codes]
                link = _frequent_pairs(hashes, pair_buckets, batch.column("pairs")[i].as_py())
                link &= (ids > 0) & (_ahead(ids, 1) > 0)
                at = np.flatnonzero(link)
                window, inside = [ids[at]], np.ones(len(at), bool)
                for n in range(1, LONGEST):
                    inside = inside & _ahead(link, n - 1)[at]
                    window.append(np.where(inside, _ahead(ids, n)[at], np.uint64(0)))
                split = np.full(len(at), 2, np.int8)
                value = None
                for size, prefix in zip(range(2, LONGEST + 1), _prefix_hashes(hashes), strict=True):
                    prefix = prefix[at]
                    value = prefix if value is None else np.where(split == size, prefix, value)
                    if size < LONGEST and len(some := wanted.get(size, ())):
                        more = (split == size) & np.isin(prefix, some) & (window[size - 1] > 0)
                        split = np.where(more, size + 1, split).astype(np.int8)
                bucket = (value % np.uint64(buckets)).astype(np.int64) * 8 + split
                # the bucket sorts first, so each run comes out sorted
                columns, counts = _merged(
                    [bucket.astype(np.uint64), *packing.pack(window)], np.ones(len(at), np.uint32)
                )
                if not len(counts):
                    continue
                edge = np.flatnonzero(np.append(True, columns[0][1:] != columns[0][:-1]))
                for a, b in zip(edge, np.append(edge[1:], len(counts)), strict=True):
                    rows = {"bucket": [], "data": []}
                    for begin in range(a, b, _ROW_WINDOWS):
                        end = min(b, begin + _ROW_WINDOWS)
                        rows["bucket"].append(int(columns[0][a]))
                        held = [c[begin:end] for c in columns[1:]]
                        rows["data"].append(_packed([*held, counts[begin:end].astype(np.uint64)]))
                    yield pa.RecordBatch.from_pydict(rows, pa.schema([("bucket", pa.int64()), ("data", pa.binary())]))

    return blocks.select("codes", "hashes", "known", "pairs").mapInArrow(tidy(emit), "bucket long, data binary")


def _phrases(columns: list[np.ndarray], counts: np.ndarray, packing: _Packing, split: int, least: int):
    """Phrases of sorted windows; those of fewer words than ``split`` may miss some counts."""
    words = [packing.word(columns, i) for i in range(LONGEST)]
    new = np.zeros(len(counts), bool)
    new[:1] = True
    for size in range(1, LONGEST + 1):
        new[1:] |= words[size - 1][1:] != words[size - 1][:-1]
        if size < 2:
            continue
        there = np.flatnonzero(words[size - 1] > 0)
        if not len(there):
            return
        # a shorter window sorts before all that extend it, so groups stay whole
        group = np.cumsum(new)[there]
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        total = np.add.reduceat(counts[there], first)
        if size >= split:
            enough = total >= least
            first, total = first[enough], total[enough]
        if len(first):
            at = there[first]
            ids = np.stack([w[at] for w in words[:size]], 1).astype(np.int64)
            ends = np.arange(0, ids.size + 1, size, dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.reshape(-1)))
            yield pa.RecordBatch.from_arrays([lists, pa.array(total.astype(np.int64))], ["ids", "f"])


def _bucket_phrases(runs: DataFrame, packing: _Packing, least: int, most: int) -> DataFrame:
    """Phrases of every bucket, whose runs come one after the other.

    A bucket of more windows than ``most`` is worked off in parts; counts of a part are
    all passed on, to be added up behind.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, n, parts = None, [], 0, False

        def together() -> tuple[list[np.ndarray], np.ndarray]:
            columns = [np.concatenate([h[i] for h in held]) for i in range(packing.columns + 1)]
            return _merged(columns[:-1], columns[-1])

        def worked(columns, counts) -> Iterator[pa.RecordBatch]:
            split = LONGEST + 1 if parts else now % 8
            yield from _phrases(columns, counts, packing, split, least)

        for batch in batches:
            for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("data"), strict=True):
                if bucket != now:
                    if held:
                        yield from worked(*together())
                    now, held, n, parts = bucket, [], 0, False
                values = _unpacked(data.as_py(), packing.columns + 1)
                held.append(values)
                n += values.shape[1]
                if n >= 2 * most:
                    columns, counts = together()
                    held, n = [np.stack([*columns, counts])], len(counts)
                    if n >= most:
                        parts = True
                        yield from worked(columns, counts)
                        held, n = [], 0
        if held:
            yield from worked(*together())

    return runs.mapInArrow(tidy(emit), "ids array<long>, f long")


def _streamed(rows: DataFrame, backwards: bool) -> DataFrame:
    """Adds counts of all parts at one end and of the commonest extension at the other.

    ``edge`` is the count of the outermost word.  Rows that share their two outermost words
    are in one task, in order, so all parts of a phrase stand before it.
    """
    order = F.reverse("ids") if backwards else F.col("ids")
    kept = [c for c in rows.columns if c != "edge"]
    dealt = rows.withColumn("way", order).repartition(F.col("way")[0], F.col("way")[1]).sortWithinPartitions("way")
    name, beyond = ("rights", "before") if backwards else ("lefts", "behind")
    types = dict(rows.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in kept) + f", {name} array<bigint>, {beyond} bigint"

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[list] = []  # way, count, counts of parts, commonest extension, other columns

        def done(rows: list[list]) -> pa.RecordBatch:
            columns = [[r[4][i] for r in rows] for i in range(len(kept))]
            return pa.RecordBatch.from_arrays(
                [
                    *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)),
                    pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                    pa.array([r[3] for r in rows], pa.int64()),
                ],
                [*kept, name, beyond],
            )

        kinds = None
        for batch in batches:
            kinds = [batch.schema.field(c).type for c in kept]
            out: list[list] = []
            others = zip(*(batch.column(c).to_pylist() for c in kept), strict=True)
            rows = (batch.column(c).to_pylist() for c in ("way", "f", "edge"))
            for way, f, edge, other in zip(*rows, others, strict=True):
                while stack and way[: len(stack[-1][0])] != stack[-1][0]:
                    out.append(stack.pop())
                if len(stack) != len(way) - 2:
                    raise ValueError(f"a part of phrase {way} is not in the stream")
                parts = [edge]
                if stack:
                    parts = [*stack[-1][2], stack[-1][1]]
                    stack[-1][3] = max(stack[-1][3], f)
                stack.append([way, f, parts, 0, other])
            if out:
                yield done(out)
        if stack:
            yield done(stack)

    return dealt.select(*kept, "edge", "way").mapInArrow(tidy(emit), schema)


def best_cut(a: int, n: int, lefts: list[int], rights: list[int]) -> tuple[int, int, int]:
    """Score, left and right count of the lowest-scoring cut, ties to the shortest first part."""
    cuts = [(1000 * a * n // (x * y), x, y) for x, y in zip(lefts, reversed(rights), strict=True)]
    return min(cuts, key=lambda c: c[0])


def _scored(rows: DataFrame) -> DataFrame:
    """Scores in whole numbers of any size; covered phrases go."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [batch.column(c).to_pylist() for c in ("f", "n", "lefts", "rights")]
            cuts = [best_cut(*row) for row in zip(*x, strict=True)]
            score, left, right = (pa.array([c[i] for c in cuts], pa.int64()) for i in range(3))
            columns = [batch.column(c) for c in ("ids", "lang", "f", "n")]
            yield pa.RecordBatch.from_arrays([*columns, score, left, right], ["ids", "lang", "a", "n", "score", "l", "r"])

    left = rows.where("greatest(before, behind) < f")
    return left.mapInArrow(tidy(emit), "ids array<long>, lang string, a long, n long, score long, l long, r long")


def _frequent(spark: SparkSession, docs: DataFrame, base: str, least: int, block_words: int, bucket_windows: int):
    """``words`` (id, lang, word, f, n) and ``phrases`` (ids, f) of at least ``least`` occurrences."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    _blocks(docs.select(F.col("text").cast("string"), lang), block_words).write.parquet(f"{base}/blocks")
    blocks = spark.read.schema(_BLOCKS).parquet(f"{base}/blocks")

    totals = blocks.groupBy("lang").agg(F.sum("n").alias("n"))
    # one exchange deals every block's words, counts them and gives the frequent ones numbers
    entries = blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("pos", "_e"))
    entries = entries.select("block", "lang", "pos", F.col("_e.words").alias("word"), F.col("_e.counts").alias("f"))
    entries = entries.withColumn("_g", F.pmod(F.xxhash64("lang", "word"), F.lit(_GROUPS))).repartition("_g")
    f = F.sum("f").over(Window.partitionBy("_g", "lang", "word"))
    number = F.dense_rank().over(Window.partitionBy("_g").orderBy("lang", "word")).cast("long")
    known = entries.withColumn("f", f).where(F.col("f") >= least)
    known = known.withColumn("id", number * _GROUPS + F.col("_g")).drop("_g")
    known.write.parquet(f"{base}/known")
    known = spark.read.parquet(f"{base}/known")
    words = known.select("id", "lang", "word", "f").distinct()
    words.join(totals, "lang").select("id", "lang", "word", "f", "n").write.parquet(f"{base}/words")
    words = spark.read.parquet(f"{base}/words")
    largest, places = words.agg(F.max("id")).first()[0], blocks.agg(F.sum("n")).first()[0]
    if largest is None:
        return words, spark.createDataFrame([], "ids array<long>, f long")

    sizes = blocks.select(F.inline("heavy")).groupBy("size", "hash").agg(F.sum("n").alias("n"))
    hot: dict[int, list[int]] = {}
    for row in sizes.where(F.col("n") * HOT_PART >= places).collect():  # under 2 * HOT_PART for each size
        hot.setdefault(row["size"], []).append(row["hash"])

    packing, buckets = _Packing(largest), max(1, -(-places // bucket_windows))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(buckets, 20_000))
    pair_buckets = max(1, -(-places * BUCKET_WINDOWS // (PAIR_PLACES * bucket_windows)))
    known = known.groupBy("block").agg(F.collect_list(F.struct("pos", "id")).alias("known"))
    pairs = _pair_answers(blocks, pair_buckets, parts, least)
    learnt = blocks.select("block", "codes", "hashes").join(known, "block").join(pairs, "block")
    runs = _runs(learnt, packing, hot, buckets, pair_buckets)
    dealt = runs.repartition(parts, "bucket").sortWithinPartitions("bucket")
    found = _bucket_phrases(dealt, packing, least, bucket_windows)
    found = found.groupBy("ids").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    found.write.parquet(f"{base}/phrases")
    return words, spark.read.parquet(f"{base}/phrases")


def collocations(
    docs: DataFrame,
    least: int = 100,
    top: int = 2000,
    block_words: int = BLOCK_WORDS,
    bucket_windows: int = BUCKET_WINDOWS,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's ``top`` phrases.

    ASCII letters count as small; texts are cut at ``. , ; : ! ?`` and line ends, and at
    spaces and tabs into words, all others characters being part of words.  A phrase has 2 to
    5 words and ``a >= least`` occurrences, overlapping ones included.  ``l`` and ``r``
    are the counts of its two parts at the cut with the lowest ``1000 * a * n / (l * r)``
    rounded down, ``n`` is the number of words of the language.  A phrase that only occurs
    inside one longer phrase is left out.  Ties go to the larger ``a``, then to the phrase
    that comes first by its UTF-8 bytes.

    A null ``lang`` is ``und``; null and empty texts have no words.  Repeated rows count as
    often as they are there; ids and other columns are ignored.  Words are told apart inside
    a block by 64-bit hashes, across blocks by themselves.
    """
    spark = docs.sparkSession
    base = scratch_dir(spark, "collocations")
    words, phrases = _frequent(spark, docs, base, least, block_words, bucket_windows)
    ends = phrases.select(
        "ids", "f", F.element_at("ids", 1).alias("_first"), F.element_at("ids", -1).alias("_last")
    )
    heads = words.select(F.col("id").alias("_first"), F.col("f").alias("edge"), "lang", "n").hint("merge")
    tails = words.select(F.col("id").alias("_last"), F.col("f").alias("edge")).hint("merge")
    forth = _streamed(ends.join(heads, "_first").drop("_first"), False)
    rows = _scored(_streamed(forth.join(tails, "_last").drop("_last"), True))

    near = F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))
    rows.withColumn("_near", near).where(F.col("_near") <= top).drop("_near").write.parquet(f"{base}/best")
    best = spark.read.parquet(f"{base}/best")
    names = best.select("ids", F.posexplode("ids").alias("_at", "id")).join(words.select("id", "word"), "id")
    names = names.groupBy("ids").agg(F.sort_array(F.collect_list(F.struct("_at", "word"))).alias("_words"))
    named = best.join(names, "ids").withColumn("phrase", F.array_join("_words.word", " "))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        named.withColumn("rank", F.row_number().over(order).cast("long"))
        .where(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
