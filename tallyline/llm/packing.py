"""Best-fit packing of token pieces into sequences of one fixed length.

The plan is made on the histogram of piece lengths, which has one count per possible
length and so does not grow with the corpus:

1. linear grouping: the long pieces, in order of length, are cut into groups of equal
   cardinality and each is rounded up to the longest of its group (no more lengths than
   groups stay as they are);
2. the configurations (which groups share a sequence) of these few lengths are
   optimised as a linear program by column generation and rounded down;
3. the real lengths take the places of the rounded ones;
4. what is left, and all short pieces, go best-fit, longest first, into the tightest
   space that holds them.

This is done for several bounds of "short", the last of which leaves everything to best
fit, and the plan of fewest sequences is taken.

The plan says which ranks of each length go where; pieces get their rank within their
length by counting per salted group, and find their place by look-up.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.tokens import encoder
from tallyline.llm.words import tidy
from tallyline.sinks.workspace import scratch_dir

#: Plans that are tried: the share of a sequence up to which pieces are left out of grouping,
#: and the groups.  Deep configurations get fewer groups; the last leaves all to best fit.
PLANS = ((0.125, 128), (0.44, 384), (1.0, 384))

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of every whole text, narrow.

    A document is its ids and ``end_id`` (a null text is empty and gives ``end_id``
    alone).  Only longer documents are cut, and only the first piece may be shorter.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = encoder(tokenizer)
        for batch in batches:
            for row, stop, ids, places in work.encode_batch(batch, end_id):
                lengths = np.diff(places)
                number = -(-lengths // capacity)
                owner = np.repeat(np.arange(stop - row), number)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
                short = (lengths - (number - 1) * capacity)[owner]
                start = np.where(piece > 0, short + (piece - 1) * capacity, 0)
                size = np.where(piece > 0, capacity, short)
                raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                at = places[owner] + start
                crc = [
                    zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at, at + size, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, stop - row).take(pa.array(owner)),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(size, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tidy(cut), PIECES)


def linear_groups(counts: dict[int, int], groups: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Equal-cardinality groups, longest first: rounded length and real (length, count)s."""
    total = sum(counts.values())
    share = max(1, -(-total // groups))
    out: list[tuple[int, list[tuple[int, int]]]] = []
    room = 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not room:
                out.append((length, []))
                room = share
            n = min(left, room)
            out[-1][1].append((length, n))
            left, room = left - n, room - n
    return out


def _best_pattern(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The configuration of greatest worth that fits."""
    deepest = capacity // int(sizes.min())
    value = np.zeros(capacity + 1)
    chosen: list[np.ndarray] = []
    for _ in range(deepest):
        tried = np.full((len(sizes), capacity + 1), -1.0)
        for i, s in enumerate(sizes):
            tried[i, s:] = value[: capacity + 1 - s] + worth[i]
        pick = tried.argmax(0)
        gain = tried[pick, np.arange(capacity + 1)]
        better = gain > value + 1e-12
        chosen.append(np.where(better, pick, -1))
        value = np.where(better, gain, value)
    pattern = np.zeros(len(sizes))
    room = capacity
    for step in reversed(chosen):
        if (i := step[room]) >= 0:
            pattern[i] += 1
            room -= sizes[i]
    return float(value[capacity]), pattern


def configurations(
    sizes: list[int], demand: list[int], capacity: int, steps: int = 2000
) -> list[tuple[int, list[int]]]:
    """(times, pieces of each size) of the linear program's solution, rounded down."""
    n = len(sizes)
    size = np.array(sizes)
    patterns = np.diag((capacity // size).astype(float))
    inverse = np.diag(1.0 / patterns.diagonal())
    amount = inverse @ np.array(demand, float)
    for _ in range(steps):
        value, pattern = _best_pattern(size, inverse.sum(0), capacity)
        # by Farley's bound no solution saves half a sequence
        if value <= 1 + 1e-7 or amount.sum() * (1 - 1 / value) < 0.5:
            break
        direction = inverse @ pattern
        usable = direction > 1e-9
        ratio = np.where(usable, amount / np.where(usable, direction, 1), np.inf)
        out = int(ratio.argmin())
        patterns[:, out] = pattern
        row = inverse[out] / direction[out]
        moved = amount[out] / direction[out]
        amount = amount - direction * moved
        amount[out] = moved
        inverse = inverse - np.outer(direction, row)
        inverse[out] = row
    times = np.floor(np.maximum(amount, 0) + 1e-7).astype(int)
    return [(int(t), [int(x) for x in patterns[:, j]]) for j, t in enumerate(times) if t]


def plan_bins(
    histogram: dict[int, int], capacity: int = 1024, groups: int = 384, small: int | None = None
) -> list[tuple[int, dict[int, int]]]:
    """Kinds of sequences, (how many, pieces of each length), that hold every piece once.

    ``small``: pieces up to it take no part in grouping; without it, each of
    ``PLANS`` is tried and the plan of fewest sequences taken.  The plan has at
    most some thousand kinds, whatever the counts are.
    """
    if small is None:
        tried = [plan_bins(histogram, capacity, min(n, groups), int(share * capacity)) for share, n in PLANS]
        return min(tried, key=lambda plan: sum(times for times, _ in plan))
    left = Counter({k: n for k, n in histogram.items() if n and k < capacity})
    done: list[tuple[int, dict[int, int]]] = []
    if histogram.get(capacity):
        done.append((histogram[capacity], {capacity: 1}))
    large = {k: n for k, n in left.items() if k > small}
    open_bins: dict[int, list[tuple[int, dict[int, int]]]] = defaultdict(list)

    def put(times: int, held: dict[int, int]) -> None:
        room = capacity - sum(k * n for k, n in held.items())
        open_bins[room].append((times, held))

    if large:
        merged: dict[int, list[tuple[int, int]]] = {}
        few = [(k, [(k, n)]) for k, n in large.items()] if len(large) <= groups else None
        for rounded, real in few or linear_groups(large, groups):
            merged.setdefault(rounded, []).extend(real)
        sizes = list(merged)
        stock = [list(merged[s]) for s in sizes]
        demand = [sum(n for _, n in real) for real in stock]
        for times, pattern in configurations(sizes, demand, capacity):
            places = [i for i, n in enumerate(pattern) for _ in range(n)]
            while times and places:
                # one real length per place: as many sequences as the shortest run allows
                uses = Counter(places)
                if any(not stock[i] for i in uses):
                    break
                run = min([times, *(stock[i][0][1] // n for i, n in uses.items())])
                held: Counter = Counter()
                if run:
                    for i, n in uses.items():
                        length, count = stock[i][0]
                        held[length] += n
                        stock[i][0] = (length, count - n * run)
                        left[length] -= n * run
                else:
                    run = 1
                    if any(sum(c for _, c in stock[i]) < n for i, n in uses.items()):
                        break
                    for i in places:
                        length, count = stock[i][0]
                        held[length] += 1
                        left[length] -= 1
                        stock[i][0] = (length, count - 1)
                        if count == 1:
                            stock[i].pop(0)
                for i in uses:
                    while stock[i] and not stock[i][0][1]:
                        stock[i].pop(0)
                put(run, dict(held))
                times -= run
    for length in sorted((k for k, n in left.items() if n), reverse=True):
        n = left[length]
        while n:
            room = min((r for r, bins in open_bins.items() if r >= length and bins), default=None)
            if room is None:
                each = min(capacity // length, n)
                put(n // each, {length: each})
                n -= n // each * each
                continue
            times, held = open_bins[room].pop()
            each = min(room // length, n)
            used = min(times, n // each)
            if used < times:
                open_bins[room].append((times - used, held))
            put(used, {**held, length: held.get(length, 0) + each})
            n -= used * each
    return done + [kind for bins in open_bins.values() for kind in bins]


def _slots(plan: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, pieces per sequence, offset), in order."""
    rank: Counter = Counter()
    sequence = 0
    rows = []
    for times, held in plan:
        offset = 0
        for length, each in held.items():
            rows.append((length, rank[length], sequence, each, offset))
            rank[length] += times * each
            offset += length * each
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack_pieces(
    pieces: DataFrame, capacity: int = 1024, groups: int = 384, small: int | None = None, salt_rows: int = 2_000
) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a stored table of pieces.

    ``pieces`` is read three times.  Its histogram (at most ``capacity`` counts) and the
    plan made of it are all the driver sees.  Ranks are counted per length and salt, so
    that a length shared by many pieces is spread over groups of about ``salt_rows``.
    """
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    slots = _slots(plan_bins(histogram, capacity, groups, small))
    most = max(histogram.values(), default=0)
    salts = max(1, -(-most // salt_rows))
    salted = pieces.withColumn("_salt", F.expr(f"pmod(xxhash64(doc_id, piece), {salts})"))
    sizes = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select(
        F.col("length").alias("_length"),
        F.col("_salt").alias("_its"),
        (F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n")).alias("_before"),
    )
    order = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        salted.withColumn("_rank", F.row_number().over(order))
        .join(before, F.expr("length = _length and _salt = _its"))
        .withColumn("_rank", F.expr("_before + _rank - 1"))
        .select(*pieces.columns, "_rank")
    )
    wide, names = 1 << 44, pieces.columns
    keys = slots[:, 0] * wide + slots[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            slot = slots[np.searchsorted(keys, length * wide + rank, "right") - 1]
            nth = rank - slot[:, 1]
            columns = [batch.column(c) for c in names]
            sequence = pa.array(slot[:, 2] + nth // slot[:, 3], pa.int64())
            offset = pa.array(slot[:, 4] + nth % slot[:, 3] * length, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*columns, sequence, offset], [*names, "sequence_id", "offset"]
            )

    return ranked.mapInArrow(place, f"{PIECES}, sequence_id long, offset long")


def packed_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece.

    Texts are encoded once; the pieces (no ids) are stored in the shared folder.  Rows
    that repeat a ``doc_id`` are packed one by one.
    """
    spark = docs.sparkSession
    folder = scratch_dir(spark, "pieces")
    token_pieces(docs, tokenizer, capacity, end_id).write.parquet(folder)
    return pack_pieces(spark.read.parquet(folder), capacity)
