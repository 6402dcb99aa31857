"""Documents whose shingle sets are alike, exactly, by parity sketches.

A sketch is a row of parity words: every shingle of a set is hashed to one word and
XORed into it, so each shingle in only one of two sets changes one word at most, and the
number of differing words (the Hamming distance) is a lower bound of the symmetric
difference.  For two sets of ``s`` shingles together, a similarity of ``percent`` allows
``D = (100 - percent) * s / (100 + percent)`` differing shingles.  Within a size band the
sketch has ``D + 1 + spare`` words, so linked sets agree in at least ``1 + spare`` of them
(pigeonhole), and only sets that agree in a word are candidates.

The spare words make this sharper: with ``t`` agreeing words certain, every set may
leave out its ``t - 1`` most frequent words (in one order for all sets) and still shares
one of the others.  Words of a common passage are left out that way, and sets that share
only a few words with others have none left.

Candidates of a word first meet only its smallest member (a star, not all pairs);
connected members need no more comparing.  Then members still in different components
meet.  Pairs whose bit sketches are further apart than their sizes allow are out; the
rest is verified on the real shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.components import components
from tallyline.llm.words import Words, mixed, pieces, tidy
from tallyline.sinks.workspace import scratch_dir

#: A word's members meet by a join up to this number, beyond it chunk by chunk.
FEW_MEMBERS = 32
CHUNK_MEMBERS = 1024
#: 64-bit words of the bit sketch that pairs are held against before the sets are.
SKETCH_WORDS = 16


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in a row, and where each text's begin."""
    n = len(words.first) - 1
    at = words.windows(size)
    counts = words.counts()
    short = np.flatnonzero((counts > 0) & (counts < size))
    begin = np.concatenate([at, words.first[short]])
    stop = np.concatenate([at + size, words.first[short + 1]])
    owner = np.concatenate([words.owner()[at], short])
    hashes = words.spans(begin, stop)
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    owner, hashes = owner[new], hashes[new]
    return hashes, np.searchsorted(owner, np.arange(n + 1))


class Bands:
    """Size bands, each with its allowed difference, sketch length and spare words."""

    def __init__(self, percent: int, ratio: float = 1.3) -> None:
        self.percent = percent
        least = 1
        while not self._linkable(least):
            least += 1
        self.edges = [least]
        while self.edges[-1] < 1 << 40:
            # no pair may span more than two bands
            self.edges.append(int(self.edges[-1] * max(ratio, 100 / percent)) + 1)

    def _linkable(self, n: int) -> bool:
        return 100 * n >= self.percent * (n + 1)

    def reach(self, n: int) -> int:
        """The largest set a set of ``n`` can be linked with."""
        return 100 * n // self.percent

    def shape(self, band: int) -> tuple[int, int]:
        """Sketch words and spare words of a band."""
        most = self.edges[band + 1] - 1
        differ = (100 - self.percent) * (most + self.reach(most)) // (100 + self.percent)
        spare = 2 + differ // 6
        return differ + 1 + spare, spare

    def of(self, n: int) -> list[int]:
        """Bands a set of ``n`` shingles takes part in."""
        own = int(np.searchsorted(self.edges, n, "right")) - 1
        if own < 0:
            # smaller than any linkable set: it may be the larger of none
            return []
        below = own and n <= self.reach(self.edges[own] - 1)
        return [own - 1, own] if below else [own]


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id``, text checksum, set size, 128-bit set hash and bit sketch of every document."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, stop, data, offsets in pieces(batch):
                hashes, places = shingle_sets(Words(data, offsets, lower=True), size)
                sums = [np.append(np.uint64(0), np.cumsum(mixed(hashes ^ np.uint64(c)))) for c in (1, 2)]
                s1, s2 = (mixed(t[places[1:]] - t[places[:-1]]) for t in sums)
                bits = mixed(hashes ^ np.uint64(5))
                sketch = np.zeros((stop - row) * SKETCH_WORDS, np.uint64)
                owner = np.repeat(np.arange(stop - row), np.diff(places))
                at = owner * SKETCH_WORDS + (bits >> np.uint64(32)).astype(np.int64) % SKETCH_WORDS
                np.bitwise_xor.at(sketch, at, np.uint64(1) << (bits & np.uint64(63)))
                ends = pa.array(np.arange(stop - row + 1, dtype=np.int32) * SKETCH_WORDS)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, stop - row),
                        batch.column("_c").slice(row, stop - row),
                        pa.array(np.diff(places), pa.int64()),
                        pa.array(s1.view(np.int64)),
                        pa.array(s2.view(np.int64)),
                        pa.ListArray.from_arrays(ends, pa.array(sketch.view(np.int64))),
                    ],
                    ["doc_id", "_c", "n_shingles", "s1", "s2", "sketch"],
                )

    return docs.mapInArrow(tidy(emit), "doc_id long, _c int, n_shingles long, s1 long, s2 long, sketch array<long>")


def _sketch_words(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Sketch words of every distinct set: ``key`` of the word, ``s1`` of the set.

    Copies inside a batch give one sketch.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for batch in batches:
            seen: set[int] = set()
            for _, _, data, offsets in pieces(batch):
                hashes, places = shingle_sets(Words(data, offsets, lower=True), size)
                total = np.append(np.uint64(0), np.cumsum(mixed(hashes ^ np.uint64(1))))
                names = mixed(total[places[1:]] - total[places[:-1]]).view(np.int64)
                spread = mixed(hashes ^ np.uint64(3)) >> np.uint64(32)
                value = mixed(hashes ^ np.uint64(4))
                keys, sets, spares, which = [], [], [], []
                for i, name in enumerate(names.tolist()):
                    a, b = places[i], places[i + 1]
                    if name in seen or a == b:
                        continue
                    seen.add(name)
                    for band in bands.of(int(b - a)):
                        length, spare = bands.shape(band)
                        word = (spread[a:b] * np.uint64(length) >> np.uint64(32)).astype(np.int64)
                        order = np.argsort(word, kind="stable")
                        at = np.flatnonzero(np.diff(word[order], prepend=-1))
                        held = np.bitwise_xor.reduceat(value[a:b][order], at)
                        word = word[order][at]
                        # empty words too: two sets may agree in them, and every set must
                        # spend its spare words on the same list
                        empty = np.setdiff1d(np.arange(length), word)
                        word = np.concatenate([word, empty])
                        held = np.concatenate([held, np.zeros(len(empty), np.uint64)])
                        label = word.astype(np.uint64) * np.uint64(256) + np.uint64(band)
                        keys.append(mixed(mixed(label) ^ held))
                        sets.append(np.full(len(word), name, np.int64))
                        spares.append(np.full(len(word), spare, np.int32))
                        which.append(np.full(len(word), band, np.int32))
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(keys).view(np.int64)),
                            pa.array(np.concatenate(sets)),
                            pa.array(np.concatenate(which)),
                            pa.array(np.concatenate(spares)),
                        ],
                        ["key", "s1", "band", "spare"],
                    )

    return docs.mapInArrow(tidy(emit), "key long, s1 long, band int, spare int")


def _candidate_words(words: DataFrame) -> DataFrame:
    """Words with two members or more, and their number of rows ``n``."""
    by_key = Window.partitionBy("key")
    met = (
        words.withColumn("hub", F.min("s1").over(by_key))
        .withColumn("_last", F.max("s1").over(by_key))
        .where("hub < _last")
    )
    return met.withColumn("n", F.count(F.lit(1)).over(by_key)).select("key", "s1", "band", "spare", "n")


def _possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a``, ``b`` that sizes and bit sketches allow to be linked."""
    one = classes.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("sketch").alias("x"))
    other = classes.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("sketch").alias("y"))
    apart = F.aggregate(
        F.zip_with("x", "y", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, n: total + n
    )
    least = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    near = apart * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent)
    return pairs.join(one, "a").join(other, "b").where(least).where(near).select("a", "b")


def _screened(placed: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a``, ``b`` of one word's members in different components that sizes and bit
    sketches allow to be linked.

    Members of a word are dealt to chunks, and every two chunks of a word meet in a group
    of bounded size, where sketches are compared as arrays; only possible pairs leave it.
    """
    rows = placed.join(classes.select("node", "n_shingles", "sketch"), "node")
    chunks = F.ceil(F.col("_n") / CHUNK_MEMBERS).cast("int")
    rows = rows.withColumn("_mine", F.pmod(F.xxhash64("node"), chunks).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    rows = rows.withColumn("_i", F.least("_mine", "_other")).withColumn("_j", F.greatest("_mine", "_other"))

    def meet(part: pd.DataFrame) -> pd.DataFrame:
        nodes, sizes = part["node"].to_numpy(), part["n_shingles"].to_numpy()
        parts, mine = part["component"].to_numpy(), part["_mine"].to_numpy()
        sketch = np.stack(part["sketch"].to_numpy()).astype(np.int64).view(np.uint64)
        left = np.flatnonzero(mine == part["_i"].iloc[0])
        right = np.flatnonzero(mine == part["_j"].iloc[0])
        found = [np.zeros((0, 2), np.int64)]
        for i in left:
            able = right[(parts[right] != parts[i])]
            small, large = np.minimum(sizes[able], sizes[i]), np.maximum(sizes[able], sizes[i])
            able = able[100 * small >= percent * large]
            apart = np.bitwise_count(sketch[able] ^ sketch[i]).sum(1, dtype=np.int64)
            able = able[apart * (100 + percent) <= (sizes[able] + sizes[i]) * (100 - percent)]
            a, b = np.minimum(nodes[able], nodes[i]), np.maximum(nodes[able], nodes[i])
            found.append(np.column_stack([a, b]))
        pairs = np.unique(np.concatenate(found), axis=0)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    columns = ["key", "node", "component", "n_shingles", "sketch", "_mine", "_i", "_j"]
    groups = rows.select(*columns).groupBy("key", "_i", "_j")
    return groups.applyInPandas(meet, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` of set representatives that are linked.

    ``texts`` has ``node`` and ``text`` of the representatives in any pair.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for name in ("text_a", "text_b"):
                sets = []
                for _, _, data, offsets in pieces(batch, name):
                    hashes, places = shingle_sets(Words(data, offsets, lower=True), size)
                    sets += [hashes[x:y] for x, y in zip(places[:-1], places[1:], strict=True)]
                sides.append(sets)
            linked = []
            for one, other in zip(*sides, strict=True):
                common = len(np.intersect1d(one, other, assume_unique=True))
                linked.append(100 * common >= percent * (len(one) + len(other) - common) > 0)
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    side_b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    side_a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    return pairs.join(side_b, "b").join(side_a, "a").select("a", "b", "text_a", "text_b").mapInArrow(
        tidy(emit), "a long, b long"
    )


def similar_documents(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every document.

    A document's set holds the distinct shingles of ``size`` lower-cased words of its whole
    text; with fewer words, the whole sequence as one; without words it is empty and
    linked with nothing.  Documents link when ``100 * intersection >= percent * union``;
    ``component_id`` is the smallest ``doc_id`` reachable by links, itself included.

    Equal sets are one node, so copies are never compared with each other.  A null text is
    empty; a null ``doc_id`` has a null component and links with nothing; rows that
    repeat a ``doc_id`` give a row each.  Other columns are ignored.
    """
    spark = docs.sparkSession
    base = scratch_dir(spark, "similar")
    keyed = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("_c", F.expr("cast(crc32(text) - 2147483648 as int)"))

    def stored(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    sets = stored(_sets(keyed, size), "sets")
    known = sets.where("n_shingles > 0 and doc_id is not null")
    classes = known.groupBy("s1", "s2", "n_shingles").agg(F.min(F.struct("doc_id", "_c", "sketch")).alias("rep"))
    classes = classes.select(
        "s1", "s2", "n_shingles", F.col("rep.doc_id").alias("node"), F.col("rep._c").alias("_c"), "rep.sketch"
    )
    classes = stored(classes, "classes")

    words = _sketch_words(keyed.where("doc_id is not null"), size, percent)
    met = stored(_candidate_words(words), "words").distinct()
    often = Window.partitionBy("s1", "band").orderBy(F.desc("n"), "key")
    left = met.withColumn("_often", F.row_number().over(often)).where("_often > spare")
    left = stored(left.select("key", "s1").join(classes.select("s1", "node"), "s1").select("key", "node"), "left")

    hubs = left.groupBy("key").agg(F.min("node").alias("a"))
    stars = left.join(hubs, "key").where("a < node").select("a", F.col("node").alias("b")).distinct()
    stars = stored(_possible(stars, classes, percent), "stars")
    links = stored(_verified(stars, _texts(keyed, classes, stars), size, percent), "links-1")
    labels = components(links)

    # members of one word in different components have not all met
    placed = left.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    unlike = placed.groupBy("key").agg(
        F.min("component").alias("_x"), F.max("component").alias("_y"), F.count(F.lit(1)).alias("_n")
    )
    placed = stored(placed.join(unlike.where("_x < _y and _n > 2").select("key", "_n"), "key"), "placed")
    few = placed.where(F.col("_n") <= FEW_MEMBERS)
    one = few.select("key", F.col("node").alias("a"), F.col("component").alias("_one"))
    other = few.select("key", F.col("node").alias("b"), F.col("component").alias("_other"))
    near = one.join(other, "key").where("a < b and _one != _other").select("a", "b").distinct()
    near = _possible(near, classes, percent).unionByName(
        _screened(placed.where(F.col("_n") > FEW_MEMBERS), classes, percent)
    )
    far = stored(near.distinct().join(stars, ["a", "b"], "left_anti"), "pairs-2")
    if not far.isEmpty():
        more = stored(_verified(far, _texts(keyed, classes, far), size, percent), "links-2")
        labels = components(links.unionByName(more))

    ends = classes.join(labels, "node", "left").select(
        "s1", "s2", "n_shingles", F.coalesce("component", "node").alias("component_id")
    )
    columns = ["doc_id", "_c", "n_shingles", "component_id"]
    linked = known.join(ends, ["s1", "s2", "n_shingles"]).select(*columns)
    alone = sets.where("n_shingles = 0 or doc_id is null").withColumn("component_id", F.col("doc_id"))
    return linked.unionByName(alone.select(*columns))


def _texts(keyed: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """``node`` and ``text`` of the representatives in ``pairs``."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = nodes.join(classes.select("node", "_c"), "node")
    texts = keyed.withColumnRenamed("doc_id", "node").join(wanted, ["node", "_c"], "left_semi")
    return texts.dropDuplicates(["node", "_c"]).select("node", "text")
