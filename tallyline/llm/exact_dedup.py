"""Exact duplicates by Grace hashing: spilled partitions, open-addressing tables.

1.  Every map task collapses equal texts in an open-addressing table that compares
    complete contents.  A table that is full is emptied into the first spill files, so
    a group of copies leaves each task as a few rows, whatever its size.
2.  The spilled contents are partitioned by hash.  Each partition fills a table of bounded
    size; contents that find it full go to the spill files of the next level, where another
    hash partitions them again.  A content in the table takes all its rows, so a level
    settles at least one full table per partition, and the recursion ends even if all
    hashes were equal.
3.  Copies get their group's result by joining the small rows that say which spilled
    content belongs to which group.

Spill files lie in the shared folder, so a lost executor costs its running tasks only.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.sinks.workspace import scratch_dir

#: Bytes of contents a table holds before it counts as full.
TABLE_BYTES = 64 << 20
#: Rows a map task's table takes in before it is emptied; bounds the ids of one row.
TABLE_ROWS = 200_000
#: Partitions of one level at most; larger inputs take more levels.
FAN_OUT = 8192
#: Bytes of contents in a row batch on its way back to Spark.
_BATCH_BYTES = 8 << 20

_SPILLED = "part long, sha string, hash long, content string, best long, n long, ids array<long>"
_SETTLED = "settled boolean, part long, of long, best long, n long, hash long, content string"


class ContentTable:
    """Open addressing with linear probing; equal hashes are told apart by content."""

    def __init__(self) -> None:
        self.hashes = array("q")
        self.contents: list[str] = []
        self.bytes = 0
        self._grow(1 << 10)

    def _grow(self, size: int) -> None:
        self.mask = size - 1
        self.slots = array("q", [-1]) * size
        for entry, value in enumerate(self.hashes):
            at = value & self.mask
            while self.slots[at] >= 0:
                at = (at + 1) & self.mask
            self.slots[at] = entry

    def find(self, value: int, content: str) -> tuple[int, int]:
        """The entry of a content, or -1, and the slot where the search ended."""
        at = value & self.mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == value and self.contents[entry] == content:
                return entry, at
            at = (at + 1) & self.mask
        return -1, at

    def add(self, value: int, content: str, slot: int) -> int:
        """A new entry at the slot where ``find`` ended."""
        entry = len(self.contents)
        self.slots[slot] = entry
        self.hashes.append(value)
        self.contents.append(content)
        self.bytes += len(content) + 64
        if 2 * len(self.contents) > self.mask:
            self._grow(4 * len(self.slots))
        return entry


def _better(one: int | None, other: int | None, largest: bool) -> bool:
    """Whether ``one`` goes before ``other``; no id goes behind all."""
    if one is None or other is None:
        return one is not None
    return one > other if largest else one < other


def _collapsed(docs: DataFrame, largest: bool, table_bytes: int, table_rows: int) -> DataFrame:
    """A row per content and filled table: its ids in order, the best one and their number."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 40

        def emptied() -> Iterator[pa.RecordBatch]:
            nonlocal part
            first = 0
            while first < len(table.contents):
                stop, size = first, 0
                while stop < len(table.contents) and size < _BATCH_BYTES:
                    size += len(table.contents[stop])
                    stop += 1
                rows = [
                    sorted(x, key=lambda i: (i is not None, i or 0), reverse=True)
                    if largest
                    else sorted(x, key=lambda i: (i is None, i or 0))
                    for x in ids[first:stop]
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(part, part + stop - first), pa.int64()),
                        pa.array(shas[first:stop], pa.string()),
                        pa.array(table.hashes[first:stop], pa.int64()),
                        pa.array(table.contents[first:stop], pa.string()),
                        pa.array([x[0] for x in rows], pa.int64()),
                        pa.array(map(len, rows), pa.int64()),
                        pa.array(rows, pa.list_(pa.int64())),
                    ],
                    ["part", "sha", "hash", "content", "best", "n", "ids"],
                )
                part += stop - first
                first = stop

        table, ids, shas, taken = ContentTable(), [], [], 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "hash", "sha", "content"))
            for doc, value, sha, content in zip(*columns, strict=True):
                entry, slot = table.find(value, content)
                if entry < 0:
                    if table.bytes >= table_bytes or taken >= table_rows:
                        yield from emptied()
                        table, ids, shas, taken = ContentTable(), [], [], 0
                        _, slot = table.find(value, content)
                    table.add(value, content, slot)
                    ids.append([doc])
                    shas.append(sha)
                else:
                    ids[entry].append(doc)
                taken += 1
                if taken >= 2 * table_rows:
                    yield from emptied()
                    table, ids, shas, taken = ContentTable(), [], [], 0
        yield from emptied()

    return docs.mapInArrow(emit, _SPILLED)


def _settled(spilled: DataFrame, largest: bool, table_bytes: int) -> DataFrame:
    """Rows ``part -> of`` and groups (``part`` null) of contents that found room; the rest again."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["settled", "part", "of", "best", "n", "hash", "content"]
        types = [pa.bool_(), *[pa.int64()] * 5, pa.string()]

        def rows(columns: list[list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        table = ContentTable()
        of, best, total, won = array("q"), [], array("q"), array("q")
        for batch in batches:
            links, rest = [], []
            columns = (batch.column(c).to_pylist() for c in ("part", "best", "n", "hash", "content"))
            for part, doc, n, value, content in zip(*columns, strict=True):
                entry, slot = table.find(value, content)
                if entry < 0 and table.bytes >= table_bytes:
                    rest.append((False, part, None, doc, n, value, content))
                    continue
                if entry < 0:
                    entry = table.add(value, content, slot)
                    of.append(part)
                    best.append(doc)
                    total.append(n)
                    won.append(part)
                else:
                    total[entry] += n
                    if _better(doc, best[entry], largest):
                        best[entry], won[entry] = doc, part
                links.append((True, part, of[entry], None, None, None, None))
            if links or rest:
                yield rows([list(c) for c in zip(*links, *rest, strict=True)])
        for at in range(0, len(of), 100_000):
            some = slice(at, at + 100_000)
            many = len(of[some])
            none = [None] * many
            # the winning row of the group stands where a link has its content's part
            yield rows([[True] * many, none, of[some], best[some], total[some], won[some], none])

    return spilled.mapInArrow(emit, _SETTLED)


def exact_duplicates(
    docs: DataFrame,
    keep: str = "largest",
    table_bytes: int = TABLE_BYTES,
    table_rows: int = TABLE_ROWS,
    fan_out: int = FAN_OUT,
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row of ``docs``.

    Rows whose whole ``text`` is identical are one group; null counts as empty, and
    nothing is trimmed, folded or normalised.  The row with the largest (or
    ``keep="smallest"``) ``doc_id`` stays.  Of several rows that share this id exactly one
    has ``kept``; a null ``doc_id`` stays only where the group has no other, and then
    ``keep_id`` is null.  Other columns are ignored, whatever their names.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep is 'largest' or 'smallest', not {keep!r}")
    spark, largest = docs.sparkSession, keep == "largest"
    base = scratch_dir(spark, "exact")
    content = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), content.alias("content"))
    rows = rows.select("doc_id", "content", F.xxhash64("content").alias("hash"), F.sha2("content", 256).alias("sha"))
    _collapsed(rows, largest, table_bytes, table_rows).write.parquet(f"{base}/spilled")
    spilled = spark.read.schema(_SPILLED).parquet(f"{base}/spilled")

    level, pending = 0, spilled.select("part", "best", "n", "hash", "content")
    folders = []
    while True:
        size = pending.agg(F.sum(F.octet_length("content") + 64)).first()[0]
        if size is None:
            break
        parts = max(1, min(fan_out, -(-2 * size // table_bytes)))
        folder = f"{base}/level-{level}"
        dealt = pending.repartition(parts, F.xxhash64("hash", F.lit(level)))
        _settled(dealt, largest, table_bytes).write.partitionBy("settled").parquet(folder)
        folders.append(folder)
        pending = spark.read.schema(_SETTLED).parquet(folder).where("not settled")
        pending = pending.select("part", "best", "n", "hash", "content")
        level += 1

    results = spark.createDataFrame([], _SETTLED)
    if folders:
        results = spark.read.schema(_SETTLED).option("basePath", folders[0]).parquet(folders[0]).where("settled")
        for folder in folders[1:]:
            results = results.unionByName(spark.read.schema(_SETTLED).parquet(folder).where("settled"))
    links = results.where("part is not null").select("part", "of")
    groups = results.where("part is null").select(
        "of", F.col("best").alias("keep_id"), F.col("n").alias("group_size"), F.col("hash").alias("_won")
    )
    found = spilled.select("part", "sha", "ids").join(links, "part").join(groups, "of")
    return found.select("part", "_won", "keep_id", "group_size", "sha", F.posexplode("ids").alias("_place", "doc_id")).select(
        "doc_id",
        "keep_id",
        "group_size",
        ((F.col("part") == F.col("_won")) & (F.col("_place") == 0)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def distinct_documents(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    ``doc_id`` must tell the rows apart; rows that repeat an id and its text count once.
    """
    stay = exact_duplicates(docs, keep).where("kept").select("doc_id", "text_sha256")
    sha = F.sha2(F.coalesce(docs["text"].cast("string"), F.lit("")), 256)
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), sha.alias("sha"))
    same = rows["id"].eqNullSafe(stay["doc_id"]) & (rows["sha"] == stay["text_sha256"])
    return rows.join(stay, same, "left_semi").dropDuplicates(["id", "sha"]).select("row.*")
