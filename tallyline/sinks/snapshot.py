"""Versions of plain partitioned Parquet, and the keyed snapshot built on them.

A version is a folder of Parquet partitioned by hash bucket, holding the buckets it wrote,
each whole.  One pointer file per version says in which version's folder each bucket is
read.  A commit is that file: a version without one, or with half of one, isn't there, so a
failed update is simply repeated, and nothing is ever renamed.  Readers of an earlier
version keep its files until :meth:`VersionedTable.expire`.  One writer at a time.

    <path>/data/_version=7/_bucket=12/part-….parquet
    <path>/pointer/00000007.json
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.operators.compact import compact
from tallyline.operators.fill import deciding_rows, filled
from tallyline.operators.merge import live_rows, merge_versioned, without_old_markers
from tallyline.schema import CONTROL, DELETED, EVENT_ORDER, state_schema

BUCKET, VERSION = "_bucket", "_version"
#: The commit that brought an event: the later one wins where positions are equal.
TURN = "_turn"


@dataclass(frozen=True)
class Pointer:
    """Per bucket the version whose folder holds it; the commit's tag, layout and mode."""

    held: dict[int, int] = field(default_factory=dict)
    tag: str | None = None
    buckets: int | None = None
    bucket_by: list[str] | None = None
    mode: str = "replace"

    def since(self, version: int) -> list[int]:
        """Buckets written after ``version``."""
        return [b for b, v in self.held.items() if v > version]


class VersionedTable:
    """Rows hashed into buckets by some of their columns, replaced bucket by bucket."""

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, bucket_by: Sequence[str], buckets: int = 64
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.bucket_by, self.buckets = list(bucket_by), buckets
        self._pointers: dict[int, Pointer] = {}  # a complete pointer never changes

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")

    def _place(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{path}")
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _list(self, path: str) -> list[str]:
        fs, place = self._place(path)
        return [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []

    def _remove(self, path: str) -> None:
        fs, place = self._place(path)
        fs.delete(place, True)

    def versions(self) -> list[int]:
        """Committed versions, newest first."""
        named = sorted((int(n[:8]) for n in self._list("pointer") if n.endswith(".json")), reverse=True)
        return [v for v in named if self.pointer(v) is not None]

    def version(self) -> int:
        """Newest committed version, 0 before the first."""
        return next(iter(self.versions()), 0)

    def pointer(self, version: int | None = None) -> Pointer | None:
        """A version's pointer (a number per bucket), read without a Spark job."""
        version = self.version() if version is None else version
        if version and version not in self._pointers:
            fs, place = self._place(f"pointer/{version:08d}.json")
            stream = fs.open(place)
            try:
                found = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            except json.JSONDecodeError:  # its writer stopped halfway
                return None
            finally:
                stream.close()
            found["held"] = {int(b): v for b, v in found["held"].items()}
            self._pointers[version] = Pointer(**found)
        return self._pointers[version] if version else Pointer()

    def _checked(self, version: int) -> Pointer:
        """The pointer, if its layout is this table's; another would misplace rows."""
        found = self.pointer(version)
        if version and (found.buckets, found.bucket_by) != (self.buckets, self.bucket_by):
            raise ValueError(
                f"{self.path} has {found.buckets} buckets by {found.bucket_by}, not {self.buckets} by "
                f"{self.bucket_by}: open it with its layout, or replace all its rows"
            )
        return found

    def rows(self, version: int | None = None, only: Sequence[int] | None = None) -> DataFrame:
        """Stored rows, optionally of some buckets only."""
        version = self.version() if version is None else version
        held = self.pointer(version).held if only is None else self._checked(version).held
        wanted = sorted(held if only is None else set(held) & set(only))
        if not wanted:
            return self.spark.createDataFrame([], self.schema)
        base = f"{self.path}/data"
        reader = self.spark.read.schema(self.schema).option("basePath", base)
        return reader.parquet(*[f"{base}/{VERSION}={held[b]}/{BUCKET}={b}" for b in wanted]).select(*self.schema.names)

    def replace(
        self,
        rows: DataFrame,
        touched: Sequence[int] | None = None,
        tag: str | None = None,
        mode: str = "replace",
        repeat: bool = False,
    ) -> int:
        """Puts ``rows`` in place of the ``touched`` buckets (default: all) and commits.

        The rows must hash into touched buckets.  Unless ``repeat``, a ``tag`` equal to the
        newest commit's makes the call a no-op.  Replacing all sets the layout anew.
        """
        current = self.version()
        before = self.pointer(current) if touched is None else self._checked(current)
        if tag is not None and tag == before.tag and not repeat:
            return current
        version = current + 1
        # rebalancing keeps files few, and splits a bucket larger than the advisory size
        placed = rows.select(*self.schema.names, self.bucket().alias(BUCKET)).hint("rebalance", F.col(BUCKET))
        folder = f"data/{VERSION}={version}"
        placed.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        gone = set(before.held if touched is None else touched)
        held = {b: v for b, v in before.held.items() if b not in gone}
        held |= {int(n.split("=")[1]): version for n in self._list(folder) if n.startswith(f"{BUCKET}=")}
        self._pointers[version] = Pointer(held, tag, self.buckets, self.bucket_by, mode)
        fs, place = self._place(f"pointer/{version:08d}.json")
        stream = fs.create(place, True)
        stream.write(bytearray(json.dumps(vars(self._pointers[version])).encode()))
        stream.close()
        return version

    def expire(self, keep: int = 10) -> None:
        """Forgets all but the newest ``keep`` versions and removes buckets only they hold.

        Pointers go first, so an interrupted call leaves files that the next one removes.
        """
        versions = self.versions()
        kept = versions[: max(keep, 1)]
        for version in versions[len(kept) :]:
            self._remove(f"pointer/{version:08d}.json")
            self._pointers.pop(version, None)
        needed = {(v, b) for k in kept for b, v in self.pointer(k).held.items()}
        old = [f for f in self._list("data") if kept and int(f.split("=")[1]) <= kept[0]]
        for folder in old:
            version = int(folder.split("=")[1])
            if not any(v == version for v, _ in needed):
                self._remove(f"data/{folder}")
                continue
            for name in self._list(f"data/{folder}"):
                if name.startswith(f"{BUCKET}=") and (version, int(name.split("=")[1])) not in needed:
                    self._remove(f"data/{folder}/{name}")


class Snapshot(VersionedTable):
    """Keyed rows with upsert, delete and time-correct late events.

    A batch is joined with the buckets it touches, which are written anew: the latest event
    per key (``replace``), the stored values under its NULLs (``coalesce``), or what decides
    the newest value per measure since the last delete (``fill``).
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        row: T.StructType,
        keys: Sequence[str],
        buckets: int = 64,
        bucket_by: Sequence[str] | None = None,
    ):
        """``bucket_by`` (default: all keys) must be a part of the keys."""
        stored = T.StructType([*state_schema(row).fields, T.StructField(TURN, T.IntegerType())])
        super().__init__(spark, path, stored, bucket_by or keys, buckets)
        self.row, self.keys = row, list(keys)
        self.columns, self.values = state_schema(row).names, [c for c in row.names if c not in self.keys]
        if not set(self.bucket_by) <= set(self.keys):
            raise ValueError("bucket_by must be part of the keys")

    def rows(self, version: int | None = None, only: Sequence[int] | None = None) -> DataFrame:
        """One row per key, delete markers included."""
        version = self.version() if version is None else version
        rows = super().rows(version, only)
        if self.pointer(version).mode == "fill":
            rows = filled(rows, self.keys, self.values, [*EVENT_ORDER, TURN])
        return rows.select(*self.columns)

    def read(self, version: int | None = None, only: Sequence[int] | None = None) -> DataFrame:
        """Live rows."""
        return live_rows(self.rows(version, only))

    def load(self, rows: DataFrame, tag: str | None = None) -> int:
        """Replaces everything by plain rows; any later event is newer than they are."""
        blank = {f.name: F.lit(None).cast(f.dataType) for f in self.schema if f.name in CONTROL}
        blank |= {DELETED: F.lit(False), TURN: F.lit(0)}
        return self.replace(rows.select(*self.row.names).withColumns(blank), tag=tag)

    def relayout(self, buckets: int, bucket_by: Sequence[str] | None = None) -> int:
        """Writes everything into another layout, which this object then has."""
        rows, now = super().rows(), self.pointer()
        self.buckets, self.bucket_by = buckets, list(bucket_by or self.bucket_by)
        return self.replace(rows, tag=now.tag, mode=now.mode, repeat=True)

    def apply(
        self,
        events: DataFrame,
        mode: str = "replace",
        tag: str | None = None,
        keep_deletes_ms: int | None = None,
    ) -> int:
        """Applies decoded events and returns the committed version.

        A ``tag`` equal to the newest commit's makes the call a no-op, so a repeated
        micro-batch is applied once.  ``replace`` and ``fill`` end in the same state however
        the log is cut into batches; a state that changes between them keeps its rows of
        that moment.  With ``keep_deletes_ms``, markers that much older than the batch's
        median event leave the touched buckets; an event later than that could revive a key.
        """
        if mode not in ("coalesce", "fill", "replace"):
            raise ValueError(f"unknown mode: {mode!r}")
        current = self.version()
        now = self._checked(current)
        if tag is not None and tag == now.tag:
            return current
        kind = "fill" if mode == "fill" else "replace"
        events = events.select(*self.columns).withColumn(TURN, F.lit(current + 1))
        batch = deciding_rows(events, self.keys, self.values) if kind == "fill" else compact(events, self.keys)
        # told apart from the merge: which buckets to read; recomputed if an executor is lost
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            touched = [r[0] for r in batch.select(self.bucket()).distinct().collect()]
            stored = super().rows(current, touched)
            if now.mode == "fill" and kind != "fill":
                touched, stored = None, self.rows(current).withColumn(TURN, F.lit(current))
            if kind == "fill":
                rows = deciding_rows(stored.unionByName(batch), self.keys, self.values, [*EVENT_ORDER, TURN])
            else:
                rows = merge_versioned(stored, batch, self.keys, mode)
            if keep_deletes_ms is not None:
                rows = without_old_markers(rows, batch, keep_deletes_ms)
            return self.replace(rows, touched, tag, kind)
        finally:
            batch.unpersist()
