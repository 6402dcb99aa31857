"""Keyed state in bucketed tables: a merge exchanges the changes, never the stored rows.

A version is an ordinary Parquet table of the catalog, bucketed by the keys.  Its scan
already has the partitioning a join by key asks for, so only the changes are shuffled to
the buckets, and the merged rows are written from where they are.  A view points to the
newest version; moving it is the commit, and readers of an older version keep their table
until :meth:`expire`.  One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.operators.compact import compact
from tallyline.operators.merge import live_rows, merge_versioned, without_old_markers
from tallyline.schema import CONTROL, DELETED, state_schema


class BucketedState:
    """Rows by key with upsert, delete and time-correct late events.

    Every version holds the whole state: choose :class:`Snapshot` where batches are
    small against it, and this where a batch touches much of it.
    """

    def __init__(
        self, spark: SparkSession, name: str, row: T.StructType, keys: Sequence[str], buckets: int = 64
    ):
        """``name`` is the view, with its database if any; versions stand beside it."""
        self.spark, self.name, self.row = spark, name, row
        self.keys, self.buckets = list(keys), buckets
        self.schema = state_schema(row)

    def _property(self, key: str) -> str | None:
        if not self.spark.catalog.tableExists(self.name):
            return None
        rows = self.spark.sql(f"show tblproperties {self.name}").collect()
        return {r["key"]: r["value"] for r in rows}.get(f"state.{key}")

    def version(self) -> int:
        """Newest committed version, 0 before the first."""
        return int(self._property("version") or 0)

    def tables(self) -> list[str]:
        """Tables of all versions still there, newest first."""
        head, _, tail = self.name.rpartition(".")
        shown = self.spark.sql(f"show tables {f'in {head} ' if head else ''}like '{tail}_v*'").collect()
        names = [r["tableName"] for r in shown if not r["isTemporary"]]
        found = sorted(names, key=lambda n: int(n.rsplit("_v", 1)[1].split("_")[0]), reverse=True)
        return [f"{head}.{n}" if head else n for n in found]

    def rows(self) -> DataFrame:
        """One row per key, delete markers included."""
        table = self._property("table")
        if table is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.table(table).select(*self.schema.names)

    def read(self) -> DataFrame:
        """Live rows."""
        return live_rows(self.rows())

    def _commit(self, rows: DataFrame, tag: str | None) -> int:
        version = self.version() + 1
        # a failed attempt leaves a table that no view names; the next has another name
        table = f"{self.name}_v{version}_{uuid.uuid4().hex[:8]}"
        written = rows.select(*self.schema.names).write.format("parquet")
        written.bucketBy(self.buckets, *self.keys).sortBy(*self.keys).saveAsTable(table)
        noted = {"version": str(version), "table": table} | ({"tag": tag} if tag is not None else {})
        given = ", ".join("'state.{}' = '{}'".format(k, v.replace("'", "\\'")) for k, v in noted.items())
        self.spark.sql(f"create or replace view {self.name} tblproperties ({given}) as select * from {table}")
        return version

    def load(self, rows: DataFrame, tag: str | None = None) -> int:
        """Replaces everything by plain rows; any later event is newer than they are."""
        blank = {f.name: F.lit(None).cast(f.dataType) for f in self.schema if f.name in CONTROL}
        blank[DELETED] = F.lit(False)
        plain = rows.select(*self.row.names).withColumns(blank)
        return self._commit(plain.repartition(self.buckets, *self.keys), tag)

    def merged(self, events: DataFrame, mode: str = "replace") -> DataFrame:
        """The state after some events, marks included, from where the stored rows lie."""
        batch = compact(events.select(*self.schema.names), self.keys)
        if not self.version():
            return batch.repartition(self.buckets, *self.keys)
        # the number of buckets, so that the stored side is the one to join up with
        return merge_versioned(self.rows(), batch.repartition(self.buckets, *self.keys), self.keys, mode)

    def apply(
        self,
        events: DataFrame,
        mode: str = "replace",
        tag: str | None = None,
        keep_deletes_ms: int | None = None,
    ) -> int:
        """Applies decoded events as a new version.

        A ``tag`` equal to the newest commit's makes the call a no-op.  With
        ``keep_deletes_ms``, delete markers that much older than the batch's median event
        are left out; an event later than that could revive its key.
        """
        if tag is not None and tag == self._property("tag"):
            return self.version()
        rows = self.merged(events, mode)
        if keep_deletes_ms is not None:
            rows = without_old_markers(rows, events, keep_deletes_ms)
        return self._commit(rows, tag)

    def expire(self, keep: int = 10) -> None:
        """Drops the tables of all but the newest ``keep`` versions, and of failed attempts."""
        current = self._property("table")
        kept = {t.rsplit("_", 1)[0] for t in self.tables()[: max(keep, 1)]}
        for table in self.tables():
            if table != current and table.rsplit("_", 1)[0] not in kept:
                self.spark.sql(f"drop table if exists {table}")
