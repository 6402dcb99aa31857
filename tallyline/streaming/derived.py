"""Tables that follow a snapshot: recomputed for the buckets a commit touched, or moved by
what the commit changed."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.numbers import exact_sums, round_to
from tallyline.functions.periods import is_trailing
from tallyline.operators.filters import exclude_prefix
from tallyline.operators.indicators import STANDARD, Spec, changed_indicators, with_indicators
from tallyline.operators.merge import live_rows
from tallyline.schema import AVERAGE_LABEL, COMPANY, CONTROL_FIELDS, DELETED, EVENT_TIME, MEASURES, PERIOD
from tallyline.sinks.jdbc import table_statement, upsert_jdbc
from tallyline.sinks.snapshot import VersionedTable, Snapshot


class FollowUp:
    """Base: keeps ``table`` equal to a per-bucket function of the snapshot.

    A bucket must hold everything the function needs for its rows.  The commit is tagged
    with the snapshot version it was built from; a step takes every bucket written since
    then, so a table added late, or after a load, catches up, and repeating a step
    changes nothing.
    """

    def __init__(self, table: VersionedTable):
        self.table = table

    def compute(self, rows: DataFrame, snapshot: Snapshot) -> DataFrame:
        raise NotImplementedError

    def __call__(self, snapshot: Snapshot, version: int) -> None:
        held, built = snapshot.pointer(version), self.table.pointer()
        last = int(built.tag.removeprefix("from-")) if built.tag else 0
        if last == version:
            return
        # a snapshot that starts again has smaller versions: everything is new then
        touched = held.since(last if last < version else 0)
        vanished = [b for b in built.held if b not in held.held]
        rows = self.compute(snapshot.read(version, only=touched), snapshot)
        self.table.replace(rows, touched=[*touched, *vanished], tag=f"from-{version}")

    def read(self) -> DataFrame:
        return self.table.rows()


class Indicators(FollowUp):
    """Indicator rows; the snapshot must be bucketed by company.

    A changed period alters the next one's growth, so whole companies are
    recomputed, but only those sharing a bucket with a change.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        row: T.StructType,
        buckets: int = 64,
        specs: Sequence[Spec] = STANDARD,
    ):
        schema = T.StructType(row.fields + [T.StructField(s.name, T.DoubleType()) for s in specs])
        super().__init__(VersionedTable(spark, path, schema, [COMPANY], buckets))
        self.specs = specs

    def compute(self, rows: DataFrame, snapshot: Snapshot) -> DataFrame:
        if snapshot.bucket_by != [COMPANY] or snapshot.buckets != self.table.buckets:
            raise ValueError("the snapshot must share this table's buckets, by company")
        return with_indicators(exclude_prefix(rows), self.specs)


class ChangedIndicators(FollowUp):
    """Indicator rows by key, moved by the rows of a commit that are otherwise than before.

    A changed period sends itself and its successor; growth of all other rows is neither
    computed nor compared.  If the version this table was built from has expired, it is
    built anew.  The snapshot must be bucketed by company.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        row: T.StructType,
        keys: Sequence[str] = (PERIOD, COMPANY),
        buckets: int = 64,
        specs: Sequence[Spec] = STANDARD,
    ):
        schema = T.StructType(row.fields + [T.StructField(s.name, T.DoubleType()) for s in specs])
        super().__init__(Snapshot(spark, path, schema, keys, buckets, [COMPANY]))
        self.specs = specs

    def changes(self, snapshot: Snapshot, since: int, version: int) -> DataFrame:
        """Rows that differ between two versions of the snapshot, and keys that left."""
        held, was = snapshot.pointer(version), snapshot.pointer(since)
        if held.bucket_by != [COMPANY] or (held.buckets, held.bucket_by) != (was.buckets, was.bucket_by):
            raise ValueError("both versions must have the same buckets, by company")
        touched = [*held.since(since), *[b for b in was.held if b not in held.held]]
        old, new = [exclude_prefix(snapshot.read(v, touched)) for v in (since, version)]
        return changed_indicators(old, new, self.specs, self.table.keys)

    def __call__(self, snapshot: Snapshot, version: int) -> None:
        tag = self.table.pointer().tag
        last = int(tag.removeprefix("from-")) if tag else 0
        if last == version:
            return
        same = 0 < last < version and last in snapshot.versions()
        layouts = [(p.buckets, p.bucket_by) for p in map(snapshot.pointer, (last, version))] if same else []
        if not same or layouts[0] != layouts[1]:
            rows = with_indicators(exclude_prefix(snapshot.read(version)), self.specs)
            self.table.load(rows, f"from-{version}")
            return
        blank = {f.name: F.lit(None).cast(f.dataType) for f in CONTROL_FIELDS if f.name != DELETED}
        events = self.changes(snapshot, last, version).withColumns(blank)
        events = events.withColumn(EVENT_TIME, F.lit(version).cast("long"))
        # versions come in order, so markers have nothing to wait for
        self.table.apply(events, tag=f"from-{version}", keep_deletes_ms=0)

    def read(self) -> DataFrame:
        return self.table.read()


class Averages(FollowUp):
    """Average row from per-bucket sums.

    Each commit replaces the sums of its buckets; the average itself is an
    aggregate over at most one row per bucket, never over the whole state.
    With ``scale``, sums are also kept in decimals of that many places, and used as long
    as every value is one: the result is then the same in any order of rows.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        measures: Sequence[str] = MEASURES,
        buckets: int = 64,
        scale: int | None = None,
    ):
        self.measures = list(measures)
        self.scale = scale
        fields = [T.StructField("bucket_no", T.IntegerType())]
        for m in self.measures:
            fields.append(T.StructField(f"sum_{m}", T.DoubleType()))
            fields.append(T.StructField(f"n_{m}", T.LongType()))
            fields.append(T.StructField(f"exact_{m}", T.DecimalType(38, scale or 0)))
            fields.append(T.StructField(f"inexact_{m}", T.LongType()))
        super().__init__(_ByNumber(spark, path, T.StructType(fields), ["bucket_no"], buckets))

    def compute(self, rows: DataFrame, snapshot: Snapshot) -> DataFrame:
        rows = rows.filter(~is_trailing(PERIOD) & (F.col(PERIOD) != AVERAGE_LABEL))
        sums = []
        for m in self.measures:
            value = F.col(m).cast("double")
            exact, inexact = exact_sums(value, self.scale)
            sums.append(F.sum(value).alias(f"sum_{m}"))
            sums.append(F.count(m).alias(f"n_{m}"))
            sums.append(exact.try_cast(f"decimal(38,{self.scale or 0})").alias(f"exact_{m}"))
            sums.append(inexact.alias(f"inexact_{m}"))
        return rows.groupBy(snapshot.bucket().alias("bucket_no")).agg(*sums)

    def average(self, digits: int | None = None) -> DataFrame:
        means = []
        for m in self.measures:
            exact = F.sum(f"exact_{m}").try_cast("double")
            total = F.when(F.sum(f"inexact_{m}") == 0, exact).otherwise(F.sum(f"sum_{m}"))
            mean = F.try_divide(total, F.sum(f"n_{m}").cast("double"))
            means.append(round_to(mean, digits).alias(m))
        summed = self.read().agg(*means)
        return summed.select(F.lit(AVERAGE_LABEL).alias(PERIOD), *self.measures)


class DatabaseCopy:
    """Keeps a keyed database table equal to the snapshot's live rows.

    A commit's buckets are upserted and their delete markers removed.  The first step of
    a program sends every bucket, so that rows loaded, or sent while the database was
    away, arrive; sending a bucket again changes nothing.
    """

    def __init__(self, url: str, table: str, execute: Callable[[str], None], **options: str):
        self.url, self.table, self.execute, self.options = url, table, execute, options
        self.sent = 0

    def __call__(self, snapshot: Snapshot, version: int) -> None:
        if not self.sent:
            self.execute(table_statement(self.table, snapshot.row, snapshot.keys))
        rows = snapshot.rows(version, only=snapshot.pointer(version).since(self.sent))
        gone = rows.filter(F.col(DELETED)).select(*snapshot.keys)
        upsert_jdbc(live_rows(rows), self.url, self.table, snapshot.keys, self.execute, gone, **self.options)
        self.sent = version


class _ByNumber(VersionedTable):
    """Rows that name their bucket themselves."""

    def bucket(self) -> Column:
        return F.col(self.bucket_by[0]).cast("int")


