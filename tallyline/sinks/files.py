"""CSV folders, catalog tables and the key check."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.operators.merge import _check_mode
from tallyline.schema import CONTROL, DELETED, EVENT_ORDER


def write_csv(df: DataFrame, path: str) -> None:
    """Headed CSV folder, one file per task; replaces what is there."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def write_single_csv(df: DataFrame, path: str, order: Sequence[Column] = ()) -> None:
    """Headed CSV folder with one data file, for reports: one task writes it all.

    ``repartition`` puts one exchange before the single writer, so the plan above
    stays parallel, where ``coalesce`` would pull it into that one task.
    """
    single = df.repartition(1)
    if order:
        single = single.sortWithinPartitions(*order)
    single.write.mode("overwrite").option("header", "true").csv(path)


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    format: str = "parquet",
    partition_by: Sequence[str] = (),
    path: str | None = None,
) -> None:
    """``CREATE TABLE IF NOT EXISTS`` with the schema's columns and types."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    layout = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {format}{layout}{place}")


def load_table(df: DataFrame, name: str, format: str = "parquet", path: str | None = None) -> None:
    """Replaces the table by the frame, which must not read from that table."""
    writer = df.write.mode("overwrite").format(format)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def merge_table(
    compacted: DataFrame, table: str, keys: Sequence[str], mode: str = "replace"
) -> None:
    """Upserts and deletes in a table whose format supports ``MERGE INTO``.

    ``compacted`` has each key once, with the delete flag; that is what makes the merge
    unambiguous.  If the target has the control columns, an older event changes nothing
    and deletes stay as marked rows, so a late event cannot revive a key; without them the
    later call wins.
    """
    _check_mode(mode)
    versioned = set(CONTROL) <= set(compacted.sparkSession.table(table).columns)
    columns = [c for c in compacted.columns if versioned or c not in CONTROL]
    same_key = reduce(and_, [F.col(f"{table}.{k}") == F.col(f"change.{k}") for k in keys])
    deleted = F.col(f"change.{DELETED}")
    fresh = {c: F.col(f"change.{c}") for c in columns}
    updated = {c: v for c, v in fresh.items() if c not in keys}
    if mode == "coalesce":
        kept = {c: F.coalesce(v, F.col(f"{table}.{c}")) for c, v in updated.items() if c not in CONTROL}
        updated |= {c: F.when(deleted, fresh[c]).otherwise(v) for c, v in kept.items()}
    merge = compacted.alias("change").mergeInto(table, same_key)
    if versioned:
        order = [F.struct(*[F.col(f"{side}.{c}") for c in EVENT_ORDER]) for side in ("change", table)]
        merge = merge.whenMatched(order[0] >= order[1]).update(updated).whenNotMatched().insert(fresh)
    else:
        merge = merge.whenMatched(deleted).delete().whenMatched().update(updated)
        merge = merge.whenNotMatched(~deleted).insert(fresh)
    merge.merge()


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Fails when a key repeats; files have no primary key to refuse it."""
    found = duplicate_keys(df, keys).take(1)
    if found:
        raise ValueError(f"duplicate key {found[0].asDict()}")
