"""Readers for change logs, stored state, pages and CSV statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.schema import statement_schema

CHANGE_SCHEMA = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)


def as_changes(df: DataFrame) -> DataFrame:
    """Any log frame to ``(value string, partition int, offset bigint)``.

    Logs without positions (plain text files) get one from the file name and the
    text: arbitrary, but the same on every run, which is what ties need.
    """
    value = F.col("value").cast("string")
    if {"partition", "offset"} <= set(df.columns):
        return df.select(
            value.alias("value"),
            F.col("partition").cast("int").alias("partition"),
            F.col("offset").cast("bigint").alias("offset"),
        )
    file_no = F.pmod(F.xxhash64(F.input_file_name()), F.lit(2**31 - 1)).cast("int")
    return df.select(
        value.alias("value"), file_no.alias("partition"), F.xxhash64(value).alias("offset")
    )


def read_changes(
    spark: SparkSession,
    format: str,
    path: str | None = None,
    streaming: bool = False,
    **options: str,
) -> DataFrame:
    """A change log as a batch (from its beginning) or a stream.

    ``kafka``          options as the connector takes them; needs its package.
    ``parquet, json``  files with ``value, partition, offset``.
    ``text``           one envelope per line.
    """
    reader = spark.readStream if streaming else spark.read
    if format == "kafka":
        settings = {"startingOffsets": "earliest", **options}
        return as_changes(reader.format("kafka").options(**settings).load())
    if path is None:
        raise ValueError(f"{format} change logs need a path")
    if format == "text":
        return as_changes(reader.format("text").options(**options).load(path))
    if format in ("parquet", "json"):
        return as_changes(reader.format(format).schema(CHANGE_SCHEMA).options(**options).load(path))
    raise ValueError(f"unknown change-log format: {format!r}")


def read_state_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: str | int | None = None,
    upper: str | int | None = None,
    partitions: int | None = None,
    **options: str,
) -> DataFrame:
    """A database table; with a partition column the read is split over tasks.

    Credentials and driver class come in through ``options``.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column is not None:
        if lower is None or upper is None or not partitions:
            raise ValueError("a partitioned read needs lower, upper and partitions")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower))
            .option("upperBound", str(upper))
            .option("numPartitions", str(partitions))
        )
    return reader.options(**options).load()


def read_snapshot_files(
    spark: SparkSession, path: str, format: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """Stored state in files."""
    reader = spark.read.format(format)
    return (reader.schema(schema) if schema else reader).load(path)


def read_pages(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    column: str = "html",
) -> DataFrame:
    """``(page_id, url, html)``.

    ``text`` reads one page per file: the file path is the address and its hash
    the identifier.
    """
    if format == "text":
        pages = spark.read.format("text").option("wholetext", "true").load(path)
        address = F.input_file_name()
        return pages.select(
            F.xxhash64(address).alias("page_id"), address.alias("url"), F.col("value").alias("html")
        )
    return spark.read.format(format).load(path).select(
        "page_id", "url", F.col(column).alias("html")
    )


def read_statements_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Statement rows from headed CSV; the declared types spare an inference pass."""
    return spark.read.schema(schema or statement_schema()).option("header", "true").csv(path)
