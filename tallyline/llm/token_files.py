"""Token-id files: ORC, ascending document id, integer run lengths and id filters.

Layout: one folder of ORC files; file order and row order follow ``doc_id``.  Each
row holds one document's ids as a list of integers, which ORC stores in run-length
encoding version 2.  Stripes are the unit of parallel reads; every stripe has row
indexes and a Bloom filter on ``doc_id``, so a look-up by id skips stripes and row
groups by metadata alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm.tokens import encoder

TOKEN_COLUMNS = "doc_id long, ids array<int>"


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = 2,
    stripe_bytes: int = 64 << 20,
    index_rows: int = 1000,
) -> None:
    """Encodes whole texts and writes them in ascending ``doc_id`` order.

    Null and empty texts give the end id alone.  Rows of one ``doc_id`` follow each
    other by text; a null ``doc_id`` comes first.  Other columns are not written.  The
    texts are ordered before they are encoded, so nothing is encoded twice; each task
    writes its range of ids as one file, whose tokens never wait in memory for others.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = encoder(tokenizer)
        for batch in batches:
            for start, stop, ids, places in work.encode_batch(batch, end_id):
                values = pa.array(ids.view(np.int32))
                lists = pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), values)
                doc = batch.column("doc_id").slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([doc, lists], ["doc_id", "ids"])

    (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(encode, TOKEN_COLUMNS)
        .write.option("orc.compress", "ZLIB")
        .option("orc.stripe.size", str(stripe_bytes))
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", str(index_rows))
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .orc(folder)
    )


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of a folder: ``doc_id``, ``ids`` and ``file``, its place in order."""
    return spark.read.schema(TOKEN_COLUMNS).orc(folder).withColumn("file", F.col("_metadata.file_name"))


def documents_by_id(spark: SparkSession, folder: str, ids: list[int]) -> DataFrame:
    """Some documents; stripes and row groups without these ids are not read."""
    return read_token_files(spark, folder).where(F.col("doc_id").isin(ids))


def token_digests(tokens: DataFrame) -> DataFrame:
    """``doc_id``, ``file``, ``n_tokens`` and the checksum of each document's ids."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            ends = np.asarray(lists.offsets).astype(np.int64)
            values = np.ascontiguousarray(np.asarray(lists.values), dtype="<i4").view(np.uint8)
            crc = [
                zlib.crc32(values[4 * a : 4 * b]) for a, b in zip(ends[:-1], ends[1:], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("file"),
                    pa.array(np.diff(ends), pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                ["doc_id", "file", "n_tokens", "ids_crc32"],
            )

    return tokens.select("doc_id", "file", "ids").mapInArrow(
        digest, "doc_id long, file string, n_tokens long, ids_crc32 long"
    )


def token_starts(digests: DataFrame) -> DataFrame:
    """Adds ``start``, the tokens of all documents before.

    Running sums stay inside a file; across files only one total per file is ordered.
    Among rows of one ``doc_id`` the one with fewer tokens, then the smaller checksum,
    comes first.  ``digests`` is read twice and should be a stored table.
    """
    inside = Window.partitionBy("file").orderBy("doc_id", "n_tokens", "ids_crc32")
    files = digests.groupBy("file").agg(F.sum("n_tokens").alias("_total"), F.min("doc_id").alias("_least"))
    # by what they hold: names of numbered files don't sort by number for ever
    order = Window.orderBy(F.asc_nulls_first("_least"), "file")
    before = files.select(
        F.col("file").alias("_file"), (F.sum("_total").over(order) - F.col("_total")).alias("_before")
    )
    sums = digests.withColumn("_sum", F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    return sums.join(before, F.col("file") == F.col("_file")).select(
        "doc_id",
        (F.col("_before") + F.col("_sum") - F.col("n_tokens")).alias("start"),
        "n_tokens",
        "ids_crc32",
        "file",
    )
