"""Pipeline stages: (spark, docs, sf_dir) to the rows that go on.

All but the last return the columns of their input.  Rows with a null ``doc_id`` are
kept by every filter but the first, which judges the text alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import decontaminate, jaccard, language_id, packing, personal_data
from tallyline.llm.tokens import tokenizer_path

#: Documents the language network doesn't learn from.
LANGUAGE_FOLD = "pmod(crc32(cast(doc_id as string)), 4) = 2"


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without letters and those no language fits; without labels, nothing."""
    judge = language_id.learn_to_judge(docs, LANGUAGE_FOLD)
    if judge is None:
        return docs
    columns = docs.columns
    clash = {"lang_pred", "score"} & set(columns)
    held = docs.withColumnsRenamed({c: f"_own_{c}" for c in clash})
    kept = judge.identify(held).where(judge.fits(F.col("text").cast("string")))
    return kept.drop("lang_pred", "score").withColumnsRenamed({f"_own_{c}": c for c in clash}).select(*columns)


def one_of_alike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of linked documents the one with the smallest ``doc_id``.

    Rows that repeat a ``doc_id`` and its text are one document and stay or go together.
    """
    groups = jaccard.similar_documents(docs, 4, 85)
    gone = groups.where("component_id < doc_id").select("doc_id", "_c").distinct()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    mine = F.expr("cast(crc32(_text) - 2147483648 as int)")
    held = docs.withColumn("_text", text).withColumn("_c", mine).drop("_text")
    return held.join(gone, ["doc_id", "_c"], "left_anti").select(*docs.columns)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark passage."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; every document stays."""
    return personal_data.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of all that is left; returns its pieces and their places."""
    return packing.packed_documents(docs, tokenizer_path("byte_bpe_50k.json"), 1024, 2)
