"""The corpus pipeline: stages in order, each on all its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyline.llm import stages
from tallyline.sinks.workspace import scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Each takes (spark, docs, sf_dir); its result is stored and is the next one's docs.
STAGES: list[tuple[str, Stage]] = [
    ("language_id", stages.known_language),
    ("ngram_jaccard", stages.one_of_alike),
    ("decontamination", stages.without_leaks),
    ("personal_data", stages.redacted),
    ("best_fit_packing", stages.packed),
]

#: A trained network and a tokenizer can't be said in SQL; tests hold each stage and the
#: whole against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = scratch_dir(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        folder = f"{base}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
