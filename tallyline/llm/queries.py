"""One registered query per operator, each over its whole table, and its SQL.

``REGISTRY`` maps a name to ``(callable(spark, sf_dir), sql or None)``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import (
    alignment,
    collocations,
    decontaminate,
    exact_dedup,
    html_text,
    jaccard,
    language_id,
    language_model,
    packing,
    personal_data,
    search,
    sql,
    substrings,
    token_files,
)
from tallyline.llm.tokens import tokenizer_path
from tallyline.sinks.workspace import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(table(spark, sf_dir, "documents"), 50)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(
        table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), 1024, 2
    )


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = "pmod(crc32(cast(doc_id as string)), 7) = 2"
    return language_model.held_out_scores(table(spark, sf_dir, "documents"), fold)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"), 4, 85).drop("_c")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted_pages(table(spark, sf_dir, "pages"))


#: Documents the language network must not learn from.
LANGUAGE_FOLD = "pmod(crc32(cast(doc_id as string)), 4) = 2"


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predicted_languages(table(spark, sf_dir, "documents"), LANGUAGE_FOLD)


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row with such an id is a query, every row but itself its candidate."""
    vectors = search.usable_vectors(table(spark, sf_dir, "embeddings"), 256, nameless=True)
    return search.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5, each_row=True)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(spark, "tokens")
    token_files.write_token_files(
        table(spark, sf_dir, "documents"), f"{base}/orc", tokenizer_path("word_bpe_49k.json"), 2
    )
    read = token_files.read_token_files(spark, f"{base}/orc")
    token_files.token_digests(read).write.parquet(f"{base}/digests")
    return token_files.token_starts(spark.read.parquet(f"{base}/digests")).drop("file")


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.personal_data(table(spark, sf_dir, "documents"))
    counts = [f"n_{k}" for k in personal_data.KINDS]
    return found.select("doc_id", *counts, F.sha2("base_list", 256).alias("base_sha256"), "spans")


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), 100, 2000)


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned_documents(
        table(spark, sf_dir, "documents"),
        tokenizer_path("byte_bpe_50k.json"),
        tokenizer_path("piece_bpe_32k.model"),
    )


REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_substring_dedup": (op1_substring_dedup, sql.SUBSTRING_DEDUP),
    "op2_best_fit_packing": (op2_best_fit_packing, None),
    "op3_lm_scoring": (op3_lm_scoring, None),
    "op4_decontamination": (op4_decontamination, sql.DECONTAMINATION),
    "op5_ngram_jaccard": (op5_ngram_jaccard, sql.NGRAM_JACCARD),
    "op6_html_extraction": (op6_html_extraction, None),
    "op7_language_id": (op7_language_id, None),
    "op8_exact_top_k": (op8_exact_top_k, sql.EXACT_TOP_K),
    "op9_token_files": (op9_token_files, None),
    "op10_personal_data": (op10_personal_data, None),
    "op11_exact_dedup": (op11_exact_dedup, sql.EXACT_DEDUP),
    "op12_collocations": (op12_collocations, sql.COLLOCATIONS),
    "op13_tokenizer_alignment": (op13_tokenizer_alignment, None),
}
