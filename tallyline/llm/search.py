"""Exact top-k by inner product: postings scattered into dense score arrays.

Vectors become sparse integer rows, ``floor(scale * x)``.  Candidates are cut into
chunks and queries into blocks; every (block, chunk) pair meets in one task.  There
the chunk's postings (dimension to rows and weights) are gone through one term at a
time, each query with that term adding its weighted postings to its score array.
The k best of a pair are selected by partition, and the winners of all chunks are
merged per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RESULT = "query_id long, nth int, copies long, vec_id long, nameless boolean, score long"


def usable_vectors(vectors: DataFrame, scale: int = 256, nameless: bool = False) -> DataFrame:
    """``vec_id`` and integer ``terms``; rows that can't take part are left out.

    Null vectors and vectors with a null or non-finite component take no part, null ids
    only with ``nameless``.  An empty vector takes part and scores 0.  Vectors of different
    lengths agree in the dimensions they share; a missing one counts as 0.
    """
    kept = vectors.select(
        F.col("vec_id").cast("long"),
        F.expr("transform(embedding, x -> cast(x as double))").alias("_x"),
    ).where(
        f"(vec_id is not null or {nameless}) and _x is not null and "
        "forall(_x, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
    )
    return kept.select("vec_id", F.expr(f"transform(_x, x -> cast(floor({scale} * x) as long))").alias("terms"))


def _matrix(terms: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(terms), width), np.int64)
    for i, t in enumerate(terms):
        out[i, : len(t)] = t
    return out


def best_of(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of one dense score array, ties to the smaller id, without ``own``."""
    at = _best_among(np.flatnonzero(ids != own), scores, ids, k)
    return ids[at], scores[at]


def _best_among(others: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of ``others``, ties to the smaller id."""
    if not len(others):
        return others
    take = min(k, len(others))
    least = np.partition(scores[others], len(others) - take)[len(others) - take]
    at = others[scores[others] >= least]
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def accumulate(queries: np.ndarray, chunk: np.ndarray) -> np.ndarray:
    """Dense scores of some queries against a chunk, one term at a time."""
    scores = np.zeros((len(queries), len(chunk)), np.int64)
    for term in range(min(queries.shape[1], chunk.shape[1])):
        rows = np.flatnonzero(chunk[:, term])
        asking = np.flatnonzero(queries[:, term])
        if len(rows) and len(asking):
            part = np.multiply.outer(queries[asking, term], chunk[rows, term])
            if len(rows) == len(chunk) and len(asking) == len(queries):
                scores += part
            else:
                scores[np.ix_(asking, rows)] += part
    return scores


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    chunk_rows: int = 4096,
    block_rows: int = 1024,
    rows_at_a_time: int = 128,
    each_row: bool = False,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: each query's k best vectors.

    Both inputs come from ``usable_vectors``.  Ties go to the smaller ``vec_id``, null ids
    last; queries with fewer candidates get all.  Candidates that share an id each count for
    themselves.

    A query stands for its id: no row of that id is its candidate, and of queries that share
    one the smallest vector by its terms is asked.  With ``each_row`` every query row is
    asked and only that row is left out, so equal rows are each other's candidates and an
    id that repeats has its ranks once per row.

    Chunks and blocks are hash groups of the rows, so their sizes are even and
    bounded whatever the vectors hold; each block goes to every chunk once, the least a
    search without an index can move.  Equal query rows are asked once.
    """
    spark = vectors.sparkSession
    queries = queries.where("vec_id is not null")
    if each_row:
        queries = queries.groupBy("vec_id", "terms").agg(F.count(F.lit(1)).alias("copies"))
        queries = queries.withColumn("nth", F.row_number().over(Window.partitionBy("vec_id").orderBy("terms")))
    else:
        queries = queries.groupBy("vec_id").agg(F.min("terms").alias("terms"))
        queries = queries.withColumns({"copies": F.lit(1).cast("long"), "nth": F.lit(1)})
    n, asked = vectors.count(), queries.count()
    chunks, blocks = max(1, -(-n // chunk_rows)), max(1, -(-asked // block_rows))
    # equal rows meet in one chunk
    side = "pmod(xxhash64(vec_id, terms), {}) as {}"
    left = queries.selectExpr("vec_id", "nth", "copies", "terms", side.format(blocks, "block")).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    )
    # pandas would turn ids beside nulls into floats
    last = "coalesce(vec_id, 9223372036854775807) as vec_id"
    right = vectors.selectExpr(last, "vec_id is null as nameless", "terms", side.format(chunks, "chunk")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )

    def others(own: int, terms: np.ndarray, ids: np.ndarray, held: pd.DataFrame) -> np.ndarray:
        """Places of a query's candidates."""
        mine = (ids == own) & ~held["nameless"].to_numpy(bool)
        if each_row:
            same = (i for i in np.flatnonzero(mine) if np.array_equal(held["terms"].iloc[i], terms))
            mine = np.arange(len(ids)) == next(same, -1)
        return np.flatnonzero(~mine)

    def score(asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        found: list[pd.DataFrame] = []
        if len(asking) and len(held):
            width = max(map(len, held["terms"]), default=0)
            wide = max(map(len, asking["terms"]), default=0)
            chunk, ids = _matrix(held["terms"], width), held["vec_id"].to_numpy()
            for start in range(0, len(asking), rows_at_a_time):
                some = asking.iloc[start : start + rows_at_a_time]
                scores = accumulate(_matrix(some["terms"], wide), chunk)
                for query, row in zip(some.itertuples(), scores, strict=True):
                    at = _best_among(others(query.vec_id, query.terms, ids, held), row, ids, k)
                    best = {"vec_id": ids[at], "nameless": held["nameless"].to_numpy(bool)[at], "score": row[at]}
                    own = {"query_id": query.vec_id, "nth": query.nth, "copies": query.copies}
                    found.append(pd.DataFrame({**own, **best}))
        if not found:
            return pd.DataFrame({c.split()[0]: pd.Series(dtype="int64") for c in RESULT.split(", ")})
        return pd.concat(found)

    pairs = spark.createDataFrame([], RESULT)
    if asked and n:
        keys = ["block", "chunk"]
        pairs = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(score, RESULT)
    order = Window.partitionBy("query_id", "nth").orderBy(F.desc("score"), "nameless", "vec_id")
    best = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    if each_row:
        best = best.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return best.select("query_id", "rank", F.when(~F.col("nameless"), F.col("vec_id")).alias("vec_id"), "score")
