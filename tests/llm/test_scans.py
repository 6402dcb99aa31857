"""Running values against plain loops, around the ends of blocks and of blocks of blocks."""

from __future__ import annotations

import random
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from tallyline.llm.scans import bound, running_max, running_sum


@pytest.mark.parametrize("length", [0, 1, 2, 63, 64, 65, 128, 4095, 4096, 4097, 300_000])
def test_running_values(spark, length):
    rng = random.Random(length)
    values = [rng.randrange(1_000) for _ in range(length)]
    df = spark.createDataFrame([(values,)], "v array<int>")
    [row] = df.select(running_sum(F.col("v")).alias("sums"), running_max(F.col("v")).alias("tops")).collect()
    assert row["sums"] == list(accumulate(values, initial=0))[:length]
    assert row["tops"] == list(accumulate(values, max, initial=0))[:length]


def test_bound_value(spark):
    [row] = spark.range(3).agg(F.max("id").alias("n")).select(bound(F.col("n") + 1, lambda n: n * n).alias("n")).collect()
    assert row["n"] == 9
