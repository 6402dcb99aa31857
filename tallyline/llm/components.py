"""Connected components of a link table, by smallest label and shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.sinks.workspace import scratch_dir


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (smallest node reachable) for links ``a``, ``b``.

    Every round takes the smallest label among a node and its neighbours and then the
    label of that label, so long chains shrink by more than half a round.  Minima combine
    in the map tasks, so a node with very many links is no hot spot.  Each round's labels
    are a table in the shared folder.  Nodes without links are not in the result.
    """
    spark = links.sparkSession
    base = scratch_dir(spark, "components")
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both.where("a != b").distinct().write.parquet(f"{base}/links")
    both = spark.read.parquet(f"{base}/links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_m"))
    labels = labels.select("node", F.least("node", "_m").alias("component"))
    turn = 0
    while True:
        folder = f"{base}/labels-{turn}"
        labels.write.parquet(folder)
        labels = spark.read.parquet(folder)
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("_near"))
        )
        if near.join(labels, "node").where("_near < component").isEmpty():
            return labels
        lower = labels.join(near, "node").select("node", F.least("component", "_near").alias("_to"))
        jump = labels.select(F.col("node").alias("_to"), F.col("component").alias("_further"))
        labels = lower.join(jump, "_to", "left").select(
            "node", F.least("_to", F.coalesce("_further", "_to")).alias("component")
        )
        turn += 1
