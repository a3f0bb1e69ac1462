"""Connected components of links, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def components(spark: SparkSession, links: DataFrame, folder: str) -> DataFrame:
    """node, component: the smallest node that each node of `links` (a long, b long) reaches.

    In each round a node takes the smallest label among its own and its neighbours', then the
    label of that label, so long chains halve. Every round is written to `folder`, which cuts
    the lineage; rounds end when no label changes. No links give no rows. A node with very many
    links is summed up before it is shuffled, and split as a skewed join.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both.write.option("compression", "zstd").parquet(f"{folder}/edges")
    both = spark.read.schema("a long, b long").parquet(f"{folder}/edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component"))
    turn = 0
    while True:
        path = f"{folder}/labels-{turn}"
        labels.withColumn("changed", F.lit(True) if turn == 0 else F.col("changed")).write.parquet(path)
        now = spark.read.schema("node long, component long, changed boolean").parquet(path)
        if turn and not now.where("changed").limit(1).count():
            return now.select("node", "component")
        now = now.select("node", "component")
        heard = (
            both.join(now.select(F.col("node").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("heard"))
        )
        least = now.join(heard, "node").select(
            "node", F.col("component").alias("before"), F.least("component", "heard").alias("label")
        )
        jump = now.select(F.col("node").alias("label"), F.col("component").alias("further"))
        labels = least.join(jump, "label").select(
            "node",
            F.least("label", "further").alias("component"),
            (F.least("label", "further") != F.col("before")).alias("changed"),
        )
        turn += 1
