"""Connected components of an edge table, by least labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pointferry.session import scratch_dir


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable from each node of the edges (a, b).

    Each round is written to the shared scratch folder, so no lineage grows and no round is lost
    with an executor. Labels are combined before they are shuffled.
    """
    spark = edges.sparkSession
    folder = scratch_dir(spark, "components")
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both.write.parquet(f"{folder}/edges")
    both = spark.read.schema("a long, b long").parquet(f"{folder}/edges")

    def stored(labels: DataFrame, round_: int) -> DataFrame:
        path = f"{folder}/labels-{round_}"
        labels.write.parquet(path)
        return spark.read.schema("node long, component long, changed boolean").parquet(path)

    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("component"), F.lit(True).alias("changed")), 0)
    round_ = 0
    while labels.where("changed").limit(1).count():
        round_ += 1
        known = labels.select("node", "component")
        near = both.join(known.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        lower = known.join(near, "node").select("node", "component", F.least("component", "near").alias("next"))
        jump = known.select(F.col("node").alias("next"), F.col("component").alias("jumped"))
        lower = lower.join(jump, "next").select("node", F.least("next", "jumped").alias("new"), "component")
        labels = stored(lower.select("node", F.col("new").alias("component"), (F.col("new") < F.col("component")).alias("changed")), round_)
    return labels.select("node", "component")
