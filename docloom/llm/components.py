"""Connected components of links that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from docloom.session import stage


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``comp``, the smallest node that it reaches, for every node of ``links`` (columns a, b).

    Each round takes the smallest label among neighbours and then the label of that label, so long chains need a
    number of rounds that grows with the logarithm of their length. Every round is a written table. Only sums of one
    number reach the driver. A node in a third of all links is met by joins whose sides are plain exchanges, which
    Spark splits, and by partial minima. No links give no rows.
    """
    edges = stage(
        links.select(F.col("a").alias("u"), F.col("b").alias("v"))
        .union(links.select(F.col("b").alias("u"), F.col("a").alias("v"))).filter("u <> v").distinct(),
        "edges",
    )
    labels = stage(
        edges.groupBy(F.col("u").alias("node")).agg(F.least(F.col("u"), F.min("v")).alias("comp")), "labels"
    )
    while True:
        near = (
            edges.join(labels.select(F.col("node").alias("v"), "comp"), "v")
            .groupBy(F.col("u").alias("node")).agg(F.min("comp").alias("near"))
        )
        lower = stage(
            labels.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp")),
            "lower",
        )
        jump = lower.select(F.col("node").alias("comp"), F.col("comp").alias("further"))
        labels = stage(
            lower.join(jump, "comp", "left").select("node", "old", F.coalesce("further", "comp").alias("comp")), "labels"
        )
        if labels.filter("old <> comp").isEmpty():
            return labels.select("node", "comp")
        labels = labels.select("node", "comp")
