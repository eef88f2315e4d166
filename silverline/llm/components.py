"""Connected components of a graph given as rows of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import checkpointed


def components(links: DataFrame) -> DataFrame:
    """Rows ``(node, component)`` for the nodes of links ``(a, b)``: the smallest node reachable.

    Each round a node takes the smallest label among its neighbours' and then the label of that label, until no label
    changes; labels spread in doubling steps. A node with very many links is one key of joins, which Spark splits, and
    of aggregates, which are partial before the shuffle.
    """
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = checkpointed(links.where("a <> b").select(F.inline(ways)).distinct())
    labels = checkpointed(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")))
    while True:
        of = labels.select(F.col("a").alias("b"), F.col("label").alias("near"))
        around = both.join(of, "b").groupBy("a").agg(F.min("near").alias("near"))
        lower = labels.join(around, "a").withColumn("low", F.least("label", "near"))
        jump = labels.select(F.col("a").alias("low"), F.col("label").alias("next"))
        stepped = lower.join(jump, "low").select("a", F.least("low", "next").alias("label"), (F.least("low", "next") < F.col("label")).alias("moved"))
        stepped = checkpointed(stepped)
        labels = stepped.select("a", "label")
        if not stepped.where("moved").limit(1).count():
            return labels.select(F.col("a").alias("node"), F.col("label").alias("component"))
