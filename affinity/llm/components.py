"""Connected components of an edge table by contraction, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges`` (a, b): comp is the smallest node
    reachable.

    Each round every label takes over its smallest neighbour's, twice followed
    further, and edges are rewritten to labels; those within one label go. So the
    edges shrink from round to round, stars at once and chains to a quarter.
    All tables are written; none passes through the driver.
    """
    live = stored(_between(edges.select("a", "b")), "cc-edges")
    labels = stored(live.select(F.col("a").alias("node")).union(live.select("b")).distinct().withColumn("comp", F.col("node")), "cc")
    while not live.isEmpty():
        up = live.groupBy(F.col("b").alias("n")).agg(F.min("a").alias("up"))
        for _ in range(2):
            up = stored(up, "cc-up")
            further = up.select(F.col("n").alias("m"), F.col("up").alias("further"))
            up = up.join(further, F.col("up") == F.col("m"), "left").select("n", F.coalesce("further", "up").alias("up"))
        up = stored(up, "cc-up")
        labels = stored(labels.join(up, F.col("comp") == F.col("n"), "left").select(
            "node", F.coalesce("up", "comp").alias("comp")), "cc")
        for side in ("a", "b"):
            live = live.join(up, F.col(side) == F.col("n"), "left").withColumn(side, F.coalesce("up", side)).select("a", "b")
        live = stored(_between(live), "cc-edges")
    return labels


def _between(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()
