"""Connected components of an edge table, by alternating large and small stars.

Every round replaces edges by edges to smaller nodes and is written to the shared folder, so lineage stays short.
Nothing is collected; a test for emptiness tells when every component is a star around its smallest node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanspark.operators.tables import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node with an edge; ``edges`` has a and b of one sortable type."""
    edges = edges.select("a", "b")
    while True:
        for star in (_large_star, _small_star):
            edges = star(edges).filter("a != b").distinct()
        edges = materialize(edges, "components")
        # Done when every node points to one other node, and that one to none.
        down = edges.groupBy("a").count().select("a", "count")
        inner = edges.select(F.col("b").alias("a")).distinct().withColumn("inner", F.lit(True))
        if down.join(inner, "a", "left").filter("count > 1 OR inner").isEmpty():
            break
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
