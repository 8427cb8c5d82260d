"""Connected components by alternating large-star and small-star steps.

Each step is a map-side-combined minimum per node and one join, so a node with
very many links is never gathered; Spark splits it as a skewed join. Every
round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
                 .first())


def connected(edges: DataFrame) -> DataFrame:
    """Rows node, root (the component's smallest node) for each node of ``edges(a, b)``."""
    a, b = F.least("a", "b"), F.greatest("a", "b")
    e = materialize(edges.where("a <> b").select(a.alias("a"), b.alias("b")).distinct(), "cc")
    seen = _state(e)
    while seen[0]:
        # Large star: each node points its larger neighbours to its smallest neighbour.
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")) \
            .select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, F.col("a") == F.col("u")) \
            .select(F.col("m").alias("a"), "b").distinct()
        # Small star: each node and its smaller neighbours point to the smallest of them.
        least = large.groupBy("b").agg(F.min("a").alias("m")).withColumnRenamed("b", "u")
        small = large.join(least, F.col("b") == F.col("u")).select(
            F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("a").alias("b")),
                              F.struct(F.col("m").alias("a"), F.col("b").alias("b")))).alias("s"))
        e = materialize(small.select("s.a", "s.b").where("a < b").distinct(), "cc")
        now = _state(e)
        if now == seen:
            break
        seen = now
    # Stars now: every node but the roots has one edge, to its root.
    rooted = e.groupBy("b").agg(F.min("a").alias("root")).select(F.col("b").alias("node"), "root")
    return rooted.unionByName(e.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
