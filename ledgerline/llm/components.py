"""Connected components of a link table, by Spark joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerline.llm.common import drop_path
from ledgerline.session import fresh_path


def _grouped(edges: DataFrame) -> DataFrame:
    """node -> smallest of its neighbours and itself."""
    return edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))


def components(links: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) for every node of a link.

    ``links``: columns a, b (long). Large-star and small-star steps alternate until
    nothing changes: each node points its larger, then its smaller neighbours to
    the smallest one. Rounds grow with the logarithm of the longest chain. Every
    step is a grouped minimum, combined before the shuffle, joined back to the
    links; each round is written to the shared folder and the one before removed.
    Whether a link changed is all that reaches the driver.
    """
    spark = links.sparkSession
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"),
                                          F.least("a", "b").alias("b")).distinct()
    path = fresh_path(spark, "links")
    edges.write.parquet(path)
    while True:
        now = spark.read.schema("a long, b long").parquet(path)
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Large star: every larger neighbour of a node links to the node's smallest.
        large = (both.join(_grouped(both), "a").filter("b > a")
                 .select(F.col("b").alias("a"), F.col("least").alias("b")).distinct())
        # Small star: a node and its smaller neighbours link to the smallest.
        low = large.groupBy("a").agg(F.min("b").alias("least"))
        small = (large.join(low, "a")
                 .select(F.explode(F.array(F.struct("a", F.col("least").alias("b")),
                                           F.struct(F.col("b").alias("a"),
                                                    F.col("least").alias("b")))).alias("e"))
                 .select("e.a", "e.b").filter("a <> b").distinct())
        after = fresh_path(spark, "links")
        small.write.parquet(after)
        following = spark.read.schema("a long, b long").parquet(after)
        still = (following.join(now, ["a", "b"], "left_anti").isEmpty()
                 and now.join(following, ["a", "b"], "left_anti").isEmpty())
        drop_path(spark, path)
        path = after
        if still:
            roots = following.select(F.col("b").alias("node"), F.col("b").alias("component"))
            return following.select(F.col("a").alias("node"), F.col("b").alias("component")) \
                .unionByName(roots.distinct())
