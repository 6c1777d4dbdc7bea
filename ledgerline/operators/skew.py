"""Joins on hot keys (J4, J6) that don't rely on AQE, and joins without a shuffle.

``salted_join`` finds the heavy keys of the large side by a frequent-items sketch, which
tasks build and merge, so no key's rows are gathered to count them. Rows of a heavy key are
dealt out over as many salts as it has shares of ``rows_per_task`` rows; the
other side's rows of that key are copied once per salt. All other rows have one salt.

``bucketed`` stores a table in buckets sorted by its key. Tables of as many buckets of one
key join bucket by bucket: the shuffle is paid once, when they are published.

Defined results: those of an inner or left join; null keys never match and, in a left join,
are dealt out by their rows; an empty side gives what the join gives. A key missed by
the sketch is only not salted. Rows that are equal in all columns share a salt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Frequent items that a sketch tracks, and heavy keys that it may name (bounds the broadcast).
TRACKED = 4096
HEAVY = 1000
ROWS_PER_TASK = 1_000_000


def heavy_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(key, salts) of at most ``HEAVY`` keys with more than ``rows_per_task`` rows."""
    top = df.filter(F.col(key).isNotNull()).agg(F.call_function(
        "approx_top_k", F.col(key), F.lit(HEAVY), F.lit(TRACKED)).alias("top"))
    return top.select(F.explode("top").alias("t")).filter(F.col("t.count") > rows_per_task).select(
        F.col("t.item").alias(key),
        F.ceil(F.col("t.count") / rows_per_task).cast("int").alias("salts"))


def salted_join(large: DataFrame, other: DataFrame, key: str, how: str = "inner",
                rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``large`` joined to ``other`` on ``key``, heavy keys spread over salts."""
    if how not in ("inner", "left"):
        raise ValueError("only inner and left joins: the other side's rows are copied")
    heavy = F.broadcast(heavy_keys(large, key, rows_per_task))  # at most HEAVY rows
    salts = F.coalesce("salts", F.lit(1))
    left = large.join(heavy, key, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in large.columns]), salts)).drop("salts")
    if how == "left":  # rows without a key match nothing; they are spread by their own hash
        left = left.withColumn("_salt", F.when(F.col(key).isNull(), F.xxhash64(
            *[F.col(f"`{c}`") for c in large.columns])).otherwise(F.col("_salt")))
    right = other.join(heavy, key, "left").withColumn("_salt", F.explode(
        F.sequence(F.lit(0).cast("long"), (salts - 1).cast("long")))).drop("salts")
    return left.join(right, [key, "_salt"], how).drop("_salt")


def bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """``df`` stored under ``path`` as table ``name`` in sorted buckets of ``key``."""
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
     .option("path", path).mode("errorifexists").saveAsTable(name))
    return df.sparkSession.table(name)


def drop_tables(spark, names: Sequence[str]) -> None:
    """Forget stored tables; their files stay until their folder is dropped."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")
