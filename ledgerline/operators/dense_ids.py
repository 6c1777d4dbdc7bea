"""Dense surrogate ids (W3): 1, 2, 3, ... in key order, continued from load to load.

New keys are range-partitioned and sorted, so each partition knows the place of its rows
among its own. The rows per partition, one number each, are added up to the ids at
which the partitions start. No window over all rows and no hash: the only shuffle
is the one by key range, and the driver sees as many numbers as there are partitions.

The hashed ids of ``functions.keys`` need no order between loads and stay the default; dense
ids suit stores that want small, gapless keys. Loads that number at the same time need
the warehouse's successor check (``sinks.Superseded``).

Defined results: keys already numbered keep their id; rows repeated by key count once; rows
with a null key (in any key column) get none and are left out; an empty load changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fresh_path

#: ``monotonically_increasing_id`` holds the partition above, the row below this bit.
ROW_BITS = 33


def next_id(existing: DataFrame, id_col: str = "id") -> int:
    """The id after the highest one of a store (1 for an empty one)."""
    return (existing.agg(F.max(id_col)).first()[0] or 0) + 1


def number(rows: DataFrame, key: Sequence[str], id_col: str = "id", start: int = 1,
           partitions: int | None = None) -> DataFrame:
    """``rows``, one per different ``key``, with ids from ``start`` on in key order.

    The key alone decides a row's id; other columns must follow from it."""
    spark = rows.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    once = rows.dropna(subset=list(key)).dropDuplicates(list(key))
    path = fresh_path(spark, "dense-ids")
    once.repartitionByRange(n, *key).sortWithinPartitions(*key) \
        .withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path)
    part = F.shiftright("_at", ROW_BITS)
    counts = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("n")).collect()}  # at most ``n`` rows
    first, offsets = start, []
    for p in sorted(counts):
        offsets.append((p, first))
        first += counts[p]
    starts = spark.createDataFrame(offsets, "_part long, _first long")
    return placed.join(starts, part == F.col("_part")).select(
        (F.col("_first") + F.col("_at").bitwiseAND((1 << ROW_BITS) - 1)).alias(id_col),
        *rows.columns)


def continue_ids(existing: DataFrame, incoming: DataFrame, key: Sequence[str],
                 id_col: str = "id", partitions: int | None = None) -> DataFrame:
    """The rows of ``incoming`` whose key the store lacks, numbered after its highest id."""
    new = incoming.join(existing.select(*key), list(key), "left_anti").select(*incoming.columns)
    return number(new, key, id_col, next_id(existing, id_col), partitions)
