"""Keep-first dedup and distinct values (A2, A3, A4).

"First" is made explicit by an ordering; Spark has no file order. The rank
filter lets the optimizer insert a per-partition group limit before the
shuffle, so a key holding a large share of the rows ships at most one row per
map partition instead of all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first by ``order_by``, which must settle every tie."""
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def distinct_values(df: DataFrame, *cols: str, drop_null: bool = False) -> DataFrame:
    out = df.select(*cols).distinct()
    return out.dropna(subset=list(cols)) if drop_null else out
