"""Constraint checks and load statistics.

Each check is one aggregate pass that returns a small report DataFrame; none
collects rows to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q1: key values occurring more than once, with their count ``n``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def null_counts(df: DataFrame, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Q2: (table_name, column_name, null_count, row_count), one aggregate pass."""
    cols = list(columns or df.columns)
    sums = [F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols]
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *sums)
    long = wide.unpivot("_rows", cols, "column_name", "null_count")
    return long.select(F.lit(table).alias("table_name"), "column_name",
                       F.coalesce("null_count", F.lit(0)).cast("long").alias("null_count"),
                       F.col("_rows").cast("long").alias("row_count"))


class CheckFailed(ValueError):
    """A constraint does not hold; nothing has been published."""


def require_unique(df: DataFrame, keys: Sequence[str], table: str) -> None:
    """Q1 as a gate: raises if a key occurs twice (one emptiness probe)."""
    bad = duplicate_keys(df, keys).first()
    if bad is not None:
        raise CheckFailed(f"{table}: {', '.join(f'{k}={bad[k]!r}' for k in keys)} "
                          f"occurs {bad['n']} times")


def require_not_null(df: DataFrame, columns: Sequence[str], table: str) -> None:
    """Q2 as a gate: raises if a column that must not be null is (one emptiness probe)."""
    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(c).isNull()
    if not df.filter(missing).isEmpty():
        raise CheckFailed(f"{table}: null in one of {', '.join(columns)}")


def require_no_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str, table: str) -> None:
    """Q3 as a gate: raises if a foreign key has no parent (distinct keys meet, not rows)."""
    keys = child.select(F.col(fk).alias("_fk")).distinct().dropna()
    if not keys.join(parent.select(F.col(pk).alias("_fk")), "_fk", "left_anti").isEmpty():
        raise CheckFailed(f"{table}.{fk}: a key without a parent row")


def orphans(child: DataFrame, fk: Sequence[str], parent: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Q3: child rows whose (non-null) foreign key has no parent row."""
    cond = [child[f] == parent[p] for f, p in zip(fk, pk)]
    keyed = child.dropna(subset=list(fk))
    return keyed.join(parent.select(*pk).distinct(), cond, "left_anti")


def orphan_report(checks: Sequence[tuple[str, DataFrame, Sequence[str], DataFrame, Sequence[str]]]
                  ) -> DataFrame:
    """One row per relation: (relation, orphan_rows, checked_rows).

    The child is reduced to its distinct key values with counts, one aggregate per
    relation and combined before the shuffle; only those meet the parent's keys, so
    neither side is shuffled by rows and a hot key is one row.
    """
    out = None
    for name, child, fk, parent, pk in checks:
        counted = child.dropna(subset=list(fk)).groupBy(*fk).agg(F.count(F.lit(1)).alias("_n"))
        parents = parent.select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(pk)]) \
            .distinct().withColumn("_hit", F.lit(True))
        cond = [counted[f] == parents[f"_p{i}"] for i, f in enumerate(fk)]
        row = counted.join(parents, cond, "left").agg(
            F.coalesce(F.sum(F.when(F.col("_hit").isNull(), F.col("_n")).otherwise(0)), F.lit(0))
            .cast("long").alias("orphan_rows"),
            F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("checked_rows"))
        row = row.select(F.lit(name).alias("relation"), "orphan_rows", "checked_rows")
        out = row if out is None else out.unionByName(row)
    return out


def vector_length(df: DataFrame, col: str = "embedding", dim: int = 64) -> Column:
    """V5: true when the vector has exactly ``dim`` entries."""
    return F.coalesce(F.size(col) == F.lit(dim), F.lit(False))


def import_outcome(df: DataFrame, valid: Column) -> DataFrame:
    """(valid, n) counts of a validity flag."""
    return df.select(valid.alias("valid")).groupBy("valid").agg(F.count(F.lit(1)).alias("n"))


def first_failures(df: DataFrame, valid: Column, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """A head sample of failing rows (a limit is the feature here)."""
    return df.filter(~valid).orderBy(*order_by).limit(n)


def load_stats(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """A5: row count observed while the DataFrame is written (no extra pass)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
