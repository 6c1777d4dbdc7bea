"""Record-level changes to the raw submissions table, as batch change sets (M1-M5).

The reference handles one record per HTTP call and rewrites the whole file; a
Spark user applies a DataFrame of changes in one pass. Every operator returns
the next version of the table (to be written to a new path, never over the
one being read) plus the rows it could not apply.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CHANGE_FIELDS
from .dedup import keep_first

KEY = "adsh"


@dataclass
class CreateResult:
    table: DataFrame
    accepted: DataFrame
    conflicts: DataFrame


def create_conflicts(raw: DataFrame, batch: DataFrame, key: str = KEY) -> DataFrame:
    """(key, reason): keys already in the table, and keys repeated inside the batch."""
    exists = (batch.select(key).join(raw.select(key), key, "left_semi")
              .withColumn("reason", F.lit("exists")))
    repeated = (batch.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
                .select(key, F.lit("duplicate_in_batch").alias("reason")))
    return exists.unionByName(repeated)


def create_rows(raw: DataFrame, batch: DataFrame, key: str = KEY,
                all_or_nothing: bool = False) -> CreateResult:
    """M1: append the batch. Row-level by default: conflicting keys are held back.

    ``all_or_nothing`` follows the reference: any conflict leaves the table as
    it was (one emptiness probe, J13).
    """
    conflicts = create_conflicts(raw, batch, key)
    accepted = batch.join(conflicts.select(key), key, "left_anti")
    if all_or_nothing and not conflicts.isEmpty():
        return CreateResult(raw, accepted.limit(0), conflicts)
    table = raw.unionByName(accepted.select(*raw.columns), allowMissingColumns=True)
    return CreateResult(table, accepted, conflicts)


def list_page(raw: DataFrame, skip: int = 0, limit: int = 100, order_by: Sequence[str] = (KEY,)
              ) -> DataFrame:
    """M2: one page in key order (defaults 0, 100)."""
    return raw.orderBy(*order_by).offset(skip).limit(limit)


def get_rows(raw: DataFrame, keys: DataFrame, key: str = KEY,
             order_by: Sequence[str] | None = None) -> DataFrame:
    """M3: for each requested key, the first matching row (or found = false)."""
    first = keep_first(raw, [key], list(order_by or raw.columns))
    hit = first.withColumn("found", F.lit(True))
    out = keys.select(key).distinct().join(hit, key, "left")
    return out.withColumn("found", F.coalesce("found", F.lit(False)))


def merge_updates(updates: DataFrame, order_col: str, key: str = KEY,
                  fields: Sequence[str] = CHANGE_FIELDS,
                  set_col: str = "set_fields") -> DataFrame:
    """One update per key, field by field: a field's value is the one that was set last.

    As if the updates had been applied one after the other by ``order_col``. Equal
    orders are settled by the value, so the result never depends on row order. A
    grouped maximum per field: combined before the shuffle, whatever a key's share.
    """
    def last(field: str) -> tuple[Column, Column]:
        is_set = F.array_contains(F.col(set_col), F.lit(field))
        at = F.when(is_set, F.struct(F.col(order_col).alias("at"), F.col(field).alias("v")))
        return F.max(at)["v"].alias(field), F.max(F.coalesce(is_set, F.lit(False))).alias(
            f"_set_{field}")

    merged = updates.groupBy(key).agg(*[c for f in fields for c in last(f)])
    set_now = F.filter(F.array(*[F.when(F.col(f"_set_{f}"), F.lit(f)) for f in fields]),
                       lambda f: f.isNotNull())
    return merged.select(key, *fields, set_now.alias(set_col))


def apply_updates(raw: DataFrame, updates: DataFrame, key: str = KEY,
                  fields: Sequence[str] = CHANGE_FIELDS, set_col: str = "set_fields",
                  order_col: str = "update_no") -> tuple[DataFrame, DataFrame]:
    """M4: partial updates. ``updates`` holds the key, new values, an
    ``array<string>`` of the fields actually set (so "set to null" differs from "not
    set") and the order in which they were made. Updates of one key are merged in
    that order, none is lost, and a repeated key never multiplies table rows.

    The key must be unique in ``raw`` (check with ``quality.duplicate_keys``); all
    rows of a repeated key would be updated.

    Returns (next table, update keys not found).
    """
    if order_col not in updates.columns:
        raise ValueError(f"updates need an order column {order_col!r}")
    updates = merge_updates(updates, order_col, key, fields, set_col)
    upd = updates.select(key, set_col, *[F.col(f).alias(f"_new_{f}") for f in fields])
    joined = raw.join(upd, key, "left")
    out_cols = []
    for c in raw.columns:
        if c in fields:
            is_set = F.coalesce(F.array_contains(F.col(set_col), F.lit(c)), F.lit(False))
            out_cols.append(F.when(is_set, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out_cols.append(F.col(c))
    not_found = updates.select(key).join(raw.select(key), key, "left_anti")
    return joined.select(*out_cols), not_found


def delete_rows(raw: DataFrame, keys: DataFrame, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """M5: remove every row whose key is listed (rows with a null key stay).

    Returns (next table, keys not found) - the A8 outcome.
    """
    k = keys.select(key).dropna().distinct()
    table = raw.join(k, key, "left_anti")
    not_found = k.join(raw.select(key), key, "left_anti")
    return table, not_found
