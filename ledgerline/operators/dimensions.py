"""Warehouse dimensions: SCD2 company (W1), insert-only dims (W2), keys (W3),
calendar (W6), metric (W7) and statement-label (W8) dimensions.

Parquet has no MERGE; every operator returns the rows of the next snapshot (or
the delta to append) as a DataFrame. Writing it to a new version is the sink's
job (``sources.sinks``), so a table is never overwritten while being read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (
    STATEMENT_DEFAULT,
    STATEMENT_NAMES,
    batch_timestamp,
    code_label,
    date_key,
    iso_date,
    open_end,
    optional_column,
)
from ..functions.keys import surrogate_key
from .dedup import distinct_values, keep_first

CHANGE_KINDS = ("new", "changed", "same", "vanished")


# --- W1: SCD type 2 -----------------------------------------------------------
def _changed(tracked: Sequence[str]) -> Column:
    """Null-safe 'any tracked column differs', compared as text."""
    diffs = [~F.col(f"t.{c}").cast("string").eqNullSafe(F.col(f"s.{c}").cast("string"))
             for c in tracked]
    out = diffs[0]
    for d in diffs[1:]:
        out = out | d
    return out


def _classified(dim: DataFrame, incoming: DataFrame, key: str,
                tracked: Sequence[str]) -> DataFrame:
    """Current versions full-outer-joined with the incoming rows, one row per key."""
    cur = dim.filter("is_current").select("id", key, *tracked, "valid_from")
    src = incoming.select(key, *tracked)
    j = cur.alias("t").join(src.alias("s"), F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    kind = (F.when(F.col(f"t.{key}").isNull(), "new")
            .when(F.col(f"s.{key}").isNull(), "vanished")
            .when(_changed(tracked), "changed")
            .otherwise("same"))
    return j.select(F.coalesce(F.col(f"s.{key}"), F.col(f"t.{key}")).alias(key),
                    kind.alias("change_kind"), "t.id", "t.valid_from",
                    *[F.col(f"t.{c}").alias(f"old_{c}") for c in tracked],
                    *[F.col(f"s.{c}").alias(f"new_{c}") for c in tracked])


def scd2_classify(dim: DataFrame, incoming: DataFrame, key: str = "cik",
                  tracked: Sequence[str] = ("name", "sic")) -> DataFrame:
    """(key, change_kind) for every key in the dimension or the incoming rows.

    ``incoming`` must hold one row per key (dedup with ``keep_first``).
    """
    return _classified(dim, incoming, key, tracked).select(key, "change_kind")


def scd2_changes(dim: DataFrame, incoming: DataFrame, batch_ts: str, key: str = "cik",
                 tracked: Sequence[str] = ("name", "sic")) -> tuple[DataFrame, DataFrame]:
    """(next current versions, versions expired by this batch).

    new -> a current version; changed -> the current version is expired at
    ``batch_ts`` and a new current version starts there; same and vanished
    -> untouched. One full outer join on the key classifies every key; each
    joined row emits its versions, so there is no branching or caching.
    Historical (already expired) rows are not read.
    """
    ts = batch_timestamp(batch_ts)
    c = _classified(dim, incoming, key, tracked)
    old_current = F.struct(
        F.col("id"), F.col(key), *[F.col(f"old_{x}").alias(x) for x in tracked],
        F.col("valid_from"), open_end().alias("valid_to"), F.lit(True).alias("is_current"))
    old_expired = F.struct(
        F.col("id"), F.col(key), *[F.col(f"old_{x}").alias(x) for x in tracked],
        F.col("valid_from"), ts.alias("valid_to"), F.lit(False).alias("is_current"))
    # Two versions of a key need two instants: else they share an id, and the older
    # one ends before it begins. Such a batch fails here, before anything is marked.
    begins = F.when(F.col("valid_from") >= ts, F.raise_error(F.concat(
        F.lit(f"batch time {batch_ts} is not later than the current version of {key} "),
        F.col(key).cast("string"))).cast("timestamp")).otherwise(ts)
    new = F.struct(
        surrogate_key(F.col(key), ts).alias("id"), F.col(key),
        *[F.col(f"new_{x}").alias(x) for x in tracked],
        begins.alias("valid_from"), open_end().alias("valid_to"), F.lit(True).alias("is_current"))
    kind = F.col("change_kind")
    current = c.select(F.inline(
        F.when(kind.isin("new", "changed"), F.array(new)).otherwise(F.array(old_current))))
    expired = c.filter(kind == "changed").select(F.inline(F.array(old_expired)))
    return current, expired


def scd2_merge(dim: DataFrame, incoming: DataFrame, batch_ts: str, key: str = "cik",
               tracked: Sequence[str] = ("name", "sic")) -> DataFrame:
    """Next full snapshot of a type-2 dimension after applying ``incoming``:
    history passes through, plus the next current versions and those just expired."""
    current, expired = scd2_changes(dim, incoming, batch_ts, key, tracked)
    history = dim.filter(~F.col("is_current")).select(
        "id", key, *tracked, "valid_from", "valid_to", "is_current")
    return history.unionByName(current).unionByName(expired)


def scd2_initial(incoming: DataFrame, valid_from: str, key: str = "cik",
                 tracked: Sequence[str] = ("name", "sic")) -> DataFrame:
    """First load: every incoming row becomes a current version."""
    ts = batch_timestamp(valid_from)
    return incoming.select(
        surrogate_key(F.col(key), ts).alias("id"), key, *tracked,
        ts.alias("valid_from"), open_end().alias("valid_to"), F.lit(True).alias("is_current"))


def company_source(sub: DataFrame, order_by: Sequence[str] = ("adsh",)) -> DataFrame:
    """One row per cik from the filings (keep-first by filing key, then by the values
    themselves, so a repeated filing key can't make a false change), cik as text."""
    rows = sub.select(F.col("cik").cast("string").alias("cik"), "name",
                      F.col("sic").cast("string").alias("sic"), *order_by)
    return keep_first(rows.filter(F.col("cik").isNotNull()), ["cik"],
                      [*order_by, "name", "sic"]).select("cik", "name", "sic")


# --- W2: insert-only dimensions -------------------------------------------------
def insert_only(existing: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Rows of ``source`` whose key is not yet in ``existing``, with their ids.

    ``source`` holds one row per key. Rerunning with the appended rows in
    ``existing`` yields an empty delta.
    """
    delta = source.join(existing.select(key), key, "left_anti")
    return delta.select(surrogate_key(key).alias("id"), *source.columns)


def append_rows(existing: DataFrame, delta: DataFrame) -> DataFrame:
    return existing.unionByName(delta.select(*existing.columns))


def filing_source(sub: DataFrame, order_by: Sequence[str] = ("form", "cik")) -> DataFrame:
    rows = keep_first(sub.filter(F.col("adsh").isNotNull()), ["adsh"], list(order_by))
    return rows.select(
        F.col("adsh").alias("accession_number"), F.col("form").alias("form_type"),
        F.lit(None).cast("string").alias("period_of_report"),
        F.lit(None).cast("string").alias("date_filed"))


def tag_source(tag: DataFrame) -> DataFrame:
    """One row per tag name, the first by tag_id (live key: tag alone)."""
    rows = keep_first(tag.filter(F.col("tag").isNotNull()), ["tag"],
                      ["tag_id", "version", "custom", "label"])
    return rows.select("tag", "version", "custom", "label")


def date_source(num: DataFrame, col: str = "ddate") -> DataFrame:
    return distinct_values(num.select(date_key(col).alias("date_key")), "date_key",
                           drop_null=True)


def statement_source(pre: DataFrame, labels: Mapping[str, str] = STATEMENT_NAMES,
                     default: str = STATEMENT_DEFAULT) -> DataFrame:
    codes = distinct_values(pre.select(F.col("stmt").alias("statement_code")),
                            "statement_code", drop_null=True)
    return codes.withColumn("statement_name", code_label("statement_code", labels, default))


# --- W6-W8: legacy-shaped dimensions -------------------------------------------
def calendar(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """One row per day between the ``start`` and ``end`` dates of each bounds row."""
    days = bounds.select(F.explode(F.sequence(F.to_date(start), F.to_date(end),
                                              F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(
        iso_date("d").alias("date"), F.year("d").alias("year"), F.month("d").alias("month"),
        F.dayofmonth("d").alias("day"), F.quarter("d").alias("quarter"),
        F.lit(None).cast("int").alias("fiscal_year"))


def calendar_range(spark, start: str = "2005-01-01", end: str = "2025-12-31") -> DataFrame:
    """Calendar over a literal range (the reference default is 2005-01-01..2025-12-31)."""
    return calendar(spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end")))


def calendar_from(df: DataFrame, col: str) -> DataFrame:
    """Calendar spanning the dates found in ``df[col]`` (min..max, one aggregate)."""
    return calendar(df.agg(F.min(col).alias("start"), F.max(col).alias("end")))


def metric_dim(tag: DataFrame, optional: Sequence[str] = ("tlabel", "datatype", "iord")) -> DataFrame:
    """Keep-first by (tag, version); optional columns are null when absent."""
    order = ["tag_id"] if "tag_id" in tag.columns else []
    rows = keep_first(tag, ["tag", "version"],
                      [*order, *[c for c in tag.columns if c not in ("tag", "version", "tag_id")]]
                      or ["tag"])
    return rows.select("tag", "version", *[optional_column(rows, c) for c in optional])


def statement_label_dim(pre: DataFrame) -> DataFrame:
    """Keep-first by (stmt, plabel); rows without a statement code dropped (P10)."""
    rows = pre.select("stmt", "plabel").dropDuplicates(["stmt", "plabel"])
    return rows.dropna(subset=["stmt"])
