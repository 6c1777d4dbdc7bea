"""Derived fixtures: "what the warehouse held before this run", built from the
driver's tables by date or attribute rules (no key sampling).

| fixture               | rule                                                           |
| existing companies    | customers with a filing dated before 1996-01-01; their sic is  |
|                       | 'OLD' where c_acctbal < 0, else c_mktsegment                    |
| incoming companies    | every customer                                                  |
| existing filings      | filings dated before 1998-01-01                                 |
| existing dates        | ship days before 1998-01-01                                     |
| raw table / new batch | filings dated before 1998-01-01 / dated from 1997-07-01 on      |
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import date_key
from ..operators.dimensions import filing_source, scd2_initial
from ..functions.keys import surrogate_key
from ..sources.tables import TableSet
from . import adapter

COMPANY_CUTOFF = "1996-01-01"
FILING_CUTOFF = "1998-01-01"
BATCH_START = "1997-07-01"
INITIAL_TS = "2024-01-01 00:00:00"
BATCH_TS = "2025-01-01 00:00:00"


def incoming_companies(t: TableSet) -> DataFrame:
    return t["customer"].select(F.col("c_custkey").cast("string").alias("cik"),
                                F.col("c_name").alias("name"),
                                F.col("c_mktsegment").alias("sic"))


def existing_companydim(t: TableSet) -> DataFrame:
    early = _orders_before(t, COMPANY_CUTOFF)
    cust = t["customer"].join(early, t["customer"].c_custkey == early.o_custkey, "left_semi")
    rows = cust.select(
        F.col("c_custkey").cast("string").alias("cik"), F.col("c_name").alias("name"),
        F.when(F.col("c_acctbal") < 0, F.lit("OLD")).otherwise(F.col("c_mktsegment")).alias("sic"))
    return scd2_initial(rows, INITIAL_TS)


def _orders_before(t: TableSet, day: str) -> DataFrame:
    """Orders filed before ``day``, as a filter on the raw column (pushed to the scan)."""
    return t["orders"].filter(F.col("o_orderdate") < F.lit(day).cast("timestamp_ntz"))


def _orders_from(t: TableSet, day: str) -> DataFrame:
    return t["orders"].filter(F.col("o_orderdate") >= F.lit(day).cast("timestamp_ntz"))


def existing_filingdim(t: TableSet) -> DataFrame:
    sub = adapter.sub(t, with_filed=True, orders=_orders_before(t, FILING_CUTOFF))
    rows = filing_source(sub)
    return rows.select(surrogate_key("accession_number").alias("id"), *rows.columns)


def existing_datedim(t: TableSet) -> DataFrame:
    li = t["lineitem"].filter(F.col("l_shipdate") < F.lit(FILING_CUTOFF).cast("timestamp_ntz"))
    keys = li.select(date_key("l_shipdate").alias("date_key")).distinct()
    return keys.select(surrogate_key("date_key").alias("id"), "date_key")


def raw_table(t: TableSet) -> DataFrame:
    """The raw submissions table before the change batch."""
    return adapter.sub(t, with_filed=True, orders=_orders_before(t, FILING_CUTOFF))


def raw_batch(t: TableSet) -> DataFrame:
    """A batch of new submissions; its first half-year overlaps the raw table."""
    return adapter.sub(t, with_filed=True, orders=_orders_from(t, BATCH_START))


def raw_later(t: TableSet) -> DataFrame:
    """A batch of new submissions none of which the raw table has."""
    return adapter.sub(t, with_filed=True, orders=_orders_from(t, FILING_CUTOFF))


RAW_COLUMNS = ("adsh", "cik", "name", "form", "sic")


def raw_requests(t: TableSet) -> DataFrame:
    """Keys to look up or delete: the filings behind returned line items."""
    return (t["lineitem"].filter(F.col("l_returnflag") == "R")
            .select(adapter.adsh("l_orderkey").alias("adsh")).distinct())


def raw_updates(t: TableSet) -> DataFrame:
    """Change sets from the line items: each line updates its filing, in line order.

    A returned line sets form to 'AMENDED'; an accepted one sets sic to null; any
    other sets the name to 'LINE <number>'."""
    flag = F.col("l_returnflag")
    return t["lineitem"].select(
        adapter.adsh("l_orderkey").alias("adsh"), F.col("l_linenumber").alias("update_no"),
        F.concat(F.lit("LINE "), F.col("l_linenumber").cast("string")).alias("name"),
        F.when(flag == "R", F.concat(F.lit("AMENDED "), F.col("l_linenumber").cast("string")))
        .alias("form"),
        F.lit(None).cast("string").alias("sic"),
        F.lit(None).cast("string").alias("filing_summary"),
        F.when(flag == "R", F.array(F.lit("form"))).when(flag == "A", F.array(F.lit("sic")))
        .otherwise(F.array(F.lit("name"))).alias("set_fields"),
    )


def raw_all(t: TableSet) -> DataFrame:
    """The raw submissions table with every filing."""
    return adapter.sub(t, with_filed=True)
