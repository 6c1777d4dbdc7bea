"""Adapter from the driver's tables onto the filing data model.

| model table | driver source                                                   |
| sub         | orders join customer: adsh=o_orderkey, cik=o_custkey,           |
|             | name=c_name, form=o_orderpriority, sic=c_mktsegment             |
| num         | lineitem: adsh=l_orderkey, tag_id=l_partkey,                    |
|             | ddate=l_shipdate as yyyyMMdd int, qtrs=l_linenumber,            |
|             | value=l_extendedprice                                           |
| pre         | distinct (l_orderkey, l_partkey, l_returnflag); stmt=returnflag |
| tag         | part: tag_id=p_partkey, tag=p_name, version=p_brand,            |
|             | custom=p_size, label=p_type                                     |

Every function returns a lazy projection; nothing is read until a query runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import date_key_int
from ..sources.tables import TableSet


def adsh(c: str) -> F.Column:
    return F.col(c).cast("string")


def sub(t: TableSet, with_filed: bool = False, orders: DataFrame | None = None) -> DataFrame:
    """Filings with their company attributes (bronze ``sub``).

    ``orders``: a filtered ``orders`` to start from, so filters on raw order
    columns reach the parquet scan."""
    cols = [
        adsh("o_orderkey").alias("adsh"),
        F.col("o_custkey").alias("cik"),
        F.col("c_name").alias("name"),
        F.col("o_orderpriority").alias("form"),
        F.col("c_mktsegment").alias("sic"),
        F.lit(None).cast("string").alias("filing_summary"),
    ]
    if with_filed:
        cols.append(F.to_date("o_orderdate").alias("filed"))
        cols.append(F.col("o_orderstatus").alias("status"))
    orders = t["orders"] if orders is None else orders
    customer = t["customer"]
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(*cols)


def num(t: TableSet) -> DataFrame:
    """Bronze ``num``: ddate as an int yyyyMMdd, as the bronze files hold it."""
    return t["lineitem"].select(
        adsh("l_orderkey").alias("adsh"),
        F.col("l_partkey").alias("tag_id"),
        date_key_int("l_shipdate").alias("ddate"),
        F.col("l_linenumber").alias("qtrs"),
        F.col("l_extendedprice").alias("value"),
    )


def silver_num(t: TableSet) -> DataFrame:
    """Silver ``num``: ddate as a date. The driver's ship dates are already typed,
    so no int round trip; ``build_silver`` applies F1 to real bronze ints."""
    return t["lineitem"].select(
        adsh("l_orderkey").alias("adsh"),
        F.col("l_partkey").alias("tag_id"),
        F.to_date("l_shipdate").alias("ddate"),
        F.col("l_linenumber").alias("qtrs"),
        F.col("l_extendedprice").alias("value"),
    )


def pre(t: TableSet) -> DataFrame:
    return t["lineitem"].select(
        adsh("l_orderkey").alias("adsh"),
        F.col("l_returnflag").alias("stmt"),
        F.col("l_partkey").alias("tag_id"),
    ).distinct()


def tag(t: TableSet) -> DataFrame:
    return t["part"].select(
        F.col("p_partkey").alias("tag_id"),
        F.col("p_name").alias("tag"),
        F.col("p_brand").alias("version"),
        F.col("p_size").alias("custom"),
        F.col("p_type").alias("label"),
    )


def silver(t: TableSet) -> dict[str, DataFrame]:
    return {"sub": sub(t), "num": silver_num(t), "pre": pre(t), "tag": tag(t)}
