"""Table-set sources.

A table set is a dict of lazily read DataFrames keyed by table name. Reads are
declared, never materialised here: Catalyst prunes columns and pushes filters
into each parquet scan when the consuming query is planned.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


# Declared schemas of the driver's tables (the same at every scale factor).
# Reading with a declared schema skips the footer-inference job per read.
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


class TableSet(dict):
    """name -> DataFrame, read on first access (with its declared schema when known)."""

    def __init__(self, spark: SparkSession, root: str, names: Iterable[str] = DRIVER_TABLES,
                 fmt: str = "parquet", schemas: dict[str, str] | None = None):
        super().__init__()
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt
        self.names = list(names)
        self.schemas = DRIVER_SCHEMAS if schemas is None else schemas

    def path(self, name: str) -> str:
        suffix = f".{self.fmt}" if self.fmt == "parquet" else ""
        return f"{self.root}/{name}{suffix}"

    def __missing__(self, name: str) -> DataFrame:
        if name not in self.names:
            raise KeyError(name)
        reader = self.spark.read.format(self.fmt)
        if name in self.schemas:
            reader = reader.schema(self.schemas[name])
        df = reader.load(self.path(name))
        self[name] = df
        return df


def read_tables(spark: SparkSession, root: str, names: Iterable[str] = DRIVER_TABLES) -> TableSet:
    return TableSet(spark, root, names)
