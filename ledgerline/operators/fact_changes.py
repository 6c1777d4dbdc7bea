"""Incremental facts (S10, W4): only the facts of changed filings are built again.

What a filing's facts are made of is its rows of ``num`` and ``pre``, its company's current
version and the tags that its numbers name. One digest per filing covers the first
three: a count and sums of row hashes, so it doesn't depend on the order of rows, is combined
before the shuffle, and a filing with very many rows needs no more room than another. Tags
have a digest of their own, and filings whose numbers name a changed tag count as changed.
The digests of the last load lie beside the facts; a filing that is new, gone or different
is replaced in the stored fact, a parted table; the parts of other filings stay as they are.

Rows are compared by 64-bit hashes summed in two halves next to their count; a change that
leaves all three sums as they were (about 1 in 2^64 for a given filing) would go unseen.

Defined results: null filings and tags have no facts (inner joins) and no digest; repeated rows
count each; without an earlier load every filing is new.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

SUMS = ("n", "low", "high")
_SUMS = [StructField(c, LongType()) for c in SUMS]
#: kind: 'filing' or 'tag'; key: adsh or tag id.
DIGESTS = StructType([StructField("kind", StringType()), StructField("key", StringType()), *_SUMS])


def _summed(rows: DataFrame) -> DataFrame:
    """(key, sums) of (key, h) rows; halves of 32 bits, so that no sum can overflow."""
    return rows.filter("key IS NOT NULL").groupBy("key").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
        F.sum(F.shiftright("h", 32)).alias("high"))


def _hashed(df: DataFrame, key: str, kind: str, *cols: str) -> DataFrame:
    # Nulls are hashed as a flag of their own: xxhash64 alone passes over them.
    parts = [c for name in cols for c in (F.col(name).isNull(), F.col(name))]
    return df.select(F.col(key).cast("string").alias("key"), F.xxhash64(F.lit(kind), *parts).alias("h"))


def digests(silver: dict[str, DataFrame], companies: DataFrame) -> DataFrame:
    """``DIGESTS`` rows of a silver snapshot; ``companies``: current company versions."""
    current = companies.filter("is_current").select("cik", F.col("id").alias("company_id"))
    sub = silver["sub"].select("adsh", F.col("cik").cast("string").alias("cik")).join(
        current, "cik", "left")
    filings = reduce(DataFrame.unionByName, [
        _hashed(silver["num"], "adsh", "num", "tag_id", "ddate", "value"),
        _hashed(silver["pre"], "adsh", "pre", "tag_id", "stmt"),
        _hashed(sub, "adsh", "sub", "cik", "company_id")])
    tags = _hashed(silver["tag"], "tag_id", "tag", "tag")
    return _summed(filings).select(F.lit("filing").alias("kind"), "key", *SUMS).unionByName(
        _summed(tags).select(F.lit("tag").alias("kind"), "key", *SUMS))


def changed(old: DataFrame, new: DataFrame, kind: str) -> DataFrame:
    """(key): keys of a kind that are new, gone or have another digest."""
    sums = lambda df: df.filter(F.col("kind") == kind).select(
        "key", F.struct(*SUMS).alias("sums"))
    both = sums(old).withColumnRenamed("sums", "was").join(sums(new), "key", "full_outer")
    return both.filter(~F.col("was").eqNullSafe(F.col("sums"))).select("key")


def changed_filings(old: DataFrame, new: DataFrame, num: DataFrame) -> DataFrame:
    """(adsh), each once: filings that changed themselves or by a tag that they name."""
    filings = changed(old, new, "filing").select(F.col("key").alias("adsh"))
    tags = changed(old, new, "tag")
    by_tag = num.select("adsh", F.col("tag_id").cast("string").alias("key")).join(
        tags, "key", "left_semi").select("adsh").dropna()
    return filings.unionByName(by_tag).distinct()


def of_filings(silver: dict[str, DataFrame], filings: DataFrame) -> dict[str, DataFrame]:
    """The silver tables with the rows of some filings alone (tags: all)."""
    return {**silver, **{n: silver[n].join(filings, "adsh", "left_semi")
                         for n in ("sub", "num", "pre")}}
