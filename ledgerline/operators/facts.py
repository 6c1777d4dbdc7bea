"""Star-schema fact build (W4) and the legacy left-join variant.

Join order is written for scale: the filings are paired with their filing and
company ids *before* meeting the facts, and the tags with their tag ids, so lookups
run on the small side. Where only ids are asked for, presentation rows look their tag up before
they meet the numbers: they are narrower than facts, which are then not shuffled by tag (with
natural keys the names would travel, so there the facts look them up). Numbers, filings and presentation rows meet partitioned by
adsh. Surrogate ids are hashes of natural keys (W3): where the dimensions are known to
hold every key of the facts (``complete``, as after a load from the same silver,
which the publish gate checks by distinct keys), date and statement ids are
computed and the facts are not shuffled by those few values at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import date_key
from ..functions.keys import surrogate_key


def _keyed_filings(sub: DataFrame, filingdim: DataFrame, companydim: DataFrame,
                   how: str = "inner") -> DataFrame:
    """(adsh, cik, filing_id, company_id): the filing and company lookups done on
    the filings, which are far fewer than the facts, so the facts are never
    shuffled by cik."""
    filings = filingdim.select(F.col("accession_number").alias("adsh"),
                               F.col("id").alias("filing_id"))
    company = companydim.filter("is_current").select("cik", F.col("id").alias("company_id"))
    return (sub.select("adsh", F.col("cik").cast("string").alias("cik"))
            .join(filings, "adsh", how)
            .join(company, "cik", how))


def _keyed_tags(tag: DataFrame, tagdim: DataFrame, how: str = "inner") -> DataFrame:
    """(tag_id, tag, tag_fk): the tag lookup done on the tag table."""
    tags = tagdim.select("tag", F.col("id").alias("tag_fk"))
    return tag.select("tag_id", "tag").join(tags, "tag", how)


def _dated(facts: DataFrame, datedim: DataFrame, complete: bool, how: str) -> DataFrame:
    if complete:
        return facts.withColumn("date_id", F.when(F.col("date_key").isNotNull(),
                                                  surrogate_key("date_key")))
    return facts.join(datedim.select("date_key", F.col("id").alias("date_id")), "date_key", how)


def _stated(facts: DataFrame, statementdim: DataFrame, complete: bool) -> DataFrame:
    if complete:
        return facts.filter("stmt IS NOT NULL").withColumn("statement_id", surrogate_key("stmt"))
    return facts.join(statementdim.select(F.col("statement_code").alias("stmt"),
                                          F.col("id").alias("statement_id")), "stmt")


def build_fact(num: DataFrame, pre: DataFrame, sub: DataFrame, tag: DataFrame,
               companydim: DataFrame, filingdim: DataFrame, tagdim: DataFrame,
               datedim: DataFrame, statementdim: DataFrame,
               natural_keys: bool = False, complete: bool = False) -> DataFrame:
    """num x pre on (adsh, tag_id) (fans out), x sub, x tag, then five inner
    surrogate-key lookups; unmatched rows drop out, as in the reference.

    Returns (value, filing_id, company_id, tag_id, date_id, statement_id), or
    with ``natural_keys`` the natural keys (adsh, cik, tag, date_key, stmt, value).
    """
    tags, stated = _keyed_tags(tag, tagdim), pre.select("adsh", "tag_id", "stmt")
    if not natural_keys:
        stated = stated.join(tags.select("tag_id", "tag_fk"), "tag_id")
    facts = (num.select("adsh", "tag_id", date_key("ddate").alias("date_key"), "value")
             .join(_keyed_filings(sub, filingdim, companydim), "adsh")
             .join(stated, ["adsh", "tag_id"]))
    if natural_keys:
        facts = facts.join(tags, "tag_id")
    facts = _stated(_dated(facts, datedim, complete, "inner"), statementdim, complete)
    if complete:
        facts = facts.filter("date_id IS NOT NULL")
    if natural_keys:
        return facts.select("adsh", "cik", "tag", "date_key", "stmt", "value")
    return facts.select("value", "filing_id", "company_id", F.col("tag_fk").alias("tag_id"),
                        "date_id", "statement_id")


def build_fact_left(num: DataFrame, pre: DataFrame, sub: DataFrame, tag: DataFrame,
                    companydim: DataFrame, filingdim: DataFrame, tagdim: DataFrame,
                    datedim: DataFrame, natural_keys: bool = False,
                    complete: bool = False) -> DataFrame:
    """Legacy variant: left joins, then drop rows missing adsh/tag/cik or any
    looked-up id. Rows without a statement survive; there is no statement key."""
    facts = (num.select("adsh", "tag_id", date_key("ddate").alias("date_key"), "value")
             .join(_keyed_filings(sub, filingdim, companydim, "left"), "adsh", "left")
             .join(pre.select("adsh", "tag_id", "stmt"), ["adsh", "tag_id"], "left")
             .join(_keyed_tags(tag, tagdim, "left"), "tag_id", "left")
             .dropna(subset=["adsh", "tag", "cik"]))
    facts = _dated(facts, datedim, complete, "left").dropna(
        subset=["company_id", "filing_id", "tag_fk", "date_id"])
    if natural_keys:
        return facts.select("adsh", "cik", "tag", "date_key", "stmt", "value")
    return facts.select("value", "filing_id", "company_id", F.col("tag_fk").alias("tag_id"),
                        "date_id")


def natural_fact(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """The fact's rows with the natural keys that its five ids stand for."""
    names = (("filing_id", "filingdim", "accession_number", "adsh"),
             ("company_id", "companydim", "cik", "cik"), ("tag_id", "tagdim", "tag", "tag"),
             ("date_id", "datedim", "date_key", "date_key"),
             ("statement_id", "statementdim", "statement_code", "stmt"))
    for fk, dim, key, name in names:
        fact = fact.join(dims[dim].select(F.col("id").alias(fk), F.col(key).alias(name)), fk)
    return fact.select(*[n[3] for n in names], "value")
