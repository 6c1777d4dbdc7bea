"""Ranked company totals (W5: join, sum by company name, order desc, limit).

Values are summed per company key *before* the join to the company table, so
the join sees one row per company instead of one per fact; the final regroup
by name merges same-named companies as the reference does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ranked_totals(values: DataFrame, key: str, companies: DataFrame, company_key: str = "id",
                  name: str = "name", value: str = "value", limit: int | None = 10,
                  round_to: int | None = None) -> DataFrame:
    """values(key, value) x companies(company_key, name) -> (company_name, total_value).

    Exact sums by default, as the reference returns; ``round_to`` rounds them
    (before ranking, so ties on the rounded value break by name)."""
    per_key = values.groupBy(key).agg(F.sum(value).alias("_part"))
    named = per_key.join(
        companies.select(F.col(company_key).alias(key), F.col(name).alias("company_name")), key)
    out = named.groupBy("company_name").agg(F.sum("_part").alias("total_value"))
    if round_to is not None:
        out = out.withColumn("total_value", F.round("total_value", round_to))
    if limit is not None:
        out = out.orderBy(F.desc("total_value"), F.asc("company_name")).limit(limit)
    return out


def company_totals(fact: DataFrame, companydim: DataFrame, limit: int | None = 10,
                   round_to: int | None = None) -> DataFrame:
    """Totals of the star: factfinancials.company_id = companydim.id, by name."""
    return ranked_totals(fact.select("company_id", "value"), "company_id", companydim,
                         company_key="id", name="name", limit=limit, round_to=round_to)
