"""Silver -> gold in one declared plan: dimensions, then the fact.

``first_load`` builds every dimension from empty; ``incremental`` applies a
silver snapshot to existing gold tables (SCD2 company, insert-only others)
and reloads the fact against the resulting dimensions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..operators import dimensions as D
from ..operators.facts import build_fact, build_fact_left


def _with_id(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(surrogate_key(key).alias("id"), *rows.columns)


INSERT_ONLY = ("filingdim", "tagdim", "datedim", "statementdim")


def dimension_changes(silver: dict[str, DataFrame], gold: dict[str, DataFrame], batch_ts: str,
                      statement_labels: dict[str, str] | None = None
                      ) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """(snapshots, deltas): the next current company versions, and the new rows
    of the append-only tables - versions expired by this batch
    (``companydim_history``) and each insert-only dimension."""
    sub = silver["sub"]
    labels = statement_labels or {}
    stmt_src = (D.statement_source(silver["pre"], labels) if labels
                else D.statement_source(silver["pre"]))
    current, expired = D.scd2_changes(gold["companydim"], D.company_source(sub), batch_ts)
    snapshots = {"companydim_current": current}
    deltas = {
        "companydim_history": expired,
        "filingdim": D.insert_only(gold["filingdim"], D.filing_source(sub), "accession_number"),
        "tagdim": D.insert_only(gold["tagdim"], D.tag_source(silver["tag"]), "tag"),
        "datedim": D.insert_only(gold["datedim"], D.date_source(silver["num"]), "date_key"),
        "statementdim": D.insert_only(gold["statementdim"], stmt_src, "statement_code"),
    }
    return snapshots, deltas


def dimensions(silver: dict[str, DataFrame], gold: dict[str, DataFrame], batch_ts: str,
               statement_labels: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Next snapshot of each dimension after applying ``silver``."""
    snapshots, deltas = dimension_changes(silver, gold, batch_ts, statement_labels)
    history = gold["companydim"].filter(~F.col("is_current"))
    out = {"companydim": history.unionByName(snapshots["companydim_current"])
           .unionByName(deltas["companydim_history"])}
    for name in INSERT_ONLY:
        out[name] = D.append_rows(gold[name], deltas[name])
    return out


def first_load_dimensions(silver: dict[str, DataFrame], batch_ts: str,
                          statement_labels: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Dimensions built from empty (no existing tables to read)."""
    labels = statement_labels or {}
    stmt_src = (D.statement_source(silver["pre"], labels) if labels
                else D.statement_source(silver["pre"]))
    return {
        "companydim": D.scd2_initial(D.company_source(silver["sub"]), batch_ts),
        "filingdim": _with_id(D.filing_source(silver["sub"]), "accession_number"),
        "tagdim": _with_id(D.tag_source(silver["tag"]), "tag"),
        "datedim": _with_id(D.date_source(silver["num"]), "date_key"),
        "statementdim": _with_id(stmt_src, "statement_code"),
    }


# ``silver`` and the dimensions it has been loaded into: each of its keys is there.
def fact(silver: dict[str, DataFrame], dims: dict[str, DataFrame],
         natural_keys: bool = False) -> DataFrame:
    return build_fact(silver["num"], silver["pre"], silver["sub"], silver["tag"],
                      dims["companydim"], dims["filingdim"], dims["tagdim"], dims["datedim"],
                      dims["statementdim"], natural_keys=natural_keys, complete=True)


def fact_left(silver: dict[str, DataFrame], dims: dict[str, DataFrame],
              natural_keys: bool = False) -> DataFrame:
    return build_fact_left(silver["num"], silver["pre"], silver["sub"], silver["tag"],
                           dims["companydim"], dims["filingdim"], dims["tagdim"],
                           dims["datedim"], natural_keys=natural_keys, complete=True)


def restrict_statements(pre: DataFrame, codes: list[str]) -> DataFrame:
    return pre.filter(F.col("stmt").isin(codes))
