"""Job runner: bronze -> silver (W12) and silver -> gold.

Each stage reads a published version and publishes a new one (see
``sources.sinks.Warehouse``); written tables are also the lineage cuts, so a
lost executor costs at most the stage in flight. Running ``publish_gold``
twice on the same silver gives identical gold tables (W11).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import parse_date_int
from ..functions.keys import surrogate_key
from ..operators import fact_changes
from ..operators.quality import (load_stats, require_no_orphans, require_not_null,
                                 require_unique)
from ..operators.text import extract_texts
from ..schemas import BRONZE, GOLD, REQUIRED
from ..sources.delimited import read_csv
from ..sources.documents import document_texts, read_documents
from ..sources.sinks import Warehouse, new_version
from . import star

SILVER_TABLES = ("sub", "num", "pre", "tag")
GOLD_PARTITIONS: dict[str, list[str]] = {}
# companydim is stored as its current versions (a snapshot, about one row per
# company) plus an append-only history of expired versions.
COMPANY_PARTS = ("companydim_current", "companydim_history")


@dataclass
class RunReport:
    version: str
    rows: dict[str, int] = field(default_factory=dict)
    # Parts of the fact that the run wrote, and filings whose facts were built again
    # (incremental loads only).
    fact_parts: int | None = None
    filings_rebuilt: int | None = None


REJECTS = "table string, reason string, record string"


def _as_json(df: DataFrame) -> F.Column:
    return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})


def build_silver(spark: SparkSession, bronze_dir: str, documents_dir: str | None = None,
                 doc_glob: str = "*") -> tuple[dict[str, DataFrame], DataFrame]:
    """Read the four bronze CSVs by column name, attach document text to ``sub`` (left
    join on adsh), turn ``num.ddate`` into a date where the column is there.

    Returns (silver tables, rejects): table, reason and record of lines that don't
    fit their columns and of facts whose date is missing or doesn't parse.
    """
    reads = {name: read_csv(spark, f"{bronze_dir}/{name}.csv", schema, multi_line=name == "sub",
                            required=REQUIRED[name]) for name, schema in BRONZE.items()}
    rejects = None
    for name, read in reads.items():
        bad = read.rejects.select(F.lit(name).alias("table"), "reason", "record")
        rejects = bad if rejects is None else rejects.unionByName(bad)
    sub = reads["sub"].table
    if documents_dir is not None:
        texts = document_texts(read_documents(spark, documents_dir, doc_glob, key="adsh"),
                               key="adsh", out="extracted_pdf_text", html=True)
        sub = sub.join(texts, "adsh", "left")
    else:
        sub = sub.withColumn("extracted_pdf_text", F.lit(None).cast("string"))
    num, undated = split_dates(reads["num"].table)
    rejects = rejects.unionByName(undated)
    return {"sub": sub, "num": num, "pre": reads["pre"].table, "tag": reads["tag"].table}, rejects


def split_dates(num: DataFrame, col: str = "ddate") -> tuple[DataFrame, DataFrame]:
    """(rows with ``col`` as a date, rejects) (F1); P12: without the column, all rows
    pass as they are."""
    if col not in num.columns:
        return num, num.sparkSession.createDataFrame([], REJECTS)
    dated = num.withColumn("_date", parse_date_int(F.trim(F.col(col).cast("string"))))
    reason = F.when(F.col(col).isNull(), F.lit(f"{col} is missing")).otherwise(
        F.lit(f"{col} does not parse as yyyyMMdd"))
    rejects = dated.filter("_date IS NULL").select(
        F.lit("num").alias("table"), reason.alias("reason"), _as_json(num).alias("record"))
    good = dated.filter("_date IS NOT NULL").withColumn(col, F.col("_date")).drop("_date")
    return good, rejects


def silver_from_pages(silver: dict[str, DataFrame], pages: DataFrame) -> dict[str, DataFrame]:
    """Attach extracted page text to ``sub`` when documents are HTML pages in a table."""
    texts = extract_texts(pages, key="page_id", out="extracted_pdf_text").withColumnRenamed(
        "page_id", "adsh")
    texts = texts.withColumn("adsh", F.col("adsh").cast("string"))
    out = dict(silver)
    out["sub"] = silver["sub"].join(texts, "adsh", "left")
    return out


def publish_silver(wh: Warehouse, silver: dict[str, DataFrame],
                   rejects: DataFrame | None = None) -> str:
    """A new version of the silver tables (and the rejects, if given)."""
    tables = {n: silver[n] for n in SILVER_TABLES}
    if rejects is not None:
        tables["rejects"] = rejects
    return wh.publish(tables)


def gold_warehouse(spark: SparkSession, root: str, fact_parts: int | None = None) -> Warehouse:
    """The gold warehouse: declared schemas; insert-only dimensions and the
    company history stored as per-run deltas, so a run writes only new rows.

    ``fact_parts``: store the fact in so many hash parts of its filing, and load it
    incrementally (see ``publish_gold``); fixed for the life of the warehouse."""
    schemas = dict(GOLD)
    schemas.update({p: GOLD["companydim"] for p in COMPANY_PARTS})
    schemas["fact_digests"] = fact_changes.DIGESTS
    return Warehouse(spark, root, schemas,
                     append_only=(*star.INSERT_ONLY, "companydim_history"),
                     views={"companydim": COMPANY_PARTS},
                     parted={"factfinancials": ("filing_id", fact_parts)} if fact_parts else None)


# Natural key of each dimension; with the surrogate id it must be unique.
NATURAL_KEYS = {"filingdim": "accession_number", "tagdim": "tag", "datedim": "date_key",
                "statementdim": "statement_code"}
FACT_PARENTS = {"filing_id": "filingdim", "company_id": "companydim", "tag_id": "tagdim",
                "date_id": "datedim", "statement_id": "statementdim"}


def check_gold(dims: dict[str, DataFrame], fact: DataFrame) -> None:
    """Q1 to Q3 over the written tables of a version, before it is marked: unique ids and
    natural keys (a clash of two 64-bit ids is one kind of duplicate), no null
    keys, and every fact key with its dimension row. Raises ``CheckFailed``."""
    checks = []
    for name, dim in dims.items():
        must = [f.name for f in GOLD[name].fields if not f.nullable]
        checks.append(lambda n=name, d=dim, m=must: require_not_null(d, m, n))
        checks.append(lambda n=name, d=dim: require_unique(d, ["id"], n))
        if name in NATURAL_KEYS:
            checks.append(lambda n=name, d=dim: require_unique(d, [NATURAL_KEYS[n]], n))
    checks.append(lambda: require_unique(dims["companydim"].filter("is_current"), ["cik"],
                                         "companydim (current)"))
    for fk, parent in FACT_PARENTS.items():
        checks.append(lambda k=fk, p=parent: require_no_orphans(fact, k, dims[p], "id",
                                                                "factfinancials"))
    # Independent small jobs: run side by side, like the writes of a version.
    with ThreadPoolExecutor(max_workers=4) as pool:
        for done in [pool.submit(check) for check in checks]:
            done.result()


def publish_gold(silver: dict[str, DataFrame], gold_wh: Warehouse, batch_ts: str,
                 statement_labels: dict[str, str] | None = None) -> RunReport:
    """Apply a silver snapshot to the gold warehouse and publish a new version.

    ``silver`` should be a published silver version: its tables are read several
    times. Dimensions are written first (they are the fact's lookup tables); the fact
    is then built against the *written* dimensions and reloaded in full. For
    append-only tables only the new rows are written; the company dimension's
    current versions are a snapshot. After every table is in place and the checks
    hold, the version becomes visible with its marker, as successor of the version
    that was read.

    In a warehouse with ``fact_parts`` the fact is not reloaded: facts of filings that
    changed since the last load (see ``fact_changes``) are built and replaced in the parts
    they lie in. The resulting fact is that of a full reload.
    """
    if not {*star.INSERT_ONLY, "companydim_history"} <= gold_wh.append_only:
        raise ValueError("make the warehouse with gold_warehouse(): the insert-only dimensions "
                         "and the company history are append-only tables")
    previous = gold_wh.current_version()
    if previous is None:
        existing = {n: gold_wh.spark.createDataFrame([], GOLD[n]) for n in GOLD}
    else:
        existing = gold_wh.tables(list(GOLD), previous)
    snapshots, deltas = star.dimension_changes(silver, existing, batch_ts, statement_labels)
    if previous is None:
        first = star.first_load_dimensions(silver, batch_ts, statement_labels)
        snapshots = {"companydim_current": first["companydim"]}
        deltas = {n: first[n] for n in star.INSERT_ONLY}
        deltas["companydim_history"] = first["companydim"].limit(0)
    version = new_version()
    staged = {**snapshots, **deltas}
    observed, obs = {}, {}
    for name, df in staged.items():
        observed[name], obs[name] = load_stats(df, name)
    gold_wh.stage(version, observed, GOLD_PARTITIONS)
    # The fact is built against the dimensions as written, not their lineage;
    # it only looks up current company versions.
    current = gold_wh.read_staged("companydim_current", version)
    history = existing["companydim"].filter("NOT is_current").unionByName(
        gold_wh.read_delta("companydim_history", version))
    written = {"companydim": current.unionByName(history)}
    for name in star.INSERT_ONLY:
        written[name] = existing[name].unionByName(gold_wh.read_delta(name, version))
    lookups = {**written, "companydim": current}
    if "factfinancials" in gold_wh.parted:
        return _publish_parted_fact(silver, gold_wh, lookups, written, version, previous,
                                    list(staged), {n: o.get["rows"] for n, o in obs.items()})
    fact, fobs = load_stats(star.fact(silver, lookups), "factfinancials")
    gold_wh.stage(version, {"factfinancials": fact})
    check_gold(written, gold_wh.read_staged("factfinancials", version))
    gold_wh.mark(version, [*staged, "factfinancials"], previous)
    rows = {n: o.get["rows"] for n, o in obs.items()}
    rows["factfinancials"] = fobs.get["rows"]
    return RunReport(version, rows)


def _publish_parted_fact(silver: dict[str, DataFrame], wh: Warehouse,
                         lookups: dict[str, DataFrame], dims: dict[str, DataFrame], version: str,
                         previous: str | None, staged: list[str], rows: dict[str, int]) -> RunReport:
    """The incremental end of ``publish_gold``: digests, changed filings, their facts.

    Facts carried over keep keys that were checked when they were written; dimensions
    lose no rows. So the foreign keys of the rewritten parts are checked, not of all."""
    wh.stage(version, {"fact_digests": fact_changes.digests(silver, lookups["companydim"])})
    digests = wh.read_staged("fact_digests", version)
    if previous is None:
        touched, rebuilt = None, digests.filter("kind = 'filing'").count()
        facts = star.fact(silver, lookups)
    else:
        wh.stage(version, {"fact_changes": fact_changes.changed_filings(
            wh.table("fact_digests", previous), digests, silver["num"])})
        filings = wh.read_staged("fact_changes", version)
        ids = filings.select(surrogate_key("adsh").alias("filing_id"))
        touched, rebuilt = wh.touched("factfinancials", ids), filings.count()
        kept = wh.parts("factfinancials", touched, previous).join(ids, "filing_id", "left_anti")
        facts = star.fact(fact_changes.of_filings(silver, filings), lookups)
        facts = kept.unionByName(facts.select(*kept.columns))
    entries = wh.stage_parts("factfinancials", facts, touched, version)
    full = {int(e.split("/")[1]): version for e in entries if not e.endswith("/empty")}
    fact = wh.read_parts("factfinancials", full)
    check_gold(dims, fact)
    wh.mark(version, [*staged, "fact_digests", *entries], previous)
    rows["factfinancials"] = fact.count()
    return RunReport(version, rows, len(entries), rebuilt)


def register_document_filings(filingdim: DataFrame, docs: DataFrame, form_type: str,
                              key: str = "doc_key") -> DataFrame:
    """Each document file becomes a filing row keyed by its file name
    (not a constant accession), inserted only if the key is new (W2)."""
    from ..operators.dimensions import insert_only

    rows = docs.select(F.col(key).alias("accession_number")).dropna().distinct().select(
        "accession_number", F.lit(form_type).alias("form_type"),
        F.lit(None).cast("string").alias("period_of_report"),
        F.lit(None).cast("string").alias("date_filed"))
    return insert_only(filingdim, rows, "accession_number")
