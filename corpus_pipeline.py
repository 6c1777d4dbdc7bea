"""The training-corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs. All but the last return the columns
of their docs. Stages work on all rows that the one before kept; rows are told
apart by their id and, where ids repeat, by their text.

Defined results: null texts pass the filters (they are not toxic, hold no
benchmark words and keep nothing to cut; near-duplicate detection sees them as
copies of each other); extra columns are passed through; an empty table passes
empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm import decontam, packing, simhash, suffix_dedup, toxicity
from ledgerline.llm.common import table, written
from ledgerline.llm.queries import word_tokenizer


#: Bytes of a repeated string that the pipeline cuts: fewer than a passage of 51 words has.
#: At 400 bytes most shared passages of 51 to 65 words stay (see README).
PASSAGE_BYTES = 250


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar rejects go."""
    model = toxicity.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.scorer(docs, model) < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the document with the smallest id stays."""
    return simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of repeated strings go; a character that loses a byte goes whole."""
    return suffix_dedup.cut_repeats(docs, PASSAGE_BYTES)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths, with their ids."""
    return packing.pack(docs, word_tokenizer())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("packing", pack),
]

#: Rolling hashes, learned weights and a tokenizer: not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
