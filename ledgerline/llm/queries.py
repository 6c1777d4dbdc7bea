"""Registered queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm import (chat, collocations, decontam, license_scan, packing, quality_qda,
                            quality_rules, ranked_search, simhash, suffix_dedup, toxicity,
                            url_filter, warc)
from ledgerline.llm.common import table


def word_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.lit(quality_rules.mask("base", 1)).cast("long")
    rows = quality_rules.apply_policy(
        quality_rules.store(table(spark, sf_dir, "documents")), "prose", 2)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words",
                       (F.col("fail_bits").bitwiseAND(base) != 0).alias("base_failed"),
                       "kept", "fail_bits")


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every policy keeps without each of its rules, from the stored bits."""
    return quality_rules.ablations(quality_rules.store(table(spark, sf_dir, "documents")))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


#: The contract's extra conversation, whose texts hold control strings.
CONTROL = ((-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    extra = spark.createDataFrame(CONTROL, "conv_id long, turn long, role string, text string")
    found, nodes = chat.format_conversations(
        turns.select("conv_id", "turn", "role", "text").unionByName(extra))
    return chat.digests(chat.read_back(found, nodes))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), word_tokenizer(), with_ids=False)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.per_document(license_scan.scan(table(spark, sf_dir, "documents")))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad"))
    return url_filter.judge(table(spark, sf_dir, "pages"), labels)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranked_search.search(ranked_search.index(table(spark, sf_dir, "documents")),
                                 table(spark, sf_dir, "benchmark"))
    return found.select("item_id", "rank", "doc_id", "score")


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_qda.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_simhash": op2_simhash,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_decontamination": op4_decontamination,
    "op5_packing": op5_packing,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_license_scan": op7_license_scan,
    "op8_url_filter": op8_url_filter,
    "op9_warc": op9_warc,
    "op10_toxicity": op10_toxicity,
    "op11_collocations": op11_collocations,
    "op12_ranked_search": op12_ranked_search,
    "op13_quality_classifier": op13_quality_classifier,
    "quality_ablations": quality_ablations,
}
