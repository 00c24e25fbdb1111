"""The operators as named queries over the given tables, each over the whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm import (
    conversations, decontamination, jaccard, licenses, minhash, negatives, ngram, packing, quality, rules, sql, toxicity, urls, warc,
)
from changeflow.llm.common import fold, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents")).drop("ids")


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"), licenses.notices(spark))
    return found.withColumn("license", F.substring_index("template", "/", 1))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents").select("doc_id", "text"), fold(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held)
    return toxicity.score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.verdicts(table(spark, sf_dir, "pages"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents").select("doc_id", "text"), fold(F.col("doc_id"), 7) == 2
    scored = ngram.score(docs, ngram.train(docs.filter(~held)))
    return scored.withColumn("held_out", held).drop("text")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rules.clean(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents").select("doc_id", "text"), fold(F.col("doc_id"), 3) == 1
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~held)
    return quality.score(docs, model).select("doc_id", held.alias("held_out"), "score", "predicted")


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.judge(decontamination.find(docs, table(spark, sf_dir, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op11_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.withColumn("label", moved)
    return negatives.mine(rows, rows.filter("vec_id % 100 = 0"))


def op12_conversation_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversations.damage(table(spark, sf_dir, "conversations"))
    return conversations.report(conversations.repair(damaged))


def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_license_scans": op2_license_scans,
    "op3_warc": op3_warc,
    "op4_toxicity": op4_toxicity,
    "op5_url_filters": op5_url_filters,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_quality_rules": op7_quality_rules,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_hard_negative_mining": op11_hard_negative_mining,
    "op12_conversation_structure_repair": op12_conversation_structure_repair,
    "op13_minhash_near_dedup": op13_minhash_near_dedup,
}

ORACLES: dict[str, str] = sql.ORACLES
