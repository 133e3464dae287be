"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bancalyt.llm import (
    ann_tree, bpe, hard_negatives, html_layout, mixing, phrases, quality, repair, simhash, suffixes, token_spans, token_store, toxicity,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.report(table(spark, sf_dir, "documents"))


def op2_ann_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_tree.neighbours(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.report(table(spark, sf_dir, "documents"))


def op4_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.report(table(spark, sf_dir, "documents"))


def op5_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_layout.extract(table(spark, sf_dir, "pages"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"))


def op7_token_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_spans.section_counts(table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.report(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair.report(repair.damaged(conversations), conversations)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0, label)


QUERIES = {f.__name__: f for f in (op1_token_store, op2_ann_tree, op3_bpe, op4_phrases, op5_html_layout, op6_quality, op7_token_spans, op8_suffix_dedup, op9_mixing, op10_simhash,
    op11_toxicity, op12_repair, op13_hard_negatives)}

ORACLE_SQL = {
    "op4_phrases": phrases.oracle("documents"),
    "op6_quality": quality.oracle("documents"),
    "op9_mixing": mixing.ORACLE.format(documents="documents"),
    "op12_repair": repair.ORACLE.replace("{conversations}", "conversations"),
    "op13_hard_negatives": hard_negatives.ORACLE.format(embeddings="embeddings"),
}
