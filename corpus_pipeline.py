"""A corpus pipeline over ``documents``: each stage works on all rows that the
stage before it kept, written as Parquet in the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bancalyt.llm import bpe, mixing, quality, simhash, suffixes
from bancalyt.llm.common import new_path


#: bytes of the repeated strings that are cut out: a passage of over 50 words has
#: more in languages with short words (259 bytes and up in the test tables), and
#: unrelated texts share no string as long
PASSAGE = 200


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go (null and empty texts too)."""
    return quality.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the smallest id."""
    return simhash.keep_one(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of PASSAGE bytes that start at two places or more are cut out of the
    texts. Every document stays, with what is left, and n_chars follows."""
    cut = suffixes.without_repeats(docs, PASSAGE)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: repeated epochs repeat rows,
    and documents beyond a source's budget go."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids of every document, and what the ids decode to."""
    return bpe.encode(docs, carry=["doc_id", "source"], decoded=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_dedup", repeated_strings),
    ("mixing", mixture),
    ("bpe", tokens),
]

#: fingerprints, sorted suffixes and merges have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            path = new_path(spark, f"stage-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
