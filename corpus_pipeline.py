"""A corpus pipeline over ``documents``: language, toxicity, near-duplicates, benchmark passages, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the one before it kept; between
stages rows are written as Parquet and read again. All but the last keep the columns of ``documents``.
"""

from pyspark.sql import DataFrame, SparkSession

from sheetloom.llm import decontamination, langid, minhash, packing, toxicity
from sheetloom.llm.common import table
from sheetloom.staging import stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return langid.keep_known(docs, langid.fit(docs))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, judged by what the labels of this input teach."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8 or more."""
    return minhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences, with their token ids."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("toxicity", drop_toxic),
    ("near_dedup", near_dedup),
    ("decontamination", drop_leaks),
    ("packing", pack),
]
ORACLE_SQL = None  # learned models and token packing have no SQL form; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
