"""From raw documents to token ids: five stages, each one of the operators in provlake.llm.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a DataFrame that is
written as Parquet and read again as the next one's docs.  All but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provlake.llm import boilerplate, bpe, decontamination, language, simhash
from provlake.llm.common import written

#: A line on fewer pages of its source is no boilerplate: on sources with a few pages any line passes the ratio.  Copies of a page count once there, as the next
#: stage takes them away: a page with many copies is not boilerplate.
LEAST_PAGES = 5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go."""
    return language.keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of each source go; n_chars follows the text."""
    out = boilerplate.drop_boilerplate(docs, min_pages=LEAST_PAGES, copies_count=False)
    n_chars = F.when(F.col(boilerplate.count_names(docs)[1]) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, the one with the least id."""
    return simhash.keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontamination.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the digest of the decoded text."""
    out = bpe.encode_documents(docs)
    return out.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("encode", encode)]

#: SQL can't express compression, SimHash components or BPE; the tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
