"""A documents table through five stages of cleaning, each written as Parquet and read again by the next."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession, functions as F

from pointferry.llm.decontam import find_contamination
from pointferry.llm.jaccard import jaccard_components, row_mark
from pointferry.llm.packing import pack_documents
from pointferry.llm.quality import judge_documents
from pointferry.llm.secrets import redacted, scan_secrets
from pointferry.llm.textkit import NO_ID, as_before
from pointferry.operators.sizing import broadcast_if_small
from pointferry.session import scratch_dir

LENGTH = "n_chars"  # the column that follows the text's length, if the table has it


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line rules, without their failing lines. A null or empty text fails."""
    judged = judge_documents(docs, carry=True).where("kept").withColumnRenamed("clean_text", "text")
    return as_before(judged, docs.columns, length_col=LENGTH)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the least id.

    Rows are known by id and text, so unlike texts under one id, or without one, are documents of their
    own. Equal rows are one document and stay or go together.
    """
    groups = jaccard_components(docs, 5, Fraction(8, 10), rows=True)
    gone = groups.where("NOT stays").select(F.col("mark").alias("_row_mark")).distinct()
    marked = docs.withColumn("_row_mark", row_mark(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), F.coalesce("text", F.lit(""))))
    return marked.join(broadcast_if_small(gone, "near-duplicates"), "_row_mark", "left_anti").select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    found = find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=True)
    return as_before(found.where(F.size("hit_spans") == 0), docs.columns)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in the place of every secret."""
    found = scan_secrets(docs, carry=True)
    return as_before(found.withColumn("text", redacted()), docs.columns, length_col=LENGTH)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their places in sequences."""
    return pack_documents(docs).drop("ids")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]
# Line rules, character models and tokenizers have no SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = scratch_dir(spark, name.replace(" ", "-").lower())
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
