"""Corpus pipeline: quality rules, line dedup, near-dedup, decontamination, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinframe.llm.common import cut, drop_cut, scratch_tables
from clinframe.llm.decontaminate import drop_contaminated
from clinframe.llm.line_dedup import line_dedup
from clinframe.llm.near_dup import drop_near_duplicates
from clinframe.llm.packing import pack
from clinframe.llm.quality import drop_poor


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; frequent lines of their host leave the others.

    Null, empty and blank texts are rejected; equal rows share their fate; a null
    source is a host of its own; other columns pass through.
    """
    return drop_poor(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of three-line windows go, and documents of which nothing is left.

    Null, empty and short texts stay as they are; equal rows get equal results.
    """
    out = line_dedup(docs).filter((F.col("line_dedup.n_removed") == 0) | (F.col("line_dedup.n_removed") < F.col("line_dedup.n_lines")))
    return out.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else c for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8; one document of each group stays.

    Texts without words are linked with nothing and stay; repeated rows collapse into one.
    """
    return drop_near_duplicates(docs, k=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; null and empty texts hold none, equal rows share their fate."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces packed into sequences of 1024; a null or empty text is its end token, equal rows are packed each."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

ORACLE_SQL = None  # near-duplicate search and packing have no SQL form; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each result written to the scratch folder and reread.

    What a stage stores on its way is deleted once its result is written, and
    the result once the next one is; the tables that the returned frame reads stay.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        with scratch_tables(spark):
            docs = cut(stage(spark, docs, sf_dir), f"stage-{name}", lasting=True)
        if before is not None:
            drop_cut(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
