"""A corpus pipeline: toxic documents go, repeated lines go, one of each group of near copies stays,
contaminated documents go, and what is left is packed into training sequences.

Every stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a DataFrame; all but the last
return the columns of ``docs``. ``run`` writes each stage as Parquet into the shared folder and reads it again, so
that a lost executor costs no more than the stage it was in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from assayer.llm import decontam, jaccard, linedup, packing, toxicity
from assayer.llm.common import landed, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go. The scorer learns from the labels of documents that are still there."""
    return toxicity.drop_toxic(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document or line has, up to one word, go; documents stay, if need be with empty texts."""
    return linedup.dedup_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents that links of five-word shingles at a similarity of 0.8 join, that with the smallest id stays."""
    return jaccard.keep_one_of_each(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and offsets."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

# SQL can express neither the trained scorer nor the packing; the tests compare the stages with plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
