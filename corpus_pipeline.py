"""The corpus pipeline: ten-operator stages applied to ``documents`` one after the other.

Each stage works on all that its predecessor kept, and is written as Parquet into the
shared folder before the next reads it. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamper.llm import decontaminate, lines, packing, quality, simhash
from tamper.llm._spark import arrow_batches, table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of at least 0.5)."""
    arrow_batches(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.accepted(docs, model)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without its repeated lines; n_chars follows the text."""
    return lines.without_repeats(docs).withColumn("n_chars", F.length("text").cast(
        docs.schema["n_chars"].dataType)).select(*docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest doc_id."""
    return simhash.representatives(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the token sequences, in curve order."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("simhash", simhash_stage),
    ("benchmark", benchmark_stage),
    ("packing", packing_stage),
]

# Learned scores, edit joins and XXH64 have no SQL form: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
