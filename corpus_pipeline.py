"""Corpus pipeline: toxicity, exact dedup, near dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's ``docs``. All but the last return the columns of documents, for the rows
that stay; the last returns the packed pieces of what is left. Stages see every row and whole
texts; null texts are empty texts (equal to each other, so one of them stays) and null doc_ids
follow the rules of each operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyloom.llm import exact, leaks, near, packing, toxicity
from skyloom.llm.common import read_table
from skyloom.session import stored


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold; the model is fitted on their labelled rows."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id."""
    return exact.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the row with the smallest doc_id."""
    return near.drop_near_copies(docs)


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return leaks.drop_leaking(docs, read_table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of what is left, packed into sequences."""
    return packing.pack_documents(docs, packing.default_tokenizer())


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("decontamination", leak_stage),
    ("packing", packing_stage),
]
# Classifier, similarity classes and tokenizer have no SQL form; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every intermediate result is a written Parquet table."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
