"""Clean and pack a corpus: five stages, each over all documents that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a frame that is written and read again as the next one's docs.
All but the last return the columns of documents: toxic and poor documents go, lines that stand in many
documents are cut from their texts (n_chars follows), of near duplicates one stays, and what is left is packed
into sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import op03_dominance_packing, op04_nb_svm, op08_toxicity, op09_bagminhash, op10_line_dedup
from tidemark.llm.common import table
from tidemark.session import settled


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op08_toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op04_nb_svm.good_quality(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = op10_line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op09_bagminhash.one_of_each_group(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op03_dominance_packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("packing", packing),
]

#: Trained scores, sketches and token ids are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
