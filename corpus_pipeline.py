"""A corpus pipeline of training-data operators: quality rules, line dedup, near-duplicates, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import line_dedup, mixing, near_dup, packing, quality
from tidemark.llm.common import cut, table
from tidemark.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or that the calibrated forests reject, go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One line of each group of near-equal lines stays; n_chars is counted anew."""
    return with_n_chars(line_dedup.without_duplicate_lines(docs))


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at a similarity of 0.8 on five-word shingles stays."""
    return near_dup.without_near_duplicates(docs, k=5, percent=80)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    return mixing.mixed(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2,048 tokens."""
    return packing.pack(docs, tokenizer_path())


def with_n_chars(docs: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F

    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_deduplication),
    ("near-duplicates", near_deduplication),
    ("mixing", source_mixing),
    ("packing", sequence_packing),
]

#: No stage but the base rules can be put in SQL; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the whole documents table, each written as Parquet and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut(docs, name.replace(" ", "-"))
    return docs
