"""A corpus pipeline of five stages, each a call of one operator, each written as Parquet and read again.

All stages take documents with null or empty texts, any other columns null, repeated rows and columns of any further name, and
give an empty table for an empty one; the operators' modules state what comes of each. The first four return the columns of their input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wordmill.llm import minhash, mixing, outliers, packing, pii
from wordmill.llm.shared import Workspace, documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the robust outlier test reject go, null and empty texts among them, as they have under
    ten words. Repeated rows are judged alike."""
    return outliers.drop_outliers(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8) stays: its smallest doc_id, a null one
    last. Texts without words all stay."""
    return minhash.drop_near_duplicates(docs, shingle=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each span of personal data gives way to a mark of its kind, and n_chars of such a text is counted anew. Null texts stay null."""
    return pii.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes, in training order; texts without words are taken once. Columns of the names
    mix_position and mix_repeat get the mix's values."""
    return mixing.curriculum(docs).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens; a null or empty text is one piece, the end token."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("packed", packed),
]

#: Robust estimates, a semi-Markov model and tokenization are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "pipeline")
    docs, before = documents(spark, sf_dir), ()
    for name, stage in STAGES:
        docs = work.keep(stage(spark, docs, sf_dir), name)
        work.drop(*before)
        before = (name,)
    return docs
