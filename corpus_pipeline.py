"""From raw documents to training pieces: every stage reads what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rushcart.llm.exact import unique_rows
from rushcart.llm.mixing import mixed_rows
from rushcart.llm.ngram_join import first_of_groups
from rushcart.llm.pieces import encode_pieces
from rushcart.llm.toxicity import reject_toxic, train
from rushcart.sources.folders import stored
from rushcart.sources.tables import load_table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labels of those that are there."""
    return reject_toxic(docs, train(docs, load_table(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text stays, the one with the largest id."""
    return unique_rows(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of those that five-word shingles link at 0.8 or more, the one with the smallest id."""
    return first_of_groups(docs, words=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    return mixed_rows(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids), a row for each copy."""
    return encode_pieces(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact),
    ("n-gram jaccard join", near),
    ("mixing sources", mixing),
    ("sentencepiece", pieces),
]

#: The classifier, the Newton steps and the keyed merges have no SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
