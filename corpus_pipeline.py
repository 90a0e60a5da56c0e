"""Corpus pipeline: toxic documents out, repeated lines out, one document of each near-duplicate group, no test items, packed.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame, which is written as Parquet and read again as the next stage's
documents. All but the last keep the columns of documents. Decisions on documents are by doc_id: rows without one are never
dropped as copies or for test items, and repeated rows of an id stay or go together. An empty table goes through every stage.

SQL cannot score, hash or tokenise the texts, so there is no SQL for the rows; the tests hold each stage against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm import decontamination, jaccard, linededup, packing, toxicity
from farelake.llm.common import checked, stage, table
from farelake.llm.queries import vocabulary


def without(docs: DataFrame, ids: DataFrame, label: str) -> DataFrame:
    """``docs`` but those whose doc_id is in ``ids``."""
    name = "_gone"
    while name in docs.columns:
        name += "_"
    gone = stage(ids.select(F.col("doc_id").alias(name)).filter(F.col(name).isNotNull()).distinct(), label)
    return docs.join(checked(gone, 16), F.col("doc_id") == F.col(name), "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as clean."""
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier document or line has; n_chars is that of the text left.

    Two edits at most: documents of one long line are told apart here and compared as wholes in the next stage.
    """
    kept = linededup.dedup_lines(docs, most=2)
    return kept.select(*[
        F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns
    ])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by similarity the one with the smallest id; documents without words stay."""
    copies = jaccard.components(docs).filter("doc_id <> component_id")
    return without(docs, copies, "pipeline-copies")


def drop_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return without(docs, decontamination.contaminated(docs, table(spark, sf_dir, "benchmark")), "pipeline-leaks")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs, vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard", one_of_each_group),
    ("decontamination", drop_test_items),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
