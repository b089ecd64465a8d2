"""Corpus pipeline: documents to a training mix, one operator a stage.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs.  All but the last return the columns of their docs.  Nulls, empty and
repeated rows are treated as each operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbend.llm import decontaminate, line_chunks, mixing, near_text, quality
from riverbend.llm.common import save
from riverbend.sources.tables import read_table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer, trained on all docs' weak labels, doesn't reject."""
    _, scorer = quality.train(docs)
    return quality.reject(docs, scorer)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that stand earlier in the corpus; ``n_chars`` follows a changed text."""
    removed = "lines_removed_" + "_".join(docs.columns).replace(".", "_")  # no column of docs has this name
    out = line_chunks.remove_repeats(docs, removed_col=removed)
    n_chars = F.when(F.col(removed) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars).drop(removed)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return near_text.drop_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.remove_leaks(docs, read_table(spark, sf_dir, "benchmark", ["item_id", "text"]))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row per document and epoch in which it is taken, with ``domain``, ``n_tokens`` and ``epoch``."""
    return mixing.mix_rows(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mix_sources", mix_sources),
]

#: The classifier and the similarity stage have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
