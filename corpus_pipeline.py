"""The corpus pipeline: classify, cut repeated lines, drop near copies and leaks, pack.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; :func:`run` writes each
result as Parquet in the shared checkpoint folder and rereads it for the next stage. All but
the last return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gradmesh.llm import ordinal_quality
from gradmesh.llm.common import table, written
from gradmesh.llm.line_windows import dedup_lines
from gradmesh.llm.order_minhash import one_of_each
from gradmesh.llm.packing import pack_documents
from gradmesh.llm.template_leaks import without_leaks


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier, fitted on labelled ones of them, keeps."""
    model = ordinal_quality.train(docs, ordinal_quality.graded(table(spark, sf_dir, "labels")))
    return ordinal_quality.keep_good(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, later places of repeated three-line windows cut out of their texts."""
    return dedup_lines(docs, length_col="n_chars" if "n_chars" in docs.columns else None)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of exact and near copies."""
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item leaks into."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("lines", lines), ("near_copies", near_copies), ("decontaminate", decontaminate), ("pack", pack)]

#: The classifier and the sketches can't be expressed in SQL; tests hold the stages against
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
