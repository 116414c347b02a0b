"""A training corpus from raw documents: each stage takes documents and returns those it keeps."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from weftgraph.llm.decontaminate import decontaminate
from weftgraph.llm.lines import drop_repeated_lines
from weftgraph.llm.mixing import mix
from weftgraph.llm.simhash import drop_near_duplicates
from weftgraph.llm.toxicity import drop_toxic
from weftgraph.operators.runtime import checkpoint_dir, delete


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't score as toxic."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later copies of runs of lines of 50 words or more.

    ``n_chars`` follows the text; a document of which nothing is left stays with an empty text.
    """
    return with_lengths(drop_repeated_lines(docs))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents in mix order, as many words from each source as its target, with ``copy``, ``taken``, ``finish``."""
    return with_lengths(mix(docs))


def with_lengths(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_chars``, where they have it, as their texts are now."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: Toxicity scores and fingerprints can't be expressed in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared checkpoint folder and read again.

    What a stage has read is deleted once its own result is written; the last result stays in the folder.
    """
    folder = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        if before:
            delete(spark, f"{folder}/{before}")
        docs, before = spark.read.parquet(f"{folder}/{name}"), name
    return docs
