"""Corpus pipeline over ``documents``: each stage calls one operator of ``tessera.llm``.

``STAGES`` lists (name, function). A function takes (spark, docs, sf_dir) and returns a DataFrame, which
is written as Parquet and read again as the next one's docs. All stages but the last return the
columns of their docs; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import toxicity
from tessera.llm.packing import pack_documents
from tessera.llm.quality import quality_filter
from tessera.llm.queries import WORD_BPE, vocabulary
from tessera.llm.simhash import simhash_dedup
from tessera.llm.substring import substring_dedup
from tessera.llm.workspace import Workspace, documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule of the policy go."""
    return quality_filter(docs, policy="full-1")


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the model learns from the labelled rows of ``sf_dir``."""
    model = toxicity.fit(documents(spark, sf_dir), documents(spark, sf_dir, "labels"), Workspace(spark, "toxicity"))
    return toxicity.toxicity_filter(docs, model, toxicity.THRESHOLD)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash_dedup(spark, docs, shingle=4, max_bits=4)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of passages of 50 words or more are cut out; every document stays."""
    return substring_dedup(docs, Workspace(spark, "passages"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens, documents in order."""
    return pack_documents(docs, Workspace(spark, "packing"), vocabulary(WORD_BPE))


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxic_documents),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", passage_dedup),
    ("packing", packing),
]

ORACLE_SQL = None  # tokens, fingerprints and the classifier have no SQL form; tests/llm holds the stages against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every earlier result is written to the shared folder and read again."""
    ws = Workspace(spark, "pipeline")
    rows = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        rows = stage(spark, rows, sf_dir)
        if k < len(STAGES) - 1:
            rows = ws.put(rows, f"{k}-{name}")
    return rows
