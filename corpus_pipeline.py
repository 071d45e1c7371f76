"""A training corpus from raw documents, in stages.

Every stage takes (spark, docs, sf_dir) and returns the documents it keeps; the
last one packs them. What a stage returns is written before the next one reads it:
by the stage itself, in small batches, where its last step runs in Python.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import contamination, jaccard, packing, surrogates, toxicity
from gridloom.llm.common import table
from gridloom.llm.queries import surrogate_key
from gridloom.session import materialized, small_batches


def written(stage):
    """The stage with its result written while Arrow batches are small, so that its
    workers' memory does not depend on how many rows Spark sends at once."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with small_batches(spark):
            return materialized(stage(spark, docs, sf_dir))

    run_stage.written = True
    return run_stage


@written
def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    with small_batches(spark):  # of its own jobs; its last step is a join
        return jaccard.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a passage with the benchmark go."""
    return contamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


@written
def privacy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gets surrogates; n_chars follows the text."""
    out = surrogates.pseudonymized(docs, surrogate_key(spark)).select(*docs.columns)
    if "n_chars" not in out.columns:
        return out
    size = F.coalesce(F.length("text").cast(dict(docs.dtypes)["n_chars"]), "n_chars")
    return out.withColumn("n_chars", size)


@written
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of the remaining documents."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("privacy", privacy_stage),
    ("packing", packing_stage),
]

# learned scores, surrogates and token ids have no SQL; tests compare with plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if not getattr(stage, "written", False):
            docs = materialized(docs)
    return docs
