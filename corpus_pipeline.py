"""The corpus pipeline: quality classifier, exact dedup, near dedup, mixing of
sources to target weights, best-fit packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm.common import small_batches, written
from tidewater.llm.exact import drop_exact
from tidewater.llm.mixing import mixed_documents
from tidewater.llm.neardup import drop_near
from tidewater.llm.packing import pack_documents
from tidewater.llm.resample import keep_good
from tidewater.session import ship_package


def _prepared(stage):
    """A stage that first sends the package to the workers and bounds their batches."""
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


@_prepared
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Importance resampling towards the labelled good documents; what it doesn't draw goes."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_prepared
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of equal texts stays."""
    return drop_exact(docs)


@_prepared
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return drop_near(docs)


@_prepared
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document may be cut, or come up to three times."""
    return mixed_documents(docs)


@_prepared
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences."""
    return pack_documents(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: The stages learn, draw and pack; no SQL gives their rows. See tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
