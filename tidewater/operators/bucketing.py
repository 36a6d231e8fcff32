"""Bucketed tables, skewed-value reports, and a layout for skewed values."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_bucketed(df: DataFrame, table: str, n: int, key, path: str | None = None, sort: bool = True) -> DataFrame:
    """Table of ``n`` buckets hashed on ``key``, sorted inside each
    bucket (external at ``path`` when given). Rows are unchanged. Two tables bucketed the same way on the join
    key join bucket-to-bucket: neither side is shuffled again.

    A REBALANCE on the key first gathers each bucket's rows (the shuffle
    hashes like the bucketing does), so every task writes few bucket files
    instead of one per bucket; AQE sizes the tasks and can split a hot
    bucket over several files.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = df.hint("rebalance", *keys).write.mode("overwrite").format("parquet")
    if path is not None:  # external table at ``path``; else managed, in the warehouse
        w = w.option("path", path)
    w = w.bucketBy(n, *keys)
    if sort:
        w = w.sortBy(*keys)
    w.saveAsTable(table)
    return df.sparkSession.table(table)


def bucket_count(spark: SparkSession) -> int:
    """Buckets for a table as large as the session's largest shuffle: as many
    as its shuffle partitions (see ``session.shuffle_partitions_for``)."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def skewed_values(df: DataFrame, columns, share: float) -> DataFrame:
    """Values of ``columns`` (a name or several) whose share of the rows is at
    least ``share``; with several, values are combinations.

    Counts are aggregated first (map-side combine); the total is a scalar
    subquery over those counts, so the input is scanned and shuffled once
    (the subquery reuses the same exchange) and nothing but one number is
    broadcast.
    """
    names = [columns] if isinstance(columns, str) else list(columns)
    counts = df.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    total = counts.select(F.sum("n")).scalar()
    return counts.select(*names, "n", (F.col("n") / total).alias("share")).where(
        F.col("share") >= F.lit(share)
    )


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


# --- heavy hitters by summary -------------------------------------------------

def heavy_summary(df: DataFrame, column: str, share: float, keys=()) -> DataFrame:
    """A mergeable summary (``summary``, and ``rows``) of the frequent values
    of ``column``, per group of ``keys``: one row a task is shuffled, whatever
    the number of values. It can be stored and merged later.

    A summary of m values errs by at most 3.5 / m of the rows; with 16 / share
    of them a value of at least ``share`` can't be missed."""
    most = max(64, math.ceil(16 / share))
    summary = F.call_function("approx_top_k_accumulate", F.col(column), F.lit(most)).alias("summary")
    return df.groupBy(*keys).agg(summary, F.count(F.lit(1)).alias("rows"))


def merge_summaries(summaries: DataFrame, keys=()) -> DataFrame:
    return summaries.groupBy(*keys).agg(F.call_function("approx_top_k_combine", F.col("summary")).alias("summary"), F.sum("rows").alias("rows"))


def heavy_candidates(summary: DataFrame, column: str, share: float) -> DataFrame:
    """The values that can hold ``share`` of the rows: at most 2 / share."""
    top = F.call_function("approx_top_k_estimate", F.col("summary"), F.lit(math.ceil(2 / share)))
    return summary.select(F.explode(top).alias("x")).select(F.col("x.item").alias(column))


def heavy_values(df: DataFrame, column: str, share: float, summary: DataFrame | None = None) -> DataFrame:
    """What ``skewed_values`` gives for one column, without a shuffle by
    value: candidates come from a summary, then are counted exactly, all
    other rows as one. A task passes on a row per candidate."""
    found = heavy_candidates(heavy_summary(df, column, share) if summary is None else summary, column, share)
    marked = found.select(F.col(column).alias("_item"), F.lit(True).alias("_found"))
    # at most 2 / share rows: a bounded broadcast
    joined = df.select(column).join(F.broadcast(marked), F.col(column) == F.col("_item"), "left")
    named = F.coalesce("_found", F.col(column).isNull())  # nulls are a value here, as in a GROUP BY
    counts = joined.groupBy(F.when(named, F.col(column)).alias(column), named.alias("_named")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.select(F.sum("n")).scalar()
    return (counts.select(column, "_named", "n", (F.col("n") / total).alias("share"))
            .where(F.col("_named") & (F.col("share") >= F.lit(share))).drop("_named"))


# --- skewed layout --------------------------------------------------------------

REST = "rest"


def write_skewed(df: DataFrame, root: str, column: str, values: DataFrame) -> None:
    """``df`` with a directory for each of the ``values`` (of ``column``; a
    bounded list, such as ``heavy_values`` gives) and one for all the rest:
    ``values_of=<value>`` or ``values_of=rest``, a prefix telling a value
    ``rest`` apart. All columns stay in the files. A large directory is
    written by several tasks."""
    marked = values.select(F.col(column).alias("_item"), F.concat(F.lit("="), F.col(column).cast("string")).alias("values_of"))
    named = df.join(marked, F.col(column).eqNullSafe(F.col("_item")), "left").drop("_item")
    directory = F.when(F.col("values_of").isNotNull(), F.col("values_of")).otherwise(F.lit(REST))
    named.withColumn("values_of", directory).hint("rebalance", "values_of").write.mode("errorifexists").partitionBy("values_of").parquet(root)


def read_skewed(spark: SparkSession, root: str, schema, column: str | None = None, value=None, directory: bool = False) -> DataFrame:
    """The rows of a skewed layout; of one ``value`` of ``column``, from its
    own directory and the rest alone. ``directory`` keeps ``values_of``."""
    df = spark.read.schema(T.StructType([*schema.fields, T.StructField("values_of", T.StringType())])).parquet(root)
    if column is not None:
        own = F.concat(F.lit("="), F.lit(value).cast("string"))
        df = df.where(F.col("values_of").isin(REST) | (F.col("values_of") == own)).where(F.col(column) == F.lit(value))
    return df if directory else df.drop("values_of")
