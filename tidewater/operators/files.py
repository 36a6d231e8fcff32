"""Partition facts from a file listing: one row per file, no data read.

The listing is Spark's own (``binaryFile`` without its content), so a root
written by the streaming file sink is seen through its ``_spark_metadata``
log: files of batches that weren't committed don't count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.schema import PARTITION_KEYS

NULL_DIRECTORY = "__HIVE_DEFAULT_PARTITION__"


def partition_value(path: Column, key: str) -> Column:
    """The value of ``key`` in a partition path, unescaped; null for the null
    partition. Writers escape signs such as ``:`` as ``%3A``."""
    raw = F.regexp_extract(path, f"(?:^|/){key}=([^/]*)", 1)
    plain = F.url_decode(F.regexp_replace(raw, r"\+", "%2B"))
    return F.when((raw != NULL_DIRECTORY) & (raw != ""), plain)


def list_files(spark: SparkSession, root: str | list[str], keys=PARTITION_KEYS) -> DataFrame:
    """(path, directory, length, keys as strings) of every data file under
    ``root`` (or several)."""
    files = spark.read.format("binaryFile").load(root).select("path", "length")
    return files.select(
        "path", F.regexp_replace("path", "/[^/]*$", "").alias("directory"), "length",
        *[partition_value(F.col("path"), k).alias(k) for k in keys])


def partition_sizes(spark: SparkSession, root: str, keys=PARTITION_KEYS) -> DataFrame:
    """Bytes and files of each partition of ``root``."""
    return list_files(spark, root, keys).groupBy(*keys).agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files"))
