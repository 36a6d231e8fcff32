"""Scans of the landed event table (Parquet, ``event_date=/event_hour=``).

Always read with a declared schema so the partition keys keep their types
(``event_date`` string, ``event_hour`` int) instead of being inferred.
A filter on ``event_date`` prunes directories (``PartitionFilters``);
filters on data columns are pushed to the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.schema import LANDED_SCHEMA


def read_landed(
    spark: SparkSession, root: str, date: str | None = None, schema: T.StructType = LANDED_SCHEMA
) -> DataFrame:
    """Root scan with partition discovery; both keys come back as the last columns."""
    df = spark.read.schema(schema).parquet(root)
    if date is not None:
        df = df.where(F.col("event_date") == F.lit(date))
    return df


def read_partition_dir(
    spark: SparkSession, root: str, date: str, schema: T.StructType = LANDED_SCHEMA, keep_date: bool = False
) -> DataFrame:
    """Scan of one ``event_date=<date>`` leaf directory, as the batch copy job
    does: ``event_date`` is not part of the result, ``event_hour`` is.
    ``keep_date=True`` reads it relative to the root (``basePath``) so the
    date column is kept."""
    leaf = f"{root.rstrip('/')}/event_date={date}"
    if keep_date:
        return spark.read.schema(schema).option("basePath", root).parquet(leaf)
    no_date = T.StructType([f for f in schema.fields if f.name != "event_date"])
    return spark.read.schema(no_date).parquet(leaf)
