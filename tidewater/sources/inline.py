"""Inline rows with a declared schema (the smoke job's source)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidewater.functions.schema import PEOPLE_SCHEMA

# The smoke job's four inline rows (name, age, location).
PEOPLE_ROWS = [
    ("Alice", 30, "New York"),
    ("Bob", 25, "San Francisco"),
    ("Cathy", 28, "Los Angeles"),
    ("David", 30, "San Francisco"),
]


def inline_rows(spark: SparkSession, rows, schema: T.StructType = PEOPLE_SCHEMA) -> DataFrame:
    """A small driver-side literal table (LocalRelation); for config-sized
    inputs only, never for data."""
    return spark.createDataFrame(list(rows), schema)


def people(spark: SparkSession) -> DataFrame:
    return inline_rows(spark, PEOPLE_ROWS, PEOPLE_SCHEMA)
