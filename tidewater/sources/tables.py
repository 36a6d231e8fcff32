"""Test tables, the SQL catalog over them, and saved views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_catalog(spark: SparkSession, sf_dir: str, tables=TABLES, prefix: str = "") -> list[str]:
    """Register each table as a temp view; returns the view names."""
    names = []
    for t in tables:
        read_table(spark, sf_dir, t).createOrReplaceTempView(prefix + t)
        names.append(prefix + t)
    return names


def save_view(spark: SparkSession, name: str, sql: str, stored: bool = False) -> DataFrame:
    """A saved view is SQL text; reading it plans the text again.

    By default it lives in the session; ``stored`` keeps it in the catalog
    (with a metastore, for every session), over tables or files, not over
    session views. ``drop_view`` removes it."""
    kind = "VIEW" if stored else "TEMP VIEW"
    spark.sql(f"CREATE OR REPLACE {kind} {name} AS {sql}")
    return spark.table(name)


def drop_view(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP VIEW IF EXISTS {name}")
