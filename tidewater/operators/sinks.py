"""Batch sinks: partitioned append, CSV and Parquet overwrite, preview."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewater.functions.schema import PARTITION_KEYS


def append_events(df: DataFrame, root: str, keys=PARTITION_KEYS) -> None:
    """Append rows under ``root/event_date=…/event_hour=…``.

    Keys are removed from the files; a null key (or an empty ``event_date``)
    goes to ``__HIVE_DEFAULT_PARTITION__`` and reads back as null. Appending
    twice doubles the rows (bag union, no de-duplication).

    A REBALANCE on the keys first brings each partition's rows together,
    so files ~ partitions rather than tasks x partitions; AQE coalesces small
    partitions and splits a hot one (say, one hour holding a third of the
    batch) over several tasks and files instead of one straggler.
    """
    (
        df.hint("rebalance", *keys)
        .write.mode("append")
        .partitionBy(*keys)
        .parquet(root)
    )


def overwrite_csv(df: DataFrame, path: str) -> None:
    """A directory of CSV part files; no header, ``,`` separator, ``"`` quote
    with ``\\`` escape. Replaces whatever was at ``path``."""
    df.write.mode("overwrite").csv(path)


def read_csv(spark, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).csv(path)


def overwrite_parquet(df: DataFrame, path: str) -> None:
    """Replaces the whole target."""
    df.write.mode("overwrite").parquet(path)


def preview(df: DataFrame, n: int = 20, truncate: bool = True) -> None:
    """Tabular preview for debugging (prints; only ``n`` rows are fetched)."""
    df.show(n, truncate=truncate)
