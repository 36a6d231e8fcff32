"""Row filters and limits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def where_equals(df: DataFrame, column: str, value) -> DataFrame:
    """Exact, case-sensitive equality; null never matches. Pushed to the
    Parquet reader when ``df`` is a file scan."""
    return df.where(F.col(column) == F.lit(value))


def take_rows(df: DataFrame, n: int, order_by=None) -> DataFrame:
    """First ``n`` rows. Without ``order_by`` any ``n`` rows (the batch copy
    job's limit); with it, the top ``n`` by that order, planned as a
    per-partition top-k plus a final merge (TakeOrderedAndProject), never a
    full sort."""
    if order_by is None:
        return df.limit(n)
    cols = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*cols).limit(n)
