"""Mergeable statistics: sketches stored per partition, merged on read.

Per partition and column the store has exact counts and bounds, a HyperLogLog
sketch of the distinct values and, for numbers, dates and times, a KLL sketch
of the quantiles. Statistics of the table, or of any part of it, come from
merging those rows: the data isn't read again, and after an append only its
partitions are scanned (``refresh``).

Bounds and quantiles are doubles; NaN is a value, but in neither. Dates are
days, timestamps seconds since 1970. Strings have lengths. A column of any
other type has nulls and distinct values only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.schema import LANDED_SCHEMA, PARTITION_KEYS
from tidewater.operators.refresh import refresh
from tidewater.operators.stats import _NUMBER, _kind

HLL_LOG_K = 14  # standard error 0.8 %
KLL_K = 800  # rank error 0.4 % or so
QUANTILES = (0.01, 0.25, 0.5, 0.75, 0.99)


def _number(field: T.StructField) -> Column | None:
    """The column as a double, where its kind has an order that quantiles show."""
    kind, c = _kind(field.dataType), F.col(f"`{field.name}`")
    if kind == "decimal":
        return c.cast("double")
    if kind == "double":
        return F.when(~F.isnan(c), c.cast("double"))
    return _NUMBER[kind](c).cast("double") if kind in _NUMBER else None


def _distinct_key(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    # A sketch ignores empty strings, so strings go in by hash.
    return c if isinstance(field.dataType, (T.IntegerType, T.LongType)) else F.when(c.isNotNull(), F.xxhash64(c))


def sketch_fields(schema: T.StructType, keys=(), columns=None) -> list[T.StructField]:
    return [f for f in schema.fields if f.name not in keys and (columns is None or f.name in columns)]


def sketch_partitions(df: DataFrame, keys=PARTITION_KEYS, columns=None) -> DataFrame:
    """One row per partition: the keys, ``rows``, and ``columns``, an array of
    the sketches of each column. One aggregation; partial sketches are merged
    map-side, so a hot partition costs a row per task."""
    fields = sketch_fields(df.schema, keys, columns)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(fields):
        c, number, text = F.col(f"`{f.name}`"), _number(f), _kind(f.dataType) == "string"
        length = F.length(c) if isinstance(f.dataType, T.StringType) else F.octet_length(c) if text else None
        aggs += [F.count(c).alias(f"n{i}"), F.hll_sketch_agg(_distinct_key(f), HLL_LOG_K).alias(f"h{i}")]
        if number is not None:
            aggs += [F.min(number).alias(f"lo{i}"), F.max(number).alias(f"hi{i}"), F.kll_sketch_agg_double(number, KLL_K).alias(f"k{i}")]
        if text:
            aggs += [F.sum(length).alias(f"sum{i}"), F.max(length).alias(f"max{i}")]
    made = df.groupBy(*keys).agg(*aggs)
    have = set(made.columns)

    def part(name: str, kind: str) -> Column:
        return (F.col(name) if name in have else F.lit(None)).cast(kind)

    return made.select(*keys, "rows", F.array(*[F.struct(
        F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("column_type"),
        (F.col("rows") - F.col(f"n{i}")).alias("num_nulls"), part(f"lo{i}", "double").alias("low"), part(f"hi{i}", "double").alias("high"),
        part(f"sum{i}", "bigint").alias("sum_len"), part(f"max{i}", "bigint").alias("max_len"),
        part(f"h{i}", "binary").alias("hll"), part(f"k{i}", "binary").alias("kll")) for i, f in enumerate(fields)]).alias("columns"))


def merge_sketches(stored: DataFrame, by=(), quantiles=QUANTILES) -> DataFrame:
    """Statistics per column (and per group of ``by``, partition columns) from
    stored rows: rows, num_nulls, low, high, distincts (estimate), avg and
    max length, quantiles (an array, estimates). The data isn't read."""
    each = stored.where("rows > 0").select(*by, "rows", F.explode("columns").alias("c")).select(*by, "rows", "c.*")
    merged = each.groupBy(*by, "column_name", "column_type").agg(
        F.sum("rows").alias("rows"), F.sum("num_nulls").alias("num_nulls"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.hll_sketch_estimate(F.hll_union_agg("hll")).alias("distincts"),
        F.sum("sum_len").alias("sum_len"), F.max("max_len").alias("max_col_len"),
        F.kll_merge_agg_double("kll", KLL_K).alias("kll"))
    known = F.col("rows") - F.col("num_nulls")
    asked = F.array(*[F.lit(float(q)) for q in quantiles])
    return merged.select(
        *by, "column_name", "column_type", "rows", "num_nulls", "low", "high", "distincts",
        F.when(known > 0, F.round(F.col("sum_len") / known, 6)).alias("avg_col_len"), "max_col_len",
        F.when(F.col("low").isNotNull(), F.kll_sketch_get_quantile_double("kll", asked)).alias("quantiles"))


def refresh_sketches(
    spark: SparkSession, store: str, root: str, keys=PARTITION_KEYS, schema: T.StructType = LANDED_SCHEMA, columns=None,
) -> tuple[DataFrame, DataFrame]:
    """Bring the sketches of ``root`` up to date: (rows that count, partitions
    that were scanned). ``merge_sketches`` of the first gives statistics."""
    return refresh(spark, store, root, lambda rows: sketch_partitions(rows, keys, columns), keys, schema)
