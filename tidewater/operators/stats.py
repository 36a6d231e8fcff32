"""Table and partition column statistics, in the metastore's column-stats shape.

One aggregation pass computes every statistic of every column; the result
(one row per group) is then unpivoted to one row per column. Distinct counts
use HyperLogLog++ (``approx_count_distinct``, within 5 % as a rule), which
keeps the pass single-stage at scale; an exact count makes Spark expand each
input row once more, so exact columns are named one by one.

Dates are days and timestamps seconds since 1970 in the long columns;
decimals are exact, as text, in columns of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STAT_FIELDS = [
    ("long_low", T.LongType()),
    ("long_high", T.LongType()),
    ("double_low", T.DoubleType()),
    ("double_high", T.DoubleType()),
    ("decimal_low", T.StringType()),
    ("decimal_high", T.StringType()),
    ("num_nulls", T.LongType()),
    ("num_distincts", T.LongType()),
    ("avg_col_len", T.DoubleType()),
    ("max_col_len", T.LongType()),
    ("num_trues", T.LongType()),
    ("num_falses", T.LongType()),
]


def _kind(dt: T.DataType) -> str:
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "long"
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return "double"
    if isinstance(dt, T.DecimalType):
        return "decimal"
    if isinstance(dt, T.DateType):
        return "date"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "time"
    if isinstance(dt, (T.StringType, T.BinaryType)):
        return "string"
    if isinstance(dt, T.BooleanType):
        return "boolean"
    return "other"


_NUMBER = {
    "long": lambda c: c.cast("bigint"),
    "double": lambda c: c.cast("double"),
    "decimal": lambda c: c.cast("string"),
    "date": F.unix_date,
    "time": lambda c: F.unix_seconds(c.cast("timestamp")),
}
_LOW_HIGH = {"long": "long", "double": "double", "decimal": "decimal", "date": "long", "time": "long"}


def column_stats(df: DataFrame, keys=(), columns=None, exact=(), len_digits: int = 6) -> DataFrame:
    """Per column (and per group of ``keys``): low/high, nulls, distinct,
    average and maximum length, trues and falses. ``exact`` names the columns
    whose distinct values are counted exactly (True: all of them)."""
    keys = list(keys)
    fields = [f for f in df.schema.fields if f.name not in keys and (columns is None or f.name in columns)]
    aggs = []
    per_col = []
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        kind = _kind(f.dataType)
        p = f"c{i}_"
        stat = {name: F.lit(None).cast(t) for name, t in STAT_FIELDS}
        aggs.append((F.count(F.lit(1)) - F.count(c)).alias(p + "num_nulls"))
        aggs.append((F.count_distinct(c) if exact is True or f.name in (exact or ()) else F.approx_count_distinct(c)).alias(p + "num_distincts"))
        wanted = ["num_nulls", "num_distincts"]
        if kind in _NUMBER:
            to = _LOW_HIGH[kind]
            aggs.append(_NUMBER[kind](F.min(c)).alias(p + f"{to}_low"))
            aggs.append(_NUMBER[kind](F.max(c)).alias(p + f"{to}_high"))
            wanted += [f"{to}_low", f"{to}_high"]
        elif kind == "string":
            ln = F.length(c) if isinstance(f.dataType, T.StringType) else F.octet_length(c)
            aggs.append(F.round(F.avg(ln), len_digits).alias(p + "avg_col_len"))
            aggs.append(F.max(ln).cast("bigint").alias(p + "max_col_len"))
            wanted += ["avg_col_len", "max_col_len"]
        elif kind == "boolean":
            aggs.append(F.count_if(c).alias(p + "num_trues"))
            aggs.append(F.count_if(~c).alias(p + "num_falses"))
            wanted += ["num_trues", "num_falses"]
        for name in wanted:
            stat[name] = F.col(p + name)
        per_col.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("column_type"),
                *[stat[name].cast(t).alias(name) for name, t in STAT_FIELDS],
            )
        )
    wide = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    return wide.select(*keys, F.explode(F.array(*per_col)).alias("s")).select(*keys, "s.*")
