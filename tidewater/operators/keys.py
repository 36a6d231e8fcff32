"""Key-constraint checks: primary-key duplicates and nulls, foreign-key orphans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, pk) -> DataFrame:
    """Key values that break a primary key: seen more than once, or with a
    null part. Columns: the key columns, ``n_rows``, ``problem``.

    A counting aggregate: partial counts are combined map-side, so a key
    holding a third of the table costs one row per task in the shuffle.
    """
    pk = [pk] if isinstance(pk, str) else list(pk)
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in pk])
    counted = df.groupBy(*pk).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.where(any_null | (F.col("n_rows") > 1)).withColumn(
        "problem", F.when(any_null, F.lit("null_key")).otherwise(F.lit("duplicate"))
    )


def orphans(child: DataFrame, parent: DataFrame, child_keys, parent_keys=None, nulls: bool = False) -> DataFrame:
    """Child rows whose key has no match in ``parent`` (left anti join).

    The parent side is reduced to its distinct keys first, so a hot parent
    key shuffles one row per task; the optimizer broadcasts the key set
    when its size estimate is small, and AQE splits a hot child key.
    Rows with a null in their key pass, as under an SQL foreign key; with
    ``nulls`` they are reported too.
    """
    child_keys = [child_keys] if isinstance(child_keys, str) else list(child_keys)
    parent_keys = child_keys if parent_keys is None else (
        [parent_keys] if isinstance(parent_keys, str) else list(parent_keys)
    )
    names = [f"_pk{i}" for i in range(len(parent_keys))]
    keys = parent.select(*[F.col(p).alias(n) for p, n in zip(parent_keys, names)]).distinct()
    if not nulls:
        child = child.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in child_keys]))
    cond = reduce(lambda a, b: a & b, [child[c] == keys[n] for c, n in zip(child_keys, names)])
    return child.join(keys, cond, "left_anti")
