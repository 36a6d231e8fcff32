"""Results kept per partition, refreshed from a file listing.

A store is an append-only Parquet table with one row per computed partition:
its keys, a fingerprint of the files it was computed from, and the result.
The rows that count are those whose fingerprint equals that of the files
listed now, so a changed partition is computed anew, one that is gone drops
out by itself, and what an interrupted run leaves is either used or never
read. Nothing is rewritten in place. ``vacuum`` writes the rows that count to
a new store.

Only new and changed partitions are scanned: their key values (partition
metadata, not data) become a partition filter.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.schema import LANDED_SCHEMA, PARTITION_KEYS
from tidewater.operators.files import list_files
from tidewater.session import workspace

FILTER_PARTITIONS = 5_000  # beyond, a filter by value costs more than the files it saves


def partition_state(spark: SparkSession, root: str, keys=PARTITION_KEYS, schema: T.StructType = LANDED_SCHEMA) -> DataFrame:
    """(keys, files, bytes, fingerprint) of every partition, from a listing."""
    types = {f.name: f.dataType for f in schema.fields}
    listed = list_files(spark, root, keys).select(*[F.col(k).cast(types[k]).alias(k) for k in keys], "path", "length")
    return listed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
        F.sum(F.xxhash64("path", "length").cast("decimal(38,0)")).alias("fingerprint"))


def same_keys(left: DataFrame, right: DataFrame, names) -> Column:
    """Null-safe equality of columns of two frames."""
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names])


def partition_filter(parts: DataFrame, keys) -> Column | None:
    """A filter on partition columns that only ``parts`` pass (a superset
    where a partition has more than two keys); None for too many of them."""
    rows = [tuple(r) for r in parts.select(*keys).distinct().limit(FILTER_PARTITIONS + 1).collect()]
    if len(rows) > FILTER_PARTITIONS:
        return None
    last: dict[tuple, list] = {}
    for r in rows:
        last.setdefault(r[:-1], []).append(r[-1])

    def among(key: str, values: list) -> Column:
        known = [v for v in values if v is not None]
        found = F.col(key).isin(known) if known else F.lit(False)
        return found | F.col(key).isNull() if None in values else found

    # Equal lists of last values share one test: 24 hours of 30 days are one.
    shared: dict[tuple, list[tuple]] = {}
    for head, values in last.items():
        shared.setdefault(tuple(sorted(values, key=str)), []).append(head)
    tests = []
    for values, heads in shared.items():
        test = among(keys[-1], list(values))
        for i, k in enumerate(keys[:-1]):
            test = test & among(k, list({h[i] for h in heads}))
        tests.append(test)
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)


def scan_partitions(spark: SparkSession, root: str, parts: DataFrame, keys=PARTITION_KEYS, schema: T.StructType = LANDED_SCHEMA) -> DataFrame:
    """The rows of the partitions ``parts`` of ``root``; others aren't opened."""
    rows = spark.read.schema(schema).parquet(root)
    test = partition_filter(parts, keys)
    if test is not None:
        rows = rows.where(test)
    wanted = parts.select(*[F.col(k).alias(f"_w{i}") for i, k in enumerate(keys)]).distinct()
    return rows.join(wanted, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_w{i}")) for i, k in enumerate(keys)]), "left_semi")


def read_store(spark: SparkSession, store: str) -> DataFrame | None:
    """All rows ever stored; None where the store doesn't exist yet."""
    try:
        return spark.read.parquet(store)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _current(stored: DataFrame, now: DataFrame, keys) -> DataFrame:
    known = [*keys, "fingerprint"]
    return stored.join(now.select(*known), same_keys(stored, now, known), "left_semi").dropDuplicates(known)


def refresh(
    spark: SparkSession,
    store: str,
    root: str,
    compute: Callable[[DataFrame], DataFrame],
    keys=PARTITION_KEYS,
    schema: T.StructType = LANDED_SCHEMA,
) -> tuple[DataFrame, DataFrame]:
    """Bring ``store`` up to date with ``root``. ``compute`` takes the rows of
    some partitions and gives one row per partition: the keys and the result.
    Returns the rows that count now, and the partitions that were computed."""
    path = workspace(spark, "partition-state")
    partition_state(spark, root, keys, schema).write.parquet(path)
    now = spark.read.parquet(path)
    stored = read_store(spark, store)
    stale = now if stored is None else now.join(stored, same_keys(now, stored, [*keys, "fingerprint"]), "left_anti")
    if stored is None or not stale.isEmpty():
        made = compute(scan_partitions(spark, root, stale, keys, schema))
        results = [c for c in made.columns if c not in keys]
        # From the listing, so that a partition without rows is stored too.
        stale.join(made, same_keys(stale, made, keys), "left").select(*[stale[k] for k in keys], "fingerprint", "files", "bytes", *results).write.mode("append").parquet(store)
    # The computed partitions are read off the stores before and after.
    after = spark.read.parquet(store)
    return _current(after, now, keys), stale


def vacuum(spark: SparkSession, store: str, root: str, to: str, keys=PARTITION_KEYS, schema: T.StructType = LANDED_SCHEMA) -> None:
    """The rows of ``store`` that count, written to the new store ``to``."""
    _current(spark.read.parquet(store), partition_state(spark, root, keys, schema), keys).write.parquet(to)
