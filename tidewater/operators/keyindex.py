"""Incremental primary-key check: an index of known keys, asked by each batch.

The index is an append-only folder of two tables. ``keys`` has a row per
distinct key of each batch: two fingerprints of 64 bits and the count, in
directories of hash buckets. ``filters`` has a Bloom filter per batch and
bucket. A batch first meets the filters (a few bytes a key); only keys that
may be known go on to the buckets that they fall in, so old data, and most of
the old keys, aren't read. Keys count as equal where both fingerprints agree.

A bucket's filters are merged into fewer by ``merge_filters`` when batches
have become many; the verdicts don't change.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.refresh import read_store
from tidewater.session import workspace

BUCKETS = 64
BITS_PER_KEY = 10
HASHES = 5
SEGMENT = 32_768


def _prints(pk) -> list[Column]:
    """Two fingerprints of a key, nulls included."""
    parts = [x for k in pk for x in (F.col(k).isNull(), F.col(k))]
    return [F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(7), *parts, F.lit(11)).alias("h2")]


def _bit(h1: Column, h2: Column, i: int, segments: Column) -> Column:
    """The place of hash ``i`` in a filter of so many segments (double hashing)."""
    return F.pmod(F.pmod(h1, F.lit(2**40)) + F.lit(i) * F.pmod(h2, F.lit(2**40)), segments * SEGMENT)


def _filters(keys: DataFrame) -> DataFrame:
    """(bucket, segments, bits): a filter per bucket of ``keys``."""
    sizes = keys.groupBy("bucket").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) * BITS_PER_KEY / SEGMENT)).cast("bigint").alias("segments"))
    at = F.explode(F.array(*[_bit(F.col("h1"), F.col("h2"), i, F.col("segments")) for i in range(HASHES)])).alias("at")
    maps = (keys.join(sizes, "bucket").select("bucket", "segments", at)
            .groupBy("bucket", "segments", F.floor(F.col("at") / SEGMENT).alias("segment")).agg(F.bitmap_construct_agg(F.col("at") % SEGMENT).alias("bitmap"))
            .groupBy("bucket", "segments").agg(F.map_from_entries(F.collect_list(F.struct("segment", "bitmap"))).alias("maps")))
    return maps.select("bucket", "segments", F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("segments") - 1), lambda s: F.col("maps")[s]).alias("bits"))


def _may_be_in() -> Column:
    """Whether a key (h1, h2) may be in the filter beside it."""
    def held(i: int) -> Column:
        at = _bit(F.col("h1"), F.col("h2"), i, F.col("segments"))
        byte = F.substring(F.get(F.col("bits"), F.floor(at / SEGMENT).cast("int")), (F.floor((at % SEGMENT) / 8) + 1).cast("int"), F.lit(1))
        return F.coalesce(F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(F.call_function("shiftleft", F.lit(1), (at % 8).cast("int"))) != 0, F.lit(False))

    return reduce(lambda a, b: a & b, [held(i) for i in range(HASHES)])


def check_batch(spark: SparkSession, index: str, batch: DataFrame, pk, buckets: int = BUCKETS) -> DataFrame:
    """Check a batch against itself and all batches before, then add its keys
    to the index. Returns the key values that break the primary key now:
    the key columns, ``n_rows`` (in all batches) and ``problem``, as
    ``duplicate_keys`` does. ``batch`` is aggregated once; its distinct keys
    are written under the shared folder."""
    pk = [pk] if isinstance(pk, str) else list(pk)
    path = workspace(spark, "batch-keys")
    (batch.groupBy(*pk).agg(F.count(F.lit(1)).alias("n_batch")).select(*pk, "n_batch", *_prints(pk))
     .withColumn("bucket", F.pmod(F.col("h1"), F.lit(buckets)).cast("int")).write.parquet(path))
    own = spark.read.parquet(path)

    known = _known(spark, index, own)
    counted = own.select(*pk, "n_batch", F.lit(0).cast("bigint").alias("n_known")) if known is None else (
        own.join(known, ["bucket", "h1", "h2"], "left").select(*pk, "n_batch", F.coalesce("n_known", F.lit(0)).alias("n_known")))
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in pk])
    total = F.col("n_batch") + F.col("n_known")
    broken = counted.where(null | (total > 1)).select(*pk, total.alias("n_rows"), F.when(null, F.lit("null_key")).otherwise(F.lit("duplicate")).alias("problem"))
    found = workspace(spark, "broken-keys")
    broken.write.parquet(found)  # before the batch's own keys are known

    # Keys first: a run that dies in between leaves keys without a filter,
    # which aren't seen; a run of the same batch again adds them anew.
    run = uuid.uuid4().hex
    keyed = own.select(F.lit(run).alias("run"), "bucket", "h1", "h2", F.col("n_batch").alias("n"))
    keyed.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(f"{index}/keys")
    _filters(own.select("bucket", "h1", "h2")).select(F.array(F.lit(run)).alias("runs"), "bucket", "segments", "bits").write.mode("append").parquet(f"{index}/filters")
    return spark.read.parquet(found)


def _known(spark: SparkSession, index: str, own: DataFrame) -> DataFrame | None:
    """(bucket, h1, h2, n_known) of the keys of ``own`` that batches before had."""
    filters, keys = read_store(spark, f"{index}/filters"), read_store(spark, f"{index}/keys")
    if filters is None or keys is None:
        return None
    maybe = (own.select("bucket", "h1", "h2").join(filters, "bucket").where(_may_be_in())
             .select("bucket", "h1", "h2", F.explode("runs").alias("run")).distinct())
    wanted = [r["bucket"] for r in maybe.select("bucket").distinct().collect()]  # at most ``buckets``
    return (keys.where(F.col("bucket").isin(wanted)).join(maybe, ["bucket", "run", "h1", "h2"], "left_semi").select("bucket", "run", "h1", "h2", "n").distinct()
            .groupBy("bucket", "h1", "h2").agg(F.sum("n").alias("n_known")))


def merge_filters(spark: SparkSession, index: str, to: str) -> None:
    """An index with one filter per bucket, made from the keys, at ``to``."""
    keys, filters = spark.read.parquet(f"{index}/keys"), spark.read.parquet(f"{index}/filters")
    runs = filters.select(F.explode("runs").alias("run")).distinct()
    valid = keys.join(runs, "run", "left_semi").select("run", "bucket", "h1", "h2", "n")
    valid.repartition("bucket").write.partitionBy("bucket").parquet(f"{to}/keys")
    of = valid.groupBy("bucket").agg(F.collect_set("run").alias("runs"))
    _filters(valid.select("bucket", "h1", "h2").distinct()).join(of, "bucket").select("runs", "bucket", "segments", "bits").write.parquet(f"{to}/filters")
