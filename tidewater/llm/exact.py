"""Exact dedup by grouping digests in rounds.

Each input partition has a slot and gives its distinct digests, with the
smallest identifier and the count of each. In round r the slots that differ
in digit r in base 16 pass rows on so that each has the digests with its own
r-th hex digit. Every round is a groupBy of slot and digest, which Spark
hashes over all tasks: a slot is a label, no sorted runs are made or merged,
and up to 16 input partitions there is one round, equal in effect to grouping
by digest. A digest has at most one row per slot however many copies it has.

Inputs: null text counts as empty; null ids sort last; repeated rows count
as copies, of which one row stays; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import SPACE, keep_rows, row_keys, text_of, written

FAN_IN = 16  # one hex digit per round


def normalised(column: str = "text") -> F.Column:
    return F.regexp_replace(text_of(column), SPACE, " ")


def digests(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, digest, check): SHA-256 of the normalised text, and a
    second, independent fingerprint that verifies equal digests."""
    norm = docs.select("doc_id", normalised().alias("norm"), *row_keys())
    return norm.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", "k1", "k2",
        F.sha2("norm", 256).alias("digest"),
        F.xxhash64("norm", F.length("norm")).alias("check"))


def tree_merge(rows: DataFrame) -> DataFrame:
    """(digest, check, keep struct<none, doc_id, rid>, n) of a written
    ``digests`` table. Digests count as equal only where ``check`` agrees."""
    slots = max(1, rows.rdd.getNumPartitions())
    rounds = max(1, math.ceil(math.log(slots, FAN_IN)))
    who = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")
    runs = (rows.withColumn("slot", F.spark_partition_id())
            .groupBy("slot", "digest", "check")
            .agg(F.min(who).alias("keep"), F.count(F.lit(1)).alias("n")))
    for r in range(rounds):
        place = FAN_IN ** r
        digit = F.conv(F.substring("digest", r + 1, 1), 16, 10).cast("int")
        own = F.floor(F.col("slot") / place) % FAN_IN
        runs = (runs.withColumn("slot", (F.col("slot") + (digit - own) * place).cast("int"))
                .groupBy("slot", "digest", "check")
                .agg(F.min("keep").alias("keep"), F.sum("n").alias("n")))
    return runs.drop("slot")


def _groups(docs: DataFrame) -> DataFrame:
    rows = written(digests(docs), "exact-digests")
    merged = tree_merge(rows).where("n > 1")
    single = F.col("keep").isNull()
    return rows.join(merged, ["digest", "check"], "left").select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("keep.rid") == F.col("rid"))).alias("kept"),
        F.col("digest").alias("text_sha256"), "k1", "k2")


def exact_groups(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id (smallest doc_id of the equal
    texts), group_size, kept (true for one row of a group), text_sha256."""
    return _groups(docs).drop("k1", "k2")


def drop_exact(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return keep_rows(docs, _groups(docs).where("kept"), once=True)
