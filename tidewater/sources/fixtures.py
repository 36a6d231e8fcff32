"""Adapters from the test tables to the event contract and its envelope.

``events`` (+ ``part`` for product attributes) becomes event rows with the
same 10 fields the producer publishes; ``event_id`` rides along for
ordering. The envelope assigns Kafka-like coordinates:
partition = event_id % 3, offset = event_id div 3.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.codec import encode_events
from tidewater.functions.schema import EVENT_COLUMNS, TOPIC
from tidewater.session import pin_utc
from tidewater.sources.tables import read_table

REPLAY_PARTITIONS = 3


def _fixture_with_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    ev = read_table(spark, sf_dir, "events")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_type", "p_brand")
    e = ev.select(
        "event_id", "ts", "event_type", "value", "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
    )
    # part is a dimension keyed by p_partkey: the optimizer broadcasts it only
    # while its size estimate is under autoBroadcastJoinThreshold, otherwise a
    # sort-merge join with AQE skew splitting of hot product ids on the left.
    j = e.join(part, e.product_id == part.p_partkey, "left")
    day = F.date_format("ts", "yyyyMMdd")
    return j.select(
        "event_id",
        "ts",
        day.alias("event_date"),
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")).alias("event_time"),
        "event_type",
        "product_id",
        F.coalesce(F.col("p_size").cast("bigint"), F.lit(0).cast("bigint")).alias("category_id"),
        F.coalesce(F.lower("p_type"), F.lit("")).alias("category_code"),
        F.coalesce("p_brand", F.lit("")).alias("brand"),
        F.col("value").cast("float").alias("price"),
        "user_id",
        F.concat(F.col("user_id").cast("string"), F.lit("-"), day).alias("user_session"),
    )


def event_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id + the 10 event columns in declared order."""
    return _fixture_with_ts(spark, sf_dir).select("event_id", *EVENT_COLUMNS)


def envelope_fixture(
    spark: SparkSession, sf_dir: str, corrupt_every: int | None = None, chunk: bool = False
) -> DataFrame:
    """Envelope rows for the events.

    ``corrupt_every=n`` replaces the payload of every n-th event id by the
    junk bytes ``ff ff ff``; ``chunk`` adds the event date, used to lay
    replay files out by arrival.
    """
    base = _fixture_with_ts(spark, sf_dir)
    cols = [base[c] for c in EVENT_COLUMNS]
    extra = [F.col("event_id"), F.col("ts")]
    env = encode_events(
        base.select(*extra, *cols),
        topic=TOPIC,
        key=F.col("event_id").cast("string"),
        partition=F.col("event_id") % REPLAY_PARTITIONS,
        offset=F.expr(f"event_id DIV {REPLAY_PARTITIONS}"),
        timestamp=F.col("ts").cast("timestamp"),
    )
    if corrupt_every:
        bad = F.col("key").cast("bigint") % corrupt_every == 0
        env = env.withColumn("value", F.when(bad, F.unhex(F.lit("ffffff"))).otherwise(F.col("value")))
    if chunk:
        env = env.withColumn("chunk", F.date_format("timestamp", "yyyyMMdd"))
    return env
