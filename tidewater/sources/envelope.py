"""The event envelope: Kafka topic, or replayed files with the same schema.

Both kinds yield the Kafka record shape
``key string, value binary, topic string, partition int, offset bigint,
timestamp timestamp``. The Kafka kind needs the spark-sql-kafka connector
on the classpath (absent in this image, so untested here); the replay kind
reads Parquet files of envelope rows as a file stream.

Start position: ``"earliest"`` reads everything; ``"latest"`` (the ingest
job's setting) sees only records written after the first start. For the
replay kind the start offsets are computed once, at the first start, from
the files present then, and stored beside the query checkpoint, so a
restart on the same checkpoint continues instead of recomputing them.
A JSON/dict of explicit offsets ``{topic: {partition: offset}}`` is also
accepted (-2 means earliest, -1 latest).
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.schema import ENVELOPE_SCHEMA, TOPIC

ENVELOPE_COLUMNS = [f.name for f in ENVELOPE_SCHEMA.fields]

START_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("start_offset", T.LongType(), True),
])


def write_replay(envelope: DataFrame, root: str, chunk: str | None = None) -> None:
    """Append envelope rows as replay files.

    With ``chunk``, each chunk value goes to its own ``chunk=<v>``
    directory, so a reader with ``maxFilesPerTrigger=1`` sees one chunk
    per micro-batch. AQE splits an oversized chunk into several files.
    """
    if chunk is None:
        envelope.select(*ENVELOPE_COLUMNS).write.mode("append").parquet(root)
        return
    (
        envelope.select(*ENVELOPE_COLUMNS, chunk)
        .hint("rebalance", chunk)
        .write.mode("append")
        .partitionBy(chunk)
        .parquet(root)
    )


def publish_events(envelope: DataFrame, brokers: str, topic: str | None = None) -> None:
    """Publish envelope rows (key, value, partition) to a Kafka topic with
    the batch Kafka sink (needs the spark-sql-kafka connector). A row with a
    null partition is placed by the sink's partitioner. Without ``topic``
    each row's own ``topic`` column is used."""
    cols = publish_columns(topic)
    w = envelope.select(*cols).write.format("kafka").option("kafka.bootstrap.servers", brokers)
    if topic is not None:
        w = w.option("topic", topic)
    w.save()


def publish_columns(topic: str | None = None) -> list[str]:
    """The columns the Kafka sink gets."""
    return ["key", "value", "partition"] + (["topic"] if topic is None else [])


def _read_or_none(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    try:
        # Resolving a file source checks that the path exists.
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return None


def _ends(spark: SparkSession, path: str) -> DataFrame:
    """Per topic-partition, the offset after the last record present."""
    existing = _read_or_none(spark, path, ENVELOPE_SCHEMA)
    if existing is None:
        return spark.createDataFrame([], START_SCHEMA)
    return existing.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("start_offset"))


def _explicit_starts(spark: SparkSession, path: str, starting) -> DataFrame:
    spec = json.loads(starting) if isinstance(starting, str) else starting
    rows = [(topic, int(p), int(off)) for topic, parts in spec.items() for p, off in parts.items()]
    given = spark.createDataFrame(rows, START_SCHEMA)
    ends = _ends(spark, path).withColumnRenamed("start_offset", "_end")
    at = F.col("start_offset")
    return given.join(ends, ["topic", "partition"], "left").select(
        "topic", "partition",
        F.when(at == -2, F.lit(0)).when(at == -1, F.coalesce("_end", F.lit(0))).otherwise(at).cast("long").alias("start_offset"))


def start_positions(spark: SparkSession, path: str, checkpoint: str, starting) -> DataFrame:
    """Per (topic, partition) first offset to read, fixed at the first start.

    One row per topic-partition, so the table's size is bounded by the
    partition count of the topic, not by the data.
    """
    saved_path = f"{checkpoint.rstrip('/')}/_start_positions"
    saved = _read_or_none(spark, saved_path, START_SCHEMA)
    if saved is not None:
        return saved
    starts = _ends(spark, path) if starting == "latest" else _explicit_starts(spark, path, starting)
    starts.coalesce(1).write.mode("errorifexists").parquet(saved_path)
    return spark.read.schema(START_SCHEMA).parquet(saved_path)


def event_envelope(
    spark: SparkSession,
    kind: str = "replay",
    path: str | None = None,
    brokers: str | None = None,
    topic: str = TOPIC,
    starting="latest",
    checkpoint: str | None = None,
    max_files_per_trigger: int | None = None,
    latest_first: bool = False,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    group_id: str | None = None,
) -> DataFrame:
    """Streaming DataFrame of envelope records from Kafka or replay files.

    For Kafka, ``min_partitions`` splits large topic-partitions into several
    Spark tasks per micro-batch, so decode parallelism is not capped by the
    topic's partition count; ``max_offsets_per_trigger`` bounds a batch.
    """
    if kind == "kafka":
        r = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", brokers)
            .option("subscribe", topic)
            .option("startingOffsets", starting if isinstance(starting, str) else json.dumps(starting))
            .option("failOnDataLoss", "true")
        )
        if max_offsets_per_trigger:
            r = r.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
        if min_partitions:
            r = r.option("minPartitions", str(min_partitions))
        if group_id:
            # positions live in the query checkpoint; the group id only names
            # the consumer for broker-side quotas and ACLs
            r = r.option("kafka.group.id", group_id)
        raw = r.load()
        return raw.select(F.col("key").cast("string").alias("key"), *ENVELOPE_COLUMNS[1:])
    if kind != "replay":
        raise ValueError(f"unknown envelope kind {kind!r}")
    r = spark.readStream.schema(ENVELOPE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if latest_first:
        r = r.option("latestFirst", "true")
    env = r.parquet(path).where(F.col("topic") == F.lit(topic))
    if starting == "earliest":
        return env
    if checkpoint is None:
        raise ValueError("a start position other than 'earliest' needs the query checkpoint")
    starts = start_positions(spark, path, checkpoint, starting)
    # Bounded by the number of topic-partitions: safe to broadcast.
    kept = env.join(F.broadcast(starts), ["topic", "partition"], "left").where(
        F.col("start_offset").isNull() | (F.col("offset") >= F.col("start_offset"))
    )
    return kept.select(*ENVELOPE_COLUMNS)


def read_replay(spark: SparkSession, path: str) -> DataFrame:
    """Batch view of replay files (same schema)."""
    return spark.read.schema(ENVELOPE_SCHEMA).parquet(path)
