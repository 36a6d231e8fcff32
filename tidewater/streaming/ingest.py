"""Streaming ingest: envelope -> decode -> drop rejects -> hour -> landed Parquet.

One streaming query, one decode per record. Per-batch metrics (records,
rejects, first event time) ride along as an ``observe`` on the decoded
stream instead of printing each record on the executors; they appear in
``query.recentProgress[i]["observedMetrics"]``. The sink is Spark's file
sink with a checkpoint: a restart continues where the last committed batch
ended and never lands a batch twice. There is no watermark: a late event
lands in the directory of its own (old) date.

Delivery is at least once: a producer that retries, or a topic that is copied
or replayed, sends a record again with the same place or under a new one.
``delivered_once`` keeps the first of the records with equal keys.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidewater.functions.codec import decode_status, decoded_columns
from tidewater.functions.schema import EVENT_COLUMNS, LANDED_SCHEMA, PARTITION_KEYS, landed_schema
from tidewater.functions.timefn import with_event_hour

METRICS_NAME = "ingest"


#: First partition key of a root that also lands rejected records.
REJECTED = "rejected"
ENVELOPE_PLACE = ("topic", "partition", "offset")


#: Where the state of a deduplicating query lives: on the executors' disks,
#: backed up in the checkpoint, not in their heaps.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
ARRIVAL = "_arrived"
#: Files per hour and micro-batch of a deduplicating query at most.
ONCE_SPREAD = 4


def delivered_once(envelope: DataFrame, within: str, keys=ENVELOPE_PLACE) -> DataFrame:
    """The stream with the first record of each ``keys`` (by default its
    place: topic, partition, offset) that arrives, where repeats come within
    ``within`` of it. The state has one row per record of that time.

    The watermark is on the time of arrival, not of the event: no record is
    ever late, however old its event is."""
    arrived = envelope.withColumn(ARRIVAL, F.current_timestamp()).withWatermark(ARRIVAL, within)
    return arrived.dropDuplicatesWithinWatermark(list(keys)).drop(ARRIVAL)


def ingest_frame(envelope: DataFrame, keep=(), engine: str = "auto", metrics: str = METRICS_NAME,
                 rejects: bool = False) -> DataFrame:
    """Decoded events with ``event_hour``; rejects are counted, then dropped.

    With ``rejects`` they stay, from the same decode, as rows with
    ``rejected = true``, null event columns, the record's place (topic,
    partition, offset) and the reason."""
    status = decode_status(envelope, engine)
    ok = F.col("_e._ok")
    observed = status.observe(
        metrics,
        F.count(F.lit(1)).alias("records"),
        F.count_if(~ok).alias("rejects"),
        F.min(F.date_format("timestamp", "yyyyMMdd")).alias("first_date"),
    )
    if not rejects:
        return with_event_hour(observed.where(ok).select(*decoded_columns(keep)))
    place = [F.col(c).alias(f"reject_{c}") for c in ENVELOPE_PLACE]
    events = [F.when(ok, F.col(f"_e.{n}")).alias(n) for n in EVENT_COLUMNS]
    marked = observed.select(*keep, *events, *place, F.col("_e._reason").alias("reject_reason"), (~ok).alias(REJECTED))
    return with_event_hour(marked)


def start_ingest(
    envelope: DataFrame,
    root: str,
    checkpoint: str,
    every: str = "120 seconds",
    once: bool = False,
    keep=(),
    engine: str = "auto",
    query_name: str | None = None,
    rejects: bool = False,
    spread: int | None = None,
    once_within: str | None = None,
) -> StreamingQuery:
    """Start landing the stream under ``root/event_date=…/event_hour=…``.

    ``every`` is the micro-batch interval; ``once=True`` processes what is
    available now and stops (tests, backfills). The sink is Spark's file
    sink: exactly once, also after a failure between write and commit.

    ``rejects=True`` lands undecodable records as well, by the same decode and
    sink, one directory level up (``rejected=false|true``): ``read_ingested``
    and ``read_rejects`` read the two. ``spread`` is for backfills: each
    micro-batch is shuffled by date, hour and a salt of that many values, so
    a partition gets at most ``spread`` files per batch and not one per task.

    ``once_within`` drops records that are delivered again within that time
    (``delivered_once``), also over restarts; their state is kept in RocksDB.
    Its shuffle by key leaves records of every hour in every task, so what it
    keeps is brought together by ``spread``, ``ONCE_SPREAD`` if not given: a
    file per task and hour costs far more than the shuffle.
    """
    if once_within:
        envelope = delivered_once(envelope, once_within)
        spread = ONCE_SPREAD if spread is None else spread
    frame = ingest_frame(envelope, keep, engine, rejects=rejects)
    keys = (REJECTED, *PARTITION_KEYS) if rejects else PARTITION_KEYS
    if spread:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in frame.columns if c not in keys]), F.lit(spread))
        frame = frame.withColumn("_salt", salt).repartition(*[F.col(k) for k in keys], F.col("_salt")).drop("_salt")
    w = (
        frame.writeStream.format("parquet")
        .partitionBy(*keys)
        .option("path", root)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime=every)
    if not once_within:
        return w.start()
    # A query takes the session's settings when it starts; the session keeps its own.
    conf = envelope.sparkSession.conf
    before = conf.get(STATE_STORE[0], None)
    conf.set(*STATE_STORE)
    try:
        return w.start()
    finally:
        conf.set(STATE_STORE[0], before) if before is not None else conf.unset(STATE_STORE[0])


def _ingested_schema(extra: T.StructType | None = None) -> T.StructType:
    fields = [f for f in landed_schema(extra).fields if f.name not in PARTITION_KEYS]
    fields += [T.StructField("reject_topic", T.StringType()), T.StructField("reject_partition", T.IntegerType()),
               T.StructField("reject_offset", T.LongType()), T.StructField("reject_reason", T.StringType()),
               T.StructField(REJECTED, T.BooleanType())]
    return T.StructType(fields + [f for f in landed_schema().fields if f.name in PARTITION_KEYS])


def read_ingested(spark, root: str, extra: T.StructType | None = None) -> DataFrame:
    """The events of a root landed with ``rejects=True``."""
    df = spark.read.schema(_ingested_schema(extra)).parquet(root).where(~F.col(REJECTED))
    return df.drop(REJECTED, *[c for c in df.columns if c.startswith("reject_")])


def read_rejects(spark, root: str) -> DataFrame:
    """The rejected records of a root landed with ``rejects=True``: topic,
    partition, offset, reason."""
    df = spark.read.schema(_ingested_schema()).parquet(root).where(F.col(REJECTED))
    return df.select(*[F.col(f"reject_{c}").alias(c) for c in (*ENVELOPE_PLACE, "reason")])


def start_fan_out(spark, root: str, checkpoint: str, sinks, schema: T.StructType = LANDED_SCHEMA,
                  every: str = "120 seconds", once: bool = False) -> StreamingQuery:
    """Feed further sinks (callables ``(batch_df, batch_id)``) from the landed
    root, as a stream of its own with its own checkpoint: no second decode,
    and the landing never waits for or repeats because of them. A replayed
    batch reaches a sink again with the same batch id (at least once)."""
    def each_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    w = (spark.readStream.schema(schema).parquet(root).writeStream.foreachBatch(each_batch)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime=every)
    return w.start()


def preview_sink(rows: int = 10):
    """Fan-out sink printing the first ``rows`` events of each batch."""
    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        batch.show(rows, truncate=False)
    return show


def run_ingest(query: StreamingQuery, timeout: float | None = None) -> StreamingQuery:
    """Wait for the query; a failure is re-raised, not swallowed."""
    query.awaitTermination(timeout)
    err = query.exception()
    if err is not None:
        raise err
    return query


PROGRESS_RETENTION = "spark.sql.streaming.numRecentProgressUpdates"


def ingest_metrics(query: StreamingQuery, name: str = METRICS_NAME, partial: bool = False) -> list[dict]:
    """Observed metrics of this run's micro-batches (batch id, records,
    rejects, first event date).

    The query keeps only the last ``spark.sql.streaming.numRecentProgressUpdates``
    progress reports. Once that many have come, older ones may be gone, and
    this raises; ``partial=True`` returns what is left. ``MetricsLog`` keeps all.
    """
    progress = query.recentProgress
    limit = int(query._jsq.sparkSession().conf().get(PROGRESS_RETENTION)) if hasattr(query, "_jsq") else len(progress) + 1
    if not partial and len(progress) >= limit - 1:  # the ring holds one fewer than it is told
        raise RuntimeError(f"{limit} progress reports are kept and earlier ones may be dropped; "
                           f"raise {PROGRESS_RETENTION}, or log with MetricsLog")
    out = []
    for p in progress:
        m = (p.observedMetrics or {}).get(name)
        if m is not None:
            out.append({"batch_id": p.batchId, **m.asDict()})
    return out


METRICS_SCHEMA = "query string, batch_id long, records long, rejects long, first_date string"


class MetricsLog(StreamingQueryListener):
    """Appends one row per micro-batch to a Parquet table at ``root``, as the
    batches finish; nothing is held on the driver. A restarted query may
    report its last batch again: ``read_metrics`` counts it once."""

    def __init__(self, spark, root: str, name: str = METRICS_NAME):
        self.spark, self.root, self.name = spark, root, name
        self.ended: dict[str, threading.Event] = {}
        self.failed: Exception | None = None
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        self.ended.setdefault(str(event.id), threading.Event()).clear()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        m = (p.observedMetrics or {}).get(self.name)
        if m is None:
            return
        row = (str(p.id), int(p.batchId), int(m["records"]), int(m["rejects"]), m["first_date"])
        try:
            self.spark.createDataFrame([row], METRICS_SCHEMA).coalesce(1).write.mode("append").parquet(self.root)
        except Exception as e:  # a listener's error would be lost in the bus
            self.failed = e

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.id), threading.Event()).set()

    def close(self, query: StreamingQuery, timeout: float = 60) -> None:
        """Wait until the ended ``query``'s reports are written, then stop listening."""
        seen = self.ended.setdefault(str(query.id), threading.Event()).wait(timeout)
        self.spark.streams.removeListener(self)
        if self.failed is not None:
            raise self.failed
        if not seen:
            raise RuntimeError(f"no end of query {query.id} within {timeout} s")


def read_metrics(spark, root: str) -> DataFrame:
    """One row per query and batch."""
    return spark.read.schema(METRICS_SCHEMA).parquet(root).dropDuplicates(["query", "batch_id"])


def start_preview(envelope: DataFrame, rows: int = 10, engine: str = "auto", every: str = "120 seconds",
                  once: bool = False) -> StreamingQuery:
    """Print the first ``rows`` decoded events of each micro-batch (console
    sink). A separate query with its own decode; for debugging only."""
    from tidewater.functions.codec import decode_events

    w = (
        decode_events(envelope, engine=engine)
        .writeStream.format("console")
        .option("numRows", str(rows))
        .option("truncate", "false")
    )
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime=every)
    return w.start()


def start_record_log(envelope: DataFrame, fn=None, engine: str = "auto", every: str = "120 seconds",
                     once: bool = False) -> StreamingQuery:
    """Per-record sink, only on request (debugging): ``fn(row)`` runs on the
    executors for every decoded event, as a print of each record would
    (default: print to the executor's stdout). Row-at-a-time Python: keep it
    off the ingest path."""
    from tidewater.functions.codec import decode_events

    w = decode_events(envelope, engine=engine).writeStream.foreach(fn or _print_record)
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime=every)
    return w.start()


def _print_record(row) -> None:
    print(f"Received event: {row.asDict()}")

