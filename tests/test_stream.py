"""Streaming ingest over replay files: batches, restart, late data, start
position, metrics."""

from pyspark.sql import functions as F

from testkit import SF001
from tidewater.functions.codec import decode_events
from tidewater.functions.schema import PARTITION_KEYS
from tidewater.functions.timefn import with_event_hour
from tidewater.sources.envelope import event_envelope, read_replay, write_replay
from tidewater.sources.fixtures import envelope_fixture
from tidewater.sources.landed import read_landed
from tidewater.streaming.ingest import ONCE_SPREAD, ingest_metrics, run_ingest, start_ingest


def _run(spark, topic, out, ck, **kw):
    starting = kw.pop("starting", "earliest")
    env = event_envelope(spark, "replay", path=topic, starting=starting, checkpoint=ck, **kw)
    return run_ingest(start_ingest(env, out, ck, once=True))


def _counts(df):
    return {(r.event_date, r.event_hour): r.n for r in df.groupBy("event_date", "event_hour")
            .agg(F.count(F.lit(1)).alias("n")).collect()}


def test_stream_equals_batch_and_restart_adds_nothing(spark, scratch):
    base = scratch("st")
    env = envelope_fixture(spark, SF001, corrupt_every=50, chunk=True)
    days = F.col("chunk").isin("20240101", "20240102", "20240103")
    write_replay(env.where(days), f"{base}/topic", chunk="chunk")
    q = _run(spark, f"{base}/topic", f"{base}/out", f"{base}/ck", max_files_per_trigger=1)
    metrics = ingest_metrics(q)
    assert len(metrics) == 3  # one file (one date) per micro-batch
    batch = decode_events(read_replay(spark, f"{base}/topic"))
    landed = read_landed(spark, f"{base}/out")
    assert landed.count() == batch.count() == sum(m["records"] - m["rejects"] for m in metrics)
    assert sum(m["rejects"] for m in metrics) == env.where(days & (F.col("key") % 50 == 0)).count()
    # restart on the same checkpoint: nothing new, nothing twice
    _run(spark, f"{base}/topic", f"{base}/out", f"{base}/ck", max_files_per_trigger=1)
    assert read_landed(spark, f"{base}/out").count() == landed.count()


def test_late_file_lands_in_its_old_date(spark, scratch):
    base = scratch("late")
    env = envelope_fixture(spark, SF001, chunk=True)
    write_replay(env.where(F.col("chunk") == "20240110"), f"{base}/topic", chunk="chunk")
    _run(spark, f"{base}/topic", f"{base}/out", f"{base}/ck")
    before = _counts(read_landed(spark, f"{base}/out"))
    assert {d for d, _ in before} == {"20240110"}
    write_replay(env.where(F.col("chunk") == "20240102"), f"{base}/topic", chunk="chunk")
    _run(spark, f"{base}/topic", f"{base}/out", f"{base}/ck")
    after = _counts(read_landed(spark, f"{base}/out"))
    assert {d for d, _ in after} == {"20240110", "20240102"}
    assert {k: v for k, v in after.items() if k[0] == "20240110"} == before


def test_latest_start_skips_existing_records(spark, scratch):
    base = scratch("latest")
    env = envelope_fixture(spark, SF001, chunk=True)
    write_replay(env.where(F.col("chunk") == "20240101"), f"{base}/topic", chunk="chunk")
    _run(spark, f"{base}/topic", f"{base}/out", f"{base}/ck", starting="latest")
    assert read_landed(spark, f"{base}/out").count() == 0
    write_replay(env.where(F.col("chunk") == "20240102"), f"{base}/topic", chunk="chunk")
    _run(spark, f"{base}/topic", f"{base}/out", f"{base}/ck", starting="latest")
    got = read_landed(spark, f"{base}/out")
    assert got.count() == env.where(F.col("chunk") == "20240102").count()
    assert {r.event_date for r in got.select("event_date").distinct().collect()} == {"20240102"}


def test_explicit_start_offsets(spark, scratch):
    base = scratch("explicit")
    env = envelope_fixture(spark, SF001)
    write_replay(env, f"{base}/topic")
    start = {"ecommerce_tst": {"0": 100, "1": -2, "2": 300}}
    _run(spark, f"{base}/topic", f"{base}/out", f"{base}/ck", starting=start)
    want = env.where(((F.col("partition") == 0) & (F.col("offset") >= 100)) | (F.col("partition") == 1)
                     | ((F.col("partition") == 2) & (F.col("offset") >= 300))).count()
    assert read_landed(spark, f"{base}/out").count() == want
    # -1 is the end of the topic
    latest = {"ecommerce_tst": {"0": -1, "1": -1, "2": -2}}
    _run(spark, f"{base}/topic", f"{base}/out2", f"{base}/ck2", starting=latest)
    assert read_landed(spark, f"{base}/out2").count() == env.where(F.col("partition") == 2).count()


def test_fan_out_after_a_failure_lands_once(spark, scratch, capsys):
    """Extra sinks follow the landed root in a stream of their own: their
    failure and replay doesn't touch what is landed."""
    import pytest
    from tidewater.streaming.ingest import preview_sink, start_fan_out

    base = scratch("fan")
    env = envelope_fixture(spark, SF001, chunk=True)
    days = F.col("chunk").isin("20240105", "20240106")
    write_replay(env.where(days), f"{base}/topic", chunk="chunk")
    total = env.where(days).count()
    _run(spark, f"{base}/topic", f"{base}/out", f"{base}/ck", max_files_per_trigger=1)
    seen, broken = {}, [True]

    def count_sink(batch, batch_id):
        seen[batch_id] = batch.count()
        if broken[0]:
            raise ValueError("sink down")

    def fan():
        return run_ingest(start_fan_out(spark, f"{base}/out", f"{base}/ck-fan", (count_sink, preview_sink(3)), once=True))

    with pytest.raises(Exception, match="sink down"):
        fan()
    broken[0] = False
    fan()  # the failed batch comes again, under its id
    assert sum(seen.values()) == total and "batch 0" in capsys.readouterr().out
    fan()  # nothing new
    _run(spark, f"{base}/topic", f"{base}/out", f"{base}/ck", max_files_per_trigger=1)
    assert sum(seen.values()) == read_landed(spark, f"{base}/out").count() == total


def test_events_and_rejects_of_one_decode(spark, scratch):
    from tidewater.streaming.ingest import read_ingested, read_rejects

    base = scratch("both")
    env = envelope_fixture(spark, SF001, corrupt_every=50)
    write_replay(env, f"{base}/topic")
    e = event_envelope(spark, "replay", path=f"{base}/topic", starting="earliest")
    run_ingest(start_ingest(e, f"{base}/out", f"{base}/ck", once=True, rejects=True))
    plain = _counts(decode_events(env).transform(with_event_hour))
    assert _counts(read_ingested(spark, f"{base}/out")) == plain
    got = {(r.partition, r.offset) for r in read_rejects(spark, f"{base}/out").collect()}
    want = {(r.partition, r.offset) for r in env.where(F.col("key") % 50 == 0).collect()}
    assert got == want and len(want) == 20


def test_metrics_log_keeps_every_batch(spark, scratch):
    from tidewater.streaming.ingest import PROGRESS_RETENTION, MetricsLog, read_metrics

    base = scratch("log")
    env = envelope_fixture(spark, SF001, corrupt_every=50, chunk=True)
    days = F.col("chunk").isin("20240101", "20240102", "20240103", "20240104")
    write_replay(env.where(days), f"{base}/topic", chunk="chunk")
    old = spark.conf.get(PROGRESS_RETENTION)
    spark.conf.set(PROGRESS_RETENTION, "2")
    try:
        log = MetricsLog(spark, f"{base}/metrics")
        log.close(_run(spark, f"{base}/topic", f"{base}/out", f"{base}/ck", max_files_per_trigger=1))
    finally:
        spark.conf.set(PROGRESS_RETENTION, old)
    rows = read_metrics(spark, f"{base}/metrics").collect()
    assert sorted(r.batch_id for r in rows) == [0, 1, 2, 3]
    assert sum(r.records for r in rows) == env.where(days).count()
    assert {r.first_date for r in rows} == {"20240101", "20240102", "20240103", "20240104"}


def test_listing_honours_the_log_of_a_stream_root(spark, scratch):
    from tidewater.operators.files import list_files

    base = scratch("listing")
    env = envelope_fixture(spark, SF001, chunk=True)
    write_replay(env.where(F.col("chunk") == "20240101"), f"{base}/topic", chunk="chunk")
    _run(spark, f"{base}/topic", f"{base}/out", f"{base}/ck")
    n = list_files(spark, f"{base}/out").count()
    # a file of a batch that was never committed
    read_landed(spark, f"{base}/out").limit(1).drop("event_date", "event_hour").coalesce(1).write.mode("append").parquet(
        f"{base}/out/event_date=20240101/event_hour=3")
    assert list_files(spark, f"{base}/out").count() == n
    assert read_landed(spark, f"{base}/out").count() == env.where(F.col("chunk") == "20240101").count()


def test_backfill_spread_bounds_the_files(spark, scratch):
    from tidewater.operators.files import partition_sizes

    base = scratch("spread")
    env = envelope_fixture(spark, SF001, chunk=True)
    write_replay(env.repartition(6), f"{base}/topic")
    e = event_envelope(spark, "replay", path=f"{base}/topic", starting="earliest")
    run_ingest(start_ingest(e, f"{base}/out", f"{base}/ck", once=True, spread=1))
    assert read_landed(spark, f"{base}/out").count() == 1000
    assert partition_sizes(spark, f"{base}/out").agg(F.max("files")).first()[0] == 1


def test_dropped_progress_is_reported_not_undercounted(spark, scratch):
    import pytest

    from tidewater.streaming.ingest import PROGRESS_RETENTION

    base = scratch("retain")
    env = envelope_fixture(spark, SF001, chunk=True)
    write_replay(env.where(F.col("chunk").isin("20240107", "20240108", "20240109")), f"{base}/topic",
                 chunk="chunk")
    old = spark.conf.get(PROGRESS_RETENTION)
    spark.conf.set(PROGRESS_RETENTION, "2")
    try:
        q = _run(spark, f"{base}/topic", f"{base}/out", f"{base}/ck", max_files_per_trigger=1)
        with pytest.raises(RuntimeError, match="dropped"):
            ingest_metrics(q)
        assert 0 < len(ingest_metrics(q, partial=True)) < 3
    finally:
        spark.conf.set(PROGRESS_RETENTION, old)


def test_stream_head_print(spark, scratch):
    from tidewater.streaming.ingest import start_preview

    base = scratch("head")
    write_replay(envelope_fixture(spark, SF001).where(F.col("offset") < 20), f"{base}/topic")
    env = event_envelope(spark, "replay", path=f"{base}/topic", starting="earliest")
    q = run_ingest(start_preview(env, rows=3, once=True))
    # the JVM prints the batch head to its own stdout; check what ran
    assert q.lastProgress["numInputRows"] == 60
    assert "Console" in q.lastProgress["sink"]["description"]


def test_processing_time_trigger_runs_until_stopped(spark, scratch):
    base = scratch("trigger")
    write_replay(envelope_fixture(spark, SF001).where(F.col("offset") < 30), f"{base}/topic")
    env = event_envelope(spark, "replay", path=f"{base}/topic", starting="earliest")
    q = start_ingest(env, f"{base}/out", f"{base}/ck", every="1 second")
    try:
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()
    assert read_landed(spark, f"{base}/out").count() == 90


def test_stream_failure_is_raised(spark, scratch):
    import pytest
    from pyspark.errors import StreamingQueryException

    base = scratch("fail")
    # a replay file whose payload column has the wrong type (the stream must read it)
    spark.range(3).selectExpr("'k' AS key", "CAST(id AS INT) AS value", "'ecommerce_tst' AS topic",
                              "0 AS partition", "id AS offset", "current_timestamp() AS timestamp") \
        .write.parquet(f"{base}/topic")
    env = event_envelope(spark, "replay", path=f"{base}/topic", starting="earliest")
    with pytest.raises(StreamingQueryException):
        run_ingest(start_ingest(env, f"{base}/out", f"{base}/ck", once=True))


def test_kafka_kind_needs_the_connector(spark):
    import pytest

    try:
        event_envelope(spark, "kafka", brokers="localhost:1", topic="ecommerce_tst", starting="latest")
    except Exception as e:  # connector jar absent in this image
        assert "kafka" in str(e).lower()
    else:
        pytest.skip("spark-sql-kafka connector present; the source resolved")


def test_record_log_on_request(spark, scratch):
    from tidewater.streaming.ingest import start_record_log

    base = scratch("records")
    write_replay(envelope_fixture(spark, SF001).where(F.col("offset") < 10), f"{base}/topic")
    env = event_envelope(spark, "replay", path=f"{base}/topic", starting="earliest")
    q = run_ingest(start_record_log(env, once=True))
    assert q.lastProgress["numInputRows"] == 30
    assert "Foreach" in q.lastProgress["sink"]["description"]


def test_compact_closed_dates_of_a_stream_root(spark, scratch):
    from tidewater.operators.compaction import compact

    base = scratch("closed")
    env = envelope_fixture(spark, SF001, chunk=True)
    days = F.col("chunk").isin("20240101", "20240102", "20240103")
    write_replay(env.where(days), f"{base}/topic", chunk="chunk")
    _run(spark, f"{base}/topic", f"{base}/out", f"{base}/ck", max_files_per_trigger=1)
    compact(spark, f"{base}/out", f"{base}/closed", where=F.col("event_date") < "20240103")
    got = read_landed(spark, f"{base}/closed")
    assert {r.event_date for r in got.select("event_date").distinct().collect()} == {"20240101", "20240102"}
    assert got.count() == read_landed(spark, f"{base}/out").where(F.col("event_date") < "20240103").count()


def test_publish_needs_the_kafka_connector(spark):
    import pytest

    from tidewater.sources.envelope import publish_events

    from tidewater.sources.envelope import publish_columns

    assert publish_columns() == ["key", "value", "partition", "topic"] and publish_columns("t") == ["key", "value", "partition"]
    env = envelope_fixture(spark, SF001).limit(1)
    try:
        publish_events(env, "localhost:1", "ecommerce_tst")
    except Exception as e:  # connector jar absent in this image
        assert "kafka" in str(e).lower()
    else:
        pytest.skip("spark-sql-kafka connector present")


def test_repeated_records_land_once_and_their_state_is_bounded(spark, scratch):
    """Twice in one run, again after a restart, and in a third run when the
    state of the first has gone."""
    import time

    base = scratch("once")
    env = envelope_fixture(spark, SF001).where(F.col("offset") < 40)

    def land(rows, within):
        write_replay(rows, f"{base}/topic")
        env_in = event_envelope(spark, "replay", path=f"{base}/topic", starting="earliest", checkpoint=f"{base}/ck")
        q = run_ingest(start_ingest(env_in, f"{base}/out", f"{base}/ck", once=True, once_within=within))
        return [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators]

    store = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    n = env.count()
    assert land(env.unionByName(env), "4 seconds")[0] == n
    land(env, "4 seconds")
    assert read_landed(spark, f"{base}/out").count() == n
    time.sleep(5)
    later = envelope_fixture(spark, SF001).where("offset >= 40 and offset < 45")
    land(later, "4 seconds")  # moves the watermark past the first records
    time.sleep(5)
    rows = land(envelope_fixture(spark, SF001).where("offset >= 45 and offset < 47"), "4 seconds")
    assert rows[-1] < n
    assert read_landed(spark, f"{base}/out").count() == n + later.count() + 6
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == store


def test_records_landed_once_are_in_few_files(spark, scratch):
    """The shuffle by key scatters every hour over all tasks; files are per hour, not per task and hour."""
    base = scratch("once-files")
    env = envelope_fixture(spark, SF001).withColumn("timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    write_replay(env.unionByName(env), f"{base}/topic")
    env_in = event_envelope(spark, "replay", path=f"{base}/topic", starting="earliest", checkpoint=f"{base}/ck")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        run_ingest(start_ingest(env_in, f"{base}/out", f"{base}/ck", once=True, once_within="1 day", spread=1))
        run_ingest(start_ingest(env_in, f"{base}/out-4", f"{base}/ck-4", once=True, once_within="1 day"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for out, most in (("out", 1), ("out-4", ONCE_SPREAD)):
        landed = read_landed(spark, f"{base}/{out}")
        assert landed.count() == env.count()
        files = landed.groupBy(*PARTITION_KEYS).agg(F.count_distinct("_metadata.file_path").alias("files"), F.count(F.lit(1)).alias("n"))
        assert files.agg(F.max("files")).first()[0] <= most and files.agg(F.max("n")).first()[0] > 1
