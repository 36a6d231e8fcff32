"""The three runnable jobs, driven through their command lines."""

from pyspark.sql import functions as F

from testkit import SF001
from tidewater.functions.timefn import with_event_hour
from tidewater.jobs import main
from tidewater.operators.sinks import append_events
from tidewater.sources.envelope import write_replay
from tidewater.sources.fixtures import envelope_fixture, event_fixture
from tidewater.sources.landed import read_landed


def test_filter_csv_job(spark, scratch):
    out = scratch("job-csv") + "/data.csv"
    main(["filter-csv", "--out", out])
    got = spark.read.schema("name string, age int, location string").csv(out).collect()
    assert sorted((r.name, r.age) for r in got) == [("Bob", 25), ("David", 30)]


def test_copy_partition_job(spark, scratch):
    root, out = scratch("job-root"), scratch("job-copy")
    append_events(with_event_hour(event_fixture(spark, SF001)), root)
    main(["copy-partition", "--root", root, "--date", "20240101", "--limit", "10", "--out", out])
    got = spark.read.parquet(out)
    assert got.count() == 10 and "event_date" not in got.columns


def test_ingest_job_on_replay_files(spark, scratch):
    base = scratch("job-ingest")
    env = envelope_fixture(spark, SF001, chunk=True)
    write_replay(env.where(F.col("chunk") <= "20240103"), f"{base}/topic", chunk="chunk")
    main(["ingest", "--kind", "replay", "--path", f"{base}/topic", "--starting", "earliest",
          "--root", f"{base}/landed", "--checkpoint", f"{base}/ck", "--once"])
    assert read_landed(spark, f"{base}/landed").count() == env.where(F.col("chunk") <= "20240103").count()


def test_copy_partition_job_ordered(spark, scratch):
    root, out = scratch("job-root2"), scratch("job-copy2")
    append_events(with_event_hour(event_fixture(spark, SF001)), root)
    main(["copy-partition", "--root", root, "--date", "20240102", "--limit", "5",
          "--order-by", "event_time", "--out", out])
    got = [r.event_time for r in spark.read.parquet(out).collect()]
    want = [r.event_time for r in read_landed(spark, root, date="20240102").orderBy("event_time").limit(5).collect()]
    assert sorted(got) == want
