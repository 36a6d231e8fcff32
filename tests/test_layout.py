"""Sinks and scans: directory layout, null partitions, CSV bytes, append and
overwrite semantics, leaf and root scans, inline rows, hour parsing."""

import glob
import os

from pyspark.sql import functions as F

from testkit import SF001, local_path
from tidewater.functions.schema import EVENT_SCHEMA, LANDED_SCHEMA
from tidewater.functions.timefn import event_hour, with_event_hour
from tidewater.operators.basic import take_rows, where_equals
from tidewater.operators.sinks import append_events, overwrite_csv, overwrite_parquet
from tidewater.sources.fixtures import event_fixture
from tidewater.sources.inline import people
from tidewater.sources.landed import read_landed, read_partition_dir


def test_inline_filter_and_csv_bytes(spark, scratch):
    sf = where_equals(people(spark), "location", "San Francisco")
    assert sorted((r.name, r.age) for r in sf.collect()) == [("Bob", 25), ("David", 30)]
    path = scratch("csv") + "/data.csv"
    overwrite_csv(sf.coalesce(1), path)
    parts = glob.glob(local_path(path) + "/part-*.csv")
    text = "".join(open(p).read() for p in parts)
    assert sorted(text.strip().split("\n")) == ["Bob,25,San Francisco", "David,30,San Francisco"]
    assert os.path.isdir(local_path(path))
    overwrite_csv(sf.limit(1).coalesce(1), path)  # overwrite replaces
    assert spark.read.csv(path).count() == 1


def test_equality_is_exact_and_null_safe(spark):
    df = spark.createDataFrame([("San Francisco",), ("san francisco",), (None,)], "location string")
    assert where_equals(df, "location", "San Francisco").count() == 1


def test_hour_strings_fixture_f7(spark):
    cases = [("2019-10-01 00:00:00 UTC", 0), ("2019-10-01 05:00:00", 5), ("2019-10-01T23:59:59Z", 23),
             ("2019-10-01 05:00:00+07:00", 22), ("12:34:56", 12), ("2019-10-01", 0), ("", None), ("bad", None)]
    df = spark.createDataFrame([(t,) for t, _ in cases], "event_time string")
    got = {r.event_time: r.h for r in df.select("event_time", event_hour().alias("h")).collect()}
    assert got == dict(cases)


def _events(spark, rows):
    return with_event_hour(spark.createDataFrame(rows, EVENT_SCHEMA))


def test_partitioned_append_layout_and_nulls(spark, scratch):
    rows = [("20191001", "2019-10-01 05:00:00 UTC", "view", 1, 2, "c", "b", 1.5, 3, "s"),
            ("20191001", "bad", "view", 1, 2, "c", "b", 1.5, 3, "s"),
            ("", "2019-10-01 06:00:00", "view", 1, 2, "c", "b", 1.5, 3, "s")]
    root = scratch("layout")
    append_events(_events(spark, rows), root)
    lp = local_path(root)
    assert os.path.isdir(f"{lp}/event_date=20191001/event_hour=5")
    assert os.path.isdir(f"{lp}/event_date=20191001/event_hour=__HIVE_DEFAULT_PARTITION__")
    assert os.path.isdir(f"{lp}/event_date=__HIVE_DEFAULT_PARTITION__/event_hour=6")
    back = read_landed(spark, root)
    assert back.columns[-2:] == ["event_date", "event_hour"]
    got = sorted((r.event_date or "", r.event_hour if r.event_hour is not None else -1) for r in back.collect())
    assert got == [("", 6), ("20191001", -1), ("20191001", 5)]
    # keys are not in the data files
    one = glob.glob(f"{lp}/event_date=20191001/event_hour=5/*.parquet")[0]
    assert "event_date" not in spark.read.parquet("file:" + one).columns
    # appending again doubles the rows
    append_events(_events(spark, rows), root)
    assert read_landed(spark, root).count() == 6


def test_leaf_scan_and_pruned_scan(spark, scratch):
    root = scratch("scan")
    append_events(with_event_hour(event_fixture(spark, SF001)), root)
    leaf = read_partition_dir(spark, root, "20240101")
    assert "event_date" not in leaf.columns and "event_hour" in leaf.columns
    pruned = read_landed(spark, root, date="20240101")
    assert leaf.count() == pruned.count() > 0
    # partition keys keep declared types: a text key like 0191 stays text
    assert dict(read_landed(spark, root).dtypes)["event_date"] == "string"


def test_limit_and_parquet_overwrite(spark, scratch):
    fx = event_fixture(spark, SF001)
    top = take_rows(fx, 5, order_by="event_id").collect()
    assert [r.event_id for r in top] == [0, 1, 2, 3, 4]
    assert take_rows(fx, 5).count() == 5
    assert take_rows(fx.limit(3), 100).count() == 3
    path = scratch("ow")
    overwrite_parquet(fx, path)
    overwrite_parquet(fx.where(F.col("event_type") == "view"), path)
    assert spark.read.parquet(path).where(F.col("event_type") != "view").count() == 0


def test_landed_schema_order():
    names = [f.name for f in LANDED_SCHEMA.fields]
    assert names[0] == "event_time" and names[-2:] == ["event_date", "event_hour"]


def test_preview_prints_rows(spark, capsys):
    from tidewater.operators.sinks import preview

    preview(people(spark), n=2)
    out = capsys.readouterr().out
    assert "Alice" in out and "only showing top 2 rows" in out


def test_empty_append_writes_only_success_marker(spark, scratch):
    root = scratch("empty")
    append_events(_events(spark, []), root)
    names = os.listdir(local_path(root))
    assert "_SUCCESS" in names and not [n for n in names if n.startswith("event_date=")]
    assert read_landed(spark, root).count() == 0


def test_csv_quoting_and_escape(spark, scratch):
    df = spark.createDataFrame([('a,"b', 1)], "s string, n int")
    path = scratch("quote") + "/q.csv"
    overwrite_csv(df.coalesce(1), path)
    text = "".join(open(p).read() for p in glob.glob(local_path(path) + "/part-*.csv"))
    assert text.strip() == '"a,\\"b",1'
    assert spark.read.schema("s string, n int").csv(path).first().s == 'a,"b'


def test_leaf_scan_with_base_path_keeps_date(spark, scratch):
    root = scratch("base")
    append_events(with_event_hour(event_fixture(spark, SF001)), root)
    kept = read_partition_dir(spark, root, "20240102", keep_date=True)
    assert {r.event_date for r in kept.select("event_date").distinct().collect()} == {"20240102"}
