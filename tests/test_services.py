"""Catalog services: partition sync, inventory, column statistics,
compaction, retention, key checks, skew report, JSON mapping, saved views."""

import glob
import math

from pyspark.sql import functions as F

from testkit import SF001, local_path, plan_text
from tidewater.functions.timefn import with_event_hour
from tidewater.operators.bucketing import skewed_values
from tidewater.operators.catalog import partition_inventory, register_landed, show_partitions, sync_partitions
from tidewater.operators.compaction import compact, retain
from tidewater.operators.files import partition_sizes
from tidewater.operators.jsonmap import map_json
from tidewater.operators.keys import duplicate_keys, orphans
from tidewater.operators.sinks import append_events
from tidewater.operators.stats import column_stats
from tidewater.session import unique_name
from tidewater.sources.fixtures import event_fixture
from tidewater.sources.landed import read_landed
from tidewater.sources.tables import register_catalog, save_view


def _landed(spark, scratch, name):
    root = scratch(name)
    append_events(with_event_hour(event_fixture(spark, SF001)), root)
    return root


def test_partition_sync(spark, scratch):
    root = _landed(spark, scratch, "sync")
    t = unique_name("landed")
    register_landed(spark, t, root)
    assert spark.table(t).count() == 0  # registered, not yet synced
    sync_partitions(spark, t)
    assert spark.table(t).count() == read_landed(spark, root).count() == 1000
    assert show_partitions(spark, t).count() == read_landed(spark, root).select(
        "event_date", "event_hour").distinct().count()


def test_partition_inventory(spark, scratch):
    root = _landed(spark, scratch, "inv")
    inv = partition_inventory(read_landed(spark, root))
    agg = inv.agg(F.sum("rows").alias("r"), F.max("files").alias("f")).first()
    assert agg.r == 1000 and agg.f == 1


def test_column_stats_kinds(spark):
    df = spark.createDataFrame(
        [(1, 2.5, "ab", True), (3, None, "abcd", False), (None, 0.5, None, True)],
        "i int, d double, s string, b boolean")
    st = {r.column_name: r for r in column_stats(df).collect()}
    assert (st["i"].long_low, st["i"].long_high, st["i"].num_nulls, st["i"].num_distincts) == (1, 3, 1, 2)
    assert (st["d"].double_low, st["d"].double_high) == (0.5, 2.5)
    assert (st["s"].avg_col_len, st["s"].max_col_len) == (3.0, 4)
    assert (st["b"].num_trues, st["b"].num_falses) == (2, 1)
    exact = {r.column_name: r.num_distincts for r in column_stats(df, exact=["s"]).collect()}
    assert exact["s"] == 2


def test_column_stats_of_decimals_dates_and_times(spark):
    df = spark.sql("""SELECT CAST(v AS DECIMAL(38, 18)) AS d, DATE '1970-01-03' AS day, TIMESTAMP '1970-01-01 00:01:00' AS t,
                             TIMESTAMP_NTZ '1970-01-01 00:02:00' AS n FROM VALUES ('12345678901234567890.123456789012345678'), ('-1.5'), (null) x(v)""")
    st = {r.column_name: r for r in column_stats(df).collect()}
    assert (st["d"].decimal_low, st["d"].decimal_high) == ("-1.500000000000000000", "12345678901234567890.123456789012345678")
    assert st["d"].num_nulls == 1 and st["d"].double_low is None
    assert st["day"].long_low == st["day"].long_high == 2
    assert (st["t"].long_low, st["n"].long_high) == (60, 120)


def test_approximate_distinct_counts_are_close(spark):
    df = with_event_hour(event_fixture(spark, SF001))
    exact = {r.column_name: r.num_distincts for r in column_stats(df, exact=True).collect()}
    for r in column_stats(df).collect():
        assert abs(r.num_distincts - exact[r.column_name]) <= max(1, 0.1 * exact[r.column_name]), r


def test_partition_stats(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5)], "k string, v int")
    got = {(r.k, r.column_name): (r.long_low, r.long_high) for r in column_stats(df, keys=("k",)).collect()}
    assert got == {("a", "v"): (1, 2), ("b", "v"): (5, 5)}


def test_compaction_bounds_file_count(spark, scratch):
    base = scratch("compact")
    rows = with_event_hour(event_fixture(spark, SF001))
    rows.repartition(4).write.partitionBy("event_date", "event_hour").parquet(f"{base}/src")
    before = len(glob.glob(local_path(base) + "/src/*/*/*.parquet"))
    sizes = compact(spark, f"{base}/src", f"{base}/dst", target_mb=1)
    after = len(glob.glob(local_path(base) + "/dst/*/*/*.parquet"))
    assert after == sizes.count() < before
    assert read_landed(spark, f"{base}/dst").count() == 1000
    one = partition_sizes(spark, f"{base}/src").agg(F.max("bytes")).first()[0]
    assert math.ceil(one / (1024 * 1024)) == 1
    assert partition_sizes(spark, f"{base}/src").agg(F.sum("files")).first()[0] == before
    # a tiny target splits a partition into ceil(bytes / target) files at most
    sizes = compact(spark, f"{base}/src", f"{base}/split", target_mb=one / 2 / 2**20)
    assert sizes.agg(F.max("_n")).first()[0] == 2
    assert sizes.count() <= len(glob.glob(local_path(base) + "/split/*/*/*.parquet")) <= sizes.agg(F.sum("_n")).first()[0]
    assert read_landed(spark, f"{base}/split").count() == 1000


def test_retention_keeps_newest_days(spark, scratch):
    root = _landed(spark, scratch, "ret")
    kept = retain(read_landed(spark, root), "event_date", 7)
    dates = sorted(r.event_date for r in kept.select("event_date").distinct().collect())
    assert dates == [f"202401{d}" for d in range(23, 31)]  # 7 days before the newest is the oldest that stays


def test_both_forms_of_retention_agree_and_keep_undated_rows(spark, scratch):
    from tidewater.functions.schema import EVENT_SCHEMA
    from tidewater.operators.catalog import drop_expired_partitions

    root = scratch("undated")
    dates = ["20240101", "20240102", "20240108", "20240109", "2024-01-09", "", "20991231"]
    rows = [(d, "2024-01-01 05:00:00 UTC", "view", 1, 2, "c", "b", 1.5, 3, "s") for d in dates]
    append_events(with_event_hour(spark.createDataFrame(rows, EVENT_SCHEMA)), root)
    landed = read_landed(spark, root)
    want = {"20240102", "20240108", "20240109", "2024-01-09", None, "20991231"}
    # one event far in the future expires nothing: the newest date that counts is 20240109
    assert {r.event_date for r in retain(landed, "event_date", 7).collect()} == want
    t = unique_name("undated")
    register_landed(spark, t, root)
    sync_partitions(spark, t)
    assert drop_expired_partitions(spark, t, 7) == ["20240101"]
    assert {r.event_date for r in spark.table(t).collect()} == want
    spark.sql(f"DROP TABLE {t}")
    assert {r.event_date for r in retain(landed, "event_date", 7, as_of="2024-01-15").collect()} == want - {"20240102"}


def test_retention_reports_what_was_dropped_before_a_failure(spark, scratch, monkeypatch):
    import pytest
    from tidewater.operators import catalog

    root = _landed(spark, scratch, "fail")
    t = unique_name("landed")
    register_landed(spark, t, root)
    sync_partitions(spark, t)
    real, seen = type(spark).sql, []

    def failing(self, text, *a, **k):
        if "DROP" in text:
            seen.append(text)
            if len(seen) == 2:
                raise ValueError("metastore gone")
        return real(self, text, *a, **k)

    monkeypatch.setattr(type(spark), "sql", failing)
    with pytest.raises(RuntimeError, match="stopped after 10 of"):
        catalog.drop_expired_partitions(spark, t, 7, per_statement=10)
    monkeypatch.undo()
    catalog.drop_expired_partitions(spark, t, 7)  # running again finishes
    assert {r.event_date for r in spark.table(t).select("event_date").distinct().collect()} == {f"202401{d}" for d in range(23, 31)}
    spark.sql(f"DROP TABLE {t}")


def test_key_checks(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (None, 3)], "a int, b int")
    got = sorted((r.a, r.b, r.n_rows, r.problem) for r in duplicate_keys(df, ["a", "b"]).collect()
                 if r.a is not None)
    assert got == [(1, 1, 2, "duplicate")]
    assert duplicate_keys(df, ["a", "b"]).where("problem = 'null_key'").count() == 1
    parent = spark.createDataFrame([(1,), (1,), (5,)], "id int")
    assert [r.a for r in orphans(df, parent, "a", "id").collect()] == [2]  # a null key passes
    assert sorted(r.a if r.a is not None else -1 for r in orphans(df, parent, "a", "id", nulls=True).collect()) == [-1, 2]


def test_skew_report(spark):
    df = spark.createDataFrame([("x",)] * 6 + [("y",)] * 3 + [("z",)], "v string")
    got = {r.v: (r.n, r.share) for r in skewed_values(df, "v", 0.3).collect()}
    assert got == {"x": (6, 0.6), "y": (3, 0.3)}
    pairs = spark.createDataFrame([("x", 1)] * 3 + [("x", 2)] * 2 + [("y", 1)], "v string, w int")
    assert [(r.v, r.w, r.n) for r in skewed_values(pairs, ["v", "w"], 0.5).collect()] == [("x", 1, 3)]


def test_json_mapping_bad_json_gives_nulls(spark):
    df = spark.createDataFrame([('{"k": 5, "s": "a"}',), ("not json",), ('{"k": "x"}',)], "p string")
    got = [tuple(r) for r in map_json(df, "p", [("k", "$.k", "bigint"), ("s", "$.s", "string")]).collect()]
    assert got == [(5, "a"), (None, None), (None, None)]


def test_json_mapping_in_the_connectors_form(spark):
    from testkit import plan_text
    from tidewater.operators.jsonmap import map_topic

    # the connector's documented example of a table description
    description = {
        "tableName": "testtable", "schemaName": "testschema", "topicName": "testtopic",
        "key": {"dataFormat": "json", "fields": [{"name": "_key", "dataFormat": "VARCHAR", "type": "VARCHAR", "hidden": "false"}]},
        "message": {"dataFormat": "json", "fields": [{"name": "id", "mapping": "id", "type": "BIGINT"},
                                                     {"name": "test_field", "mapping": "test_field", "type": "VARCHAR"}]}}
    df = spark.createDataFrame([("k1", b'{"id": 7, "test_field": "x"}'), ("k2", b'{"id": "no"}'), (None, b"junk")], "key string, value binary")
    out = map_topic(df, description)
    assert out.columns == ["_key", "id", "test_field"] and dict(out.dtypes)["id"] == "bigint"
    assert [tuple(r) for r in out.collect()] == [("k1", 7, "x"), ("k2", None, None), (None, None, None)]
    deep = spark.createDataFrame([('{"u": {"n": "a", "m": 1}, "l": [1, 2]}',)], "j string")
    m = map_json(deep, "j", [("n", "u/n", "VARCHAR(10)"), ("m", "$.u.m", "INTEGER"), ("u", "u", "VARCHAR"), ("l1", "$.l[1]", "BIGINT")])
    assert [tuple(r) for r in m.collect()] == [("a", 1, '{"n":"a","m":1}', 2)]
    # one parse per row for plain paths
    plan = plan_text(map_json(deep, "j", [("n", "u/n", "VARCHAR"), ("m", "u/m", "INTEGER")]), "simple")
    assert plan.count("from_json") == 1 and "get_json_object" not in plan


def test_catalog_and_saved_view(spark):
    names = register_catalog(spark, SF001, ("region", "nation"))
    assert names == ["region", "nation"]
    v = save_view(spark, unique_name("v"), "SELECT r_name, count(*) AS n FROM region JOIN nation "
                                          "ON n_regionkey = r_regionkey GROUP BY r_name")
    assert v.agg(F.sum("n")).first()[0] == 25
    name = unique_name("stored")
    save_view(spark, name, f"SELECT r_name FROM parquet.`{SF001}/region.parquet`", stored=True)
    assert spark.newSession().table(name).count() == 5  # another session sees it
    spark.sql(f"DROP VIEW {name}")


def test_drop_expired_partitions_and_analyze(spark, scratch):
    from tidewater.operators.catalog import analyze_columns, drop_expired_partitions

    root = _landed(spark, scratch, "drop")
    t = unique_name("landed")
    register_landed(spark, t, root)
    sync_partitions(spark, t)
    dropped = drop_expired_partitions(spark, t, 7)
    assert dropped == [f"202401{d:02d}" for d in range(1, 23)]
    assert spark.table(t).count() == retain(read_landed(spark, root), "event_date", 7).count()
    stats = {r.column_name: r for r in analyze_columns(spark, t).collect()}
    assert int(stats["event_type"].num_nulls) == 0 and int(stats["event_type"].distinct_count) == 5


def test_sync_modes(spark, scratch):
    root = _landed(spark, scratch, "modes")
    t = unique_name("landed")
    register_landed(spark, t, root)
    sync_partitions(spark, t, mode="sync")
    n = show_partitions(spark, t).count()
    sync_partitions(spark, t, mode="drop")  # every directory still exists: nothing dropped
    sync_partitions(spark, t, mode="add")  # nothing new: nothing added
    assert show_partitions(spark, t).count() == n
    assert spark.table(t).count() == 1000


def test_apply_retention_publishes_to_a_new_root(spark, scratch):
    from tidewater.operators.compaction import apply_retention

    root = _landed(spark, scratch, "ret-src")
    dst = scratch("ret-dst")
    apply_retention(spark, root, dst, days=3)
    dates = sorted(r.event_date for r in read_landed(spark, dst).select("event_date").distinct().collect())
    assert dates == ["20240127", "20240128", "20240129", "20240130"]
    assert read_landed(spark, root).count() == 1000  # the source is untouched
    assert read_landed(spark, dst).count() == read_landed(spark, root).where(
        F.col("event_date") >= "20240127").count()


def test_compaction_keeps_null_partition_rows(spark, scratch):
    from tidewater.functions.schema import EVENT_SCHEMA

    rows = [("20240101", "bad time", "view", 1, 2, "c", "b", 1.5, 3, "s"),
            ("20240101", "2024-01-01 05:00:00 UTC", "view", 1, 2, "c", "b", 1.5, 3, "s"),
            ("", "2024-01-01 06:00:00 UTC", "view", 1, 2, "c", "b", 1.5, 3, "s")]
    src, dst = scratch("null-src"), scratch("null-dst")
    df = with_event_hour(spark.createDataFrame(rows, EVENT_SCHEMA))
    df.repartition(3).write.partitionBy("event_date", "event_hour").parquet(src)
    df.write.mode("append").partitionBy("event_date", "event_hour").parquet(src)
    compact(spark, src, dst)
    got = sorted((r.event_date or "", -1 if r.event_hour is None else r.event_hour)
                 for r in read_landed(spark, dst).collect())
    assert got == [("", 6), ("", 6), ("20240101", -1), ("20240101", -1), ("20240101", 5), ("20240101", 5)]


def test_incremental_compaction_of_a_catalog_table(spark, scratch):
    from tidewater.operators.compaction import compact_table

    base = scratch("inc")
    rows = with_event_hour(event_fixture(spark, SF001))
    early = F.col("event_date") <= "20240110"
    # early dates: four files per partition; later dates: one file each
    rows.where(early).repartition(4).write.partitionBy("event_date", "event_hour").parquet(f"{base}/src")
    rows.where(~early).hint("rebalance", "event_date", "event_hour").write.mode("append") \
        .partitionBy("event_date", "event_hour").parquet(f"{base}/src")
    t = unique_name("landed")
    register_landed(spark, t, f"{base}/src")
    sync_partitions(spark, t)
    files_before = len(spark.table(t).inputFiles())
    closed = F.col("event_date") < "20240115"
    picked = compact_table(spark, t, f"{base}/staging", where=closed, target_mb=1)
    assert picked["swapped"] and not picked["skipped"] and all(d <= "20240110" for d, _ in picked["swapped"])
    assert spark.table(t).count() == 1000
    assert len(spark.table(t).inputFiles()) < files_before
    assert not [f for f in spark.table(t).inputFiles() if "staging" in f and "event_date=2024011" in f
                and "event_date=20240110" not in f]
    assert compact_table(spark, t, f"{base}/staging2", where=closed, target_mb=1) == {"swapped": [], "skipped": []}  # nothing left to do


def test_compact_table_hides_no_append_and_finds_escaped_keys(spark, scratch, monkeypatch):
    from tidewater.operators import compaction

    base = scratch("race")
    schema = "v int, event_date string, event_hour int"
    rows = [(i, d, h) for i, (d, h) in enumerate([("2024-01-01 00:00", 1), ("it's+1", 2), ("20240103", 3)] * 20)]
    df = spark.createDataFrame(rows, schema)
    df.repartition(4).write.partitionBy("event_date", "event_hour").parquet(f"{base}/src")
    t = unique_name("escaped")
    register_landed(spark, t, f"{base}/src", schema=df.schema)
    sync_partitions(spark, t)
    real = compaction._salted_rewrite

    def append_meanwhile(*args):
        real(*args)
        spark.createDataFrame([(99, "20240103", 3)], schema).write.mode("append").partitionBy("event_date", "event_hour").parquet(f"{base}/src")

    monkeypatch.setattr(compaction, "_salted_rewrite", append_meanwhile)
    out = compaction.compact_table(spark, t, f"{base}/staging", where=F.lit(True), target_mb=1)
    assert out == {"swapped": [("2024-01-01 00:00", 1), ("it's+1", 2)], "skipped": [("20240103", 3)]}
    assert spark.table(t).count() == 61
    assert {(r.event_date, r.n) for r in spark.table(t).groupBy("event_date").agg(F.count("v").alias("n")).collect()} == {
        ("2024-01-01 00:00", 20), ("it's+1", 20), ("20240103", 21)}
    spark.sql(f"DROP TABLE {t}")


def test_true_foreign_keys_have_no_orphans(spark):
    from testkit import SF01
    from tidewater.sources.tables import read_table

    t = lambda n: read_table(spark, SF01, n)
    assert orphans(t("lineitem"), t("orders"), "l_orderkey", "o_orderkey").count() == 0
    assert orphans(t("orders"), t("customer"), "o_custkey", "c_custkey").count() == 0
    assert orphans(t("customer"), t("nation"), "c_nationkey", "n_nationkey").count() == 0
    assert orphans(t("orders"), t("lineitem"), "o_orderkey", "l_orderkey").count() == 257


def test_compaction_lists_files_without_reading_rows(spark, scratch):
    from tidewater.operators.compaction import table_files

    base, t = scratch("listing"), unique_name("listed")
    df = spark.range(40).select(F.col("id").cast("int").alias("v"), (F.col("id") % 4).cast("string").alias("event_date"), (F.col("id") % 2).cast("int").alias("event_hour"))
    df.repartition(3).write.partitionBy("event_date", "event_hour").parquet(f"{base}/t")
    register_landed(spark, t, f"{base}/t", schema=df.schema)
    sync_partitions(spark, t)
    files = table_files(spark, t, F.col("event_date").isin("1", "2"))
    assert {(r.event_date, r.event_hour) for r in files.collect()} == {("1", "1"), ("2", "0")}
    plan = plan_text(files)
    assert "parquet" not in plan.split("== Physical Plan ==")[-1].lower().replace(f"{base}/t".lower(), "").replace(".parquet", "") or "binaryFile" in plan
    assert table_files(spark, t, F.col("event_date") == "none").count() == 0
    spark.sql(f"DROP TABLE {t}")
