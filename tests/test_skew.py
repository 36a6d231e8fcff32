"""Skew: one key holding a third of the rows. Work is split, results stay whole."""

import glob
import math

from pyspark.sql import functions as F

from testkit import SF01, local_path
from tidewater.functions.timefn import with_event_hour
from tidewater.operators.compaction import compact
from tidewater.operators.keys import duplicate_keys, orphans
from tidewater.operators.sinks import append_events
from tidewater.sources.fixtures import event_fixture
from tidewater.sources.landed import read_landed
from tidewater.sources.tables import read_table

HOT_DATE, HOT_HOUR = "20240115", 12


def _skewed(spark):
    hot = F.col("event_id") % 3 == 0
    return (with_event_hour(event_fixture(spark, SF01))
            .withColumn("event_date", F.when(hot, F.lit(HOT_DATE)).otherwise(F.col("event_date")))
            .withColumn("event_hour", F.when(hot, F.lit(HOT_HOUR)).otherwise(F.col("event_hour"))))


def _hot_files(root):
    return glob.glob(f"{local_path(root)}/event_date={HOT_DATE}/event_hour={HOT_HOUR}/*.parquet")


def test_hot_hour_is_written_by_several_tasks(spark, scratch):
    src, root = scratch("src"), scratch("skew")
    _skewed(spark).repartition(8).write.parquet(src)  # several input splits, as at scale
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        append_events(spark.read.parquet(src), root)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    assert len(_hot_files(root)) > 1
    assert read_landed(spark, root).count() == 10000
    assert read_landed(spark, root, date=HOT_DATE).where(F.col("event_hour") == HOT_HOUR).count() >= 3333


def test_compaction_spreads_a_hot_partition(spark, scratch):
    src, dst = scratch("csrc"), scratch("cdst")
    _skewed(spark).repartition(4).write.partitionBy("event_date", "event_hour").parquet(src)
    target_mb = 0.02
    sizes = compact(spark, src, dst, target_mb=target_mb)
    hot = sizes.where((F.col("event_date") == HOT_DATE) & (F.col("event_hour") == HOT_HOUR)).first()
    want = math.ceil(hot.bytes / int(target_mb * 1024 * 1024))
    assert want > 1 and 1 < len(_hot_files(dst)) <= want
    assert read_landed(spark, dst).count() == 10000


def test_key_checks_whole_under_a_hot_key(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        li = read_table(spark, SF01, "lineitem")
        hot_li = li.withColumn("l_orderkey", F.when(F.col("l_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("l_orderkey")))
        n_hot = hot_li.where(F.col("l_orderkey") == 7).count()
        assert n_hot * 3 >= li.count() * 0.9
        dup = duplicate_keys(hot_li, ["l_orderkey", "l_linenumber"]).where(F.col("l_orderkey") == 7)
        assert dup.agg(F.sum("n_rows")).first()[0] == n_hot
        o = read_table(spark, SF01, "orders")
        want = o.join(hot_li, o.o_orderkey == hot_li.l_orderkey, "left_anti").count()
        assert orphans(o, hot_li, "o_orderkey", "l_orderkey").count() == want
        child = orphans(hot_li, o, "l_orderkey", "o_orderkey")
        assert child.count() == hot_li.join(o, hot_li.l_orderkey == o.o_orderkey, "left_anti").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fixture_join_whole_without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fx = event_fixture(spark, SF01)
        assert fx.count() == 10000
        assert fx.where(F.col("brand") == "").count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
