"""Plan shape: partition pruning, filter pushdown, column pruning, top-k,
no shuffle in the bucketed join, broadcast only of bounded tables."""

from pyspark.sql import functions as F

from testkit import SF001, plan_text
from tidewater.functions.timefn import with_event_hour
from tidewater.operators.basic import take_rows, where_equals
from tidewater.operators.bucketing import write_bucketed
from tidewater.operators.sinks import append_events
from tidewater.session import unique_name
from tidewater.sources.fixtures import event_fixture
from tidewater.sources.landed import read_landed
from tidewater.sources.tables import read_table


def test_date_filter_prunes_partitions(spark, scratch):
    root = scratch("prune")
    append_events(with_event_hour(event_fixture(spark, SF001)), root)
    plan = plan_text(read_landed(spark, root, date="20240101"))
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "(event_date#" in plan and "= 20240101)" in plan


def test_equality_pushed_to_parquet_and_columns_pruned(spark):
    df = where_equals(read_table(spark, SF001, "events"), "event_type", "purchase").select("event_id")
    plan = plan_text(df)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in plan
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan


def test_ordered_limit_is_top_k(spark):
    df = take_rows(read_table(spark, SF001, "events"), 100, order_by="event_id")
    assert "TakeOrderedAndProject" in plan_text(df, "simple")


def test_bucketed_join_has_no_exchange(spark, scratch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = scratch("bucket")
        o = write_bucketed(read_table(spark, SF001, "orders").select("o_orderkey", "o_custkey"),
                           unique_name("o"), 4, "o_orderkey", f"{base}/o")
        li = write_bucketed(read_table(spark, SF001, "lineitem").select("l_orderkey", "l_quantity"),
                            unique_name("l"), 4, "l_orderkey", f"{base}/l")
        per = li.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("q"))
        j = o.join(per, o.o_orderkey == per.l_orderkey)
        plan = plan_text(j, "simple")
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        n = read_table(spark, SF001, "orders").join(read_table(spark, SF001, "lineitem"),
                                                    F.col("o_orderkey") == F.col("l_orderkey")).count()
        assert o.join(li, o.o_orderkey == li.l_orderkey).count() == n
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fixture_join_is_a_left_join_on_part(spark):
    plan = plan_text(event_fixture(spark, SF001), "simple")
    assert "LeftOuter" in plan


def test_shuffle_sizing_for_scale():
    from tidewater.session import shuffle_partitions_for

    assert shuffle_partitions_for(100 * 1024 ** 4) == 819200  # 100 TB -> 128 MB reducers
    assert shuffle_partitions_for(1) == 200


def test_registered_bucketed_join_has_no_exchange(spark):
    from tidewater.operators.bucketing import drop_table
    from tidewater.plans.queries import bucketed_revenue

    names = unique_name("o"), unique_name("l")
    plan = plan_text(bucketed_revenue(spark, SF001, *names), "simple")
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Broadcast" not in plan
    for n in names:
        drop_table(spark, n)


def test_inventory_is_a_hash_aggregate(spark, scratch):
    from tidewater.operators.catalog import partition_inventory

    root = scratch("inv-plan")
    append_events(with_event_hour(event_fixture(spark, SF001)), root)
    plan = plan_text(partition_inventory(read_landed(spark, root)), "simple")
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Expand" not in plan
