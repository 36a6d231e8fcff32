"""Plan shapes of the SQL queries, and the incremental key check."""

import pytest
from pyspark.sql import functions as F

from testkit import SF001, plan_text
from tidewater.operators.keyindex import check_batch, merge_filters
from tidewater.operators.keys import duplicate_keys
from tidewater.plans.queries import registered


@pytest.mark.parametrize("name, wanted", [
    ("sql_grouping_sets", ["Expand"]), ("sql_rollup", ["Expand"]), ("sql_top_in_groups", ["WindowGroupLimit"]),
    ("sql_exists", ["LeftSemi", "LeftAnti"]), ("sql_correlated", ["HashAggregate", "Join"]),
    ("sql_set_operations", ["LeftSemi", "LeftAnti"]), ("sql_not_in", ["LeftAnti", "LeftSemi"])])
def test_shapes(spark, name, wanted):
    plan = plan_text(registered()[name](spark, SF001))
    assert all(w in plan for w in wanted) and "CartesianProduct" not in plan


def _final(found, pk):
    """The last verdict on each key."""
    out = {}
    for rows in found:
        out.update({tuple(r[k] for k in pk): (r["n_rows"], r["problem"]) for r in rows})
    return out


def test_batches_against_an_index_equal_one_check(spark, scratch):
    index, pk = scratch("keys"), ["a", "b"]
    rows = [(i % 40 if i % 13 else None, f"k{i % 7}" if i % 17 else None, i) for i in range(400)] + [(1000 + i, "own", i) for i in range(300)]
    df = spark.createDataFrame(rows, "a long, b string, i long")
    found = [check_batch(spark, index, df.where(F.col("i") % 3 == b), pk, buckets=5).collect() for b in range(3)]
    want = {(r.a, r.b): (r.n_rows, r.problem) for r in duplicate_keys(df, pk).collect()}
    assert _final(found, pk) == want
    # nothing new: every key is known now
    again = check_batch(spark, index, df.where("a >= 1000 and i = 5"), pk, buckets=5).collect()
    assert [(r.a, r.n_rows) for r in again] == [(1005, 2)]
    merged = scratch("merged")
    merge_filters(spark, index, merged)
    assert spark.read.parquet(f"{merged}/filters").count() <= 5
    more = check_batch(spark, merged, spark.createDataFrame([(1005, "own"), (5000, "own")], "a long, b string"), pk, buckets=5).collect()
    assert [(r.a, r.n_rows) for r in more] == [(1005, 3)]


def test_a_run_that_died_before_its_filters_is_not_counted(spark, scratch):
    index = scratch("died")
    batch = spark.createDataFrame([(1,), (2,)], "a long")
    assert check_batch(spark, index, batch, "a").collect() == []
    keys = spark.read.parquet(f"{index}/keys")
    keys.withColumn("run", F.lit("died")).write.mode("append").partitionBy("bucket").parquet(f"{index}/keys")
    assert sorted((r.a, r.n_rows) for r in check_batch(spark, index, batch, "a").collect()) == [(1, 2), (2, 2)]


def test_an_empty_batch(spark, scratch):
    index = scratch("none")
    empty = spark.createDataFrame([], "a long")
    assert check_batch(spark, index, empty, "a").collect() == []
    assert check_batch(spark, index, spark.createDataFrame([(None,), (3,)], "a long"), "a").collect()[0].problem == "null_key"
