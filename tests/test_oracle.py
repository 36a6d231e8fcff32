"""Every registered query against its DuckDB oracle (row count, column
names, order-insensitive values), at sf0.001."""

import os
import sys

import duckdb
import pytest

from testkit import ROOT, SF001

sys.path.insert(0, os.path.join(ROOT, "scripts"))
from oracle_check import TABLES, rows_of  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from tidewater.plans.queries import oracles, registered  # noqa: E402

NAMES = sorted(registered())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(oracles()) == set(registered())
    assert set(registered()) <= set(queries()) and set(oracles()) <= set(oracle_sql())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns == entry(spark).columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF001)
    got = [tuple(r) for r in df.collect()]
    res = duck.sql(oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert rows_of(df.columns, got) == rows_of(res.columns, res.fetchall())


def test_queries_pin_utc_whatever_the_caller_zone(spark, duck):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    df = queries()["batch_metrics"](spark, SF001)
    got = [tuple(r) for r in df.collect()]
    res = duck.sql(oracle_sql()["batch_metrics"])
    assert rows_of(df.columns, got) == rows_of(res.columns, res.fetchall())
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_queries_leave_no_tables_or_views_behind(spark):
    spark.range(1).createOrReplaceTempView("orders")  # a caller's own view of that name
    before = {(t.name, t.isTemporary) for t in spark.catalog.listTables()}
    for name in ("bucket_join", "partition_sync", "retention_catalog", "compact_table", "sql_s2", "sql_s5"):
        queries()[name](spark, SF001).count()
    assert {(t.name, t.isTemporary) for t in spark.catalog.listTables()} == before
    assert spark.table("orders").columns == ["id"]
    spark.catalog.dropTempView("orders")


def test_queries_run_from_a_foreign_folder(tmp_path):
    """Python workers get the package from the session, not from the folder."""
    import subprocess

    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
import __spark_entry__ as e
print("ROWS", e.queries()["codec_roundtrip"](spark, {SF001!r}).count(), e.entry(spark).count())
import tidewater.jobs as jobs
jobs.main(["filter-csv", "--out", {str(tmp_path)!r} + "/out.csv"])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 1000 33" in r.stdout, r.stderr[-2000:]
