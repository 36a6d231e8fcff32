"""Registered queries: (spark, sf_dir) -> DataFrame, each with a DuckDB oracle.

Every query reads the given tables (or files Spark derived from them) in
full. Queries that exercise a sink write to a fresh folder under the shared
scratch root, then return a lazy read of what was written.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.codec import REASON_UNDECODABLE, decode_events, decode_rejects
from tidewater.functions.schema import EVENT_FIELDS, PARTITION_KEYS, TOPIC, WITH_EVENT_ID, landed_schema
from tidewater.functions.timefn import with_event_hour
from tidewater.operators.basic import take_rows, where_equals
from tidewater.operators.bucketing import (
    bucket_count, drop_table, heavy_values, read_skewed, skewed_values, write_bucketed, write_skewed,
)
from tidewater.operators.catalog import (
    drop_expired_partitions, partition_inventory, register_landed, sync_partitions,
)
from tidewater.operators.compaction import compact, compact_table, retain
from tidewater.operators.files import list_files, partition_sizes
from tidewater.operators.jsonmap import map_json
from tidewater.operators.keyindex import check_batch
from tidewater.operators.keys import duplicate_keys, orphans
from tidewater.operators.refresh import refresh
from tidewater.operators.sinks import append_events, overwrite_csv, overwrite_parquet, read_csv
from tidewater.operators.sketches import QUANTILES, merge_sketches, refresh_sketches
from tidewater.operators.skipping import scan_values, update_index
from tidewater.operators.stats import column_stats
from tidewater.plans import sql as Q
from tidewater.session import pin_utc, shared_root, unique_name, workspace
from tidewater.sources.envelope import event_envelope, read_replay, write_replay
from tidewater.sources.fixtures import envelope_fixture, event_fixture
from tidewater.sources.landed import read_landed, read_partition_dir
from tidewater.sources.tables import drop_view, read_table, register_catalog, save_view
from tidewater.streaming.ingest import (
    MetricsLog, read_ingested, read_metrics, read_rejects, run_ingest, start_ingest,
)

# Fixed values of the test queries.
PURCHASE = "purchase"
ONE_DATE = "20240101"
LIMIT_ROWS = 100
CORRUPT_EVERY = 50
ARRIVAL_SPLIT = "2024-01-16 00:00:00"  # first replay arrival: events before this time
RETAIN_DAYS = 7
UNDATED_EVERY = 100  # events whose date the retention queries blank, to see them kept
SKEW_SHARE = 0.2
PAIR_SHARE = 0.1
SUMMARY_SHARES = (0.2, 0.05, 0.002)
EXACT_DISTINCT = ("event_date", "event_hour", "event_type")
JSON_MAPPING = [("product_id", "k", "BIGINT"), ("k_text", "k", "VARCHAR"), ("missing", "nope", "INTEGER")]

FIXTURE_SCHEMA = T.StructType(
    [T.StructField("event_id", T.LongType(), True)] + [T.StructField(n, t, True) for n, _, _, t in EVENT_FIELDS]
)
LANDED_WITH_ID = landed_schema(WITH_EVENT_ID)
LANDED_WITH_KEY = landed_schema(T.StructType([T.StructField("key", T.StringType(), True)]))

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None):
    """Register ``fn(spark, sf_dir)``; every registered query runs with the
    session time zone pinned to UTC, whatever the caller's session says."""
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            pin_utc(spark)
            return fn(spark, sf_dir)

        _QUERIES[name] = run
        if oracle is not None:
            _ORACLE[name] = oracle
        return fn
    return deco


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLE)


# --- helpers ----------------------------------------------------------------

def _landed(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Fixture + hour appended to a fresh landed root; returns the root."""
    root = workspace(spark, name)
    append_events(with_event_hour(event_fixture(spark, sf_dir)), root)
    return root


_SHARED: dict[tuple, str] = {}


def _source_state(spark: SparkSession, sf_dir: str) -> tuple:
    """What identifies the files behind the event queries: their number,
    bytes, newest change and a fingerprint of the list."""
    out = []
    for t in ("events", "part"):
        files = spark.read.format("binaryFile").load(f"{sf_dir.rstrip('/')}/{t}.parquet")
        out += files.agg(F.count(F.lit(1)), F.sum("length"), F.max("modificationTime"),
                         F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()
    return tuple(out)


def _shared(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    """A table written once per shared root and state of the source files,
    then read by many queries (land once, query many). Rebuilt when a source
    file changes or the folder is gone."""
    k = (shared_root(spark), sf_dir, name, _source_state(spark, sf_dir))
    path = _SHARED.get(k)
    if path is not None:
        try:
            spark.read.schema("x int").parquet(path)  # path still resolves
            return path
        except AnalysisException:
            pass
    path = workspace(spark, name)
    build(path)
    _SHARED[k] = path
    return path


def _landed_table(spark: SparkSession, sf_dir: str) -> str:
    """The landed event table (fixture + hour) that read-side queries scan."""
    return _shared(spark, sf_dir, "landed-shared",
                   lambda p: append_events(with_event_hour(event_fixture(spark, sf_dir)), p))


def _undated_table(spark: SparkSession, sf_dir: str) -> str:
    """The landed table with the date of every UNDATED_EVERY-th event blank."""
    def build(path: str) -> None:
        rows = with_event_hour(event_fixture(spark, sf_dir))
        blank = F.when(F.col("event_id") % UNDATED_EVERY == 0, F.lit("")).otherwise(F.col("event_date"))
        append_events(rows.withColumn("event_date", blank), path)

    return _shared(spark, sf_dir, "undated-shared", build)


def _replay_topic(spark: SparkSession, sf_dir: str, corrupt: int | None = None) -> str:
    """Replay files of the envelope, one directory per event date."""
    return _shared(spark, sf_dir, f"topic-shared-{corrupt}", lambda p: write_replay(
        envelope_fixture(spark, sf_dir, corrupt_every=corrupt, chunk=True), p, chunk="chunk"))


def _settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, so that the catalog
    tables behind it can be dropped."""
    path = workspace(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _key_to_id(df: DataFrame) -> DataFrame:
    return df.withColumn("event_id", F.col("key").cast("bigint")).drop("key")


# --- sources, filters, sinks (A-tier) ---------------------------------------

@query("events_filter", Q.with_fixture(f"SELECT {Q.FX_COLS} FROM fx WHERE event_type = 'purchase'"))
def events_filter(spark, sf_dir):
    return where_equals(event_fixture(spark, sf_dir), "event_type", PURCHASE)


@query("csv_roundtrip", Q.with_fixture(f"SELECT {Q.FX_COLS} FROM fx WHERE event_type = 'purchase'"))
def csv_roundtrip(spark, sf_dir):
    path = workspace(spark, "csv") + "/data.csv"
    overwrite_csv(events_filter(spark, sf_dir), path)
    return read_csv(spark, path, FIXTURE_SCHEMA)


@query("parquet_overwrite", Q.with_fixture(f"SELECT {Q.FX_COLS} FROM fx WHERE event_type = 'purchase'"))
def parquet_overwrite(spark, sf_dir):
    path = workspace(spark, "overwrite")
    overwrite_parquet(event_fixture(spark, sf_dir), path)
    overwrite_parquet(events_filter(spark, sf_dir), path)
    return spark.read.schema(FIXTURE_SCHEMA).parquet(path)


@query("event_hour", Q.with_fixture("SELECT event_id, event_time, event_hour FROM fx"))
def event_hour(spark, sf_dir):
    return with_event_hour(event_fixture(spark, sf_dir)).select("event_id", "event_time", "event_hour")


@query("landed_root", Q.with_fixture(f"SELECT {Q.LANDED_COLS} FROM fx"))
def landed_root(spark, sf_dir):
    return read_landed(spark, _landed(spark, sf_dir, "landed"), schema=LANDED_WITH_ID)


@query("landed_append_twice", Q.with_fixture(
    "SELECT event_date, event_hour, 2 * count(*) AS n FROM fx GROUP BY event_date, event_hour"))
def landed_append_twice(spark, sf_dir):
    root = _landed(spark, sf_dir, "append2")
    append_events(with_event_hour(event_fixture(spark, sf_dir)), root)
    return read_landed(spark, root).groupBy(*PARTITION_KEYS).agg(F.count(F.lit(1)).alias("n"))


_LEAF_COLS = Q.FX_COLS.replace("event_date, ", "") + ", event_hour"


@query("leaf_scan", Q.with_fixture(f"SELECT {_LEAF_COLS} FROM fx WHERE event_date = '{ONE_DATE}'"))
def leaf_scan(spark, sf_dir):
    return read_partition_dir(spark, _landed_table(spark, sf_dir), ONE_DATE, schema=LANDED_WITH_ID)


@query("pruned_scan", Q.with_fixture(f"SELECT {Q.LANDED_COLS} FROM fx WHERE event_date = '{ONE_DATE}'"))
def pruned_scan(spark, sf_dir):
    return read_landed(spark, _landed_table(spark, sf_dir), date=ONE_DATE, schema=LANDED_WITH_ID)


@query("limit_100", Q.with_fixture(
    f"SELECT {Q.LANDED_COLS} FROM fx WHERE event_date = '{ONE_DATE}' ORDER BY event_id LIMIT {LIMIT_ROWS}"))
def limit_100(spark, sf_dir):
    return take_rows(pruned_scan(spark, sf_dir), LIMIT_ROWS, order_by="event_id")


# --- codec -------------------------------------------------------------------

@query("codec_roundtrip", Q.with_fixture(f"SELECT {Q.FX_COLS} FROM fx"))
def codec_roundtrip(spark, sf_dir):
    env = envelope_fixture(spark, sf_dir)
    return _key_to_id(decode_events(env, keep=("key",)))


@query("malformed_drop", Q.with_fixture(f"SELECT {Q.FX_COLS} FROM fx WHERE event_id % {CORRUPT_EVERY} <> 0"))
def malformed_drop(spark, sf_dir):
    env = envelope_fixture(spark, sf_dir, corrupt_every=CORRUPT_EVERY)
    return _key_to_id(decode_events(env, keep=("key",)))


@query("malformed_rejects", f"""
SELECT '{TOPIC}' AS topic, CAST(event_id % 3 AS INTEGER) AS "partition",
       event_id // 3 AS "offset", '{REASON_UNDECODABLE}' AS reason
FROM events WHERE event_id % {CORRUPT_EVERY} = 0""")
def malformed_rejects(spark, sf_dir):
    return decode_rejects(envelope_fixture(spark, sf_dir, corrupt_every=CORRUPT_EVERY))


# --- streaming ---------------------------------------------------------------

def _ingest(spark, topic, out, ck, rejects=False, once_within=None, **kw):
    starting = kw.pop("starting", "earliest")
    env = event_envelope(spark, "replay", path=topic, starting=starting, checkpoint=ck, **kw)
    return run_ingest(start_ingest(env, out, ck, once=True, keep=("key",), rejects=rejects, once_within=once_within))


@query("stream_ingest", Q.with_fixture(f"SELECT {Q.LANDED_COLS} FROM fx"))
def stream_ingest(spark, sf_dir):
    topic, base = _replay_topic(spark, sf_dir), workspace(spark, "stream")
    _ingest(spark, topic, f"{base}/landed", f"{base}/ck")
    return _key_to_id(read_landed(spark, f"{base}/landed", schema=LANDED_WITH_KEY))


@query("stream_rejects", f"""
SELECT '{TOPIC}' AS topic, CAST(event_id % 3 AS INTEGER) AS "partition",
       event_id // 3 AS "offset", '{REASON_UNDECODABLE}' AS reason
FROM events WHERE event_id % {CORRUPT_EVERY} = 0""")
def stream_rejects(spark, sf_dir):
    """Undecodable records as rows, landed by the same decode as the events."""
    topic, base = _replay_topic(spark, sf_dir, CORRUPT_EVERY), workspace(spark, "rejects")
    _ingest(spark, topic, f"{base}/landed", f"{base}/ck", rejects=True)
    return read_rejects(spark, f"{base}/landed")


@query("late_data", Q.with_fixture(f"""
SELECT event_date, event_hour, count(*) FILTER (WHERE ts >= TIMESTAMP '{ARRIVAL_SPLIT}') AS n_first, count(*) AS n
FROM fx GROUP BY event_date, event_hour"""))
def late_data(spark, sf_dir):
    """Newer events arrive and land first, the older ones in a later run:
    each lands in the directory of its own date, none is dropped as late."""
    base = workspace(spark, "late")
    topic, out, ck = f"{base}/topic", f"{base}/landed", f"{base}/ck"
    env = envelope_fixture(spark, sf_dir, chunk=True)
    late = F.col("timestamp") < F.lit(ARRIVAL_SPLIT).cast("timestamp")
    per_hour = lambda n: read_landed(spark, out).groupBy(*PARTITION_KEYS).agg(F.count(F.lit(1)).alias(n))
    write_replay(env.where(~late), topic, chunk="chunk")
    _ingest(spark, topic, out, ck)
    first = _settled(per_hour("n_first"), "late-first")
    write_replay(env.where(late), topic, chunk="chunk")
    _ingest(spark, topic, out, ck)
    both = [F.col(k).eqNullSafe(F.col(f"f_{k}")) for k in PARTITION_KEYS]
    seen = first.select(*[F.col(k).alias(f"f_{k}") for k in PARTITION_KEYS], "n_first")
    return per_hour("n").join(seen, both, "left").select(*PARTITION_KEYS, F.coalesce("n_first", F.lit(0)).alias("n_first"), "n")


@query("stream_once", Q.with_fixture(f"SELECT {Q.LANDED_COLS} FROM fx"))
def stream_once(spark, sf_dir):
    """Every record is delivered twice, some in the same run and the rest
    after a restart; each lands once."""
    base = workspace(spark, "once")
    topic, out, ck = f"{base}/topic", f"{base}/landed", f"{base}/ck"
    env = envelope_fixture(spark, sf_dir)
    some = F.col("offset") % 4 == 0
    write_replay(env.unionByName(env.where(some)), topic)
    _ingest(spark, topic, out, ck, once_within="1 day")
    write_replay(env.where(~some), topic)
    _ingest(spark, topic, out, ck, once_within="1 day")
    return _key_to_id(read_landed(spark, out, schema=LANDED_WITH_KEY))


@query("offset_start", Q.with_fixture(
    f"SELECT {Q.LANDED_COLS} FROM fx WHERE ts >= TIMESTAMP '{ARRIVAL_SPLIT}'"))
def offset_start(spark, sf_dir):
    """Start at "latest": records already in the topic at the first start are
    skipped; records that arrive later are landed."""
    base = workspace(spark, "offsets")
    topic, out, ck = f"{base}/topic", f"{base}/landed", f"{base}/ck"
    env = envelope_fixture(spark, sf_dir, chunk=True)
    early = F.col("timestamp") < F.lit(ARRIVAL_SPLIT).cast("timestamp")
    write_replay(env.where(early), topic, chunk="chunk")
    _ingest(spark, topic, out, ck, starting="latest")
    write_replay(env.where(~early), topic, chunk="chunk")
    _ingest(spark, topic, out, ck, starting="latest")
    return _key_to_id(read_landed(spark, out, schema=LANDED_WITH_KEY))


@query("batch_metrics", f"""
SELECT count(*) AS records, count(*) FILTER (WHERE event_id % {CORRUPT_EVERY} = 0) AS rejects FROM events""")
def batch_metrics(spark, sf_dir):
    """Records and rejects from the metrics table that the run appends to, a
    row per micro-batch, not per record."""
    topic, base = _replay_topic(spark, sf_dir, CORRUPT_EVERY), workspace(spark, "metrics")
    log = MetricsLog(spark, f"{base}/metrics")
    log.close(_ingest(spark, topic, f"{base}/landed", f"{base}/ck"))
    return read_metrics(spark, f"{base}/metrics").agg(F.sum("records").alias("records"), F.sum("rejects").alias("rejects"))


# --- catalog services (R-tier) -----------------------------------------------

@query("partition_sync", Q.with_fixture(
    "SELECT event_date, event_hour, count(*) AS n FROM fx GROUP BY event_date, event_hour"))
def partition_sync(spark, sf_dir):
    root = _landed_table(spark, sf_dir)
    table = unique_name("landed_events")
    register_landed(spark, table, root)
    sync_partitions(spark, table)
    out = _settled(spark.table(table).groupBy(*PARTITION_KEYS).agg(F.count(F.lit(1)).alias("n")), "synced")
    drop_table(spark, table)
    return out


@query("partition_inventory", Q.with_fixture("""
SELECT event_date, event_hour, 2 * count(*) AS rows, CAST(2 AS BIGINT) AS files,
       min(event_time) AS min_time, max(event_time) AS max_time
FROM fx GROUP BY event_date, event_hour"""))
def partition_inventory_q(spark, sf_dir):
    """Of a table landed twice: two files in every partition."""
    root = _landed(spark, sf_dir, "inventory")
    append_events(with_event_hour(event_fixture(spark, sf_dir)), root)
    return partition_inventory(read_landed(spark, root))


# DuckDB names of the statistics of a column, by kind of type.
_KINDS = {"string": "string", "bigint": "long", "int": "long", "float": "double", "double": "double",
          "decimal(12,2)": "decimal", "date": "date", "timestamp_ntz": "time"}


def _stats_sql(columns, source, keys=()) -> str:
    """``columns``: (name, Spark type); ``source``: table, or WITH clause whose last name is fx."""
    parts = []
    key_sel = "".join(f"{k}, " for k in keys)
    group = f" GROUP BY {', '.join(keys)}" if keys else ""
    for name, stype in columns:
        if name in keys:
            continue
        kind = _KINDS[stype]
        number = {"long": "CAST({f}({c}) AS BIGINT)", "date": "CAST(datediff('day', DATE '1970-01-01', {f}({c})) AS BIGINT)",
                  "time": "CAST(epoch({f}({c})) AS BIGINT)"}.get(kind)
        low_high = []
        for f in ("min", "max"):
            low_high.append({
                "long": number.format(f=f, c=name) if number else "CAST(NULL AS BIGINT)",
                "double": f"CAST({f}({name}) AS DOUBLE)" if kind == "double" else "CAST(NULL AS DOUBLE)",
                "decimal": f"CAST({f}({name}) AS VARCHAR)" if kind == "decimal" else "CAST(NULL AS VARCHAR)"})
        lo, hi = low_high
        text = kind == "string"
        parts.append(
            f"SELECT {key_sel}'{name}' AS column_name, '{stype}' AS column_type, "
            f"{lo['long']} AS long_low, {hi['long']} AS long_high, {lo['double']} AS double_low, {hi['double']} AS double_high, "
            f"{lo['decimal']} AS decimal_low, {hi['decimal']} AS decimal_high, count(*) - count({name}) AS num_nulls, "
            + (f"count(DISTINCT {name})" if name in EXACT_DISTINCT else "CAST(NULL AS BIGINT)") + " AS num_distincts, "
            + (f"round(avg(length({name})), 6)" if text else "CAST(NULL AS DOUBLE)") + " AS avg_col_len, "
            + (f"CAST(max(length({name})) AS BIGINT)" if text else "CAST(NULL AS BIGINT)") + " AS max_col_len, "
            f"CAST(NULL AS BIGINT) AS num_trues, CAST(NULL AS BIGINT) AS num_falses FROM {source}{group}"
        )
    return "\nUNION ALL\n".join(parts)


_EVENT_STATS = [("event_id", "bigint"), *[(n, t.simpleString()) for n, _, _, t in EVENT_FIELDS], ("event_hour", "int")]
_ORDER_STATS = [("o_orderkey", "bigint"), ("o_totalprice", "decimal(12,2)"), ("o_orderdate", "date"), ("o_orderpriority", "string")]
_LINE_STATS = [("l_orderkey", "bigint"), ("l_quantity", "double"), ("l_shipdate", "timestamp_ntz")]
_ORDERS_CTE = "(SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(12, 2)) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders)"


def _exact_only(stats: DataFrame) -> DataFrame:
    """Approximate counts are left out of what is compared; tests hold them to 5 %."""
    exact = F.col("column_name").isin(*EXACT_DISTINCT)
    return stats.withColumn("num_distincts", F.when(exact, F.col("num_distincts")))


@query("column_stats", Q.with_fixture(
    _stats_sql(_EVENT_STATS, "fx") + "\nUNION ALL\n" + _stats_sql(_ORDER_STATS, _ORDERS_CTE) + "\nUNION ALL\n" + _stats_sql(_LINE_STATS, "lineitem")))
def column_stats_q(spark, sf_dir):
    """Events, and orders and line items for their decimals, dates and timestamps."""
    events = with_event_hour(event_fixture(spark, sf_dir))
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"), F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority")
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_shipdate")
    stats = [column_stats(df, exact=EXACT_DISTINCT) for df in (events, orders, lines)]
    return _exact_only(functools.reduce(DataFrame.unionByName, stats))


@query("partition_stats", Q.with_fixture(_stats_sql([(n, t) for n, t in _EVENT_STATS if n not in PARTITION_KEYS], "fx", PARTITION_KEYS)))
def partition_stats_q(spark, sf_dir):
    """Per full partition (date and hour) of the landed table."""
    landed = read_landed(spark, _landed_table(spark, sf_dir), schema=LANDED_WITH_ID)
    return _exact_only(column_stats(landed, keys=PARTITION_KEYS, exact=EXACT_DISTINCT))


# --- sketches, skipping index, refreshed report: kept per partition or file ------

def _newest_later(spark, sf_dir, root: str, between) -> str:
    """Lands all dates but the newest, calls ``between``, lands the newest; returns it."""
    rows = with_event_hour(event_fixture(spark, sf_dir))
    newest = rows.agg(F.max("event_date")).first()[0]
    append_events(rows.where(F.col("event_date") < newest), root)
    between()
    append_events(rows.where(F.col("event_date") == newest), root)
    return newest


DISTINCT_ERROR, RANK_ERROR = 0.05, 0.01


def _held_to_exact(merged: DataFrame, rows: DataFrame) -> DataFrame:
    """``merged`` with its estimates judged against exact counts of ``rows``:
    one pass, with the few estimates as constants."""
    found = merged.collect()  # a row per column
    types = dict(rows.dtypes)
    aggs = []
    for i, r in enumerate(found):
        c = F.col(r["column_name"])
        aggs.append(F.count_distinct(c).alias(f"d{i}"))
        for j, v in enumerate(r["quantiles"] or []):
            x = c.cast("double")
            aggs += [F.count_if(x < v).alias(f"lt{i}_{j}"), F.count_if(x <= v).alias(f"le{i}_{j}")]
    exact = rows.agg(*aggs).first()
    judged = []
    for i, r in enumerate(found):
        n = r["rows"] - r["num_nulls"]
        ranks = [(exact[f"lt{i}_{j}"] / n - RANK_ERROR <= q <= exact[f"le{i}_{j}"] / n + RANK_ERROR) for j, q in enumerate(QUANTILES)] if r["quantiles"] else []
        judged.append((r["column_name"], abs(r["distincts"] - exact[f"d{i}"]) <= DISTINCT_ERROR * exact[f"d{i}"], all(ranks) if ranks else None))
    assert all(n in types for n, _, _ in judged)
    verdict = rows.sparkSession.createDataFrame(judged, "column_name string, distincts_ok boolean, quantiles_ok boolean")
    return merged.drop("distincts", "quantiles").join(F.broadcast(verdict), "column_name")


_SKETCHED = [(n, t) for n, t in _EVENT_STATS if n not in PARTITION_KEYS]


def _sketch_sql() -> str:
    each = []
    for name, kind in _SKETCHED:
        number, text = kind in ("bigint", "int", "float"), kind == "string"
        each.append(
            f"SELECT '{name}' AS column_name, '{kind}' AS column_type, count(*) AS rows, count(*) - count({name}) AS num_nulls, "
            + (f"CAST(min({name}) AS DOUBLE) AS low, CAST(max({name}) AS DOUBLE) AS high, " if number else "CAST(NULL AS DOUBLE) AS low, CAST(NULL AS DOUBLE) AS high, ")
            + (f"round(avg(length({name})), 6) AS avg_col_len, CAST(max(length({name})) AS BIGINT) AS max_col_len, " if text
               else "CAST(NULL AS DOUBLE) AS avg_col_len, CAST(NULL AS BIGINT) AS max_col_len, ")
            + f"TRUE AS distincts_ok, {'TRUE' if number else 'CAST(NULL AS BOOLEAN)'} AS quantiles_ok FROM fx")
    scanned = "(SELECT count(DISTINCT event_hour) FROM fx WHERE event_date = (SELECT max(event_date) FROM fx))"
    return f"SELECT *, {scanned} AS scanned_partitions FROM (" + "\nUNION ALL\n".join(each) + ")"


@query("stats_sketches", Q.with_fixture(_sketch_sql()))
def stats_sketches_q(spark, sf_dir):
    """Statistics merged from sketches per partition; the newest date lands
    after the first refresh, and the second one scans its partitions alone.
    Estimates are held to 5 % (distinct values) and 1 % of rank (quantiles)."""
    base = workspace(spark, "sketches")
    run = functools.partial(refresh_sketches, spark, f"{base}/store", f"{base}/landed", schema=LANDED_WITH_ID)
    _newest_later(spark, sf_dir, f"{base}/landed", run)
    stored, scanned = run()
    rows = read_landed(spark, f"{base}/landed", schema=LANDED_WITH_ID)
    return _held_to_exact(merge_sketches(stored), rows).withColumn("scanned_partitions", F.lit(scanned.count()).cast("bigint"))


@query("skipping_scan", Q.with_fixture(
    f"SELECT {Q.LANDED_COLS} FROM fx WHERE user_id IN (SELECT user_id FROM events WHERE event_id IN (1, 2, 3))"))
def skipping_scan_q(spark, sf_dir):
    """Rows of a few users, from the files that the index picks; the index
    takes in the newest date's files after those of the others."""
    base = workspace(spark, "skipping")
    add = functools.partial(update_index, spark, f"{base}/index", f"{base}/landed", ["user_id", "product_id", "price", "brand"], schema=LANDED_WITH_ID)
    _newest_later(spark, sf_dir, f"{base}/landed", add)
    add()
    users = [r[0] for r in read_table(spark, sf_dir, "events").where(F.col("event_id").isin(1, 2, 3)).select("user_id").distinct().collect()]
    return scan_values(spark, f"{base}/index", f"{base}/landed", "user_id", users, schema=LANDED_WITH_ID)


def report_partitions(rows: DataFrame) -> DataFrame:
    """The landed-table report, a row per partition with its event types."""
    money = F.round(F.sum(F.col("price").cast("double").cast("decimal(18,6)")).cast("double"), 2)
    per_type = rows.groupBy(*PARTITION_KEYS, "event_type").agg(F.count(F.lit(1)).alias("events"), F.count_distinct("user_id").alias("users"), money.alias("revenue"))
    return per_type.groupBy(*PARTITION_KEYS).agg(F.collect_list(F.struct("event_type", "events", "users", "revenue")).alias("report"))


@query("report_refresh", Q.with_fixture(f"""
SELECT r.*, CAST((SELECT count(DISTINCT event_hour) FROM fx WHERE event_date = (SELECT max(event_date) FROM fx)) AS BIGINT) AS scanned_partitions
FROM ({Q.S5_TEMPLATE.format(table="fx")}) r"""))
def report_refresh_q(spark, sf_dir):
    """The landed-table report as a stored result, refreshed after one more
    date has landed: only its partitions are computed."""
    base = workspace(spark, "report")
    run = functools.partial(refresh, spark, f"{base}/store", f"{base}/landed", report_partitions, schema=LANDED_WITH_ID)
    _newest_later(spark, sf_dir, f"{base}/landed", run)
    stored, scanned = run()
    return (stored.select(*PARTITION_KEYS, F.explode("report").alias("r")).select(*PARTITION_KEYS, "r.*")
            .withColumn("scanned_partitions", F.lit(scanned.count()).cast("bigint")))


def _scattered(spark, sf_dir, root: str) -> float:
    """Lands the events as frequent small appends do, every task writing into
    every hour it holds; returns half the mean partition size in MB."""
    rows = with_event_hour(event_fixture(spark, sf_dir))
    salt = F.col("event_id") % 3
    rows.repartition(*PARTITION_KEYS, salt).write.partitionBy(*PARTITION_KEYS).parquet(root)
    return partition_sizes(spark, root).agg(F.avg("bytes")).first()[0] / 2 / 2**20


@query("compact", Q.with_fixture(f"SELECT {Q.LANDED_COLS} FROM fx"))
def compact_q(spark, sf_dir):
    """Small files compacted into a new root, to files of half the mean
    partition size: partitions are split over several tasks."""
    base = workspace(spark, "compact")
    target = _scattered(spark, sf_dir, f"{base}/src")
    compact(spark, f"{base}/src", f"{base}/dst", target_mb=target, schema=LANDED_WITH_ID)
    return read_landed(spark, f"{base}/dst", schema=LANDED_WITH_ID)


@query("compact_table", Q.with_fixture(f"SELECT {Q.LANDED_COLS} FROM fx"))
def compact_table_q(spark, sf_dir):
    """The closed dates of a catalog table compacted in place, partition by partition."""
    base, table = workspace(spark, "compact-table"), unique_name("landed_events")
    target = _scattered(spark, sf_dir, f"{base}/src")
    register_landed(spark, table, f"{base}/src", schema=LANDED_WITH_ID)
    sync_partitions(spark, table)
    compact_table(spark, table, f"{base}/staging", where=F.col("event_date") < ARRIVAL_SPLIT[:10].replace("-", ""), target_mb=4 * target)
    out = _settled(spark.table(table), "compacted")
    drop_table(spark, table)
    return out


_RETENTION_SQL = Q.with_fixture(f"""
SELECT {Q.LANDED_COLS.replace("event_date", "CASE WHEN event_id % " + str(UNDATED_EVERY) + " <> 0 THEN event_date END AS event_date")} FROM fx
WHERE event_id % {UNDATED_EVERY} = 0
   OR CAST(ts AS DATE) >= (SELECT max(CAST(ts AS DATE)) FROM fx WHERE event_id % {UNDATED_EVERY} <> 0) - INTERVAL {RETAIN_DAYS} DAY""")


@query("retention", _RETENTION_SQL)
def retention_q(spark, sf_dir):
    """Expired dates go; rows without a readable date stay."""
    root = _undated_table(spark, sf_dir)
    dst = workspace(spark, "retained")
    kept = retain(read_landed(spark, root, schema=LANDED_WITH_ID), "event_date", RETAIN_DAYS, dates=list_files(spark, root))
    append_events(kept, dst)
    return read_landed(spark, dst, schema=LANDED_WITH_ID)


@query("retention_catalog", _RETENTION_SQL)
def retention_catalog(spark, sf_dir):
    """The same rule on a catalog table: expired partitions are dropped from
    the table's metadata."""
    root = _undated_table(spark, sf_dir)  # external table: dropping keeps the files
    table = unique_name("landed_events")
    register_landed(spark, table, root, schema=LANDED_WITH_ID)
    sync_partitions(spark, table)
    drop_expired_partitions(spark, table, RETAIN_DAYS)
    out = _settled(spark.table(table), "retained-catalog")
    drop_table(spark, table)
    return out


@query("pk_check", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows,
       CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN 'null_key' ELSE 'duplicate' END AS problem
FROM lineitem GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""")
def pk_check(spark, sf_dir):
    return duplicate_keys(read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("pk_incremental", """
SELECT k AS o_custkey_or_null, o_orderpriority, count(*) AS n_rows, CASE WHEN k IS NULL THEN 'null_key' ELSE 'duplicate' END AS problem
FROM (SELECT CASE WHEN o_orderkey % 97 <> 0 THEN o_custkey END AS k, o_orderpriority FROM orders) GROUP BY k, o_orderpriority HAVING k IS NULL OR count(*) > 1""")
def pk_incremental(spark, sf_dir):
    """Orders as if customer and priority were a key, checked in three
    batches against the index of the keys before: the last verdicts on each
    key are those of one check of all orders."""
    index, key = workspace(spark, "key-index"), ["o_custkey_or_null", "o_orderpriority"]
    orders = read_table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 97 != 0, F.col("o_custkey")).alias(key[0]), key[1], F.pmod(F.xxhash64("o_orderkey"), F.lit(3)).alias("batch"))
    found = [check_batch(spark, index, orders.where(F.col("batch") == b), key).withColumn("batch", F.lit(b)) for b in range(3)]
    last = F.max_by(F.struct("n_rows", "problem"), "batch").alias("v")
    return functools.reduce(DataFrame.unionAll, found).groupBy(*key).agg(last).select(*key, "v.*")


@query("fk_check", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority
FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def fk_check(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"), "o_orderpriority")
    return orphans(o, read_table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey")


@query("bucket_join", """
SELECT o.o_orderkey, o.o_custkey, count(*) AS n_lines,
       CAST(round(sum(CAST(l.l_extendedprice AS DECIMAL(15, 2))
                      * (1 - CAST(l.l_discount AS DECIMAL(15, 2)))), 2) AS DOUBLE) AS revenue
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
GROUP BY o.o_orderkey, o.o_custkey""")
def bucket_join(spark, sf_dir):
    """Two bucketed tables joined bucket to bucket: no exchange on either side."""
    o_t, l_t = unique_name("orders_b"), unique_name("lineitem_b")
    out = _settled(bucketed_revenue(spark, sf_dir, o_t, l_t), "bucket-join")
    drop_table(spark, o_t)
    drop_table(spark, l_t)
    return out


def bucketed_revenue(spark: SparkSession, sf_dir: str, orders_table: str, lines_table: str) -> DataFrame:
    base, n = workspace(spark, "buckets"), bucket_count(spark)
    orders = write_bucketed(
        read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), orders_table, n, "o_orderkey",
        f"{base}/orders")
    items = write_bucketed(
        read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount"),
        lines_table, n, "l_orderkey", f"{base}/lineitem")
    # Aggregate lineitem per order inside its buckets first (no shuffle),
    # then join bucket to bucket: one row per order meets one row per order.
    per_order = items.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(_money("l_extendedprice") * (1 - _money("l_discount"))).alias("rev"),
    )
    j = orders.hint("merge").join(per_order, orders.o_orderkey == per_order.l_orderkey, "inner")
    return j.select("o_orderkey", "o_custkey", "n_lines", F.round("rev", 2).cast("double").alias("revenue"))


def _money(c):
    """Exact cents: decimal sums do not depend on the order of addition."""
    return F.col(c).cast("decimal(15,2)")


@query("skew", f"""
SELECT event_type, count(*) AS n, count(*) / (SELECT count(*) FROM events) AS share
FROM events GROUP BY event_type HAVING count(*) / (SELECT count(*) FROM events) >= {SKEW_SHARE}""")
def skew(spark, sf_dir):
    return skewed_values(read_table(spark, sf_dir, "events"), "event_type", SKEW_SHARE)


@query("skew_pairs", f"""
SELECT l_returnflag, l_linestatus, count(*) AS n, count(*) / (SELECT count(*) FROM lineitem) AS share
FROM lineitem GROUP BY l_returnflag, l_linestatus HAVING count(*) / (SELECT count(*) FROM lineitem) >= {PAIR_SHARE}""")
def skew_pairs(spark, sf_dir):
    """Combinations of two columns."""
    return skewed_values(read_table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], PAIR_SHARE)


@query("skew_summary", "\nUNION ALL\n".join(f"""
SELECT CAST({share} AS DOUBLE) AS at_least, event_type AS value, count(*) AS n, count(*) / (SELECT count(*) FROM events) AS share FROM events
GROUP BY event_type HAVING count(*) >= {share} * (SELECT count(*) FROM events)
UNION ALL
SELECT CAST({share} AS DOUBLE), CAST(user_id AS VARCHAR), count(*), count(*) / (SELECT count(*) FROM events) FROM events
GROUP BY user_id HAVING count(*) >= {share} * (SELECT count(*) FROM events)""" for share in SUMMARY_SHARES))
def skew_summary_q(spark, sf_dir):
    """Skewed values by summary and recount: equal to a full count, without a shuffle by value."""
    events = read_table(spark, sf_dir, "events")
    found = [heavy_values(events, c, share).select(F.lit(share).alias("at_least"), F.col(c).cast("string").alias("value"), "n", "share")
             for share in SUMMARY_SHARES for c in ("event_type", "user_id")]
    return functools.reduce(DataFrame.unionAll, found)


@query("skew_layout", Q.with_fixture(f"""
SELECT {Q.LANDED_COLS}, CASE WHEN event_type IN (SELECT event_type FROM fx GROUP BY event_type HAVING count(*) >= {SKEW_SHARE} * (SELECT count(*) FROM fx))
       THEN event_type END AS own_directory FROM fx"""))
def skew_layout_q(spark, sf_dir):
    """All rows of a table whose skewed event types have directories of their own."""
    root = f"{workspace(spark, 'skew-layout')}/events"
    rows = with_event_hour(event_fixture(spark, sf_dir))
    write_skewed(rows, root, "event_type", heavy_values(rows, "event_type", SKEW_SHARE))
    read = read_skewed(spark, root, rows.schema, directory=True)
    own = F.when(F.col("values_of").startswith("="), F.expr("substring(values_of, 2)"))
    return read.withColumn("own_directory", own).drop("values_of")


@query("json_mapping", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
       json_extract_string(props, '$.k') AS k_text, CAST(NULL AS INTEGER) AS missing
FROM events""")
def json_mapping(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id", "props")
    return map_json(ev, "props", JSON_MAPPING)


# --- SQL surface (S-tier) ----------------------------------------------------

def _sql(text):
    def run(spark, sf_dir):
        # Views of this call alone: the caller may have views of the tables' names.
        tables, prefix = ("region", "nation", "customer", "supplier", "orders", "lineitem"), f"t_{uuid.uuid4().hex[:10]}_"
        register_catalog(spark, sf_dir, tables, prefix)
        ctes = ", ".join(f"{t} AS (SELECT * FROM {prefix}{t})" for t in tables)
        out = spark.sql(f"WITH {ctes}\n{text}")
        for t in tables:  # the plan holds the tables; the names can go
            spark.catalog.dropTempView(prefix + t)
        return out
    return run


for _name, _text in (("sql_s1", Q.S1), ("sql_s2", Q.S2), ("sql_s3", Q.S3), ("sql_s4", Q.S4), ("sql_grouping_sets", Q.S6), ("sql_rollup", Q.S7),
                     ("sql_top_in_groups", Q.S8), ("sql_exists", Q.S9), ("sql_correlated", Q.S10), ("sql_set_operations", Q.S11), ("sql_not_in", Q.S12)):
    query(_name, _text)(_sql(_text))


@query("sql_s5", Q.with_fixture(Q.S5_TEMPLATE.format(table="fx")))
def sql_s5(spark, sf_dir):
    """Landed-table report through a view stored in the catalog, over a
    registered external table."""
    root = _landed_table(spark, sf_dir)
    table, view = unique_name("landed_events"), unique_name("landed_report")
    register_landed(spark, table, root)
    sync_partitions(spark, table)
    out = _settled(save_view(spark, view, Q.S5_TEMPLATE.format(table=table), stored=True), "report")
    drop_view(spark, view)
    drop_table(spark, table)
    return out


# --- the minimum slice (entry) -----------------------------------------------

def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> adapter -> hour -> partitioned append -> pruned scan of one
    date -> first 100 rows by event id."""
    return _QUERIES["limit_100"](spark, sf_dir)
