"""Catalog services over the landed root: register, sync, inventory."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.schema import LANDED_SCHEMA, PARTITION_KEYS
from tidewater.operators.compaction import expired, newest_date
from tidewater.operators.files import NULL_DIRECTORY, partition_value


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def register_landed(
    spark: SparkSession, table: str, root: str, schema: T.StructType = LANDED_SCHEMA, keys=PARTITION_KEYS
) -> None:
    """External partitioned table over ``root``. Until the partitions are
    synced the table shows no rows."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(
        f"CREATE TABLE {table} ({_ddl(schema)}) USING parquet "
        f"PARTITIONED BY ({', '.join(keys)}) LOCATION '{root}'"
    )


def sync_partitions(spark: SparkSession, table: str, mode: str = "add") -> None:
    """Sync the catalog with the partition directories under the table's
    location: ``add`` new ones (default), ``drop`` ones whose directory is
    gone, or ``sync`` both."""
    clause = {"add": "ADD", "drop": "DROP", "sync": "SYNC"}[mode]
    spark.sql(f"MSCK REPAIR TABLE {table} {clause} PARTITIONS")


def show_partitions(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {table}")


def partition_inventory(df: DataFrame, keys=PARTITION_KEYS, time_col: str = "event_time") -> DataFrame:
    """One row per partition: rows, files, first and last time of ``time_col``
    (as ``yyyy-MM-dd HH:mm:ss UTC`` text; null where none can be read).

    ``df`` must be a file scan (it reads ``_metadata.file_path``). Times are
    compared as numbers, so both steps are hash aggregates: one row per file
    first, combined map-side, then one per partition.
    """
    t = F.unix_micros(F.try_to_timestamp(F.col(time_col)))
    per_file = df.groupBy(*keys, F.col("_metadata.file_path").alias("_file")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(t).alias("_lo"), F.max(t).alias("_hi"))
    text = lambda c: F.concat(F.date_format(F.timestamp_micros(c), "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC"))
    return per_file.groupBy(*keys).agg(
        F.sum("_rows").alias("rows"), F.count(F.lit(1)).alias("files"), F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"),
    ).select(*keys, "rows", "files", text("_lo").alias("min_time"), text("_hi").alias("max_time"))


def analyze_columns(spark: SparkSession, table: str) -> DataFrame:
    """Spark's built-in table and column statistics (used by the cost-based
    optimizer); returns the per-column statistics Spark keeps."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
    cols = [f.name for f in spark.table(table).schema.fields]
    rows = []
    for c in cols:
        d = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {table} `{c}`").collect()}
        rows.append((c, d.get("min"), d.get("max"), d.get("num_nulls"), d.get("distinct_count"),
                     d.get("avg_col_len"), d.get("max_col_len")))
    return spark.createDataFrame(
        rows, "column_name string, min string, max string, num_nulls string, distinct_count string, "
              "avg_col_len string, max_col_len string")


def drop_expired_partitions(spark: SparkSession, table: str, days: int, key: str = "event_date",
                            fmt: str = "yyyyMMdd", as_of=None, per_statement: int = 500) -> list[str]:
    """Retention on a catalog table: drop the partitions whose date lies more
    than ``days`` days before the newest one (the rule of ``expired``;
    undated partitions stay); returns the dropped dates.

    Works on partition metadata only (``SHOW PARTITIONS``: one row per
    partition), never on the data. Each partition is dropped by its full
    spec (datasource tables take no partial specs), a few hundred per
    statement. If a statement fails, the error names what was dropped
    before it; running again finishes the work. For an external table the
    files stay on storage; readers of the table stop seeing them.
    """
    parts = spark.sql(f"SHOW PARTITIONS {table}").select("partition", partition_value(F.col("partition"), key).alias(key))
    newest = newest_date(parts, key, as_of, fmt)
    gone = parts.where(expired(F.col(key), newest, days, fmt)).orderBy(key, "partition").collect()
    specs = []
    for row in gone:
        kv = [item.split("=", 1) for item in row.partition.split("/")]
        specs.append("PARTITION (" + ", ".join(f"`{k}` = {_sql_value(v)}" for k, v in kv) + ")")
    for i in range(0, len(specs), per_statement):
        try:
            spark.sql(f"ALTER TABLE {table} DROP {', '.join(specs[i:i + per_statement])}")
        except Exception as e:
            done = sorted({r[key] for r in gone[:i]})
            raise RuntimeError(f"retention of {table} stopped after {i} of {len(specs)} partitions; dropped so far: {done}") from e
    return sorted({row[key] for row in gone})


def _sql_value(raw: str) -> str:
    """A value as SHOW PARTITIONS prints it, as an SQL literal."""
    if raw == NULL_DIRECTORY:
        return "null"
    plain = unquote(raw)
    return "'" + plain.replace("\\", "\\\\").replace("'", "\\'") + "'"
