"""Table maintenance: small-file compaction and retention.

Both publish to a *new* root. A root written by the streaming file sink
keeps a ``_spark_metadata`` log and Spark readers see only logged files,
so rewriting such a root in place would hide the rewrite.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.schema import LANDED_SCHEMA, PARTITION_KEYS
from tidewater.operators.files import list_files, partition_sizes

SWAP_BATCH = 200  # partitions that are listed again together, then swapped
SWAPS_AT_ONCE = 8


def table_files(spark: SparkSession, table: str, where=None, keys=PARTITION_KEYS) -> DataFrame:
    """(path, directory, length, keys) of the files behind the partitions of a
    catalog table that ``where`` passes, now. A listing: Spark prunes the
    partitions and names their files, no row is read. Directories are named
    by their keys (``key=value``), as Spark's writers and MSCK have them."""
    spark.catalog.refreshTable(table)
    rows = spark.table(table) if where is None else spark.table(table).where(where)
    found = sorted({unquote(p.rsplit("/", 1)[0]) for p in rows.inputFiles()})
    return _listed(spark, found, keys)


def _listed(spark: SparkSession, directories: list[str], keys) -> DataFrame:
    if not directories:
        return spark.createDataFrame([], "path string, directory string, length long, " + ", ".join(f"`{k}` string" for k in keys))
    return list_files(spark, directories, keys)


def _salted_rewrite(src: DataFrame, sizes: DataFrame, keys, dst_root: str) -> None:
    """Rewrite the rows of the partitions listed in ``sizes`` (keys + ``_n``)
    into ``dst_root`` with at most ``_n`` files per partition.

    Rows of one partition are spread over ``_n`` salts and the shuffle is on
    (keys, salt): one hot hour goes to ``_n`` tasks instead of one, and each
    task writes one file per partition. The size table has one row per
    partition; whether it is broadcast is Spark's choice, from its real size
    at run time, and otherwise the skew join splits a hot partition.
    """
    types = dict(src.dtypes)
    plan = sizes.select(*[F.col(k).cast(types[k]).alias(f"_k{i}") for i, k in enumerate(keys)], "_n")
    data_cols = [c for c in src.columns if c not in keys]
    # Null partition keys must match too: join with null-safe equality.
    cond = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    joined = src.join(plan, cond, "inner").select(*src.columns, "_n")
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in data_cols]), F.col("_n"))
    (
        joined.withColumn("_salt", salt)
        .repartition(*[F.col(k) for k in keys], F.col("_salt"))
        .drop("_salt", "_n")
        .write.mode("errorifexists")
        .partitionBy(*keys)
        .parquet(dst_root)
    )


def _with_file_bound(sizes: DataFrame, target_mb: float) -> DataFrame:
    target = int(target_mb * 1024 * 1024)
    return sizes.withColumn(
        "_n", F.greatest(F.lit(1).cast("bigint"), F.ceil(F.col("bytes") / F.lit(target)).cast("bigint"))
    )


def compact(
    spark: SparkSession,
    src_root: str,
    dst_root: str,
    keys=PARTITION_KEYS,
    target_mb: float = 128,
    schema: T.StructType = LANDED_SCHEMA,
    where=None,
) -> DataFrame:
    """Rewrite ``src_root`` into ``dst_root`` with at most
    ``ceil(bytes / target)`` files per partition. Returns the size table.

    ``where`` (a filter on partition columns, e.g. dates that are closed)
    compacts part of the source: the filter prunes directories, so a live
    stream root can be compacted date by date. A stream root is read through
    its ``_spark_metadata`` log, so files of uncommitted batches are skipped.
    """
    src = spark.read.schema(schema).parquet(src_root)
    types = dict(src.dtypes)
    listed = partition_sizes(spark, src_root, keys)
    sizes = listed.select(*[F.col(k).cast(types[k]).alias(k) for k in keys], "bytes", "files")
    if where is not None:
        src, sizes = src.where(where), sizes.where(where)
    # One row per partition, used twice (by the rewrite and the caller):
    # cached, and listed again if an executor holding it is lost.
    sizes = _with_file_bound(sizes, target_mb).cache()
    _salted_rewrite(src, sizes, keys, dst_root)
    sizes.unpersist()
    return sizes


def _quoted(value) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _state(files: DataFrame, types: dict, keys) -> DataFrame:
    """Per partition: files, bytes, its directories and a fingerprint of the file set."""
    return files.groupBy(*[F.col(k).cast(types[k]).alias(k) for k in keys]).agg(
        F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files"), F.collect_set("directory").alias("_directories"),
        F.sum(F.xxhash64("path", "length").cast("decimal(38,0)")).alias("_set"))


def compact_table(
    spark: SparkSession,
    table: str,
    staging_root: str,
    where,
    keys=PARTITION_KEYS,
    target_mb: float = 128,
) -> dict[str, list[tuple]]:
    """Incremental compaction of the closed partitions of a catalog table.

    ``where`` is a filter on the partition columns that only closed
    partitions pass (dates nobody appends to any more). Of those, the ones
    with more files than ``ceil(bytes / target)`` are rewritten into
    ``staging_root``; each is then pointed at its new directory with
    ``ALTER TABLE … PARTITION … SET LOCATION``: a metadata swap, so readers
    switch partition by partition. Swaps go in batches of ``SWAP_BATCH``, a
    few at a time, and right before each batch its directories are listed
    again: a partition whose file set changed since the rewrite read it is
    left alone and reported, so an append before that isn't hidden. Old files
    stay for a later cleanup. Partitions with a null key are left as they are.

    Returns {"swapped": [...], "skipped": [...]}, partition keys each; both
    are bounded by the number of closed partitions, not by the data.
    """
    files = table_files(spark, table, where, keys)
    src = spark.table(table).where(where)
    types = dict(src.dtypes)
    picked = _with_file_bound(_state(files, types, keys), target_mb).where(F.col("files") > F.col("_n"))
    for k in keys:
        picked = picked.where(F.col(k).isNotNull())
    picked = picked.cache()
    before = {tuple(r[k] for k in keys): r for r in picked.collect()}
    out: dict[str, list[tuple]] = {"swapped": [], "skipped": []}
    if before:
        _salted_rewrite(src, picked, keys, staging_root)
        # Directories as the writer named them: it escapes some key values.
        written = (list_files(spark, staging_root, keys).select("directory", *[F.col(k).cast(types[k]).alias(k) for k in keys]).distinct())
        to = sorted(((tuple(r[k] for k in keys), r["directory"]) for r in written.collect()), key=str)
        for i in range(0, len(to), SWAP_BATCH):
            _swap(spark, table, to[i:i + SWAP_BATCH], before, types, keys, out)
        spark.catalog.refreshTable(table)
    picked.unpersist()
    return {k: sorted(v) for k, v in out.items()}


def _swap(spark: SparkSession, table: str, to: list[tuple], before: dict, types: dict, keys, out: dict) -> None:
    """Point the partitions of ``to`` (values, directory) at their new
    directories, where their files are still those of ``before``."""
    listed = _listed(spark, sorted({d for values, _ in to for d in before[values]["_directories"]}), keys)
    now = {tuple(r[k] for k in keys): (r["files"], r["_set"]) for r in _state(listed, types, keys).collect()}
    same = [x for x in to if now.get(x[0]) == (before[x[0]]["files"], before[x[0]]["_set"])]
    out["skipped"] += [x[0] for x in to if x not in same]

    def alter(values: tuple, directory: str) -> None:
        spec = ", ".join(f"`{k}` = {_quoted(v)}" for k, v in zip(keys, values))
        spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION {_quoted(directory)}")

    with ThreadPoolExecutor(SWAPS_AT_ONCE) as pool:
        for x, done in [(x, pool.submit(alter, *x)) for x in same]:
            done.result()
            out["swapped"].append(x[0])


def expired(column: Column, newest: Column, days: int, fmt: str = "yyyyMMdd") -> Column:
    """The one retention rule: true where the date lies more than ``days``
    days before ``newest``. False for text that isn't a date: undated rows
    and partitions are never dropped."""
    d = F.try_to_timestamp(column, F.lit(fmt)).cast("date")
    return F.coalesce(d < F.date_sub(newest, days), F.lit(False))


def newest_date(dates: DataFrame, column: str, as_of=None, fmt: str = "yyyyMMdd") -> Column:
    """The date to count back from: ``as_of`` where given, else the newest
    date that isn't in the future (producers write the dates, and one event
    dated 2099 must not expire the table)."""
    if as_of is not None:
        return F.lit(as_of).cast("date")
    d = F.try_to_timestamp(F.col(column), F.lit(fmt)).cast("date")
    return dates.select(F.max(F.when(d <= F.current_date(), d))).scalar()


def retain(df: DataFrame, column: str = "event_date", days: int = 7, fmt: str = "yyyyMMdd", as_of=None,
           dates: DataFrame | None = None) -> DataFrame:
    """Drop the rows that ``expired`` names. ``dates`` is a small frame to
    take the newest date from (a listing of partitions); without it, ``df``."""
    newest = newest_date(df if dates is None else dates, column, as_of, fmt)
    return df.where(~expired(F.col(column), newest, days, fmt))


def apply_retention(
    spark: SparkSession,
    src_root: str,
    dst_root: str,
    days: int = 7,
    keys=PARTITION_KEYS,
    schema: T.StructType = LANDED_SCHEMA,
    as_of=None,
) -> None:
    """Publish the retained partitions to a new root. The newest date comes
    from the file listing, and expired directories aren't opened."""
    listed = list_files(spark, src_root, keys)
    kept = retain(spark.read.schema(schema).parquet(src_root), keys[0], days, as_of=as_of, dates=listed)
    kept.hint("rebalance", *keys).write.mode("errorifexists").partitionBy(*keys).parquet(dst_root)
