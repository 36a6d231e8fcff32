"""Helpers shared by the operators: written tables, row ids, exact top-k cuts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import workspace

#: The word separator of every operator here, as a regex class.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: cuts the
    lineage, fixes nondeterministic columns and survives lost executors."""
    spark = df.sparkSession
    path = workspace(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most BATCH_ROWS rows in this session: texts are
    long, and a worker holds a whole batch beside its work arrays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(column: str = "text") -> F.Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text", max_bytes: int = 1 << 19, max_rows: int = 1 << 20):
    """Sub-batches of at most ``max_bytes`` of text (or one row) and
    ``max_rows`` rows: numpy work arrays are many times the text."""
    for batch in batches:
        i = batch.schema.get_field_index(column)
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(i)), 0).to_numpy(zero_copy_only=False)
        start, size = 0, 0
        for k, n in enumerate(lengths):
            if k > start and (size + n > max_bytes or k - start >= max_rows):
                yield batch.slice(start, k - start)
                start, size = k, 0
            size += int(n)
        if batch.num_rows > start:
            yield batch.slice(start)


def largest_cut(scored: DataFrame, column: str, k: int) -> float | None:
    """The ``k``-th largest value of a finite double column, exactly: narrows
    an interval by counting 256 cells per pass; nothing is sorted or
    collected but those counts. None where k is 0 or the table is empty."""
    lo, hi, n = scored.agg(F.min(column), F.max(column), F.count(column)).first()
    if k <= 0 or not n:
        return None
    if k >= n:
        return lo
    c, rank = F.col(column), k
    while lo < hi:
        width = (hi - lo) / 256
        if lo + width <= lo or hi - width >= hi:  # neighbours in floating point
            width = 0
        cell = F.least(F.floor((c - lo) / F.lit(width)), F.lit(255)) if width else F.when(c == hi, 255).otherwise(0)
        cells = (scored.where((c >= lo) & (c <= hi)).groupBy(cell.alias("cell"))
                 .agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).collect())
        for r in sorted(cells, key=lambda r: -r["cell"]):
            if rank <= r["n"]:
                lo, hi = r["lo"], r["hi"]
                break
            rank -= r["n"]
    return lo


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_keys() -> list[F.Column]:
    """Two columns, k1 and k2, that stand for a row's doc_id and text (null as empty)."""
    return [F.xxhash64(F.col("doc_id").isNull(), "doc_id", text_of()).alias("k1"), F.crc32(text_of().cast("binary")).alias("k2")]


def keep_rows(docs: DataFrame, kept: DataFrame, once: bool) -> DataFrame:
    """The rows of ``docs`` whose keys are in ``kept`` (k1, k2), with all
    their columns; with ``once``, one row of those with equal doc_id and text."""
    a, b = fresh(docs, "k1"), fresh(docs, "k2")
    k1, k2 = row_keys()
    right = kept.select(F.col("k1").alias(a + "_kept"), F.col("k2").alias(b + "_kept")).distinct()
    tagged = docs.select("*", k1.alias(a), k2.alias(b))
    out = tagged.join(right, (F.col(a) == F.col(a + "_kept")) & (F.col(b) == F.col(b + "_kept")), "left_semi")
    return (out.dropDuplicates([a, b]) if once else out).drop(a, b)
