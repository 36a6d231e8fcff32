"""Data-skipping index: bounds and a Bloom filter of chosen columns per file,
and scans that open only the files that can hold the wanted values.

The index is an append-only Parquet table with a row per file and column.
Files are known by path and length and never change, so only new ones are
read when the index is brought up to date; rows of files that are gone are
never looked at. A file that isn't in the index is always picked: a stale
index costs time, not rows.

A filter has ``BITS_PER_ROW`` bits a row of its file, in segments of 32,768
bits (Spark's bitmaps), and ``HASHES`` of them set per value; about 2 % of the
files that lack a value are picked. A task sets the bits of the file it
reads, one file after the other: it holds one filter per column, and what is
sorted and shuffled is bitmaps, not values.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.schema import LANDED_SCHEMA
from tidewater.operators.files import list_files
from tidewater.operators.refresh import read_store
from tidewater.session import ship_package

BITS_PER_ROW = 8
HASHES = 4
SEGMENT = 32_768
_BOUNDS = {"long": "bigint", "double": "double", "text": "string"}
_ENDS = [f"{k}_{end}" for k in _BOUNDS for end in ("low", "high")]
_PARTS = ("_file string, column string, rows bigint, segments bigint, filled bigint, "
          + "".join(f"{n} {_BOUNDS[n.split('_')[0]]}, " for n in _ENDS) + "segment bigint, bitmap binary")
_PARTS_ARROW = pa.schema([("_file", pa.string()), ("column", pa.string()), ("rows", pa.int64()), ("segments", pa.int64()), ("filled", pa.int64()),
                          *[(n, {"long": pa.int64(), "double": pa.float64(), "text": pa.string()}[n.split("_")[0]]) for n in _ENDS],
                          ("segment", pa.int64()), ("bitmap", pa.binary())])
_SENT = 256  # bitmaps in a batch


def _name(path: Column) -> Column:
    """A path in one form: listings and scans differ in the slashes behind the scheme."""
    return F.regexp_replace(path, r"^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def _kind(dt: T.DataType) -> str:
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "long"
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return "double"
    if isinstance(dt, T.StringType):
        return "text"
    raise ValueError(f"no index for a column of type {dt.simpleString()}")


def _position(value: Column, i, segments: Column) -> Column:
    """The bit of hash ``i`` of a value (cast to its kind) in a filter of so many segments."""
    return F.pmod(F.xxhash64(value, F.lit(i)), segments * SEGMENT)


def _ends(values: pa.Array, kind: str) -> tuple:
    """Least and greatest of values without nulls; NaN is the greatest, as in Spark."""
    if kind != "double":
        return tuple(x.as_py() for x in pc.min_max(values).values())
    v = values.to_numpy()
    numbers = v[~np.isnan(v)]
    return (float(numbers.min()) if len(numbers) else np.nan), (float(numbers.max()) if len(numbers) == len(v) else np.nan)


class _FilePart:
    """Facts and filters of the rows of one file that a task has read so far."""

    def __init__(self, file: str, segments: int, columns: dict[str, str]):
        self.file, self.segments, self.columns, self.rows = file, segments, columns, 0
        self.filled = [0] * len(columns)
        self.ends = [[] for _ in columns]
        self.bits = [np.zeros(segments * SEGMENT // 8, np.uint8) for _ in columns]

    def add(self, batch: pa.RecordBatch) -> None:
        self.rows += batch.num_rows
        for i, kind in enumerate(self.columns.values()):
            values = batch.column(f"_v{i}").drop_null()
            if not len(values):
                continue
            self.filled[i] += len(values)
            found = _ends(values, kind)
            self.ends[i] = [found] if not self.ends[i] else [self._wider(self.ends[i][0], found)]
            for h in range(HASHES):
                at = batch.column(f"_p{i}_{h}").drop_null().to_numpy()
                np.bitwise_or.at(self.bits[i], at >> 3, np.left_shift(1, at & 7).astype(np.uint8))

    @staticmethod
    def _wider(x: tuple, y: tuple) -> tuple:
        last = lambda v: (v != v, v)
        return min(x[0], y[0], key=last), max(x[1], y[1], key=last)

    def batches(self) -> Iterator[pa.RecordBatch]:
        """A row of facts per column, and one per segment with bits."""
        def sent(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"_file": self.file, **r} for r in rows], _PARTS_ARROW)

        facts = []
        for i, (column, kind) in enumerate(self.columns.items()):
            low, high = self.ends[i][0] if self.ends[i] else (None, None)
            facts.append({"column": column, "rows": self.rows, "segments": self.segments, "filled": self.filled[i], f"{kind}_low": low, f"{kind}_high": high})
        yield sent(facts)
        for i, column in enumerate(self.columns):
            maps = self.bits[i].reshape(self.segments, SEGMENT // 8)
            some = np.flatnonzero(maps.any(axis=1))
            for lo in range(0, len(some), _SENT):
                yield sent([{"column": column, "segment": int(s), "bitmap": maps[s].tobytes()} for s in some[lo:lo + _SENT]])


def _index_rows(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """(file, column, rows, nulls, bounds, segments, bits) of a file scan."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = None
        for batch in batches:
            names = batch.column("_file").dictionary_encode()
            code = names.indices.to_numpy()
            starts = np.flatnonzero(np.diff(code, prepend=-1)).tolist()
            for lo, hi in zip(starts, [*starts[1:], len(code)]):
                file = names.dictionary[int(code[lo])].as_py()
                if part is None or part.file != file:
                    if part is not None:
                        yield from part.batches()
                    part = _FilePart(file, batch.column("segments")[lo].as_py(), columns)
                part.add(batch.slice(lo, hi - lo))
        if part is not None:
            yield from part.batches()

    rows = rows.select(_name(F.col("_metadata.file_path")).alias("_file"), *[F.col(c).cast(_BOUNDS[k]).alias(f"_v{i}") for i, (c, k) in enumerate(columns.items())])
    # A row per new file: as many as the paths that the driver lists.
    sizes = rows.groupBy("_file").agg(F.greatest(F.lit(1).cast("bigint"), F.ceil(F.count(F.lit(1)) * BITS_PER_ROW / SEGMENT)).alias("segments"))
    placed = rows.join(F.broadcast(sizes), "_file").select("*", *[
        F.when(F.col(f"_v{i}").isNotNull(), _position(F.col(f"_v{i}"), h, F.col("segments"))).alias(f"_p{i}_{h}") for i in range(len(columns)) for h in range(HASHES)])
    parts = placed.mapInArrow(run, _PARTS)
    ends = [(F.min if n.endswith("low") else F.max)(n).alias(n) for n in _ENDS]
    facts = [F.sum("rows").alias("rows"), F.max("segments").alias("segments"), F.sum("filled").alias("filled"), *ends]
    # A file that was read by several tasks has parts to put together.
    merged = parts.groupBy("_file", "column", "segment").agg(*facts, F.bitmap_or_agg("bitmap").alias("bitmap"))
    whole = merged.groupBy("_file", "column").agg(*facts, F.map_from_entries(F.collect_list(F.when(F.col("segment").isNotNull(), F.struct("segment", "bitmap")))).alias("bitmaps"))
    return whole.select("_file", "column", (F.col("rows") - F.col("filled")).alias("nulls"), *_ENDS, "rows", "segments",
                        F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("segments") - 1), lambda s: F.col("bitmaps")[s]).alias("bits"))


def update_index(spark: SparkSession, index: str, root: str, columns, schema: T.StructType = LANDED_SCHEMA) -> int:
    """Index the files of ``root`` that ``index`` lacks; returns how many.
    Their paths (not data) pass through the driver, as in any scan."""
    types = {f.name: f.dataType for f in schema.fields}
    listed = list_files(spark, root, ()).select("path", "length", _name(F.col("path")).alias("_file"))
    known = read_store(spark, index)
    new = listed if known is None else listed.join(known.select("_file", "length"), ["_file", "length"], "left_anti")
    paths = [r["path"] for r in new.select("path").collect()]
    if not paths:
        return 0
    ship_package(spark)
    rows = spark.read.schema(schema).option("basePath", root).parquet(*paths)
    made = _index_rows(rows, {c: _kind(types[c]) for c in columns})
    made.join(listed.select("_file", "length"), "_file").write.mode("append").parquet(index)
    return len(paths)


def _may_hold(values: list, kind: str) -> Column:
    """Whether a file's row of the index allows for any of the values."""
    wanted = F.array(*[F.lit(v).cast(_BOUNDS[kind]) for v in values])

    def bit(v: Column, h: int) -> Column:
        at = _position(v, h, F.col("segments"))
        byte = F.substring(F.get(F.col("bits"), F.floor(at / SEGMENT).cast("int")), (F.floor((at % SEGMENT) / 8) + 1).cast("int"), F.lit(1))
        return F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(F.call_function("shiftleft", F.lit(1), (at % 8).cast("int"))) != 0

    return F.exists(wanted, lambda v: (v >= F.col(f"{kind}_low")) & (v <= F.col(f"{kind}_high")) & reduce(lambda a, b: a & b, [bit(v, h) for h in range(HASHES)]))


def pick_files(spark: SparkSession, index: str, root: str, column: str, values, schema: T.StructType = LANDED_SCHEMA) -> DataFrame:
    """(path, length) of the files of ``root`` that can hold one of the
    ``values`` (not null) in ``column``, and of those not indexed."""
    kind = _kind({f.name: f.dataType for f in schema.fields}[column])
    listed = list_files(spark, root, ()).select("path", "length", _name(F.col("path")).alias("_file"))
    rows = spark.read.parquet(index).where(F.col("column") == column)
    verdict = rows.select("_file", "length", F.coalesce(_may_hold(list(values), kind), F.lit(False)).alias("may")).dropDuplicates(["_file", "length"])
    return listed.join(verdict, ["_file", "length"], "left").where(F.coalesce("may", F.lit(True))).select("path", "length")


def scan_values(spark: SparkSession, index: str, root: str, column: str, values, schema: T.StructType = LANDED_SCHEMA) -> DataFrame:
    """The rows of ``root`` with one of the ``values`` in ``column``, read
    from the picked files only."""
    paths = [r["path"] for r in pick_files(spark, index, root, column, values, schema).collect()]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*paths).where(F.col(column).isin(list(values)))
