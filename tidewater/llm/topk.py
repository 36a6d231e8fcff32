"""Exact top-k search by inner product: columnar branch-and-bound.

Components are scaled and floored to integers, and vectors are packed in
blocks with vertical layout: each dimension of a block stands in one piece.
A search meets a block of candidates with a few queries at a time and goes
through the dimensions in pieces of ``STEP``, those that weigh most in the
queries first. After each piece the score of a candidate is at most what it
has so far plus |rest of query| * |rest of candidate| (the mass that remains);
where that is below the query's k-th best score so far the pair is out. Columns
that no query of the few wants any more are compacted away, and where few
pairs are left in the rest, these go on one by one.

Queries and candidates meet in a grid: ``slices`` of candidate blocks by
``groups`` of query blocks, each of bounded bytes. A cell gives at most k rows
a query; the best of all cells are the result, equal to a full comparison.

All scores are exact: float32 or float64 products are used only where
Cauchy-Schwarz bounds every partial sum within their integers, else int64.

Inputs: vectors that are null or hold a null or non-finite component take no
part, nor do those whose squared length (scaled) is above 2^62, whose scores
need not fit a long; missing components of a shorter vector count as 0;
repeated rows are candidates of each other; a null id is no query and comes
last among ties; tables without vectors give an empty result; columns other
than the id and the vector are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import shuffle_partitions, written

K = 5
SCALE = 256
STEP = 16  # dimensions between two bounds
FEW = 64  # queries that go through a block together
SPARSE = 0.1  # share of pairs from which they go on one by one
BLOCK_BYTES = 1 << 17  # vectors of one block
SLICE_BYTES = 192 << 20  # candidates of a cell
GROUP_BYTES = 48 << 20  # queries of a cell
NO_ID = np.iinfo(np.int64).max  # stands for a null id, which sorts last
_LIMIT = 2.0**62


# --- blocks ------------------------------------------------------------------------

def _matrix(vectors: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Scaled and floored components (rows, dimensions), zero-padded, as
    int64; and the rows that take part."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    size = pa.compute.fill_null(pa.compute.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().cast(pa.float64())  # leaves out null lists
    x = flat.to_numpy(zero_copy_only=False)  # nulls become NaN
    row = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(x)) - np.repeat(np.cumsum(size) - size, size)
    with np.errstate(over="ignore", invalid="ignore"):
        y = np.floor(scale * x)
        mass = np.bincount(row, y * y, len(size))
    good = np.isfinite(mass) & (mass <= _LIMIT) & pa.compute.is_valid(vectors).to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), int(size.max(initial=0))), np.int64)
    on = good[row]
    out[row[on], at[on]] = y[on].astype(np.int64)
    return out, good


def blocks(vectors: DataFrame, id_column: str, column: str, queries: int, scale: int = SCALE) -> DataFrame:
    """(query, n, bytes, ids, rids, dims, data): blocks of candidates
    (query false) and of queries, whose ids ``queries`` divides. ``data`` has
    the components of one dimension after another, little-endian, in the
    smallest of int16, int32 and int64 that holds them. Written once."""
    def block(query: bool, ids: np.ndarray, rids: np.ndarray, m: np.ndarray) -> tuple:
        most = np.abs(m).max(initial=0)
        kind = next(k for k in ("<i2", "<i4", "<i8") if most <= np.iinfo(k).max)
        data = np.ascontiguousarray(m.T).astype(kind).tobytes()
        return query, len(ids), len(data), ids.tobytes(), rids.tobytes(), m.shape[1], data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bool, list] = {False: [], True: []}
        bytes_held = {False: 0, True: 0}

        def given(query: bool) -> Iterator[pa.RecordBatch]:
            if held[query]:
                ids, rids = (np.concatenate([h[k] for h in held[query]]) for k in (0, 1))
                wide = max(h[2].shape[1] for h in held[query])
                m = np.concatenate([np.pad(h[2], ((0, 0), (0, wide - h[2].shape[1]))) for h in held[query]])
                per = max(1, BLOCK_BYTES // max(2 * wide, 1))
                rows = [block(query, ids[k:k + per], rids[k:k + per], m[k:k + per]) for k in range(0, len(ids), per)]
                held[query], bytes_held[query] = [], 0
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _BLOCK.types)], schema=_BLOCK)

        for b in batches:
            ids = b.column("id")
            known = pa.compute.is_valid(ids).to_numpy(zero_copy_only=False)
            number = pa.compute.fill_null(ids, NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
            m, good = _matrix(b.column("vector"), scale)
            for query, on in ((False, good), (True, good & known & (number % queries == 0))):
                if on.any():
                    held[query].append((number[on], b.column("rid").to_numpy()[on], m[on]))
                    bytes_held[query] += 2 * m.shape[1] * int(on.sum())
                    if bytes_held[query] >= 4 * BLOCK_BYTES:
                        yield from given(query)
        yield from given(False)
        yield from given(True)

    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(column).alias("vector"), F.monotonically_increasing_id().alias("rid"))
    return written(rows.mapInArrow(run, "query boolean, n long, bytes long, ids binary, rids binary, dims int, data binary"), "vector-blocks")


_BLOCK = pa.schema([("query", pa.bool_()), ("n", pa.int64()), ("bytes", pa.int64()), ("ids", pa.binary()), ("rids", pa.binary()), ("dims", pa.int32()), ("data", pa.binary())])


def _opened(block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, rids and components (dimension by row) of a block."""
    kind = {2: "<i2", 4: "<i4", 8: "<i8"}[block["bytes"] // max(block["n"] * block["dims"], 1)] if block["bytes"] else "<i2"
    return np.frombuffer(block["ids"], np.int64), np.frombuffer(block["rids"], np.int64), np.frombuffer(block["data"], kind).reshape(block["dims"], block["n"])


# --- one cell ----------------------------------------------------------------------

class Best:
    """The k best candidates of each query so far: score descending, id ascending."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.full((queries, k), np.iinfo(np.int64).min)
        self.id = np.full((queries, k), NO_ID)
        self.full = np.zeros(queries, np.int64)  # candidates seen, up to k

    def least(self, q: slice) -> np.ndarray:
        """The score that a candidate must reach."""
        return self.score[q, -1]

    def add(self, query: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        which = np.unique(query)
        rank = np.arange(self.k)
        query = np.concatenate([np.repeat(which, self.k), query])
        seen = np.concatenate([(rank < self.full[which][:, None]).ravel(), np.ones(len(score), bool)])
        score, ident = np.concatenate([self.score[which].ravel(), score])[seen], np.concatenate([self.id[which].ravel(), ident])[seen]
        query = query[seen]
        order = np.lexsort((ident, -score, query))
        query, score, ident = query[order], score[order], ident[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        top = place < self.k
        self.score[query[top], place[top]], self.id[query[top], place[top]] = score[top], ident[top]
        np.maximum.at(self.full, query[top], place[top] + 1)


def _number_kind(longest_query: float, longest_candidate: float) -> type:
    """A number type whose integers hold every partial sum of the products."""
    most = longest_query * longest_candidate * 1.001
    return np.float32 if most < 2.0**24 else np.float64 if most < 2.0**53 else np.int64


def _may_reach(score: np.ndarray, rest_q: np.ndarray, rest_c: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Whether a score can still reach ``least`` with the masses that remain
    (squared); rounding only ever keeps a pair."""
    so_far = score.astype(np.float64)
    return so_far + np.sqrt(rest_q * np.maximum(rest_c, 0)) * (1 + 1e-9) + (1e-3 + 1e-12 * np.abs(so_far)) >= least


def _bounded(q: np.ndarray, c: np.ndarray, least: np.ndarray, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of the pairs that reach ``least``, exactly.
    ``q``: (queries, dimensions), ``c``: (dimensions, candidates), integers."""
    dims = q.shape[1]
    order = np.argsort(-np.abs(q).astype(np.float64).sum(axis=0), kind="stable")
    real_q = q[:, order].astype(np.float64)
    rest_q = np.concatenate([np.cumsum((real_q**2)[:, ::-1], axis=1)[:, ::-1], np.zeros((len(q), 1))], axis=1)
    alive = np.arange(c.shape[1])
    mass = (c.astype(np.float64) ** 2).sum(axis=0) * (1 + 1e-11) + 1e-9  # above what rounding takes
    score = np.zeros((len(q), len(alive)), kind)
    pairs = None
    for lo in range(0, max(dims, 1), STEP):
        part = order[lo:lo + STEP]
        hi = min(lo + STEP, dims)
        if pairs is None:
            piece = c[part][:, alive].astype(kind)
            score += q[:, part].astype(kind) @ piece
            mass = mass - (piece.astype(np.float64) ** 2).sum(axis=0)
            on = _may_reach(score, rest_q[:, hi, None], mass, least[:, None]) if hi < dims else score >= least[:, None].astype(kind)
            if hi >= dims or on.mean() < SPARSE:
                i, j = np.nonzero(on)
                pairs, score, mass = (i, alive[j]), score[i, j], mass[j]
            else:
                stay = on.any(axis=0)
                if not stay.all():
                    alive, score, mass = alive[stay], score[:, stay], mass[stay]
        else:
            i, j = pairs
            x, y = q[i][:, part].astype(kind), c[part][:, j].T.astype(kind)
            score = score + (x * y).sum(axis=1, dtype=kind)
            mass = mass - (y.astype(np.float64) ** 2).sum(axis=1)
            on = _may_reach(score, rest_q[i, hi], mass, least[i]) if hi < dims else score >= least[i].astype(kind)
            pairs, score, mass = (i[on], j[on]), score[on], mass[on]
    return pairs[0], pairs[1], score.astype(np.int64)


def _rows(table: pa.Table) -> list[dict]:
    """The rows of a table, binaries as buffers (not copied)."""
    cols = {c: table.column(c).to_pylist() if pa.types.is_integer(table.schema.field(c).type) else [x.as_buffer() for x in table.column(c)] for c in table.column_names}
    return [dict(zip(cols, r)) for r in zip(*cols.values())]


def search_cell(queries: list[dict], candidates: list[dict], k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(rid, id, score, candidate id) of the k best in a cell, per query block."""
    for block in queries:
        ids, rids, q = _opened(block)
        q = q.T.astype(np.int64)
        length = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
        best = Best(len(ids), k)
        for cand in candidates:
            other, other_rids, c = _opened(cand)
            dims = min(q.shape[1], c.shape[0])  # what is missing counts as 0
            kind = _number_kind(length.max(initial=0), float(np.sqrt((c[:dims].astype(np.float64) ** 2).sum(axis=0)).max(initial=0)))
            for lo in range(0, len(ids), FEW):
                few = slice(lo, lo + FEW)
                least = best.least(few)
                floor = np.where(best.full[few] < k, -math.inf, least.astype(np.float64))
                i, j, score = _bounded(q[few, :dims], c[:dims], floor if kind is not np.int64 else least, kind)
                own = rids[few][i] == other_rids[j]
                i, j, score = i[~own], j[~own], score[~own]
                if len(i):
                    best.add(i + lo, score, other[j])
        row = np.repeat(np.arange(len(ids)), best.full)
        place = np.concatenate([np.arange(n) for n in best.full]).astype(np.int64) if len(row) else row
        yield rids[row], ids[row], best.score[row, place], best.id[row, place]


# --- the search --------------------------------------------------------------------

def _grid(candidate_bytes: int, query_bytes: int, partitions: int) -> tuple[int, int]:
    """Slices and groups: cells of bounded bytes, and enough of them."""
    groups = max(1, math.ceil(query_bytes / GROUP_BYTES))
    return max(math.ceil(candidate_bytes / SLICE_BYTES), math.ceil(partitions / groups), 1), groups


def top_k(vectors: DataFrame, queries: int, k: int = K, id_column: str = "vec_id", column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row whose id ``queries``
    divides, the ``k`` other rows of highest inner product, ties to smaller ids."""
    spark = vectors.sparkSession
    packed = blocks(vectors, id_column, column, queries, scale)
    size = {r["query"]: r["b"] for r in packed.groupBy("query").agg(F.sum("bytes").alias("b")).collect()}
    slices, groups = _grid(size.get(False, 0), size.get(True, 0), shuffle_partitions(spark))

    content = ["n", "bytes", "ids", "rids", "dims", "data"]
    dealt = F.xxhash64("rids")
    right = packed.where("not query").select(F.pmod(dealt, F.lit(slices).cast("long")).alias("slice"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), *content)
    left = packed.where("query").select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("slice"), F.pmod(dealt, F.lit(groups)).cast("int").alias("group"), *content)

    def run(key, q: pa.Table, c: pa.Table) -> pa.Table:
        found = list(search_cell(_rows(q.select(content)), _rows(c.select(content)), k))
        cols = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 4
        return pa.table(dict(zip(("rid", "query_id", "score", "id"), cols)))

    cells = left.groupBy("slice", "group").cogroup(right.groupBy("slice", "group")).applyInArrow(run, "rid long, query_id long, score long, id long")
    order = Window.partitionBy("rid").orderBy(F.desc("score"), "id")
    return (cells.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), F.when(F.col("id") != NO_ID, F.col("id")).alias("vec_id"), "score"))
