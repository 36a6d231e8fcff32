"""Mixing sources to target weights.

The words of a source, its documents in a keyed pseudo-random order, are cut
into blocks of equal size. A source's target gives its exact quota of
blocks: whole passes over the source and a part of one more. The quotas are
dealt to output shards by a splitting tree: at each node the blocks that go
left are drawn per source from the multivariate hypergeometric distribution,
so every shard holds a random mix of the exact totals. A shard then owns one
range of each source's permuted blocks, disjoint from every other shard's,
and orders its blocks by a local shuffle.

Every draw is a function of the seed, so reruns agree. Block numbers come
from prefix sums over (source, bucket) cells: a source may hold any share of
the rows. Per-source totals (one row a source, at most ``MAX_SOURCES``,
checked) are what the driver sees.

Inputs: null text has size 0 and is never drawn; null source is a source of
its own, last; repeated rows are separate documents; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import WORD, text_of, written
from tidewater.llm.words import mix

MAX_SOURCES = 100_000  # rows of the per-source table that tasks get; more raise
MAX_REPEAT = 3  # a target is at most this many times its source
BLOCK_WORDS = 128
SOURCE_BLOCKS = 1024  # smaller sources get smaller blocks, so that quotas stay exact
ROWS_PER_CELL = 5_000


def n_words(column: str = "text") -> F.Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def targets(sizes: list[int], weights: list[int], most: int = MAX_REPEAT) -> list[float]:
    """Shares of all sizes by weight; a target stops at ``most`` times its
    size and the excess is shared again by weight until none is above."""
    out = [0.0] * len(sizes)
    open_ = [k for k in range(len(sizes))]
    left = float(sum(sizes))
    while open_:
        total = sum(weights[k] for k in open_)
        full = [k for k in open_ if left * weights[k] / total > most * sizes[k]]
        if not full:
            for k in open_:
                out[k] = left * weights[k] / total
            break
        for k in full:
            out[k] = float(most * sizes[k])
        left -= sum(most * sizes[k] for k in full)
        closed = set(full)
        open_ = [k for k in open_ if k not in closed]
    return out


def source_plan(rows: DataFrame) -> list[dict]:
    """One dict a source, by code point, null last: its size, target, block
    size, number of blocks and quota of blocks."""
    per = rows.groupBy("source").agg(F.sum("size").alias("size"))
    found = per.limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"over {MAX_SOURCES} sources; raise MAX_SOURCES if the driver can hold more")
    found.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = [int(r["size"]) for r in found]
    goal = targets(sizes, [k % 3 + 1 for k in range(len(sizes))])
    plan = []
    for r, size, want in zip(found, sizes, goal):
        block = max(1, min(BLOCK_WORDS, size // SOURCE_BLOCKS))
        blocks = -(-size // block)
        plan.append({"source": r["source"], "size": size, "target": want, "block": block, "blocks": blocks,
                     "quota": min(MAX_REPEAT * blocks, round(want / block))})
    return plan


def shard_quotas(quotas: list[int], shards: int, seed: int) -> np.ndarray:
    """(shards, sources) blocks of each shard, by the splitting tree. A node
    is seeded by its range of shards, so any part can be drawn alone."""
    out = np.zeros((shards, len(quotas)), np.int64)
    nodes = [(0, shards, np.asarray(quotas, np.int64))]
    while nodes:
        lo, hi, have = nodes.pop()
        if hi - lo == 1:
            out[lo] = have
            continue
        mid = (lo + hi) // 2
        total, rng = int(have.sum()), np.random.default_rng([seed, lo, hi])
        want, left = total * (mid - lo) // (hi - lo), np.zeros_like(have)
        rest = total
        for k, n in enumerate(have):
            # numpy's hypergeometric takes less than 1e9 of each kind: larger
            # nodes are split by proportion, whose relative noise is below 1e-4
            if want and n:
                left[k] = (rng.hypergeometric(n, rest - n, want) if rest < 10**9
                           else min(n, want, max(want - (rest - n), round(n * want / rest))))
            rest -= int(n)
            want -= int(left[k])
        nodes += [(lo, mid, left), (mid, hi, have - left)]
    return out


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed permutation of range(n), elementwise: a four-round Feistel
    network on the next even power of two, walked until inside the range."""
    out = index.astype(np.uint64)
    n = n.astype(np.uint64)
    half = np.maximum(1, np.ceil(np.log2(np.maximum(n, 2).astype(np.float64)) / 2)).astype(np.uint64)
    half += (np.uint64(1) << (half + half)) < n
    mask = (np.uint64(1) << half) - np.uint64(1)
    todo = np.arange(len(out))
    while len(todo):
        h, m, x = half[todo], mask[todo], out[todo]
        left, right = x >> h, x & m
        for r in range(4):
            left, right = right, left ^ (mix(right + key[todo] + np.uint64(0x9E3779B97F4A7C15 * (r + 1) % 2**64)) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


PIECES = "array<struct<epoch:int,shard:int,place:long,start:long,words:long>>"


def draw(docs: DataFrame, shards: int = 64, seed: int = 7, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken and its
    drawn ``pieces`` (epoch, shard, place in the shard, first word, words).
    With ``with_text`` also the columns of ``docs``, as struct ``row``."""
    sized = docs.select(
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if with_text else []),
        "doc_id", "source", n_words().alias("size"), F.xxhash64(F.lit(seed), "doc_id", text_of()).alias("key"))
    rows = written(sized, "mix-sizes")
    plan = source_plan(rows)
    number = {p["source"]: k for k, p in enumerate(plan)}
    cuts = np.vstack([np.zeros((1, len(plan)), np.int64),
                      np.cumsum(shard_quotas([p["quota"] for p in plan], shards, seed), axis=0)])
    column = {c: np.array([p[c] for p in plan], np.int64) for c in ("size", "block", "blocks", "quota")}
    goal = np.array([p["target"] for p in plan], np.float64)

    cells = max(1, math.ceil(rows.count() / ROWS_PER_CELL))
    # Words before each cell of its source; a cell holds about ROWS_PER_CELL rows.
    rows = rows.withColumn("cell", F.pmod(F.col("key"), F.lit(cells)))
    per_cell = rows.groupBy("source", "cell").agg(F.sum("size").alias("n"))
    before = per_cell.select(
        F.col("source").alias("s"), F.col("cell").alias("c"),
        (F.sum("n").over(Window.partitionBy("source").orderBy("cell")) - F.col("n")).alias("base"))
    w = Window.partitionBy("source", "cell").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    offset = rows.withColumn("inside", F.coalesce(F.sum("size").over(w), F.lit(0)))
    placed = offset.join(before, F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("c"))).withColumn(
        "at", F.col("base") + F.col("inside")).drop("s", "c", "cell", "base", "inside", "key")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 2000):
                yield _pieces(whole.slice(i, 2000), number, column, goal, cuts, seed)

    schema = T.StructType.fromDDL(f"doc_id {dict(docs.dtypes)['doc_id']}, size long, source_size long, target double, taken long, pieces {PIECES}")
    if with_text:
        schema = T.StructType([rows.schema["row"], *schema.fields])
    return placed.mapInArrow(deal, schema)


def drawn_by_shard(docs: DataFrame, shards: int = 64, seed: int = 7) -> DataFrame:
    """``draw`` with the words that each shard takes of a document, by shard,
    in place of its pieces: ``shard_words`` (shard, words)."""
    total = lambda s: F.aggregate(F.filter("pieces", lambda p: p["shard"] == s), F.lit(0).cast("long"), lambda n, p: n + p["words"])
    each = F.transform(F.array_sort(F.array_distinct("pieces.shard")), lambda s: F.struct(s.alias("shard"), total(s).alias("words")))
    return draw(docs, shards, seed).withColumn("shard_words", each).drop("pieces")


def _pieces(b: pa.RecordBatch, number: dict, column: dict, goal: np.ndarray, cuts: np.ndarray, seed: int) -> pa.RecordBatch:
    src = np.array([number[s] for s in b.column("source").to_pylist()], np.int64)
    size, at = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("size", "at"))
    block, blocks, quota = (column[c][src] for c in ("block", "blocks", "quota"))
    first = at // block
    many = np.where(size > 0, (at + size - 1) // block - first + 1, 0)
    doc = np.repeat(np.arange(len(src)), many)
    index = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    lo = np.maximum(index * block[doc], at[doc])
    hi = np.minimum((index + 1) * block[doc], (at + size)[doc])
    found = []
    for epoch in range(MAX_REPEAT):
        key = mix((src[doc] * 1000 + epoch + seed * 1_000_003).astype(np.uint64))
        turn = epoch * blocks[doc] + permuted(index, blocks[doc], key)
        on = np.flatnonzero(turn < quota[doc])
        shard = np.empty(len(on), np.int64)
        for s in np.unique(src[doc[on]]):
            mine = src[doc[on]] == s
            shard[mine] = np.searchsorted(cuts[:, s], turn[on][mine], "right") - 1
        place = (mix(turn[on].astype(np.uint64) ^ key[on]) >> np.uint64(1)).astype(np.int64)
        found.append((doc[on], np.full(len(on), epoch), shard, place, (lo - at[doc])[on], (hi - lo)[on]))
    doc_of, epoch, shard, place, start, words = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((start, epoch, doc_of))
    doc_of, epoch, shard, place, start, words = (x[order] for x in (doc_of, epoch, shard, place, start, words))
    bounds = np.searchsorted(doc_of, np.arange(len(src) + 1))
    pieces = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(epoch, pa.int32()), pa.array(shard, pa.int32()), pa.array(place), pa.array(start), pa.array(words)],
        names=["epoch", "shard", "place", "start", "words"]))
    taken = np.bincount(doc_of, words, len(src)).astype(np.int64)
    columns = {"doc_id": b.column("doc_id"), "size": pa.array(size), "source_size": pa.array(column["size"][src]),
               "target": pa.array(goal[src]), "taken": pa.array(taken), "pieces": pieces}
    if "row" in b.schema.names:
        columns = {"row": b.column("row")} | columns
    return pa.RecordBatch.from_pydict(columns)


def mixed_documents(docs: DataFrame, shards: int = 64, seed: int = 7) -> DataFrame:
    """The mix as documents: a row of ``docs`` for each pass that takes any of
    it. A whole pass keeps the text as it is; a part keeps the drawn words in
    their order, joined by one space."""
    drawn = draw(docs, shards, seed, with_text=True).where("taken > 0")
    passes = drawn.select("row", "size", "pieces", F.explode(F.array_distinct("pieces.epoch")).alias("epoch"))
    mine = F.filter("pieces", lambda p: p["epoch"] == F.col("epoch"))
    cut = F.pandas_udf(_cut, "string")
    out = passes.select("row", cut(F.col("row.text"), F.col("size"), mine["start"], mine["words"]).alias("cut"))
    return out.select(*[F.col("cut").alias("text") if c == "text" else
                        F.length("cut").cast("long").alias("n_chars") if c == "n_chars" else
                        F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def _cut(text: pd.Series, size: pd.Series, start: pd.Series, words: pd.Series) -> pd.Series:
    out = []
    for t, n, a, k in zip(text, size, start, words):
        if sum(k) == n:
            out.append(t)
        else:
            w = t.encode().split()
            out.append(b" ".join(x for i, m in zip(a, k) for x in w[i:i + m]).decode())
    return pd.Series(out, dtype=object)


def shard_rows(docs: DataFrame, shards: int = 64, seed: int = 7) -> DataFrame:
    """The drawn blocks of every shard in its shuffled order: shard, place,
    doc_id, epoch, start, words. One partition per shard at most."""
    return (draw(docs, shards, seed).select("doc_id", F.explode("pieces").alias("p")).select("doc_id", "p.*")
            .repartitionByRange("shard", "place").sortWithinPartitions("shard", "place", "doc_id", "start"))
