"""Near-duplicate detection with DartMinHash signatures.

Each element of a weighted set owns a region [0, weight) x [0, infinity).
Darts fall on the regions by a Poisson process that is a function of the
element's hash, so equal elements get equal darts in every document. A dart
has a rank and one of k coordinates; a signature keeps the earliest dart of
each coordinate. Two sets agree on a coordinate with the probability of their
weighted Jaccard similarity, and only about k log k darts a document are made
whatever its length.

Elements are the five-word shingles; with ``weights="count"`` each weighs its
count in the document, with ``"set"`` 1 (the plain Jaccard similarity). ``BANDS`` bands
of ``ROWS`` coordinates: a pair of similarity 0.8 shares no band with a
probability below 1e-5.

Documents with equal sets are one class from the start and one of them goes
on. In each band bucket the documents are compared with one of least size
(its pivot), exactly, and links give classes. Buckets that still hold several
classes are compared in full: every two documents of such a bucket, in a grid
of blocks. A bucket is dealt by hash into chunks of about ``BLOCK_DOCS``
documents and ``BLOCK_UNITS`` units at most, and each pair of chunks is a
group of its own, so what a task holds doesn't grow with the bucket; the
overlaps of a block are one product of incidence matrices. Buckets of the same
documents (128-bit fingerprints) are compared once. Nothing that shares a band
is lost, whatever the size of the bucket. The number of comparisons is
quadratic in the size of an open bucket; README has the figures.

``exact`` refines open buckets by units instead of the grid. Of two similar
documents in a bucket, not both similar to the pivot, both hold some unit (an
element, or one more of its copies) that the pivot lacks: if x and y overlap
by more than 4/9 of |x| + |y|, as they must at 0.8, and all of that lay in a
pivot z no larger than either, then both would overlap z by 4/9 of |x| + |z|
and |y| + |z|, so be similar to it. So what a pivot has is taken away, and
documents that share a unit that is left form the next buckets, with pivots of
their own, until no bucket holds several classes. That loses nothing either,
compares less where unlike documents share a template, and takes as many
rounds as a group of scattered edits has pivots.

Inputs: null text counts as empty; a document without words is a class of its
own; one of one to four words has one shingle, all its words; repeated rows
are copies; null ids sort last; empty tables give an empty result; columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import keep_rows, row_keys, text_slices, written
from tidewater.llm.components import components
from tidewater.llm.words import Words, mix, uniform

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 30, 5
BLOCK_DOCS, BLOCK_UNITS = 512, 1 << 19  # of a chunk of an open bucket; a block of the grid holds two chunks
GRID_COLUMNS = 2048  # units of a block that are multiplied at a time
SLICE_ROWS = 256  # documents at a time: each makes some thousand darts, however short it is
SEED = 0x51ED270B
_BASE_CLASS = -6  # darts of ranks below 2**-6 are made together
_CDF: dict[float, np.ndarray] = {}


def _poisson(u: np.ndarray, mean: float) -> np.ndarray:
    """Poisson counts by inversion of uniform numbers."""
    if mean not in _CDF:
        top = int(mean + 12 * math.sqrt(mean) + 20)
        terms = np.cumsum(np.concatenate([[0.0], np.log(np.arange(1, top))]))
        _CDF[mean] = np.cumsum(np.exp(np.arange(top) * math.log(mean) - mean - terms))
    return np.searchsorted(_CDF[mean], u, "right")


def dart_signatures(element: np.ndarray, weight: np.ndarray, row: np.ndarray, rows: int, k: int, seed: int = SEED) -> np.ndarray:
    """(rows, k) ranks of the earliest dart per coordinate; inf in rows of no weight."""
    total = np.bincount(row, weight, rows).astype(np.float64)
    # Unit cells of the weight axis; the last one of an element may be cut.
    cells = np.ceil(weight).astype(np.int64)
    which = np.repeat(np.arange(len(element)), cells)
    cell = np.arange(len(which)) - np.repeat(np.cumsum(cells) - cells, cells)
    room = weight[which] - cell
    key = mix(element[which] + cell.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    owner = row[which]
    signature = np.full(rows * k, np.inf)
    until = np.divide(k * (math.log(k) + 2), total, out=np.zeros(rows), where=total > 0)  # rank of the last dart wanted
    open_ = total > 0
    rank_class = _BASE_CLASS
    while open_.any():
        lo = 0.0 if rank_class == _BASE_CLASS else 2.0 ** (rank_class - 1)
        width = 2.0 ** rank_class - lo
        on = np.flatnonzero(open_[owner])
        own = mix(key[on] ^ np.uint64((rank_class + 64) * 0x2545F4914F6CDD1D % 2**64))
        many = _poisson(uniform(own), width)
        hit = np.repeat(np.arange(len(on)), many)
        dart = mix(own[hit] + (np.arange(len(hit)) - np.repeat(np.cumsum(many) - many, many)).astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(1))
        rank = lo + width * uniform(dart)
        other = mix(dart ^ np.uint64(0xA0761D6478BD642F))
        inside = uniform(mix(other + np.uint64(7))) < room[on][hit]
        at = owner[on][hit] * k + (other % np.uint64(k)).astype(np.int64)
        np.minimum.at(signature, at[inside], rank[inside])
        rank_class += 1
        reached = 2.0 ** (rank_class - 1) >= until
        empty = np.isinf(signature.reshape(rows, k)).any(axis=1)
        open_ &= ~reached | empty
    return signature.reshape(rows, k)


def shingles(texts: pa.Array, weights: str = "set") -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(row, element, weight) of the distinct shingles of each row, and the rows."""
    w = Words(texts)
    h, row, rows = w.hashes(), w.rows(), len(w.count)
    at, prints = w.windows(h, SHINGLE)
    owner = row[at]
    short = np.flatnonzero((w.count > 0) & (w.count < SHINGLE))
    if len(short):
        whole = [mix(np.array([np.bitwise_xor.reduce(mix(h[w.first[k]:w.first[k + 1]] + np.arange(w.count[k]).astype(np.uint64))) ^ np.uint64(0x5D)], np.uint64)) for k in short]
        prints, owner = np.concatenate([prints, *whole]), np.concatenate([owner, short])
    _, one, count = np.unique(mix(prints ^ mix(owner.astype(np.uint64) + np.uint64(1))), return_index=True, return_counts=True)
    return owner[one], prints[one], (count if weights == "count" else np.ones(len(one))).astype(np.float64), rows


def _band_hashes(signature: np.ndarray, bands: int, per_band: int) -> np.ndarray:
    bits = signature.view(np.uint64).reshape(len(signature), bands, per_band)
    h = np.tile(np.arange(bands, dtype=np.uint64) + np.uint64(1), (len(signature), 1))
    for r in range(per_band):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + bits[:, :, r])
    return h.view(np.int64)


def signatures(docs: DataFrame, weights: str = "set", bands: int = BANDS, per_band: int = ROWS) -> DataFrame:
    """One row per document: rid, doc_id, size (total weight), fp1 and fp2
    (fingerprints of the weighted set), band hashes and the compressed text. Written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, max_rows=SLICE_ROWS):
            row, element, weight, rows = shingles(b.column("text"), weights)
            signature = dart_signatures(element, weight, row, rows, bands * per_band)
            size = np.bincount(row, weight, rows).astype(np.float64)
            own = mix(element + mix(weight.astype(np.uint64)))
            order = np.argsort(row, kind="stable")
            bounds = np.searchsorted(row[order], np.arange(rows + 1))
            sums = np.concatenate([[np.uint64(0)], np.cumsum(own[order])])
            more = np.concatenate([[np.uint64(0)], np.cumsum(mix(own[order] ^ np.uint64(0xC0FFEE)))])
            fp = [(s[bounds[1:]] - s[bounds[:-1]]).view(np.int64) for s in (sums, more)]
            hashes = _band_hashes(signature, bands, per_band)
            text = [_ZSTD.compress((t or "").encode()) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("k1"), b.column("k2"), pa.array(size), pa.array(fp[0]), pa.array(fp[1]), pa.array(list(hashes), pa.list_(pa.int64())),
                 pa.array(text, pa.binary())],
                names=["doc_id", "k1", "k2", "size", "fp1", "fp2", "bands", "z"])

    out = docs.select("doc_id", "text", *row_keys()).mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, k1 long, k2 long, size double, fp1 long, fp2 long, bands array<long>, z binary")
    return written(out.withColumn("rid", F.monotonically_increasing_id()), "signatures")


class _Zstd:
    """One zstd context per worker process."""

    def compress(self, raw: bytes) -> bytes:
        import zstandard

        if not hasattr(self, "c"):
            self.c = zstandard.ZstdCompressor(level=1)
        return self.c.compress(raw)

    def decompress(self, raw: bytes) -> bytes:
        import zstandard

        if not hasattr(self, "d"):
            self.d = zstandard.ZstdDecompressor()
        return self.d.decompress(raw)


_ZSTD = _Zstd()


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, za, zb) of the pairs (a, b), those of one ``a`` in a row."""
    left = texts.select(F.col("rid").alias("a"), F.col("z").alias("za"))
    right = texts.select(F.col("rid").alias("b"), F.col("z").alias("zb"))
    # Sort-merge at every size: which side is small depends on the corpus.
    return pairs.select("a", "b").join(right.hint("merge"), "b").join(left.hint("merge"), "a").select("a", "b", "za", "zb")


def _sets(batch: pa.RecordBatch, weights: str, last: list) -> Iterator[tuple]:
    """(a, b, set of a, set of b) of a batch; ``last`` keeps the latest a."""
    for a, b, za, zb in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "za", "zb"))):
        if last[0] != a:
            last[:] = a, _set_of(za, weights)
        yield a, b, last[1], _set_of(zb, weights)


def similar(pairs: DataFrame, texts: DataFrame, weights: str = "set", least: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose exact similarity is ``least`` or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = [None, None]
        for batch in batches:
            out = [(a, b) for a, b, x, y in _sets(batch, weights, last) if _jaccard(x, y) >= least]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], names=["a", "b"])

    return _with_texts(pairs, texts).mapInArrow(run, "a long, b long")


def units_beside(pivot: tuple[np.ndarray, np.ndarray], own: tuple[np.ndarray, np.ndarray], most: int | None) -> np.ndarray:
    """Hashes of the units of ``own`` that ``pivot`` lacks: the ``most`` least."""
    element, weight = own
    at = np.minimum(np.searchsorted(pivot[0], element), max(len(pivot[0]) - 1, 0))
    held = np.where(pivot[0][at] == element, pivot[1][at], 0.0) if len(pivot[0]) else np.zeros(len(element))
    extra = np.maximum(weight - held, 0).astype(np.int64)
    which = np.repeat(np.arange(len(element)), extra)
    copy = held.astype(np.int64)[which] + np.arange(len(which)) - np.repeat(np.cumsum(extra) - extra, extra)
    units = mix(mix(element[which]) + copy.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return units if most is None or len(units) <= most else np.partition(units, most)[:most]


def _compared(pairs: DataFrame, texts: DataFrame, weights: str, least: float, most: int | None) -> DataFrame:
    """(a, b, alike, units) of the pairs: whether they are similar, and the
    hashed units of b that its pivot a lacks, as keys of finer buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = [None, None]
        for batch in batches:
            alike, units = [], []
            for a, b, x, y in _sets(batch, weights, last):
                alike.append(_jaccard(x, y) >= least)
                units.append(mix(units_beside(x, y, most) ^ mix(np.array([a], np.int64).view(np.uint64) + np.uint64(SEED))).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(alike, pa.bool_()), pa.array(units, pa.list_(pa.int64()))], names=["a", "b", "alike", "units"])

    return _with_texts(pairs, texts).mapInArrow(run, "a long, b long, alike boolean, units array<long>")


def _set_of(z: bytes, weights: str) -> tuple[np.ndarray, np.ndarray]:
    _, element, weight, _ = shingles(pa.array([_ZSTD.decompress(z)], pa.binary()).cast(pa.string()), weights)
    order = np.argsort(element)
    return element[order], weight[order]


def _jaccard(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    _, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    common = np.minimum(x[1][i], y[1][j]).sum()
    total = x[1].sum() + y[1].sum() - common
    return float(common / total) if total else 0.0


def near_classes(docs: DataFrame, weights: str = "count", least: float = SIMILARITY, exact: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, class_id (smallest doc_id of its class),
    class_size and kept (true for one row of a class). ``exact`` refines
    buckets by all units until none holds several classes."""
    return _classes(docs, weights, least, exact).drop("k1", "k2")


def _classes(docs: DataFrame, weights: str = "count", least: float = SIMILARITY, exact: bool = False) -> DataFrame:
    rows = signatures(docs, weights)
    # Equal weighted sets: one document goes on.
    sets = rows.where("size > 0").groupBy("fp1", "fp2", "size").agg(F.min("rid").alias("rep"))
    member = written(rows.select("rid", "doc_id", "k1", "k2", "fp1", "fp2", "size").join(sets, ["fp1", "fp2", "size"], "left")
                     .select("rid", "doc_id", "k1", "k2", F.coalesce("rep", "rid").alias("rep")), "members")
    first = member.where("rid = rep").select("rid")
    # Sort-merge joins, here and of the texts, whatever the size: the same plan on small and large tables.
    banded = rows.where("size > 0").select("rid", "size", "bands").join(first.hint("merge"), "rid", "left_semi").select("rid", "size", F.explode("bands").alias("h"))
    shared = banded.groupBy("h").agg(F.min(F.struct("size", "rid")).alias("pivot"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    buckets = written(banded.join(shared, "h").select("h", "rid", "size", "pivot"), "buckets")
    texts = written(rows.select("rid", "z", "size").join(buckets.select("rid").distinct().hint("merge"), "rid", "left_semi"), "texts")

    roots, turn = None, 0
    while True:
        # Every document of a bucket beside its pivot.
        beside = buckets.where("rid <> pivot.rid").select(F.col("pivot.rid").alias("a"), F.col("rid").alias("b")).distinct()
        if exact:
            compared = written(_compared(beside, texts, weights, least, None), f"compared-{turn}")
            found = compared.where("alike").select("a", "b")
        else:
            found = written(similar(beside, texts, weights, least), "pairs")
        roots = written(components(found if roots is None else _stars(roots).unionByName(found)), f"roots-{turn}")
        open_ = written(_several(_rooted(buckets, roots)), f"open-{turn}")
        if not exact or open_.isEmpty():
            break
        # Finer buckets, by the units that the pivots of open ones lack.
        still = open_.select(F.col("pivot.rid").alias("a"), F.col("rid").alias("b")).distinct()
        finer = compared.join(still, ["a", "b"]).select(F.explode("units").alias("h"), F.col("b").alias("rid")).distinct()
        sized = _rooted(finer.join(texts.select("rid", "size"), "rid"), roots)
        pivots = (sized.groupBy("h").agg(F.min(F.struct("size", "rid", "root")).alias("pivot"), F.min("root").alias("x"), F.max("root").alias("y"))
                  .where("x <> y").drop("x", "y"))
        turn += 1
        buckets = (written(sized.join(pivots, "h").select("h", "rid", "size", "pivot"), f"buckets-{turn}")
                   .select("h", "rid", "size", F.struct("pivot.size", "pivot.rid").alias("pivot")))
    if not open_.isEmpty():
        found = written(_grid_links(open_, roots, texts, weights, least), "links")
        roots = written(components(_stars(roots).unionByName(found)), "roots-grid")

    of = member.join(roots, F.col("rep") == F.col("node"), "left").select("rid", "doc_id", "k1", "k2", F.coalesce("root", "rep").alias("root"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")
    groups = of.groupBy("root").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("class_size"))
    return of.join(groups, "root").select("doc_id", F.col("first.doc_id").alias("class_id"), F.col("class_size").cast("long").alias("class_size"),
                                          (F.col("first.rid") == F.col("rid")).alias("kept"), "k1", "k2")


def _grid_links(open_: DataFrame, roots: DataFrame, texts: DataFrame, weights: str, least: float,
                docs: int = BLOCK_DOCS, units: int = BLOCK_UNITS) -> DataFrame:
    """Links (a, b) between the classes so far of all similar documents that
    share an open bucket: every pair of each bucket, in blocks."""
    def run(table: pa.Table) -> pa.Table:
        held = pa.array([_ZSTD.decompress(z) for z in table.column("z").to_pylist()], pa.binary()).cast(pa.string())
        root, chunk = (table.column(c).to_numpy() for c in ("root", "chunk"))
        left = np.flatnonzero(chunk == chunk.min())
        right = np.flatnonzero(chunk == chunk.max())
        alike = _overlaps(held, weights, left, right)
        size = table.column("size").to_numpy()
        total = size[left][:, None] + size[right][None, :] - alike
        i, j = np.nonzero((alike / total >= least) & (root[left][:, None] != root[right][None, :]))
        a, b = root[left[i]], root[right[j]]
        links = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
        return pa.table({"a": pa.array(links[0], pa.int64()), "b": pa.array(links[1], pa.int64())})

    rows = _rooted(open_.select("h", "rid").join(texts.select("rid", "size"), "rid"), roots)
    buckets = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("held"),
                                    F.sum(F.xxhash64("rid").cast("decimal(38,0)")).alias("f1"), F.bit_xor(F.xxhash64("rid", F.lit(SEED))).alias("f2"))
    once = (buckets.groupBy("n", "f1", "f2").agg(F.min(F.struct("h", "held")).alias("x"))
            .select("x.h", F.greatest(F.ceil(F.col("n") / docs), F.ceil(F.col("x.held") / units)).alias("chunks")))
    dealt = rows.join(once, "h").withColumn("chunk", F.pmod(F.xxhash64("rid", "h"), F.col("chunks")))
    blocks = (dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))
              .select("h", F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"), "chunk", "rid", "size", "root"))
    full = blocks.join(texts.select("rid", "z").hint("merge"), "rid").select("h", "lo", "hi", "chunk", "size", "root", "z")
    return full.groupBy("h", "lo", "hi").applyInArrow(run, "a long, b long").distinct()


def _overlaps(texts: pa.Array, weights: str, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Units in common of each text at ``left`` with each at ``right``."""
    row, element, weight, rows = shingles(texts, weights)
    copies = weight.astype(np.int64)
    which = np.repeat(np.arange(len(element)), copies)
    copy = np.arange(len(which)) - np.repeat(np.cumsum(copies) - copies, copies)
    _, unit, held = np.unique(mix(mix(element[which]) + copy.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_inverse=True, return_counts=True)
    # Units of one text alone are no overlap; the others by number.
    shared = held[unit] > 1
    number = np.cumsum(held > 1) - 1
    at, owner = number[unit[shared]], row[which[shared]]
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    common = np.zeros((len(left), len(right)))
    for lo in range(0, int(at[-1]) + 1 if len(at) else 0, GRID_COLUMNS):
        some = slice(*np.searchsorted(at, [lo, lo + GRID_COLUMNS]))
        held_by = np.zeros((rows, min(GRID_COLUMNS, int(at[-1]) + 1 - lo)), np.float32)
        held_by[owner[some], at[some] - lo] = 1
        common += held_by[left] @ held_by[right].T
    return common


def _stars(roots: DataFrame) -> DataFrame:
    """The classes so far as links."""
    return roots.where("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b"))


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` (with rid) and the class that each is in so far."""
    return rows.join(roots, F.col("rid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "rid")).drop("node")


def _several(rooted: DataFrame) -> DataFrame:
    """The rows of buckets that hold more than one class."""
    several = rooted.groupBy("h").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("h")
    return rooted.join(several, "h", "left_semi").select("h", "rid", "pivot")


def drop_near(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one of each class, with all their columns."""
    return keep_rows(docs, _classes(docs).where("kept"), once=True)
