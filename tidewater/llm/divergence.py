"""Source divergence audit: how far the term frequencies of the sources of a
language lie apart, and which terms set a source off.

Counting packs terms by length. In each batch of texts, terms of up to 8 bytes
become one big-endian uint64 word and those of up to 16 two; their order is
that of their bytes. They are sorted by radix passes over 16-bit digits, and
equal neighbours are run-counted in numpy. Longer terms go to byte-sorted
buckets of doubling widths, those beyond 1024 bytes to one of their own. Rows
of a batch are ordered by language and source first and the passes are
stable, so one sort gives a term's count and its documents in every group.
A task merges its batches the same way and gives each (term, group) of at
most ``FLUSH_TERMS`` occurrences at a time once; Spark adds up the rest.

A language keeps the terms that at least ``MIN_DOCS`` of its documents hold.
With count a term's occurrences in a group (a source of the language, or all
of it), N their sum over the kept terms and V the number of those,

    p = 1 + floor(SCALE * (count + PRIOR) / (N + PRIOR * V))

in exact integers. ``pair`` rows give the sum of |p - q| over all kept terms
for every two sources of a language: tiles of sources meet in blocks of terms,
so a task holds one block, and what it passes on is one number a pair.
``term`` rows give the kept terms of a source whose p is above the language's,
the first ``TOP`` of them.

Inputs: null text, lang and source count as empty; repeated rows are separate
documents; groups without terms still occur; doc_id isn't read, nor is any
column beyond text, lang and source; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import shuffle_partitions, text_of, text_slices, written
from tidewater.llm.words import Words, eight_bytes

MIN_DOCS = 30
PRIOR = 5
SCALE = 1_000_000_000
TOP = 50
TILE = 256  # sources of a language that meet at once
CHUNK_ROWS = 1_000_000  # kept (term, group) that a task compares
BLOCK_TERMS = 2048  # columns of the dense block in a task
FLUSH_TERMS = 4_000_000  # distinct (term, group) that a task holds
LONGEST = 1024  # bytes of a term in the fixed-width buckets

# Letters and all bytes beyond ASCII.
_TERM = np.zeros(256, np.uint8)
_TERM[0x41:0x5B] = _TERM[0x61:0x7B] = _TERM[0x80:] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


# --- packing, sorting, run-counting ------------------------------------------------

def packed(data: np.ndarray, start: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
    """The terms' bytes, zero-padded to ``width`` (a multiple of 8), as rows
    of big-endian uint64 words."""
    words = np.empty((len(start), width // 8), np.uint64)
    for k in range(width // 8):
        words[:, k] = eight_bytes(data, start + 8 * k, size - 8 * k)
    return words


def unpacked(words: np.ndarray) -> np.ndarray:
    """The terms (numpy bytes) of rows of words."""
    return np.ascontiguousarray(words.astype(">u8")).view(f"S{8 * words.shape[1]}").ravel()


def radix_order(words: np.ndarray) -> np.ndarray:
    """A stable order of rows of uint64 words: passes over 16-bit digits, the
    lowest first. Digits that all rows share are left out."""
    order = np.arange(len(words))
    for k in range(words.shape[1] - 1, -1, -1):
        for shift in (0, 16, 32, 48):
            digit = ((words[:, k] >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]  # numpy sorts 16 bits by radix
    return order


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal neighbours begins."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for k in keys:
        new[1:] |= (k[1:] != k[:-1]) if k.ndim == 1 else (k[1:] != k[:-1]).any(axis=1)
    return np.flatnonzero(new)


def _run_counted(term: np.ndarray, group: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, ...]:
    """(index of a term, group, occurrences, documents) of sorted terms."""
    if not len(group):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    both, one = _runs(term, group), np.zeros(len(group), np.int64)
    one[_runs(term, group, row)] = 1  # the first of a document
    return both, group[both], np.diff(np.append(both, len(group))), np.add.reduceat(one, both)


#: A bucket of counted terms: distinct (term, group) with occurrences and documents.
Counted = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _widths() -> list[int]:
    out = [8, 16]
    while out[-1] < LONGEST:
        out.append(2 * out[-1])
    return out


def count_terms(texts: pa.Array, group: np.ndarray) -> dict[int, Counted]:
    """By bucket width (0: beyond all): terms, groups, occurrences, documents,
    of rows that are ordered by ``group``."""
    w = Words(texts, _TERM)
    data, size, row = _LOWER[w.data], w.end - w.start, w.rows()
    out: dict[int, Counted] = {}
    least = 0
    for width in _widths():
        on = np.flatnonzero((size > least) & (size <= width))
        least = width
        if not len(on):
            continue
        if width <= 16:
            words = packed(data, w.start[on], size[on], width)
            order = radix_order(words)
            words = words[order]
            at, g, n, docs = _run_counted(words, group[row[on][order]], row[on][order])
            out[width] = (words[at], g, n, docs)
        else:
            held = unpacked(packed(data, w.start[on], size[on], width))
            order = np.argsort(held, kind="stable")
            at, g, n, docs = _run_counted(held[order], group[row[on][order]], row[on][order])
            out[width] = (held[order][at], g, n, docs)
    on = np.flatnonzero(size > least)
    if len(on):
        raw = data.tobytes()
        held = np.empty(len(on), object)
        held[:] = [raw[a:b] for a, b in zip(w.start[on].tolist(), w.end[on].tolist())]
        order = np.array(sorted(range(len(on)), key=held.__getitem__))
        at, g, n, docs = _run_counted(held[order], group[row[on][order]], row[on][order])
        out[0] = (held[order][at], g, n, docs)
    return out


def merged(parts: list[Counted]) -> Counted:
    """Counted terms of several batches as one, in the same order."""
    term, group, n, docs = (np.concatenate(x) for x in zip(*parts))
    by_group = np.argsort(group, kind="stable")
    if term.ndim == 2:
        order = by_group[radix_order(term[by_group])]
    elif term.dtype == object:
        order = np.array(sorted(by_group.tolist(), key=term.__getitem__), np.int64)
    else:
        order = by_group[np.argsort(term[by_group], kind="stable")]
    term, group, n, docs = term[order], group[order], n[order], docs[order]
    at = _runs(term, group)
    return term[at], group[at], np.add.reduceat(n, at), np.add.reduceat(docs, at)


class _Held:
    """What a task has counted: buckets of terms, and the number of each group."""

    def __init__(self):
        self.number: dict[tuple[str, str], int] = {}
        self.parts: dict[int, list[Counted]] = {}
        self.whole = self.more = 0

    def add(self, batch: pa.RecordBatch) -> None:
        lang, source = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
        group = np.array([self.number.setdefault(k, len(self.number)) for k in zip(lang, source)], np.int64)
        order = np.argsort(group, kind="stable")
        for width, counted in count_terms(batch.column("text").take(pa.array(order)), group[order]).items():
            self.parts.setdefault(width, []).append(counted)
            self.more += len(counted[1])

    def settle(self) -> None:
        """Merge where the batches since the last time hold as much as all before."""
        if self.more > max(self.whole, 200_000):
            self.parts = {width: [merged(p)] for width, p in self.parts.items()}
            self.whole, self.more = sum(len(p[0][1]) for p in self.parts.values()), 0

    def given(self) -> Iterator[pa.RecordBatch]:
        names = list(self.number)
        langs, sources = (pa.array([k[i] for k in names], pa.string()) for i in (0, 1))
        for p in self.parts.values():
            term, group, n, docs = merged(p)
            for lo in range(0, len(group), 50_000):
                part = slice(lo, lo + 50_000)
                terms = unpacked(term[part]) if term.ndim == 2 else term[part]
                g = pa.array(group[part])
                yield pa.RecordBatch.from_arrays(
                    [langs.take(g), sources.take(g), pa.array(terms.tolist(), pa.binary()).cast(pa.string()), pa.array(n[part]), pa.array(docs[part])],
                    names=["lang", "source", "term", "n", "docs"])
        self.__init__()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term
    in each group of ``docs`` (text, lang and source without nulls)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held()
        for b in text_slices(batches, max_bytes=1 << 20):
            held.add(b)
            held.settle()
            if held.whole > FLUSH_TERMS:
                yield from held.given()
        yield from held.given()

    partial = docs.select("text", "lang", "source").mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# --- measures ----------------------------------------------------------------------

def _p(count, total, kept) -> F.Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * kept)), in exact decimals."""
    wide = "decimal(30,0)"
    top = (F.lit(SCALE).cast("decimal(10,0)") * (count + F.lit(PRIOR)).cast("decimal(20,0)")).cast(wide)
    return F.lit(1) + F.call_function("div", top, (total + F.lit(PRIOR) * kept).cast(wide))


def _pair_block(key, counts: pa.Table, sources: pa.Table) -> pa.Table:
    """Partial distances of the sources of two tiles over one block of terms."""
    number, base, tile = (sources.column(c).to_numpy() for c in ("number", "p0", "tile"))
    order = np.argsort(number)
    number, base, tile = number[order], base[order], tile[order]
    term = counts.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
    at, p = np.searchsorted(number, counts.column("number").to_numpy()), counts.column("p").to_numpy()
    by_term = np.argsort(term, kind="stable")
    term, at, p = term[by_term], at[by_term], p[by_term]
    first = _runs(term) if len(term) else np.zeros(0, np.int64)
    which = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(term))))
    total = np.zeros((len(number), len(number)), np.int64)
    for lo in range(0, len(first), BLOCK_TERMS):
        hi = min(lo + BLOCK_TERMS, len(first))
        part = slice(first[lo], first[hi] if hi < len(first) else len(term))
        dense = np.repeat(base[:, None], hi - lo, axis=1)
        dense[at[part], which[part] - lo] = p[part]
        for i in range(len(number) - 1):
            total[i, i + 1:] += np.abs(dense[i + 1:] - dense[i]).sum(axis=1)
    ta, tb = key[1].as_py(), key[2].as_py()
    i, j = np.nonzero(np.triu((tile[:, None] == ta) & (tile == tb) if ta == tb else (tile[:, None] != tile), 1))
    return pa.table({"lang": pa.array([key[0].as_py()] * len(i), pa.string()), "a": number[i], "b": number[j], "value": total[i, j],
                     "seen": np.full(len(i), len(first))})


def _pairs(kept: DataFrame, groups: DataFrame, chunks: int) -> DataFrame:
    """(lang, source, item, value) of every two sources of a language.
    ``kept``: lang, source, term, n; ``groups``: lang, source, total, terms."""
    sources = written(groups.withColumn("number", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
                      .withColumn("tile", F.floor(F.col("number") / TILE)).withColumn("p0", F.when(F.col("terms") > 0, _p(F.lit(0), F.col("total"), F.col("terms"))).otherwise(0))
                      .withColumn("tiles", F.floor(F.max("number").over(Window.partitionBy("lang")) / TILE) + 1), "sources")
    # A tile's rows go to each pair of tiles that it is in.
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("other")
    cell = [F.least("tile", "other").alias("ta"), F.greatest("tile", "other").alias("tb")]
    left = (kept.join(sources, ["lang", "source"]).select("lang", "number", "tile", "term", _p(F.col("n"), F.col("total"), F.col("terms")).alias("p"), other)
            .select("lang", *cell, F.pmod(F.xxhash64("term"), F.lit(chunks)).alias("chunk"), "term", F.col("number").cast("long").alias("number"), "p"))
    right = (sources.select("lang", "tile", F.col("number").cast("long").alias("number"), "p0", other)
             .select("lang", *cell, "tile", "number", "p0").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long")))))
    key = ["lang", "ta", "tb", "chunk"]
    parts = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_pair_block, "lang string, a long, b long, value long, seen long")
    half = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    both = half.unionAll(half.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value", "seen"))
    # Terms that no source of the two tiles has add the distance of count 0.
    return (both.join(sources.select("lang", F.col("number").alias("a"), "source", "terms", F.col("p0").alias("pa")), ["lang", "a"])
            .join(sources.select("lang", F.col("number").alias("b"), F.col("source").alias("item"), F.col("p0").alias("pb")), ["lang", "b"])
            .select("lang", "source", "item", (F.col("value") + (F.col("terms") - F.col("seen")) * F.abs(F.col("pa") - F.col("pb"))).alias("value")))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) of ``docs``: all pairs of
    sources, and the ``top`` terms above the language's frequency."""
    clean = docs.select(text_of().alias("text"), text_of("lang").alias("lang"), text_of("source").alias("source"))
    of_term = Window.partitionBy("lang", "term")
    counts = term_counts(clean)
    kept = written(counts.withColumn("in_lang", F.sum("docs").over(of_term)).where(F.col("in_lang") >= min_docs)
                   .withColumn("all", F.sum("n").over(of_term)).select("lang", "source", "term", "n", "all"), "kept-terms")
    langs = (kept.groupBy("lang", "term").agg(F.first("all").alias("all"))
             .groupBy("lang").agg(F.sum("all").alias("lang_total"), F.count(F.lit(1)).alias("terms")))
    occurring = clean.select("lang", "source").distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = written(occurring.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
                     .select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "lang_total", "terms")]), "groups")

    pairs = _pairs(kept, groups, max(shuffle_partitions(docs.sparkSession), kept.count() // CHUNK_ROWS + 1))
    above = (kept.join(groups, ["lang", "source"])
             .select("lang", "source", F.col("term").alias("item"),
                     (_p(F.col("n"), F.col("total"), F.col("terms")) - _p(F.col("all"), F.col("lang_total"), F.col("terms"))).alias("value"))
             .where("value > 0"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [x.withColumn("rank", F.row_number().over(best)).select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))
              for part, x in (("pair", pairs), ("term", above))]
    return ranked[0].unionAll(ranked[1].where(F.col("rank") <= top))
