"""Quality rules: boosted trees over document statistics.

Whole texts are measured in Arrow batches with numpy. The trees are fitted on
at most ``SAMPLE_ROWS`` labelled documents (by a hash of doc_id), with
monotonic constraints: more symbols, repeated lines or repeated passages
never raise the quality score. A document is kept where the base rules pass
and the trees score it at least ``KEEP_AT``.

Inputs: null text counts as empty; null labels and null doc_ids in ``labels``
are ignored, a doc_id with several labels counts with its lowest; repeated
documents are measured one by one; without labels of both classes the trees
keep all; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm import trees
from tidewater.llm.common import text_slices
from tidewater.llm.words import Words, mix

SAMPLE_ROWS = 20_000
KEEP_AT = 0.4
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "bang": b"!?", "pipe": b"|", "brace": b"{}[]()=;", "stop": b".,"}
_LINES = np.ones(256, np.uint8)
_LINES[0x0A] = 0

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["log_words", "word_length", "symbols", "dup_lines", "repeats", *_CLASSES, "distinct", "words_per_line", "no_letters"]
MONOTONE = [-1 if f in ("symbols", "dup_lines", "repeats") else 0 for f in FEATURES]


def _per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _repeated(key: np.ndarray) -> np.ndarray:
    _, which, count = np.unique(key, return_inverse=True, return_counts=True)
    return count[which] > 1


def statistics(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(counts, features) of each row."""
    w = Words(texts)
    data, rows, n = w.data, len(w.count), w.count.astype(np.int64)
    lead = (data & 0xC0) != 0x80  # first byte of a code point
    is_word = ~np.isin(data, np.array([0x20, 9, 10, 11, 12, 13], np.uint8))
    chars = _per_row(lead & is_word, w.offsets)
    symbols = _per_row(_SYMBOLS[data], w.offsets)

    lines = Words(texts, _LINES)
    words_before = np.concatenate([[0], np.cumsum(is_word)])
    with_word = words_before[lines.end] > words_before[lines.start]
    line_row = lines.rows()[with_word]
    line_key = np.unique(mix(lines.hashes()[with_word] + line_row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
    n_lines = np.bincount(line_row, minlength=rows)
    dup_lines = n_lines - np.bincount(line_row[line_key], minlength=rows)

    h, row = w.hashes(), w.rows()
    at, window = w.windows(h, WINDOW)
    again = at[_repeated(window ^ mix(row[at].astype(np.uint64) + np.uint64(1)))]
    edge = np.bincount(again, minlength=len(h) + 1) - np.bincount(again + WINDOW, minlength=len(h) + 1)[:len(h) + 1]
    repeats = np.bincount(row, np.cumsum(edge)[:len(h)] > 0, rows).astype(np.int64)
    distinct = np.bincount(row[np.unique(h ^ mix(row.astype(np.uint64) + np.uint64(1)), return_index=True)[1]], minlength=rows)
    letters = ((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A) | (data >= 0x80)
    before = np.concatenate([[0], np.cumsum(letters)])
    bare = np.bincount(row, before[w.end] == before[w.start], rows)

    each, per_char = np.maximum(n, 1), np.maximum(chars, 1)
    counts = np.stack([n, chars, symbols, dup_lines, repeats], axis=1)
    features = np.stack([
        np.log1p(n), chars / each, symbols / per_char, dup_lines / np.maximum(n_lines, 1), repeats / each,
        *[_per_row(np.isin(data, np.frombuffer(c, np.uint8)), w.offsets) / per_char for c in _CLASSES.values()],
        distinct / each, n / np.maximum(n_lines, 1), bare / each], axis=1)
    return counts, features


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, where: F.Column | None = None) -> DataFrame:
    """At most ``rows`` labelled documents (doc_id, text, label), by a hash of doc_id."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    if where is not None:
        known = known.where(where)
    picked = (known.groupBy(F.col("doc_id").alias("_id")).agg(F.min(label).alias("label"))
              .orderBy(F.xxhash64("_id"), "_id").limit(rows))
    # at most ``rows`` ids and labels: a bounded broadcast
    return docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).drop("_id")


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> trees.Trees:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            _, x = statistics(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label").cast(pa.float64()), pa.array(list(x))], names=["doc_id", "label", "x"])

    sample = labelled_sample(docs, labels, "quality", rows)
    found = sample.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, label double, x array<double>").limit(2 * rows).toPandas()
    if not len(found):
        return trees.constant(0.999)
    found = found.sort_values("doc_id", kind="stable")
    y = found["label"].to_numpy()
    if y.min() == y.max():
        return trees.constant(0.999)
    return trees.fit(np.stack(found["x"]), y, MONOTONE)


SCORED = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, score double"


def score_quality(docs: DataFrame, model: trees.Trees, keep_at: float = KEEP_AT) -> DataFrame:
    """Per row of ``docs``: doc_id, the counts, base_failed, kept and the trees' score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            counts, x = statistics(b.column("text"))
            n, repeats = counts[:, 0], counts[:, 4]
            failed = (n < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n)
            score = model.probability(x)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(counts[:, k]) for k in range(5)], pa.array(failed), pa.array(~failed & (score >= keep_at)), pa.array(score)],
                names=["doc_id", *COUNTS, "base_failed", "kept", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, {SCORED}")


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_quality(docs, fit_quality(docs, labels))
