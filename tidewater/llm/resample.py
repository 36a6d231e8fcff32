"""Quality classifier by importance resampling.

Two generative models of hashed n-grams, one of the target text (labelled
good documents) and one of the raw corpus, give each document the log of its
importance weight: the sum over its runs of letters, digits and signs, and
over pairs of neighbours, of log p_target - log p_raw. Adding Gumbel noise, a
function of the document and the seed, and keeping the k largest draws k
documents without replacement in proportion to their weights.

The raw counts are over all documents; the target counts over at most
``SAMPLE_ROWS`` labelled ones. Both models are tables of ``BUCKETS`` numbers.
k is found on the labelled sample: as many as score above the point that
keeps all but ``MISS`` of the good ones and the fewest others. For this a good
row is weighed without its own counts in the target model, as one without a
label is; counts of labelled copies of its text stay.

Inputs: null text counts as empty (weight 0); null labels and ids in
``labels`` are ignored, a doc_id with several labels counts with its lowest;
without labels of both classes all are kept; rows that tie at the cut all
stay; repeated rows have equal noise; empty tables give an empty result;
``keep_good`` keeps all other columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import keep_rows, largest_cut, row_keys, text_slices, written
from tidewater.llm.rules import labelled_sample
from tidewater.llm.words import Words, mix, uniform

BUCKETS = 1 << 15
SAMPLE_ROWS = 20_000
MISS = 0.001
SMOOTH = 1.0

# Runs of lower-case letters (and bytes beyond ASCII), capitals, digits, other signs.
_KINDS = np.full(256, 4, np.uint8)
_KINDS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
_KINDS[0x30:0x3A] = 3
_KINDS[0x61:0x7B] = _KINDS[0x80:] = _KINDS[0x41:0x5B] = 1


def ngrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """(row, bucket) of every run and every pair of neighbours, and the rows."""
    w = Words(texts, _KINDS)
    h, row = w.hashes(), w.rows()
    pair = np.flatnonzero(row[1:] == row[:-1])
    both = mix(h[pair] * np.uint64(31) + h[pair + 1])
    return (np.concatenate([row, row[pair]]), (np.concatenate([h, both]) % np.uint64(BUCKETS)).astype(np.int64), len(w.count))


def bucket_counts(docs: DataFrame) -> np.ndarray:
    """n-gram counts of all of ``docs``: at most BUCKETS rows a task and in all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for b in text_slices(batches):
            total += np.bincount(ngrams(b.column("text"))[1], minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    out = np.zeros(BUCKETS)
    for r in docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log p_target - log p_raw per bucket, both smoothed towards the raw model."""
    p_raw = (raw + SMOOTH) / (raw.sum() + SMOOTH * BUCKETS)
    p_target = (target + SMOOTH * BUCKETS * p_raw) / (target.sum() + SMOOTH * BUCKETS)
    return np.log(p_target) - np.log(p_raw)


def left_out(row: np.ndarray, bucket: np.ndarray, n: int, target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """The log weight of each row by the ratio of ``target`` less the row's own
    counts (which it must hold; else they count as far as it does) to ``raw``."""
    p_raw = (raw + SMOOTH) / (raw.sum() + SMOOTH * BUCKETS)
    cell, own = np.unique(row * np.int64(BUCKETS) + bucket, return_counts=True)
    at, total = cell % BUCKETS, np.maximum(target.sum() - np.bincount(row, minlength=n), 0)
    each = own * (np.log(np.maximum(target[at] - own, 0) + SMOOTH * BUCKETS * p_raw[at]) - np.log(p_raw[at]))
    return np.bincount(cell // BUCKETS, each, n) - np.bincount(row, minlength=n) * np.log(total + SMOOTH * BUCKETS)


def weigh(docs: DataFrame, ratio: np.ndarray, seed: int, extra: tuple[str, ...] = (), counted: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """doc_id, row keys, log_weight, perturbed (log_weight plus Gumbel noise), and ``extra`` columns.
    With ``counted``, the target and raw counts, rows of label 1 are weighed without their own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            row, bucket, n = ngrams(b.column("text"))
            weight = np.bincount(row, ratio[bucket], n).astype(np.float64)
            if counted is not None:
                weight = np.where(b.column("label").to_numpy(zero_copy_only=False) == 1, left_out(row, bucket, n, *counted), weight)
            u = uniform(mix((b.column("k1").to_numpy() + seed).view(np.uint64)))
            noise = -np.log(-np.log(np.clip(u, 1e-16, 1 - 1e-16)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("k1"), b.column("k2"), pa.array(weight), pa.array(weight + noise), *[b.column(c) for c in extra]],
                                             names=["doc_id", "k1", "k2", "log_weight", "perturbed", *extra])

    types = dict(docs.dtypes)
    keyed = docs.select("doc_id", "text", *extra, *row_keys())
    return keyed.mapInArrow(run, ", ".join([f"doc_id {types['doc_id']}, k1 long, k2 long, log_weight double, perturbed double", *[f"{c} {types[c]}" for c in extra]]))


def cut_point(score: np.ndarray, good: np.ndarray, miss: float = MISS) -> float:
    """The highest score that keeps all but ``miss`` of the good rows, moved
    down to the middle of the gap below it where that admits nothing bad."""
    if not good.any() or good.all():
        return -np.inf
    g = np.sort(score[good])
    point = g[int(miss * len(g))]
    below = score[~good & (score < point)]
    return (point + below.max()) / 2 if len(below) else point - 1.0


def _resample(docs: DataFrame, labels: DataFrame, seed: int) -> DataFrame:
    sample = written(labelled_sample(docs, labels, "quality", SAMPLE_ROWS), "target-sample")
    raw = bucket_counts(docs)
    target = bucket_counts(sample.where("label = 1"))
    ratio = log_ratio(target, raw)
    scored = written(weigh(docs, ratio, seed), "weights")
    known = weigh(sample, ratio, seed, ("label",), (target, raw)).orderBy("k1", "k2", "perturbed").limit(2 * SAMPLE_ROWS).toPandas()
    point = cut_point(known["perturbed"].to_numpy(float), known["label"].to_numpy() == 1)
    k = scored.where(F.col("perturbed") >= F.lit(float(point))).count()
    cut = largest_cut(scored, "perturbed", k)
    return scored.withColumn("kept", F.lit(False) if cut is None else F.col("perturbed") >= F.lit(cut))


def resample(docs: DataFrame, labels: DataFrame, seed: int = 11) -> DataFrame:
    """doc_id, log_weight, perturbed and kept of every row of ``docs``."""
    return _resample(docs, labels, seed).drop("k1", "k2")


def keep_good(docs: DataFrame, labels: DataFrame, seed: int = 11) -> DataFrame:
    """The rows of ``docs`` that the resampling draws, with all their columns."""
    return keep_rows(docs, _resample(docs, labels, seed).where("kept"), once=False)
