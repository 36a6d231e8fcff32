"""Toxicity: boosted trees over dense features, calibrated by isotonic regression.

Features of whole texts: densities of a learned lexicon (words and word
beginnings far more frequent in toxic documents), lexicon hits near a
second-person word, hits that show only after undoing look-alike signs, and
the rates of capitals, punctuation and words with signs inside. Lexicon,
trees and calibration are learned from at most ``SAMPLE_ROWS`` labelled
documents outside the held-out third; the lexicon (at most ``LEXICON_ROWS``
hashes) is what tasks get. Labels, language, source and id are never inputs
of a score.

Inputs: null text counts as empty and is scored like any other; null labels
and ids in ``labels`` are ignored, a doc_id with several labels counts with
its lowest; without labels of both classes all scores are equal; empty tables
give an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm import trees
from tidewater.llm.common import text_slices
from tidewater.llm.rules import labelled_sample
from tidewater.llm.words import Words, mix

SAMPLE_ROWS = 20_000
LEXICON_ROWS = 5_000
PREDICT_AT = 0.7
MIN_TOXIC_DOCS = 4
MIN_EVIDENCE = 9.0  # log-likelihood gain of a lexicon entry over the base rate
PREFIXES = (4, 5, 6)  # bytes
NEAR = 5  # words

SECOND_PERSON = (b"you", b"your", b"yours", b"yourself", b"u", b"du", b"dich", b"dir", b"dein", b"deine", b"ihr", b"euch",
                 b"tu", b"te", b"toi", b"ton", b"ta", b"tes", b"vous", b"votre", b"vos", b"ti", b"tus", b"usted", b"ustedes", b"vosotros")
_LOOKS_LIKE = {b"0": b"o", b"1": b"i", b"3": b"e", b"4": b"a", b"5": b"s", b"7": b"t", b"@": b"a", b"$": b"s", b"!": b"i"}

# Letters and bytes beyond ASCII make words; "core" also keeps the signs that stand for letters.
_LETTERS = np.full(256, 0, np.uint8)
_LETTERS[0x41:0x5B] = _LETTERS[0x61:0x7B] = _LETTERS[0x80:] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_PLAIN = _LOWER.copy()
for _a, _b in _LOOKS_LIKE.items():
    _PLAIN[_a[0]] = _b[0]

FEATURES = ["hits", "hit_rate", "prefix_hits", "prefix_rate", "weight", "near_second", "hidden_hits", "second_rate",
            "capitals", "punctuation", "exclaims", "mixed_words", "log_words"]
MONOTONE = [1 if f in ("hits", "hit_rate", "prefix_hits", "prefix_rate", "weight", "near_second", "hidden_hits") else 0 for f in FEATURES]


def _word_hash(words: tuple[bytes, ...]) -> np.ndarray:
    w = Words(pa.array([b" ".join(words).decode()]))
    return w.hashes()


def tokens(texts: pa.Array) -> tuple[Words, np.ndarray, list[np.ndarray]]:
    """Letter runs in lower case: their hashes, and those of their beginnings
    (zero where the run is shorter)."""
    w = Words(texts, _LETTERS)
    low = _LOWER[w.data]
    full, end = w.hashes(low), w.end
    begin = []
    for n in PREFIXES:
        w.end = np.minimum(end, w.start + n)
        begin.append(np.where(end - w.start > n, mix(w.hashes(low) + np.uint64(n)), np.uint64(0)))
    w.end = end
    return w, full, begin


def learn_lexicon(sample: DataFrame) -> dict[str, np.ndarray]:
    """(hash, weight) of words and beginnings, most telling first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            w, full, begin = tokens(b.column("text"))
            row, toxic = w.rows(), np.asarray(b.column("label").to_pylist(), np.int64)
            for h, kind in ((full, 0), *((x, 1) for x in begin)):
                keep = h != 0
                _, one = np.unique(mix(h[keep] ^ mix(row[keep].astype(np.uint64) + np.uint64(1))), return_index=True)
                u, which, count = np.unique(h[keep][one], return_inverse=True, return_counts=True)
                bad = np.bincount(which, toxic[row[keep][one]], len(u)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(np.full(len(u), kind, np.int32)), pa.array(count), pa.array(bad)],
                                                 names=["h", "kind", "n", "bad"])

    counts = sample.mapInArrow(run, "h long, kind int, n long, bad long").groupBy("h", "kind").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    n, bad = sample.agg(F.count("label"), F.sum("label")).first()
    if not n or not bad or bad == n:
        return {"hash": np.zeros(0, np.uint64), "kind": np.zeros(0, np.int32), "weight": np.zeros(0)}
    p = F.lit(bad / n)
    a, c = F.col("bad"), F.col("n") - F.col("bad")
    q = F.col("bad") / F.col("n")
    evidence = a * F.log(q / p) + F.when(c > 0, c * F.log((1 - q) / (1 - p))).otherwise(0.0)
    weight = F.log(((a + 0.5) / (F.lit(float(bad)) + 1)) / ((c + 0.5) / (F.lit(float(n - bad)) + 1)))
    top = (counts.where((a >= MIN_TOXIC_DOCS) & (q > 2 * p)).select("h", "kind", evidence.alias("evidence"), weight.alias("weight"))
           .where((F.col("evidence") >= MIN_EVIDENCE) & (F.col("weight") >= 2)).orderBy(F.desc("evidence"), "h").limit(LEXICON_ROWS).collect())
    out = {"hash": np.array([r["h"] for r in top], np.int64).view(np.uint64), "kind": np.array([r["kind"] for r in top], np.int32),
           "weight": np.array([r["weight"] for r in top])}
    order = np.argsort(out["hash"])
    return {k: v[order] for k, v in out.items()}


def _weights(h: np.ndarray, lexicon: dict[str, np.ndarray], kind: int) -> np.ndarray:
    own = lexicon["kind"] == kind
    known, weight = lexicon["hash"][own], lexicon["weight"][own]
    if not len(known) or not len(h):
        return np.zeros(len(h))
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    return np.where(known[at] == h, weight[at], 0.0)


def features(texts: pa.Array, lexicon: dict[str, np.ndarray]) -> np.ndarray:
    w, full, begin = tokens(texts)
    rows, row, n = len(w.count), w.rows(), np.maximum(w.count, 1)
    word = _weights(full, lexicon, 0)
    starts = np.max([_weights(b, lexicon, 1) for b in begin], axis=0)
    hit = word > 0
    at = np.arange(len(full))
    second = np.isin(full, _word_hash(SECOND_PERSON))

    def near(back: bool) -> np.ndarray:
        """Words since (until) the last (next) second-person word of the row."""
        mark = np.where(second, at, -(10**9) if back else 10**9)
        last = np.maximum.accumulate(mark) if back else np.minimum.accumulate(mark[::-1])[::-1]
        ok = np.abs(at - last) <= NEAR
        ok[ok] = row[last[ok]] == row[ok]
        return ok

    close = hit & (near(True) | near(False)) if len(full) else hit
    # words between separators, to see signs inside them
    v = Words(texts)
    letter = _LETTERS[v.data].astype(bool)
    before = np.concatenate([[0], np.cumsum(letter)])
    turns = np.concatenate([[0, 0], np.cumsum(letter[1:] != letter[:-1])]) if len(letter) else np.zeros(1, np.int64)
    size, letters = v.end - v.start, before[v.end] - before[v.start]
    inside = (turns[v.end] - turns[np.minimum(v.start + 1, len(turns) - 1)]) >= 2 if len(size) else np.zeros(0, bool)
    mixed = inside & (letters >= 2) & (letters < size)
    hidden = np.zeros(rows)
    vrow = v.rows()
    if mixed.any():
        data = v.data.tobytes()
        for k in np.flatnonzero(mixed):
            raw = data[v.start[k]:v.end[k]].strip(b".,;:!?\"()").translate(_PLAIN.tobytes())
            core = bytes(c for c in raw if 0x61 <= c <= 0x7A or c >= 0x80)
            if core:
                try:
                    h = Words(pa.array([core.decode()])).hashes()
                except UnicodeDecodeError:
                    continue
                hidden[vrow[k]] += float(_weights(h, lexicon, 0)[0] > 0)
    count = lambda mask, r: np.bincount(r[mask], minlength=rows)
    chars = np.maximum(np.diff(w.offsets), 1)

    def rate(signs: bytes) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(np.isin(w.data, np.frombuffer(signs, np.uint8)))])
        return (sums[w.offsets[1:]] - sums[w.offsets[:-1]]) / chars

    hits, begins = count(hit, row), count(starts > 0, row)
    return np.stack([
        hits, hits / n, begins, begins / n, np.bincount(row, np.maximum(word, starts), rows), count(close, row), hidden,
        count(second, row) / n, rate(bytes(range(0x41, 0x5B))), rate(b".,;:!?-'\"()"), rate(b"!"), count(mixed, vrow) / n, np.log1p(w.count)],
        axis=1).astype(np.float64)


def held_out() -> F.Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> dict:
    """Lexicon, trees and calibration, from labelled documents that aren't held out."""
    sample = labelled_sample(docs, labels, "toxic", rows, where=~held_out())
    lexicon = learn_lexicon(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label").cast(pa.float64()), pa.array(list(features(b.column("text"), lexicon)))],
                                             names=["doc_id", "label", "x"])

    found = sample.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, label double, x array<double>").limit(2 * rows).toPandas().sort_values("doc_id", kind="stable")
    if not len(found):
        return {"lexicon": lexicon, "trees": trees.constant(0.01), "knots": np.array([0.0, 1.0]), "values": np.array([0.0, 1.0])}
    x, y = np.stack(found["x"]), found["label"].to_numpy()
    third = np.arange(len(y)) % 3 == 2
    if min(y[third].sum(), y[~third].sum()) < 20:  # too few of a class to set rows aside
        third = np.ones(len(y), bool)
        model = trees.fit(x, y, MONOTONE)
    else:
        model = trees.fit(x[~third], y[~third], MONOTONE)
    knots, values = trees.isotonic(model.probability(x[third]), y[third])
    return {"lexicon": lexicon, "trees": model, "knots": knots, "values": values}


def score_toxicity(docs: DataFrame, model: dict, predict_at: float = PREDICT_AT) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            raw = model["trees"].probability(features(b.column("text"), model["lexicon"]))
            score = np.interp(raw, model["knots"], model["values"])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(score), pa.array((score >= predict_at).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    marked = docs.select("doc_id", "text", held_out().alias("held_out"))
    return marked.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_toxicity(docs, fit_toxicity(docs, labels))
