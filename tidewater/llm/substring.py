"""Substring dedup by difference-cover anchors.

Of two places that hold the same 35 words, some shift below the period puts
both on cover positions (the cover's differences give every residue), so they
share an aligned anchor: a window of 15 words that starts at a cover
position. Only cover positions are hashed; anchors found more than once mark
where 35-word windows can repeat, and those windows are compared in turn.

Both comparisons are exchanges of fingerprints between blocks of documents
(about ``BLOCK_BYTES`` of text each) and buckets of fingerprints: a block
sends each fingerprint once (twice where it repeats inside the block), sorted
and packed, to its bucket; a bucket answers each block with those that occur
elsewhere. However common a passage is, a bucket gets it at most twice from
a block, and no pairs are made. Buckets grow in number with the corpus.

Fingerprints have 64 bits. Windows are judged on the input.

Inputs: null text counts as empty; repeated rows are copies of each other
(whole texts of 35 words or more repeat, and are removed from all); documents
under 35 words are kept whole; empty tables give an empty result; columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import shuffle_partitions, text_slices, written
from tidewater.llm.words import Words

WINDOW = 35
PERIOD = 21
COVER = (0, 1, 4, 14, 16)  # every residue modulo 21 is a difference of two of these
ANCHOR = WINDOW - (PERIOD - 1)
BLOCK_BYTES = 2 << 20
BUCKET_BYTES = 32 << 20
_IS_COVER = np.isin(np.arange(PERIOD), COVER)


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(raw: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(raw).read_next_batch()


def blocks(docs: DataFrame) -> DataFrame:
    """(block, n_words, docs): documents packed in blocks, written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, max_bytes=BLOCK_BYTES):
            words = int(Words(b.column("text")).count.sum())
            yield pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().int >> 65], pa.int64()), pa.array([words], pa.int64()), pa.array([_packed(b)], pa.binary())],
                                             names=["block", "n_words", "docs"])

    return written(docs.select("doc_id", "text").mapInArrow(run, "block long, n_words long, docs binary"), "blocks")


def _anchors(w: Words, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and fingerprint of the anchors at cover positions."""
    at, prints = w.windows(h, ANCHOR, salt=1)
    first = np.repeat(w.first[:-1], w.count)
    on = _IS_COVER[(at - first[at]) % PERIOD]
    return at[on], prints[on]


def _messages(block: int, prints: np.ndarray, buckets: int) -> pa.RecordBatch:
    """A row for each bucket: the block's fingerprints, sorted, twice where they repeat."""
    u, n = np.unique(prints, return_counts=True)
    u = np.repeat(u, np.minimum(n, 2))
    bounds = np.searchsorted(u, np.arange(1, buckets, dtype=np.uint64) * np.uint64(2**64 // buckets))
    parts = np.split(u, bounds)
    rows = [(k, block, p.tobytes()) for k, p in enumerate(parts) if len(p)]
    cols = list(zip(*rows)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary())],
                                      names=["bucket", "block", "prints"])


def _repeated(table: pa.Table) -> pa.Table:
    """One bucket: to each block, its fingerprints that occur more than once."""
    block = table.column("block").to_numpy()
    each = [np.frombuffer(x, np.uint64) for x in table.column("prints").to_pylist()]
    prints = np.concatenate(each)
    order = np.argsort(prints, kind="stable")
    same = prints[order][1:] == prints[order][:-1]
    again = np.zeros(len(prints), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    own = np.split(again, np.cumsum([len(e) for e in each])[:-1])
    rows = [(int(b), np.unique(e[m]).tobytes()) for b, e, m in zip(block, each, own) if m.any()]
    cols = list(zip(*rows)) or [[], []]
    return pa.table({"block": pa.array(cols[0], pa.int64()), "prints": pa.array(cols[1], pa.binary())})


def _exchange(sent: DataFrame) -> DataFrame:
    """(block, found): the fingerprints of each block that occur elsewhere."""
    answers = sent.groupBy("bucket").applyInArrow(_repeated, "block long, prints binary")
    return answers.groupBy("block").agg(F.collect_list("prints").alias("found"))


def _known(found: list[bytes]) -> np.ndarray:
    return np.sort(np.concatenate([np.frombuffer(x, np.uint64) for x in found])) if found else np.zeros(0, np.uint64)


def _in(prints: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known) or not len(prints):
        return np.zeros(len(prints), bool)
    return known[np.minimum(np.searchsorted(known, prints), len(known) - 1)] == prints


def _candidates(w: Words, h: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows that hold a repeated anchor at a shift below the period."""
    at, prints = _anchors(w, h)
    hit = at[_in(prints, known)]
    near = np.cumsum(np.bincount(np.maximum(hit - (PERIOD - 1), 0), minlength=len(h) + 1) - np.bincount(hit + 1, minlength=len(h) + 1)[:len(h) + 1])
    start, whole = w.windows(h, WINDOW)
    on = near[start] > 0
    return start[on], whole[on]


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed and kept_sha256, the
    digest of the kept words joined by one space; ``with_text`` adds those."""
    packed = blocks(docs)
    words = packed.agg(F.sum("n_words")).first()[0] or 0
    share = len(COVER) / PERIOD
    buckets = max(shuffle_partitions(docs.sparkSession), math.ceil(words * share * 8 / BUCKET_BYTES))

    def send_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, raw in zip(b.column("block").to_pylist(), b.column("docs")):
                w = Words(_unpacked(raw.as_py()).column("text"))
                yield _messages(block, _anchors(w, w.hashes())[1], buckets)

    def send_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, raw, found in zip(b.column("block").to_pylist(), b.column("docs"), b.column("found")):
                w = Words(_unpacked(raw.as_py()).column("text"))
                yield _messages(block, _candidates(w, w.hashes(), _known(found.as_py()))[1], buckets)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw, found in zip(b.column("docs"), b.column("found")):
                yield _kept(_unpacked(raw.as_py()), _known(found.as_py() or []), with_text)

    sent = "bucket long, block long, prints binary"
    anchors = _exchange(packed.select("block", "docs").mapInArrow(send_anchors, sent))
    windows = _exchange(packed.select("block", "docs").join(anchors, "block").mapInArrow(send_windows, sent))
    result = packed.select("block", "docs").join(windows, "block", "left").select("docs", "found")
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if with_text else "")
    return result.mapInArrow(finish, schema)


def _kept(batch: pa.RecordBatch, known: np.ndarray, with_text: bool) -> pa.RecordBatch:
    w = Words(batch.column("text"))
    h = w.hashes()
    start, whole = w.windows(h, WINDOW)
    hit = start[_in(whole, known)] if len(known) else start[:0]
    gone = np.cumsum(np.bincount(hit, minlength=len(h) + 1) - np.bincount(hit + WINDOW, minlength=len(h) + 1)[:len(h) + 1])[:len(h)] > 0
    data, texts, removed = w.data.tobytes(), [], []
    for lo, hi in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        stay = ~gone[lo:hi]
        removed.append(hi - lo - int(stay.sum()))
        texts.append(b" ".join([data[a:b] for a, b in zip(w.start[lo:hi][stay].tolist(), w.end[lo:hi][stay].tolist())]))
    arrays = [batch.column("doc_id"), pa.array(w.count.astype(np.int64)), pa.array(removed, pa.int64()),
              pa.array([hashlib.sha256(t).hexdigest() for t in texts])]
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    if with_text:
        arrays.append(pa.array([t.decode() for t in texts]))
        names.append("kept_text")
    return pa.RecordBatch.from_arrays(arrays, names=names)
