"""Best-fit packing with certified repacking.

Documents become token pieces of at most ``capacity``; only longer documents
are cut. Pieces are dealt to groups of bounded size; each group is packed by
best-fit decreasing, and dual-feasible functions give a lower bound of its
bin count. Where the count equals the bound the packing is certified optimal
and only the emptiest bin is reopened; a group with a gap reopens its
emptiest bins. Groups exchange the pieces of reopened bins, ``FAN_IN`` groups
at a time, and pack them again, until one group is left: a reopened share of
at most 1/FAN_IN keeps every round's groups within the first round's size.
The last group is packed once, with its bound. ``gap`` is the count of bins
of a sequence's group above the bound, at the packing that placed it: 0 where
that is certified optimal.

Inputs: null text counts as empty (one piece, the end token); null or
repeated doc_ids are separate documents; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import math
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import text_slices, written
from tidewater.llm.words import Words

CAPACITY = 4096
END = 1
GROUP_PIECES = 60_000  # pieces in one group of the first round
FAN_IN = 16

# --- tokens --------------------------------------------------------------------

# Letters (ASCII ones and all bytes beyond), single digits, and other signs are
# encoded apart by the vocabulary, which also ignores case.
_KINDS = np.full(256, 3, np.uint8)
_KINDS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
_KINDS[0x30:0x3A] = 2
_KINDS[0x41:0x5B] = _KINDS[0x61:0x7B] = _KINDS[0x80:] = 1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_CACHE_ENTRIES = 200_000


class Encoder:
    """Token ids of text batches, each distinct run of signs encoded once.

    The vocabulary drops white space and joins neither across it nor between
    letters, digits and other signs, so a text's ids are those of its runs in
    order. Runs go through a byte-pair encoder that holds the same vocabulary
    as ranks, with a zero byte for the end of a run. Texts where bytes can't
    tell the runs (apostrophes, special tokens, zero bytes, signs beyond ASCII
    that aren't letters in composed form, runs of equal hash but other bytes) go through the tokenizer whole.
    """

    def __init__(self, path: str):
        import json

        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        to_byte = {c: b for b, c in _byte_signs().items()}
        ranks: dict[bytes, int] = {}
        for token, i in vocabulary.items():
            word = token.removesuffix("</w>")
            if all(c in to_byte for c in word):
                ranks[bytes(to_byte[c] for c in word) + b"\0" * (word != token)] = i
        self.ends = np.zeros(max(ranks.values()) + 1, bool)
        self.ends[[i for b, i in ranks.items() if b[-1:] == b"\0" and len(b) > 1]] = True
        self.ranked = tiktoken.Encoding("runs", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})
        self.known: dict[bytes, bytes] = {}

    def whole(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    @staticmethod
    def _plain(run: bytes) -> str | None:
        """The run in lower case, or None where it isn't a run by itself."""
        text = run.decode()
        if text.isascii():
            return None if "'" in text or "\0" in text else text
        if "\u03a3" in text or not text.isalpha() or not unicodedata.is_normalized("NFC", text):
            return None
        text = text.lower()
        return text if text.isalpha() else None

    def _learn(self, runs: list[bytes]) -> None:
        plain = [(r, p) for r in runs if (p := self._plain(r)) is not None]
        self.known.update(dict.fromkeys(runs))  # None: not plain
        if plain:
            ids = np.asarray(self.ranked.encode_ordinary("\0".join(p for _, p in plain) + "\0"), "<u4")
            raw, at = ids.tobytes(), 0
            for (r, _), e in zip(plain, (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()):
                self.known[r] = raw[at:e]
                at = e

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows in order, and the bounds of each row's."""
        w = Words(texts, _KINDS)
        rows = len(w.count)
        if not len(w.start):
            return np.zeros(0, "<u4"), np.zeros(rows + 1, np.int64)
        low = _LOWER[w.data]
        _, one, which = np.unique(w.hashes(low), return_index=True, return_inverse=True)
        data = low.tobytes()
        distinct = [data[a:b] for a, b in zip(w.start[one].tolist(), w.end[one].tolist())]
        if len(self.known) + len(distinct) > _CACHE_ENTRIES:
            self.known.clear()
        missing = [x for x in distinct if x not in self.known]
        if missing:
            self._learn(missing)
        ids = [self.known[x] for x in distinct]
        slow = np.fromiter((x is None for x in ids), bool, len(ids))
        size = np.fromiter((len(x) if x else 0 for x in ids), np.int64, len(ids)) // 4
        pool = np.frombuffer(b"".join(x for x in ids if x), "<u4")
        at = np.cumsum(size) - size
        many = size[which]
        until = np.concatenate([[0], np.cumsum(many)])
        source = np.repeat(at[which] - until[:-1], many) + np.arange(until[-1])
        out, bounds = pool[source], until[w.first]
        odd = np.zeros(rows, bool)
        odd[w.rows()[slow[which] | ~w.same(np.arange(len(which)), one[which], low)]] = True
        if b"<|" in data:
            odd |= np.array([b"<|" in data[a:b] for a, b in zip(w.offsets[:-1].tolist(), w.offsets[1:].tolist())])
        if odd.any():
            parts = [self.whole(texts[k].as_py()) if odd[k] else out[bounds[k]:bounds[k + 1]] for k in range(rows)]
            out, bounds = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return out, bounds


def _byte_signs() -> dict[int, str]:
    """The printable sign that byte-level vocabularies write for each byte:
    itself where it is printable, else the next one from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}


_ENCODERS: dict[str, Encoder] = {}


def encoder(name: str) -> Encoder:
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder(public_tokenizers.path(name))
    return _ENCODERS[name]


PIECE = "piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(vocabulary), np.asarray([END], "<u4").tobytes()
        for b in text_slices(batches):
            cols = ([], [], [], [], [])
            ids, bounds = enc.batch(b.column("text"))
            for k, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                own = ids[lo:hi].tobytes() + end
                n = len(own) // 4
                for piece, start in enumerate(range(0, n, capacity)):
                    part = own[4 * start:4 * (start + capacity)]
                    for c, v in zip(cols, (k, piece, start, len(part) // 4, zlib.crc32(part))):
                        c.append(v)
            at, piece, start, length, crc = cols
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, {PIECE}")


# --- packing one group -----------------------------------------------------------

def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset, bins): each item goes to the fullest bin that holds it."""
    order = np.argsort(-lengths, kind="stable")
    bin_of, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, bins = 0, 0  # rooms: bit r is set where some bin has r left
    for k in order:
        n = int(lengths[k])
        fits = rooms >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                rooms &= ~(1 << r)
        else:
            r, b, bins = capacity, bins, bins + 1
        bin_of[k], offset[k] = b, capacity - r
        if r - n:
            by_room[r - n].append(b)
            rooms |= 1 << (r - n)
    return bin_of, offset, bins


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The best bound of two families of dual-feasible functions: items over
    C - t count whole and those under t nothing; and lengths rounded to
    multiples of C/k. A feasible bin has a value of at most 1 under each."""
    x = lengths.astype(np.float64) / capacity
    best = x.sum()
    for t in np.unique(np.concatenate([lengths[lengths <= capacity // 2], [1]])):
        big, small = lengths > capacity - t, lengths < t
        best = max(best, big.sum() + x[~big & ~small].sum())
    for k in range(1, 33):
        scaled = lengths.astype(np.int64) * (k + 1)
        exact = scaled % capacity == 0
        best = max(best, np.where(exact, x, (scaled // capacity) / k).sum())
    return math.ceil(best - 1e-9)


def _reopened(lengths: np.ndarray, bin_of: np.ndarray, bins: int, bound: int, capacity: int) -> np.ndarray:
    """The bins whose pieces are exchanged: the emptiest one, and where the
    bound is not met, two more for each bin of the gap."""
    fill = np.bincount(bin_of, lengths, bins)
    limit = max(1, bins // FAN_IN)
    order = np.argsort(fill, kind="stable")[:min(limit, 1 + 2 * (bins - bound))]
    out = np.zeros(bins, bool)
    out[order[fill[order] < capacity]] = True
    return out


def _round(base: list[str], number: int, last: bool, capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(base, kind="stable").reset_index(drop=True)
        lengths = pdf["length"].to_numpy(np.int64)
        bin_of, offset, bins = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(lengths, capacity)
        again = np.zeros(bins, bool) if last else _reopened(lengths, bin_of, bins, bound, capacity)
        return pdf[base].assign(round=number, grp=pdf["grp"], bin=bin_of, offset=offset, done=~again[bin_of], gap=bins - bound)
    return run


GROUPED = "round int, grp long, bin long, offset long, done boolean, gap long"


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``items`` (with a column length, at most ``capacity``) with
    sequence_id, offset and gap. Items are written once; the rounds read them."""
    base = items.columns
    kept_schema = ", ".join(f"`{c}` {t}" for c, t in items.dtypes)
    full = items.where(F.col("length") == capacity)
    rest = items.where(F.col("length") < capacity)
    spread = F.xxhash64(*[f"`{c}`" for c in base])
    count = rest.count()
    groups = max(1, math.ceil(count / GROUP_PIECES))
    out, number = [], 0
    open_ = rest.withColumn("grp", F.pmod(spread, F.lit(groups)))
    while True:
        last = groups == 1

        packed = written(open_.groupBy("grp").applyInPandas(_round(base, number, last, capacity), f"{kept_schema}, {GROUPED}"), f"pack-{number}")
        out.append(packed.where("done"))
        if last:
            break
        groups = math.ceil(groups / FAN_IN)
        open_ = packed.where("not done").select(*base, F.floor(F.col("grp") / FAN_IN).cast("long").alias("grp"))
        number += 1
    # Bins of a round and group are consecutive numbers in a range of their own;
    # full pieces take the negative numbers.
    bins = out[0]
    for x in out[1:]:
        bins = bins.unionByName(x)
    placed = bins.select(*base, (F.col("round").cast("long") * F.lit(1 << 58) + F.col("grp") * F.lit(1 << 24) + F.col("bin")).alias("sequence_id"), "offset", "gap")
    whole = full.select(*base, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(0).cast("long").alias("gap"))
    return placed.unionByName(whole)


def pack_documents(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all ``docs`` with sequence_id, offset and gap."""
    return pack(written(pieces(docs, vocabulary, capacity), "pieces"), capacity)
