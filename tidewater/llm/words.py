"""Words of whole Arrow text batches as numpy arrays.

A word is a maximal run of bytes other than 20, 09-0D (the contract's
``[^\\x20\\x09-\\x0D]+`` on UTF-8). A word's fingerprint sums mixed pieces of
eight bytes, each with its place; a window's mixes those of its halves. Both
have 64 bits and no structure that words of any length could share.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_IS_WORD = np.ones(256, np.uint8)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finisher (public-domain splitmix constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Doubles in [0, 1) from hashes."""
    return (x >> np.uint64(11)).astype(np.float64) * (1.0 / (1 << 53))


def bytes_and_offsets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a text array; null counts as empty."""
    texts = pa.compute.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def eight_bytes(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Up to eight bytes from each start as a big-endian uint64, zeros behind
    ``size`` bytes (none where it is 0 or less)."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    each = np.ndarray(len(data) + 1, ">u8", padded, strides=(1,))
    spare = (8 * (8 - np.clip(size, 1, 8))).astype(np.uint64)
    word = each[np.minimum(start, len(data))].astype(np.uint64)
    return np.where(size > 0, (word >> spare) << spare, np.uint64(0))


class Words:
    """Words of a text batch.

    ``data``/``offsets``: bytes and row bounds; ``start``/``end``: byte span
    of each word; ``first``: index of each row's first word (rows + 1 values).
    ``kinds`` (256 values, 0 for separators) splits words further where the
    kind of byte changes; kind 2 makes every byte a word.
    """

    def __init__(self, texts: pa.Array, kinds: np.ndarray | None = None):
        self.data, self.offsets = bytes_and_offsets(texts)
        n = len(self.data)
        kind = (_IS_WORD if kinds is None else kinds)[self.data]
        turn = np.ones(n + 1, bool)  # turn[i]: a word may begin at i or end before i
        np.not_equal(kind[1:], kind[:-1], out=turn[1:n] if n else turn[:0])
        turn[self.offsets] = True
        if kinds is not None:
            single = kind == 2
            turn[:n] |= single
            turn[1:] |= single
        word = kind != 0
        self.start = np.flatnonzero(word & turn[:n])
        self.end = np.flatnonzero(word & turn[1:]) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        self.count = np.diff(self.first)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.count)), self.count)

    def hashes(self, data: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit fingerprint of each word (of its bytes in ``data``, where
        those differ, as after a change of case)."""
        data = self.data if data is None else data
        size = self.end - self.start
        pieces = (size + 7) >> 3
        first = np.cumsum(pieces) - pieces
        if not len(size):
            return np.zeros(0, np.uint64)
        which = np.repeat(np.arange(len(size)), pieces)
        place = np.arange(len(which)) - first[which]
        piece = eight_bytes(data, self.start[which] + 8 * place, size[which] - 8 * place)
        mixed = mix(mix(piece + np.uint64(0x9E3779B97F4A7C15)) + place.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        return mix(np.add.reduceat(mixed, first) + size.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))

    def same(self, i: np.ndarray, j: np.ndarray, data: np.ndarray | None = None) -> np.ndarray:
        """Whether words i and j are equal, byte by byte (of ``data``)."""
        data = self.data if data is None else data
        a, b, size = self.start[i], self.start[j], (self.end - self.start)[i]
        out = size == (self.end - self.start)[j]
        on = np.flatnonzero(out & (a != b))
        for k in range(0, 64, 8):
            on = on[size[on] > k]
            out[on] &= eight_bytes(data, a[on] + k, size[on] - k) == eight_bytes(data, b[on] + k, size[on] - k)
        for x in on[size[on] > 64].tolist():
            out[x] = out[x] and np.array_equal(data[a[x]:a[x] + size[x]], data[b[x]:b[x] + size[x]])
        return out

    def windows(self, hashes: np.ndarray, size: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first word of each window of ``size`` words within a
        row, and the window's fingerprint: of runs of 1, 2, 4, … words, as
        ``size`` is a sum of them, each made of two of half its length."""
        last = np.repeat(self.first[1:], self.count) - size
        at = np.flatnonzero(np.arange(len(hashes)) <= last)
        run, width, begin = mix(hashes ^ np.uint64(salt)) if salt else hashes, 1, at
        out = np.full(len(at), size, np.uint64)
        while True:
            if size & width:
                out = mix(out * np.uint64(0xD6E8FEB86659FD93) + run[begin])
                begin = begin + width
            if 2 * width > size:
                return at, out
            run = mix(run[:-width] * np.uint64(0x9E3779B97F4A7C15) + run[width:]) if len(run) > width else run[:0]
            width *= 2
