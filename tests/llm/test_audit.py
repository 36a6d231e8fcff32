"""Source divergence against a plain version; packing and sorting of terms."""

import collections
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tests_llm_util import CLASHES
from tidewater.llm import divergence as d

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _terms(text):
    return [t.translate(UPPER) for t in TERM.findall(text or "")]


def _plain_version(rows, min_docs, top):
    rows = [(t or "", lang or "", s or "") for t, lang, s in rows]
    out = []
    for lang in {x for _, x, _ in rows}:
        held = collections.Counter(t for text, x, _ in rows if x == lang for t in set(_terms(text)))
        kept = {t for t, n in held.items() if n >= min_docs}
        sources = {s for _, x, s in rows if x == lang}
        count = {s: collections.Counter(t for text, x, y in rows if (x, y) == (lang, s) for t in _terms(text) if t in kept) for s in sources}
        every = sum(count.values(), collections.Counter())

        def p(c, t):
            return 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))

        for s in sources:
            pair = [(-sum(abs(p(count[s], t) - p(count[o], t)) for t in kept), o.encode(), o) for o in sources - {s}]
            term = [(p(every, t) - p(count[s], t), t.encode(), t) for t in kept if count[s][t] and p(count[s], t) > p(every, t)]
            for part, found in (("pair", sorted(pair)), ("term", sorted(term)[:top])):
                out += [(lang, s, part, item, -v, k + 1) for k, (v, _, item) in enumerate(found)]
    return sorted(out)


def _table(spark, rows):
    return spark.createDataFrame([(t, x, s) + (0,) * len(CLASHES) for t, x, s in rows], "text string, lang string, source string" + "".join(f", `{c}` int" for c in CLASHES))


@pytest.mark.parametrize("tile, flush", [(256, 4_000_000), (2, 1)])
def test_divergence_against_a_plain_version(spark, monkeypatch, tile, flush):
    monkeypatch.setattr(d, "TILE", tile)
    monkeypatch.setattr(d, "FLUSH_TERMS", flush)
    rng = random.Random(4)
    words = [w * k for w, k in zip(["a", "Zebra", "é", "straße", "日本語", "ÀB", "qwertyui", "qwertyuio", "sixteen-", "abcdefghABCDEFGH", "abcdefghABCDEFGHi", "long", "longer"],
                                   [1, 1, 1, 2, 3, 1, 1, 1, 1, 1, 1, 9, 400])] + [f"w{chr(97 + i)}x" for i in range(20)]
    rows = [(" 0_".join(rng.choices(words, k=rng.randrange(0, 40))), rng.choice(["en", "en", "de", None, ""]), rng.choice(["s1", "s2", "S3", "é", None])) for _ in range(120)]
    rows += [(None, "en", "quiet"), ("", "xx", "a"), ("rare words", "xx", "b"), ("rare words", "xx", "b"), ("the " * 30_000, "en", "s1"), ("\x00A\x7fA\x80", "de", "s2")]
    got = [tuple(r) for r in d.divergence(_table(spark, rows), min_docs=4, top=7).collect()]
    assert sorted(got) == _plain_version(rows, 4, 7)


def test_divergence_of_nothing(spark):
    assert d.divergence(_table(spark, [])).count() == 0
    got = d.divergence(_table(spark, [(None, None, None), ("few words", "", "b")])).collect()
    assert sorted(map(tuple, got)) == [("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)]


def test_packed_terms_sort_as_their_bytes():
    rng = random.Random(1)
    terms = [bytes(rng.choice(b"ab\xc3\xa9\xff") for _ in range(rng.randrange(1, 17))) for _ in range(500)]
    data = np.frombuffer(b"".join(terms), np.uint8)
    size = np.array([len(t) for t in terms])
    words = d.packed(data, np.cumsum(size) - size, size, 16)
    order = d.radix_order(words)
    assert d.unpacked(words[order]).tolist() == sorted(terms)
    assert order.tolist() == sorted(range(500), key=lambda i: (terms[i], i))  # stable


def test_counts_of_a_batch_and_of_merged_ones():
    texts = ["b A a", "a " + "Xy" * 700, "a b " + "q" * 40, "xy" * 700 + " b"]
    group = np.array([0, 0, 1, 1])

    def as_rows(counted):
        rows = []
        for term, g, n, docs in counted.values():
            names = d.unpacked(term).tolist() if term.ndim == 2 else list(term)
            rows += list(zip(names, g.tolist(), n.tolist(), docs.tolist()))
        return sorted(rows)

    want = sorted([(b"a", 0, 3, 2), (b"b", 0, 1, 1), (b"xy" * 700, 0, 1, 1), (b"a", 1, 1, 1), (b"b", 1, 2, 2), (b"q" * 40, 1, 1, 1), (b"xy" * 700, 1, 1, 1)])
    whole = d.count_terms(pa.array(texts), group)
    assert as_rows(whole) == want
    parts = [d.count_terms(pa.array([t]), group[i:i + 1]) for i, t in enumerate(texts)]
    widths = set(itertools.chain(*parts))
    assert as_rows({w: d.merged([p[w] for p in parts if w in p]) for w in widths}) == want
