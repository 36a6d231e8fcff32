"""Exact top-k search against a full comparison; edge cases, compaction, the grid."""

import math
import random

import numpy as np
import pytest

from tests_llm_util import CLASHES
from tidewater.llm import topk


def _plain_version(rows, queries, k, scale=256):
    held = []
    for n, (i, v) in enumerate(rows):
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            held.append((n, i, [math.floor(scale * np.float64(np.float32(x))) for x in v]))
    out = []
    for n, i, q in held:
        if i is not None and i % queries == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, c)), j is None, j or 0, j) for m, j, c in held if m != n)
            out += [(i, r + 1, s[3], -s[0]) for r, s in enumerate(scores[:k])]
    return sorted(out, key=str)


def _table(spark, rows):
    return spark.createDataFrame([(i, v, 0) + (0,) * len(CLASHES) for i, v in rows], "vec_id long, embedding array<float>, rank int" + "".join(f", `{c}` int" for c in CLASHES if c != "rank"))


def _found(spark, rows, queries, k=5):
    return sorted(map(tuple, topk.top_k(_table(spark, rows), queries, k).collect()), key=str)


def _vectors(rng, n, dims):
    rows = []
    for i in range(n):
        v = [rng.gauss(0, 1) * (3 if d % 7 == 0 else 0.3) for d in range(dims)]
        rows.append((i, v))
    return rows


@pytest.mark.parametrize("dims, block, sparse, scale", [(40, 1 << 17, 0.1, 1), (40, 600, 2.0, 1), (70, 2000, 0.0, 300), (33, 1000, 0.3, 10**5)])
def test_top_k_against_a_full_comparison(spark, monkeypatch, dims, block, sparse, scale):
    monkeypatch.setattr(topk, "BLOCK_BYTES", block)
    monkeypatch.setattr(topk, "SPARSE", sparse)
    monkeypatch.setattr(topk, "SLICE_BYTES", 8000)
    monkeypatch.setattr(topk, "GROUP_BYTES", 1500)
    rng = random.Random(dims + block)
    rows = [(i, [x * scale for x in v]) for i, v in _vectors(rng, 150, dims)]
    same = rows[10][1]
    rows += [(200 + k, same) for k in range(20)] + [(30, same), (30, rows[30][1])]  # ties, repeated ids
    rows += [(None, same), (60, None), (75, [None] * dims), (90, [math.inf] * dims), (None, [1.0] * dims), (-15, [0.25] * dims)]
    assert _found(spark, rows, 15) == _plain_version(rows, 15, 5)


def test_vectors_of_other_lengths_and_few_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0]), (2, []), (50, [0.5, -1.0, 8.0]), (3, [float("nan")])]
    assert _found(spark, rows, 50) == _plain_version(rows, 50, 5)
    assert _found(spark, [(0, [1.0])], 50) == [] and _found(spark, [], 50) == []
    assert _found(spark, [(0, None), (50, None)], 50) == []


def test_vectors_too_long_for_a_score(spark):
    rows = [(0, [1.0, 1.0]), (1, [3e38, 1.0]), (2, [2.0, 3.0]), (50, [1e6, -7e6])]
    assert _found(spark, rows, 50) == _plain_version([r for r in rows if r[0] != 1], 50, 5)


def test_bounds_drop_pairs_only_below_the_least():
    rng = np.random.default_rng(2)
    q, c = rng.integers(-200, 200, (9, 64)), rng.integers(-200, 200, (64, 500))
    full = q @ c
    least = np.sort(full, axis=1)[:, -5].astype(float)
    for kind in (np.float32, np.float64, np.int64):
        i, j, s = topk._bounded(q, c, least if kind is not np.int64 else least.astype(np.int64), kind)
        assert (s == full[i, j]).all()
        assert sorted(zip(i.tolist(), j.tolist())) == sorted(zip(*(x.tolist() for x in np.nonzero(full >= least[:, None]))))
