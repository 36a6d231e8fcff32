"""WARC and capture index, mixing, packing and the pipeline."""

import base64
import collections
import hashlib
import itertools
import os
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tests_llm_util import CLASHES, words
from tidewater.llm import queries, warc
from tidewater.llm.mixing import draw, drawn_by_shard, mixed_documents, permuted, shard_quotas, shard_rows, targets
from tidewater.llm.packing import Encoder, best_fit_decreasing, encoder, lower_bound, pack, pack_documents

SF001 = "/root/testdata/sf0.001"
PAGE = "page_id long, url string, html string"


# --- WARC --------------------------------------------------------------------------

def _pages(spark):
    rows = [(1, "http://www.Example.com/a?b=1#f", "<p>é</p>"), (2, "https://example.com:8080/x", "<p>é</p>"), (3, None, None), (4, "not a url", ""),
            (5, "http://a.b.org", "y" * 70_000), (5, "http://a.b.org", "y" * 70_000), (None, "http://z.com/", "<p>é</p>"), (6, "http://[bad", "z"),
            *[(i, "http://hot.com/", f"page {i % 7}") for i in range(100, 160)]]
    return rows, spark.createDataFrame([(*r, 1, 2) for r in rows], PAGE + ", kept int, digest int")


def test_url_keys():
    assert warc.url_key("http://www.Example.com/a?b=1#f") == "com,example,www)/a?b=1"
    assert warc.url_key("https://example.com:8080") == "com,example:8080)/" and warc.url_key(None) == warc.url_key("") == "-"
    assert warc.url_key("http://[bad") == "http://[bad"


def test_archives_round_trip_through_the_index(spark):
    rows, pages = _pages(spark)
    captures = warc.write_archives(warc.with_revisits(pages.repartition(3)), max_bytes=2000)
    directory = warc.build_index(captures, block_lines=5, file_captures=20)
    assert directory.count() > 10 and directory.select("index").distinct().count() > 2
    found = warc.lookup(directory, captures)
    assert found.count() == len(rows)
    got = sorted(((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload) for r in warc.read_records(found, with_payload=True).collect()), key=str)
    largest = collections.defaultdict(int)
    for p, _, h in rows:
        largest[h or ""] = max(largest[h or ""], p or 0)
    want = []
    for p, _, h in rows:
        raw, keep = (h or "").encode(), largest[h or ""]
        first = p == keep
        want.append((p or 0, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if first else "revisit",
                     None if first else keep, raw if first else None))
    assert got == sorted(want, key=str)
    # one key: only the blocks that can hold it are read
    one = warc.lookup(directory, spark.createDataFrame([("com,hot)/",), ("com,none)/",), (None,)], "key string"))
    assert one.count() == 60
    assert {r.payload_bytes for r in warc.read_records(warc.lookup(directory, spark.createDataFrame([("org,b,a)/",)], "key string"))).collect()} == {70_000}


def test_archives_are_standard_gzip_members(spark):
    _, pages = _pages(spark)
    path = warc.write_archives(warc.with_revisits(pages)).first().file.removeprefix("file:")
    import gzip

    with gzip.open(path) as f:
        raw = f.read()
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: ") and raw.endswith(b"\r\n\r\n")


def test_small_payloads_are_all_responses(spark):
    _, pages = _pages(spark)
    assert {r.refers_to for r in warc.with_revisits(pages, min_bytes=10**6).collect()} == {None}


def test_archive_of_no_pages(spark):
    captures, directory = warc.archive(spark.createDataFrame([], PAGE))
    assert warc.read_records(warc.lookup(directory, captures)).count() == 0


# --- mixing ------------------------------------------------------------------------

def test_targets_stop_at_three_times_the_source():
    assert targets([100, 100, 100], [1, 2, 3]) == [50, 100, 150]
    got = targets([1000, 10, 10, 500], [1, 2, 3, 1])
    assert got[1:3] == [30, 30] and sum(got) == pytest.approx(1520) and got[0] == got[3] == pytest.approx(730)
    assert targets([0, 0], [1, 2]) == [0, 0] and targets([], []) == []


def test_splitting_tree_deals_exact_quotas():
    quotas = [1000, 0, 17, 5000]
    q = shard_quotas(quotas, 13, 3)
    assert q.sum(axis=0).tolist() == quotas and (q >= 0).all()
    assert q.sum(axis=1).max() - q.sum(axis=1).min() <= 4  # equal shards
    assert (q == shard_quotas(quotas, 13, 3)).all() and (q != shard_quotas(quotas, 13, 4)).any()
    share = q[:, 3] / q.sum(axis=1)
    assert abs(share - 5000 / 6017).max() < 0.1


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000])
def test_permutation_is_one(n):
    p = permuted(np.arange(n), np.full(n, n), np.full(n, 99, np.uint64))
    assert sorted(p.tolist()) == list(range(n))


def _mix_table(docs):
    rng = random.Random(5)
    texts, sources = [], []
    for s, (n, size) in {"a": (60, 80), "b": (3, 20), "é": (40, 50), None: (20, 60), "B": (1, 3000)}.items():
        for _ in range(n):
            texts.append(" ".join(words(rng, rng.randrange(size))))
            sources.append(s)
    return texts + [None, ""], sources + ["a", "empty"], docs(texts + [None, ""], sources=sources + ["a", "empty"], extra=CLASHES)


def test_mix_meets_its_targets(docs):
    texts, sources, df = _mix_table(docs)
    rows = {r.doc_id: r for r in draw(df).collect()}
    sizes = collections.Counter()
    for t, s in zip(texts, sources):
        sizes[s] += len((t or "").split())
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    want = dict(zip(order, targets([sizes[s] for s in order], [k % 3 + 1 for k in range(len(order))])))
    taken = collections.Counter()
    for i, (t, s) in enumerate(zip(texts, sources)):
        r = rows[i]
        assert (r.size, r.source_size) == (len((t or "").split()), sizes[s]) and r.target == pytest.approx(want[s])
        assert r.taken == sum(p.words for p in r.pieces) <= 3 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= max(3, 0.01 * want[s]) for s in sizes)
    again = {r.doc_id: r.pieces for r in draw(df.repartition(7)).collect()}
    assert again == {i: r.pieces for i, r in rows.items()}
    # an epoch takes no word twice, and shards share no block
    for r in rows.values():
        for _, group in itertools.groupby(r.pieces, key=lambda p: p.epoch):
            end = 0
            for p in group:
                assert p.start >= end and p.start + p.words <= r.size
                end = p.start + p.words
    placed = shard_rows(df).collect()
    assert sum(r.words for r in placed) == sum(taken.values()) and len({r.shard for r in placed}) > 30


def test_mix_tells_the_words_of_each_shard(spark, docs):
    _, _, df = _mix_table(docs)
    rows, per_shard = drawn_by_shard(df).collect(), collections.Counter()
    for r in rows:
        assert [x.shard for x in r.shard_words] == sorted({x.shard for x in r.shard_words})
        assert sum(x.words for x in r.shard_words) == r.taken
        for x in r.shard_words:
            per_shard[x.shard] += x.words
    want = collections.Counter()
    for r in shard_rows(df).collect():
        want[r.shard] += r.words
    assert per_shard == want and len(want) > 30
    assert "shard_words" in queries.registered()["op3_mixing"](spark, SF001).columns


def test_mixed_documents_hold_the_drawn_words(docs):
    texts, _, df = _mix_table(docs)
    pieces = {r.doc_id: r.pieces for r in draw(df).collect()}
    want = collections.Counter()
    for d, ps in pieces.items():
        for e in {p.epoch for p in ps}:
            own = [p for p in ps if p.epoch == e]
            w = texts[d].split()
            want[d, texts[d] if sum(p.words for p in own) == len(w) else " ".join(x for p in own for x in w[p.start:p.start + p.words])] += 1
    out = mixed_documents(df)
    assert out.columns == df.columns
    rows = out.collect()
    assert collections.Counter((r.doc_id, r.text) for r in rows) == want and all(r.n_chars == len(r.text) for r in rows)


def test_mix_of_nothing(docs):
    assert draw(docs([])).count() == 0 and mixed_documents(docs([])).count() == 0
    assert [r.taken for r in draw(docs([None, ""])).collect()] == [0, 0]


# --- packing -----------------------------------------------------------------------

TEXTS = ["it's a Test's 1234 <|endoftext|> <|ENDOFTEXT|> x<|startoftext|>y", "a b éé ẞ ΑΣ İstanbul Ⅷ x²3 漢字 mix漢字ed É é", "", None,
         "\x1c#a\x85b q\x00r", "don''t  's 're", "a1b2c3--x__y 555-4124", "ñandú " * 9000, "٣ Ǆ ﬁ ​ z"]


def _ids(text):
    return encoder("word_bpe_49k.json").tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_encoder_equals_the_tokenizer():
    import public_tokenizers

    e = Encoder(public_tokenizers.path("word_bpe_49k.json"))
    con = duckdb.connect()
    texts = TEXTS + [r[0] for r in con.sql(f"SELECT text FROM '{SF001}/documents.parquet'").fetchall()]
    for part in (texts, texts[::-1]):  # also with a full cache
        ids, bounds = e.batch(pa.array(part, pa.string()))
        for k, t in enumerate(part):
            assert ids[bounds[k]:bounds[k + 1]].tolist() == _ids(t)[:-1], t[:80]


def test_best_fit_decreasing_and_its_bound():
    rng = np.random.default_rng(2)
    for lengths in (rng.integers(1, 100, 500), rng.integers(34, 60, 300), np.array([51] * 7), np.array([1] * 250), np.zeros(0, np.int64)):
        bin_of, offset, bins = best_fit_decreasing(lengths, 100)
        fill = np.bincount(bin_of, lengths, bins) if bins else np.zeros(0)
        assert (fill <= 100).all() and lower_bound(lengths, 100) <= bins
        for b in range(bins):
            own = np.argsort(offset[bin_of == b])
            assert (np.cumsum(lengths[bin_of == b][own]) - lengths[bin_of == b][own] == offset[bin_of == b][own]).all()
    assert lower_bound(np.array([51] * 7), 100) == 7 and lower_bound(np.array([34] * 9), 100) == 5
    assert lower_bound(np.array([60, 60, 41]), 100) == 3


def _check_packing(rows, capacity):
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        end = 0
        for offset, length in sorted(b):
            assert offset == end
            end += length
        assert end <= capacity
    return len(bins)


def test_packing_of_documents(docs):
    rows = pack_documents(docs(TEXTS, ids=[0, 1, 2, 3, 4, 5, 6, 7, None], extra=CLASHES)).collect()
    _check_packing(rows, 4096)
    by = collections.defaultdict(list)
    for r in rows:
        by[8 if r.doc_id is None else r.doc_id].append(r)
    for d, t in enumerate(TEXTS):
        ids, start = _ids(t), 0
        for k, r in enumerate(sorted(by[d], key=lambda r: r.piece)):
            part = np.asarray(ids[start:start + 4096], "<u4").tobytes()
            assert (r.piece, r.start, r.length, r.ids_crc32) == (k, start, len(part) // 4, zlib.crc32(part))
            start += r.length
        assert start == len(ids)
    assert pack_documents(docs([])).count() == 0


def test_groups_exchange_until_few_sequences_are_left(spark, monkeypatch):
    from tidewater.llm import packing

    monkeypatch.setattr(packing, "GROUP_PIECES", 40)
    monkeypatch.setattr(packing, "FAN_IN", 4)
    rng = random.Random(3)
    items = [(i, rng.choice([rng.randrange(1, 30), rng.randrange(30, 100), 100])) for i in range(1500)]
    rows = pack(spark.createDataFrame(items, "doc_id long, length long"), capacity=100).collect()
    assert sorted((r.doc_id, r.length) for r in rows) == items
    bound = lower_bound(np.array([n for _, n in items]), 100)
    assert bound <= _check_packing(rows, 100) <= 1.03 * bound + 1


def test_packing_tells_the_gap_of_its_last_group(spark):
    for lengths, gap in (([60, 60, 40, 40, 100], 0), ([43, 14, 22, 23, 47, 48], 1)):
        rows = pack(spark.createDataFrame(list(enumerate(lengths)), "doc_id long, length long"), capacity=100).collect()
        assert {r.gap for r in rows if r.length < 100} == {gap}
        assert all(r.gap == 0 for r in rows if r.length == 100)


# --- the registered queries and the pipeline ---------------------------------------

@pytest.mark.parametrize("name", sorted(queries.oracles()))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF001):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF001}/{f}'")
    df = queries.registered()[name](spark, SF001)
    want = con.sql(queries.oracles()[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    order = ", ".join(columns)
    assert sorted(map(str, df.select(columns).collect())) == sorted(
        str(r) for r in spark.createDataFrame(con.sql(f"SELECT {order} FROM want").fetchall(), df.select(columns).schema).collect())


def test_pipeline_stages(spark):
    import corpus_pipeline
    from __spark_entry__ import queries as all_queries

    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "near_dedup", "mixing", "packing"]
    assert "pipeline" in all_queries()
    con = duckdb.connect()
    labels = dict(con.sql(f"SELECT doc_id, quality FROM '{SF001}/labels.parquet'").fetchall())
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns, kept = docs.columns, []
    from tidewater.llm.common import written

    junk = range(10**6, 10**6 + 5)  # long rows of signs that no labelled good text has
    signs = [" ".join(f"#{(i * k) % 97}$%&" for k in range(20_000)) for i in junk]
    docs = docs.unionByName(spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in zip(junk, signs)], docs.schema))

    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF001), "t")
        assert docs.columns == columns
        kept.append([(r.doc_id, r.text) for r in docs.collect()])
    good, exact, near, mixed = kept
    ids = {d for d, _ in good}
    assert all(d in ids for d, q in labels.items() if q) and not ids & set(junk)
    norm = lambda t: " ".join(t.split())
    assert len(exact) == len({norm(t) for _, t in good}) and {d for d, _ in exact} <= ids
    first = {}
    for d, t in sorted(good):
        first.setdefault(norm(t), d)
    assert sorted(d for d, _ in exact) == sorted(first.values())
    assert 0 < len(near) <= len(exact) and {d for d, _ in mixed} <= {d for d, _ in near}
    total, out = sum(len(t.split()) for _, t in near), sum(len(t.split()) for _, t in mixed)
    assert abs(out - total) <= 0.01 * total
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF001).collect()
    assert len({(r.doc_id) for r in rows}) == len({d for d, _ in mixed})
    assert sum(r.length for r in rows) == sum(len(_ids(t)) for _, t in mixed)
    assert _check_packing(rows, 4096) <= lower_bound(np.array([r.length for r in rows]), 4096) + 1
