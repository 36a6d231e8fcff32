"""Registered queries of the training-data operators: each applies one
operator, with production parameters, to its whole table."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import small_batches
from tidewater.llm.divergence import divergence
from tidewater.llm.exact import exact_groups
from tidewater.llm.fim import fill_in_middle, restored
from tidewater.llm.lines import near_lines
from tidewater.llm.mixing import drawn_by_shard
from tidewater.llm.neardup import near_classes
from tidewater.llm.packing import pack_documents
from tidewater.llm.resample import resample
from tidewater.llm.rules import quality_rules
from tidewater.llm.substring import remove_repeats
from tidewater.llm.topk import top_k
from tidewater.llm.toxicity import toxicity
from tidewater.llm.warc import archive, lookup, read_records

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            small_batches(spark)
            return fn(spark, sf_dir)

        _QUERIES[name] = run
        if oracle:
            _ORACLE[name] = oracle
        return fn
    return deco


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLE)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- op7: exact dedup ------------------------------------------------------------

EXACT_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)"""


@query("op7_exact_dedup", EXACT_SQL)
def op7(spark, sf_dir):
    return exact_groups(_table(spark, sf_dir, "documents"))


# --- op3: mixing -----------------------------------------------------------------

@query("op3_mixing")
def op3(spark, sf_dir):
    return drawn_by_shard(_table(spark, sf_dir, "documents"))


# --- op8: packing ----------------------------------------------------------------

@query("op8_best_fit_packing")
def op8(spark, sf_dir):
    return pack_documents(_table(spark, sf_dir, "documents"))


# --- op1: WARC and capture index ---------------------------------------------------

WARC_SQL = r"""
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
b AS (
  SELECT *, max(page_id) OVER (PARTITION BY hex) AS keep,
    (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
        (CAST('0x' || substr(hex || '00', 1 + 2 * ((5 * i) // 8), 4) AS BIGINT) >> (11 - (5 * i) % 8)) & 31 AS BIGINT), 1), '' ORDER BY i)
     FROM range(32) t(i)) AS payload_digest
  FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = keep THEN NULL ELSE keep END AS refers_to
FROM b"""


@query("op1_warc_index", WARC_SQL)
def op1(spark, sf_dir):
    captures, directory = archive(_table(spark, sf_dir, "pages"))
    found = lookup(directory, captures)
    return read_records(found).drop("url")


# --- op4: quality rules ------------------------------------------------------------

@query("op4_quality_rules")
def op4(spark, sf_dir):
    return quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


# --- op9: importance resampling ----------------------------------------------------

@query("op9_importance_resampling")
def op9(spark, sf_dir):
    return resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


# --- op10: toxicity ----------------------------------------------------------------

@query("op10_toxicity")
def op10(spark, sf_dir):
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


# --- op6: substring dedup ------------------------------------------------------------

@query("op6_substring_dedup")
def op6(spark, sf_dir):
    return remove_repeats(_table(spark, sf_dir, "documents"))


# --- op5: near dedup -----------------------------------------------------------------

@query("op5_dart_minhash")
def op5(spark, sf_dir):
    return near_classes(_table(spark, sf_dir, "documents"))


# --- op11: exact top-k search ------------------------------------------------------------

TOP_K_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.r <> c.r)
SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s QUALIFY rank <= 5"""


@query("op11_exact_top_k", TOP_K_SQL)
def op11(spark, sf_dir):
    return top_k(_table(spark, sf_dir, "embeddings"), queries=50)


# --- op12: fill-in-middle ---------------------------------------------------------------

FIM_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (
  SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(x, 1, 8) AS BIGINT) % (len(u) + 1) AS a, CAST('0x' || substr(x, 9, 8) AS BIGINT) % (len(u) + 1) AS b,
         CAST('0x' || substr(x, 17, 8) AS BIGINT) % 100 AS c, CAST('0x' || substr(x, 25, 8) AS BIGINT) % 100 AS d FROM d),
f AS (
  SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 100 THEN 'plain' WHEN d < 50 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m, array_to_string(u[greatest(a, b) + 1:], '') AS s FROM h)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM f"""


@query("op12_fill_in_middle", FIM_SQL)
def op12(spark, sf_dir):
    made = fill_in_middle(_table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"))


# --- op13: source divergence audit -------------------------------------------------------

DIVERGENCE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS x FROM documents),
o AS (SELECT r, lang, source, translate(unnest(x), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT s.lang, s.source, coalesce(v.v, 0) AS v, coalesce(sum(c.n), 0) AS total
      FROM (SELECT DISTINCT lang, source FROM d) s LEFT JOIN v USING (lang) LEFT JOIN c ON c.lang = s.lang AND c.source = s.source GROUP BY s.lang, s.source, v.v),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (g.total + 5 * g.v)::HUGEINT AS p
      FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
t AS (SELECT lang, sum(total) AS total FROM g GROUP BY lang),
q AS (SELECT k.lang, k.term, 1 + 1000000000::HUGEINT * (sum(c.n) + 5)::HUGEINT // (any_value(t.total) + 5 * any_value(v.v))::HUGEINT AS q
      FROM k JOIN c USING (lang, term) JOIN t ON t.lang = k.lang JOIN v ON v.lang = k.lang GROUP BY k.lang, k.term),
far AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(sum(abs(x.p - y.p)), 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY a.lang, a.source, b.source),
own AS (SELECT p.lang, p.source, p.term AS item, CAST(p.p - q.q AS BIGINT) AS value FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q)
SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM far
UNION ALL
SELECT lang, source, 'term', item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM own
QUALIFY rank <= 50"""


@query("op13_source_divergence", DIVERGENCE_SQL)
def op13(spark, sf_dir):
    return divergence(_table(spark, sf_dir, "documents"))


# --- op2: line dedup -----------------------------------------------------------------

LINES_SQL = r"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents),
l AS (SELECT doc_id, unnest(range(len(x))) AS line_no, trim(unnest(x), ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line FROM split),
f AS (SELECT line, length(line) AS n, min(struct_pack(d := doc_id, l := line_no)) AS o FROM l WHERE line <> '' GROUP BY line),
k AS (SELECT *, unnest(list_distinct([(n - 2) // 2, (n - 1) // 2])) AS m FROM f WHERE n >= 20),
p AS (
  SELECT a.line AS a, b.line AS b, a.n AS na, b.n AS nb FROM k a JOIN k b ON a.m = b.m AND left(a.line, a.m) = left(b.line, b.m) AND b.o < a.o AND abs(a.n - b.n) <= 1
  UNION SELECT a.line, b.line, a.n, b.n FROM k a JOIN k b ON a.m = b.m AND right(a.line, a.m) = right(b.line, b.m) AND b.o < a.o AND abs(a.n - b.n) <= 1),
e AS (SELECT *, unnest(range(greatest(na, nb))) AS i FROM p),
near AS (SELECT DISTINCT a FROM e WHERE left(a, i) = left(b, i)
         AND substr(a, i + 1 + CASE WHEN na >= nb THEN 1 ELSE 0 END) = substr(b, i + 1 + CASE WHEN nb >= na THEN 1 ELSE 0 END)),
gone AS (SELECT l.doc_id, CAST(l.line_no AS INTEGER) AS line_no FROM l JOIN f USING (line) LEFT JOIN near ON near.a = l.line
         WHERE near.a IS NOT NULL OR f.o <> struct_pack(d := l.doc_id, l := l.line_no))
SELECT s.doc_id, CAST(len(s.x) AS BIGINT) AS n_lines, count(g.line_no) AS n_dropped,
       coalesce(list(g.line_no ORDER BY g.line_no) FILTER (WHERE g.line_no IS NOT NULL), CAST([] AS INTEGER[])) AS dropped
FROM split s LEFT JOIN gone g ON g.doc_id = s.doc_id GROUP BY s.doc_id, s.x"""


@query("op2_line_dedup", LINES_SQL)
def op2(spark, sf_dir):
    return near_lines(_table(spark, sf_dir, "documents"))
