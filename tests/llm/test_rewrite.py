"""Fill-in-middle against a plain version; edge cases."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tests_llm_util import CLASHES
from tidewater.llm.fim import fill_in_middle, restored

ODD = [None, "", "\n", "\n\n", "a", "a\n", "a\nb", "\na\n\nb\n", "é\nü\x0b\x85 ß\n", "x <P> y\nz", "<", "a<P\n<S\nM>", "<M\n>\n<S", "w\r\nv\r\n", "l\n" * 30_000, "q" * 300_000, "\U0001f600\n" * 40]


def _plain_version(i, text, seed=7, rate=100, spm=50):
    text = text or ""
    u = re.findall(r"[^\n]*\n|[^\n]+", text)
    x = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(x[8 * k:8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(t in text for t in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(u), "plain", None, None, text
    out = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < spm else f"<P>{p}<S>{s}<M>{m}"
    return len(u), "spm" if h4 % 100 < spm else "psm", len(p), len(m), out


@pytest.mark.parametrize("seed, rate, spm", [(7, 100, 50), (8, 60, 20)])
def test_fill_in_middle_against_a_plain_version(docs, seed, rate, spm):
    texts = ODD * 6
    ids = list(range(-3, len(texts) - 5)) + [None, 5]  # a null and a repeated doc_id
    made = fill_in_middle(docs(texts, ids=ids, extra=CLASHES), seed, rate, spm, keep=("text", "n_chars", "two words"))
    assert made.columns[:6] == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = made.drop("n_chars").withColumn("back", restored()).collect()
    want = sorted(((i, t or "") + _plain_version(i, t, seed, rate, spm) for i, t in zip(ids, texts)), key=str)
    assert sorted(((r.doc_id, r.text or "", r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=str) == want
    assert all(r.back == (r.text or "") for r in got)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_fill_in_middle_of_an_empty_table(docs):
    assert fill_in_middle(docs([])).withColumn("back", restored()).where(F.col("back").isNotNull()).count() == 0
