"""Fill-in-middle transformation, as one pyarrow.compute pipeline per batch.

A text is cut into lines (each with its line feed). Two cut points, functions
of the doc_id and the seed, part them into prefix, middle and suffix, which
are put out in one of two orders behind markers:

    psm   <P>prefix<S>suffix<M>middle
    spm   <S>suffix<P>prefix<M>middle

The lines of a batch become list arrays, flattened with the index of their
text; ordinals against the cut points give each line its role; the lines of a
role are filtered, put back in lists and joined. Only whole columns are
handled, no text on its own, and a batch is cut into slices of bounded bytes
(or one text) first.

A text stays plain where it is empty, holds a marker, or isn't drawn (``rate``
percent are). ``restored`` gives the text back from output and form alone: as
no text holds a marker, the markers found are those put in.

Inputs: null text counts as empty; a null doc_id is hashed as no digits;
repeated rows are transformed alike; an empty table gives an empty result;
other columns are kept by ``fill_in_middle`` only if named.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import text_of, text_slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
RATE = 100  # percent of the texts that are transformed
SPM = 50  # percent of those in the order spm


def _text(s: str) -> pa.Scalar:
    return pa.scalar(s, pa.large_string())


def _draws(seed: int) -> F.Column:
    """h1 to h4: the first four 8-digit groups of the hex SHA-256 of seed:doc_id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return F.struct(*[F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)])


def split_lines(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The lines of all texts, each with its line feed, the row of each, and
    its ordinal in the text."""
    parts = pc.split_pattern(texts, "\n")
    parent = pc.list_parent_indices(parts)
    flat = pc.list_flatten(parts)
    size = pc.list_value_length(parts)
    first = pc.subtract(pc.cumulative_sum(size), size)
    ordinal = pc.subtract(pa.array(np.arange(len(flat))), pc.take(first, parent))
    last = pc.equal(ordinal, pc.subtract(pc.take(size, parent), 1))
    nothing = pc.and_(last, pc.equal(pc.binary_length(flat), 0))  # behind the last line feed
    ended = pc.binary_join_element_wise(flat, pc.if_else(last, _text(""), _text("\n")), _text(""))
    stay = pc.invert(nothing)
    return ended.filter(stay), parent.filter(stay).to_numpy(), ordinal.filter(stay).to_numpy()


def _joined(units: pa.Array, parent: np.ndarray, role: np.ndarray, which: int, rows: int) -> pa.Array:
    """Per row, its units of one role as one string."""
    on = role == which
    bounds = np.concatenate([[0], np.cumsum(np.bincount(parent[on], minlength=rows))])
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), units.filter(pa.array(on))), _text(""))


def rearranged(texts: pa.Array, h: list[np.ndarray], rate: int = RATE, spm: int = SPM) -> dict[str, pa.Array]:
    """n, form, prefix_chars, middle_chars and output of a text array."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    rows = len(texts)
    units, parent, ordinal = split_lines(texts)
    n = np.bincount(parent, minlength=rows)
    a, b = h[0] % (n + 1), h[1] % (n + 1)
    lo, hi = np.minimum(a, b)[parent], np.maximum(a, b)[parent]
    role = (ordinal >= lo).astype(np.int8) + (ordinal >= hi)
    prefix, middle, suffix = (_joined(units, parent, role, k, rows) for k in range(3))

    marked = pc.or_(pc.or_(pc.match_substring(texts, PREFIX), pc.match_substring(texts, SUFFIX)), pc.match_substring(texts, MIDDLE))
    plain = pc.or_(pc.or_(pc.equal(pc.binary_length(texts), 0), marked), pa.array(h[2] % 100 >= rate))
    form = pc.if_else(plain, "plain", pc.if_else(pa.array(h[3] % 100 < spm), "spm", "psm"))
    p, s, m = map(_text, (PREFIX, SUFFIX, MIDDLE))
    psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, _text(""))
    spm_ = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, _text(""))
    none = pa.scalar(None, pa.int64())
    return {
        "n": pa.array(n, pa.int64()), "form": form,
        "prefix_chars": pc.if_else(plain, none, pc.utf8_length(prefix).cast(pa.int64())),
        "middle_chars": pc.if_else(plain, none, pc.utf8_length(middle).cast(pa.int64())),
        "output": pc.if_else(plain, texts, pc.if_else(pc.equal(form, "spm"), spm_, psm)),
    }


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row of ``docs``: doc_id, n (lines), form, prefix_chars,
    middle_chars, the output text, and the columns in ``keep``."""
    types = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches):
            h = [pc.struct_field(b.column("h"), f"h{k + 1}").to_numpy(zero_copy_only=False) for k in range(4)]
            made = rearranged(b.column("text"), h, rate, spm)
            made["form"], made["output"] = made["form"].cast(pa.string()), made["output"].cast(pa.string())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *made.values(), *[b.column(f"kept{k}") for k in range(len(keep))]], names=["doc_id", *made, *keep])

    schema = ", ".join([f"doc_id {types['doc_id']}, n long, form string, prefix_chars long, middle_chars long, output string", *[f"`{c}` {types[c]}" for c in keep]])
    return docs.select("doc_id", text_of().alias("text"), _draws(seed).alias("h"), *[F.col(f"`{c}`").alias(f"kept{k}") for k, c in enumerate(keep)]).mapInArrow(run, schema)


def restored(output: str = "output", form: str = "form") -> F.Column:
    """The text, from output and form alone."""
    p = F.split(F.col(output), f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (F.when(F.col(form) == "psm", F.concat(p[1], p[3], p[2]))
            .when(F.col(form) == "spm", F.concat(p[2], p[3], p[1]))
            .otherwise(F.col(output)))
