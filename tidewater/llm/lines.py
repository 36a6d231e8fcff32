"""Line dedup within one edit, by a deletion-neighbourhood join. DataFrame
functions only.

A line is what stands between line feeds, without white space at its ends.
A line is dropped where an earlier one (by doc_id, then line number) is equal,
or one insertion, deletion or substitution away (the bound is one edit). Lines
of at least ``min_chars`` code points are compared by edits; equal ones of any
length from ``equal_chars`` on meet by fingerprint. Empty lines stay.

Equal lines meet first, and each distinct line goes on once. Of two different
lines one edit apart, everything but the part that the edit is in is equal:
first by halves (key: the half without the edit), which tells the lines that
can have a neighbour at all, then, for those, by 4 to 64 parts (key: what
stands before and behind the part). Only lines that share such a key emit
their deletion neighbourhood, of that part alone: the part and the part
without each one of its characters, hashed with the key. Lines that agree
without the character at one position are one substitution apart, all of
them, so each is joined with the earliest only; a whole part joins the parts
that become it. Every pair is verified on the whole lines, which must be equal
without the characters that the variants lack; no pairs are made inside a
group. A part has at most a 64th of a long line, so that the
variants of one have a 64th of its length squared.

So that lines whose lengths differ by one share keys, a line has them twice:
for its own length, and as the longer one of two for its length less one.

Inputs: null text counts as empty (one empty line); rows that repeat a doc_id
are separate documents, whose equal lines count as copies in an order that
the rows' contents fix; null ids come last; an empty table gives an empty
result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import text_of, written

MIN_CHARS = 20
_BLANK = " \t\r\x0b\x0c"


def _lines() -> F.Column:
    """The lines of a text, without white space at their ends."""
    return F.transform(F.split(text_of(), "\n"), lambda x: F.btrim(x, F.lit(_BLANK)))


def _id(line: F.Column) -> F.Column:
    """96 bits that stand for a line's text."""
    return F.struct(F.xxhash64(line).alias("h"), (F.crc32(line.cast("binary")) - F.lit(2**31)).cast("int").alias("g"))


def _keys(line: F.Column, parts: int | None, longer: int) -> F.Column:
    """(key, longer, a, b) per part of a line, as one of the length less
    ``longer``: ``a`` characters before the part and ``b`` behind it make the
    key. Without ``parts``, 4 to 64 by the length."""
    n = F.char_length(line)
    own = n - longer
    size = F.ceil(own / (F.when(own <= 256, 4).when(own <= 4096, 16).otherwise(64) if parts is None else parts)).cast("int")

    def part(j: F.Column) -> F.Column:
        a, b = (j * size).cast("int"), F.greatest(own - (j + 1) * size, F.lit(0)).cast("int")
        key = F.xxhash64(own, j, F.substring(line, F.lit(1), a), F.substring(line, n - b + 1, b))
        return F.struct(key.alias("key"), F.lit(longer).alias("longer"), a.alias("a"), b.alias("b"))

    return F.transform(F.sequence(F.lit(0), F.ceil(own / size).cast("int") - 1), part)


def _without(text: F.Column, place: F.Column) -> F.Column:
    """The text without its character at ``place`` (from 1; 0: whole)."""
    return F.when(place == 0, text).otherwise(F.concat(F.substring(text, F.lit(1), place - 1), F.substring(text, place + 1, F.char_length(text))))


def near_lines(docs: DataFrame, min_chars: int = MIN_CHARS, equal_chars: int = 1) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped and the dropped line
    numbers (from 0, ascending)."""
    equal_chars = max(1, min(equal_chars, min_chars))
    min_chars = max(min_chars, 4)
    wanted = F.filter(
        F.transform(F.col("all"), lambda x, i: F.struct(i.alias("line_no"), x.alias("line"))),
        lambda p: F.char_length(p["line"]) >= equal_chars)
    split = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", _lines().alias("all"))
    rows = written(split.select("rid", "doc_id", F.size("all").cast("long").alias("n_lines"), F.transform(wanted, lambda p: F.struct(
        p["line_no"].alias("line_no"), _id(p["line"]).alias("id"),
        F.when(F.char_length(p["line"]) >= min_chars, F.transform(
            F.flatten(F.array(*[_keys(p["line"], 2, longer) for longer in (0, 1)])), lambda k: k["key"])).alias("keys"))).alias("lines")), "lines")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "l.line_no", "rid").alias("place")
    at = rows.select("rid", "doc_id", F.explode("lines").alias("l")).select("l.id", place, *[F.get("l.keys", F.lit(j)).alias(f"k{j}") for j in range(4)])

    first = written(at.groupBy("id").agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("copies"), *[F.min(f"k{j}").alias(f"k{j}") for j in range(4)]), "first-lines")
    halved = first.where("k0 is not null").select(F.col("id"), F.explode(F.array_distinct(F.array(*[f"k{j}" for j in range(4)]))).alias("key"))
    able = written(_met(halved, "id").select("id").distinct(), "able-lines")

    # Text of the lines that can have a neighbour, once each.
    line = F.col("line")
    texts = (docs.select(F.explode(_lines()).alias("line")).where(F.char_length(line) >= min_chars).select(_id(line).alias("id"), "line")
             .join(able.hint("merge"), "id", "left_semi").groupBy("id").agg(F.min("line").alias("line")))
    # ``ord`` numbers them in the order of their places, over all partitions.
    known = written(texts.join(first.select("id", "place"), "id").repartitionByRange("place").sortWithinPartitions("place")
                    .withColumn("ord", F.monotonically_increasing_id()).select("ord", "id", "line"), "line-texts")

    keyed = known.select("ord", F.explode(F.flatten(F.array(*[_keys(line, None, longer) for longer in (0, 1)]))).alias("k")).select("ord", "k.*")
    met = _met(keyed, "ord")
    part = F.expr("substring(line, a + 1, char_length(line) - a - b)")
    parts = known.select("ord", "line").join(met, "ord").select("ord", "key", "longer", "a", part.alias("part"))
    # at 0: the whole part; else the part without one character, with the place
    # of it among lines of one length, and without among the longer ones.
    cuts = F.transform(F.sequence(F.col("longer"), F.char_length("part")), lambda i: F.struct(
        i.alias("at"), F.when(i == 0, F.xxhash64("key", F.lit(-1), "part")).when(F.col("longer") == 1, F.xxhash64("key", F.lit(-1), _without(F.col("part"), i)))
        .otherwise(F.xxhash64("key", i, _without(F.col("part"), i))).alias("v")))
    made = (parts.where("longer = 0 or part <> ''").select("ord", "longer", "a", F.explode(cuts).alias("c"))
            .select("ord", "longer", F.when(F.col("c.at") > 0, F.col("a") + F.col("c.at")).otherwise(0).alias("place"), "c.v"))
    # Variants that two lines share. A variant has at most as many lines as it
    # has places and the script has signs, however long the table is.
    variants = written(_shared(made, "v", "ord"), "variants")

    # Pairs of a line and an earlier one, and the characters (from 1; 0: none)
    # without which they are equal. Equal without the one at the same place:
    # the earliest of them.
    swapped = variants.where("place > 0 and longer = 0")
    same = (swapped.join(swapped.groupBy("v").agg(F.min("ord").alias("by")), "v").where("by < ord")
            .select("ord", "by", F.col("place").alias("cut"), F.col("place").alias("cut_by")))
    # A whole part and the parts that become it by one deletion.
    whole = variants.where("place = 0").select("v", F.col("ord").alias("whole")).distinct()
    longer = variants.where("longer = 1").select("v", "ord", "place").join(whole, "v")
    down = longer.where("whole < ord").groupBy("ord", "whole").agg(F.min("place").alias("cut")).select("ord", F.col("whole").alias("by"), "cut", F.lit(0).alias("cut_by"))
    up = (longer.where("ord < whole").groupBy("v", "whole").agg(F.min(F.struct("ord", "place")).alias("m"))
          .select(F.col("whole").alias("ord"), F.col("m.ord").alias("by"), F.lit(0).alias("cut"), F.col("m.place").alias("cut_by")))
    pairs = same.unionByName(down).unionByName(up).distinct()

    mine = known.select("ord", F.col("line").alias("x"), "id")
    other = known.select(F.col("ord").alias("by"), F.col("line").alias("y"))
    near = (pairs.join(mine, "ord").join(other, "by")
            .where(_without(F.col("x"), F.col("cut")) == _without(F.col("y"), F.col("cut_by"))).select("id").distinct())

    # Lines to drop: all of a line with an earlier neighbour, and all copies but the first.
    hit = (first.select("id", "place", "copies").join(near.withColumn("near", F.lit(True)), "id", "left").where("copies > 1 or near")
           .select("id", F.when(F.col("near").isNull(), F.col("place")).alias("keep")))
    dropped = (at.select("id", "place").join(hit, "id").where(F.col("keep").isNull() | (F.col("keep") != F.col("place")))
               .groupBy(F.col("place.rid").alias("r")).agg(F.sort_array(F.collect_list("place.line_no")).alias("lines")))
    counted = rows.select("rid", "doc_id", "n_lines")
    return counted.join(dropped, F.col("rid") == F.col("r"), "left").select(
        "doc_id", "n_lines", F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce("lines", F.array().cast("array<int>")).alias("dropped"))


def _met(keyed: DataFrame, of: str) -> DataFrame:
    """The rows whose ``key`` several different ``of`` have. A key may be hot:
    it is aggregated map-side, and the join can be split."""
    several = keyed.groupBy("key").agg(F.min(of).alias("x"), F.max(of).alias("y")).where("x <> y").select("key")
    return keyed.join(several, "key", "left_semi")


def _shared(rows: DataFrame, key: str, of: str) -> DataFrame:
    """The same for keys that few rows have."""
    alike = Window.partitionBy(key)
    return (rows.select("*", F.min(of).over(alike).alias("_lo"), F.max(of).over(alike).alias("_hi")).where("_lo <> _hi").drop("_lo", "_hi"))
