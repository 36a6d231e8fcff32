"""Typed columns from JSON text, driven by a field mapping.

A mapping is a list of (name, path, type). A path is a field name, a
``/``-separated path of names, or a JSON path that starts with ``$``. Types
are Spark's or the connector's names (``VARCHAR``, ``BIGINT``, …). A table
description in the connector's form (``key`` and ``message`` decoders with
``fields``) is applied by ``map_topic``.

Plain paths are read with one ``from_json`` per row, whatever their number;
only other JSON paths parse the text again. A missing field, bad JSON or a
value that doesn't convert gives null.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The connector's type names and their Spark types.
TYPE_NAMES = {
    "varchar": "string", "char": "string", "varbinary": "binary", "boolean": "boolean", "tinyint": "tinyint",
    "smallint": "smallint", "integer": "int", "bigint": "bigint", "real": "float", "double": "double",
    "date": "date", "timestamp": "timestamp",
}
_PLAIN = re.compile(r"(?:\$\.)?([A-Za-z_][\w-]*(?:[/.][A-Za-z_][\w-]*)*)$")


def spark_type(name: str) -> str:
    """Spark's type for a connector type name; lengths of text are dropped."""
    base = name.strip().lower()
    bare = re.sub(r"\s*\(.*\)$", "", base)
    return TYPE_NAMES[bare] if bare in TYPE_NAMES else base


def _steps(path: str) -> list[str] | None:
    """The field names of a plain path, or None."""
    found = _PLAIN.match(path)
    if not found:
        return None
    if path.startswith("$"):
        return found.group(1).split(".") if "/" not in path else None
    return path.split("/")


def _schema(paths: list[list[str]]) -> T.StructType:
    tree: dict = {}
    for p in paths:
        node = tree
        for step in p:
            node = node.setdefault(step, {})
    build = lambda t: T.StructType([T.StructField(k, build(v) if v else T.StringType()) for k, v in t.items()])
    return build(tree)


def _prefixes(paths: list[list[str]]) -> set[tuple[str, ...]]:
    return {tuple(p[:k]) for p in paths for k in range(1, len(p))}


def map_json(df: DataFrame, source: str, mapping, keep=None) -> DataFrame:
    """``keep`` columns (default: all but ``source``) followed by the mapped fields."""
    keep = [c for c in df.columns if c != source] if keep is None else list(keep)
    wanted = [(name, path, _steps(path), spark_type(kind)) for name, path, kind in mapping]
    plain = [s for _, _, s, _ in wanted if s]
    inner = _prefixes(plain)  # a path that is also an object on the way to another is read by itself
    in_struct = [s for s in plain if tuple(s) not in inner]
    parsed = "_parsed"
    while parsed in df.columns:
        parsed += "_"
    if in_struct:
        df = df.withColumn(parsed, F.from_json(F.col(f"`{source}`"), _schema(in_struct)))

    def value(path: str, steps: list[str] | None) -> Column:
        if steps and tuple(steps) not in inner:
            c = F.col(parsed)
            for s in steps:
                c = c.getField(s)
            return c
        return F.get_json_object(F.col(f"`{source}`"), path if path.startswith("$") else "$." + ".".join(path.split("/")))

    return df.select(*[F.col(f"`{c}`") for c in keep], *[value(p, s).try_cast(t).alias(n) for n, p, s, t in wanted])


def _decoder(df: DataFrame, source: str, spec: dict | None) -> tuple[DataFrame, list[str]]:
    """``df`` with the columns of one decoder added; their names."""
    if not spec:
        return df, []
    fields = [f for f in spec.get("fields", []) if str(f.get("hidden", "false")).lower() != "true"]
    names = [f["name"] for f in fields]
    if spec["dataFormat"] == "json" and all("mapping" in f for f in fields):
        return map_json(df, source, [(f["name"], f["mapping"], f["type"]) for f in fields], keep=df.columns), names
    if spec["dataFormat"] not in ("raw", "json"):
        raise ValueError(f"unknown data format {spec['dataFormat']!r}")
    # A field without a mapping is the whole text.
    whole = F.col(f"`{source}`").cast("string")
    return df.withColumns({f["name"]: whole.try_cast(spark_type(f["type"])) for f in fields}), names


def map_topic(records: DataFrame, description: dict, keep=()) -> DataFrame:
    """Columns of a topic table: the ``key`` decoder's fields from the column
    ``key``, then the ``message`` decoder's from ``value``. ``description``
    is a table description in the connector's form."""
    base = records.select(*[F.col(c).alias(f"_keep_{c}") for c in keep], F.col("key").cast("string").alias("_key_text"),
                          F.col("value").cast("string").alias("_value_text"))
    out, first = _decoder(base, "_key_text", description.get("key"))
    out, second = _decoder(out, "_value_text", description.get("message"))
    return out.select(*[F.col(f"_keep_{c}").alias(c) for c in keep], *first, *second)
