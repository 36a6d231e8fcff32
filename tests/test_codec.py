"""Protobuf codec: round trip (property test) and hand-made payloads."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewater.functions.codec import (
    REASON_NULL, REASON_UNDECODABLE, _decode_batch, _encode_batch, decode_events, decode_rejects,
    encode_events, message_class,
)
from tidewater.functions.schema import EVENT_COLUMNS, EVENT_SCHEMA

from testkit import plan_text

text = st.text(max_size=40)
i64 = st.integers(min_value=-(2**63), max_value=2**63 - 1)
f32 = st.floats(width=32, allow_nan=False)
event = st.tuples(text, text, text, i64, i64, text, text, f32, i64, text)


def _frame(rows):
    df = pd.DataFrame(rows, columns=EVENT_COLUMNS)
    for c in ("product_id", "category_id", "user_id"):
        df[c] = df[c].astype("int64")
    df["price"] = df["price"].astype("float32")
    return df


@settings(max_examples=60, deadline=None)
@given(st.lists(event, min_size=1, max_size=20))
def test_roundtrip_property(rows):
    out = _decode_batch(_encode_batch(_frame(rows)))
    assert out["_ok"].all()
    for i, row in enumerate(rows):
        got = tuple(out.loc[i, c] for c in EVENT_COLUMNS)
        for a, b in zip(got, row):
            if isinstance(b, float):
                assert np.float32(a) == np.float32(b) or (math.isnan(a) and math.isnan(b))
            else:
                assert a == b


def _msg(**kw):
    return message_class()(**kw).SerializeToString()


def _decode(payloads):
    return _decode_batch(pd.Series(payloads, dtype=object))


def test_payloads_from_fixture_f6():
    full = _msg(event_date="20191001", event_time="2019-10-01 00:00:00 UTC", event_type="view", product_id=7)
    # boundary after field 1: tag(1) + len + 8 bytes
    boundary = full[: 2 + len("20191001")]
    twice = _msg(event_type="a") + _msg(event_type="b")
    bad_utf8 = bytes([0x0A, 0x02, 0xFF, 0xFE])
    extra_field = full + bytes([0x78, 0x01])  # field 15, varint 1
    fixed32_f1 = bytes([0x0D, 1, 2, 3, 4])  # field 1 with wire type 5
    cases = [b"", full[:-3], boundary, twice, b"\xff\xff\xff", bad_utf8, extra_field, fixed32_f1, None]
    out = _decode(cases)
    ok = out["_ok"].tolist()
    assert ok == [True, False, True, True, False, False, True, True, False]
    assert out.loc[0, "event_date"] == "" and out.loc[0, "product_id"] == 0 and out.loc[0, "price"] == 0.0
    assert out.loc[2, "event_date"] == "20191001" and out.loc[2, "event_type"] == ""
    assert out.loc[3, "event_type"] == "b"
    assert out.loc[6, "product_id"] == 7
    assert out.loc[7, "event_date"] == ""
    assert out["_reason"].tolist()[1] == REASON_UNDECODABLE
    assert out["_reason"].tolist()[8] == REASON_NULL


def test_defaults_omitted_on_wire():
    assert _msg() == b""
    assert _msg(event_type="") == b""


def test_spark_roundtrip_and_rejects(spark):
    rows = [("20240101", "2024-01-01 01:02:03 UTC", "view", 1, 2, "c", "b", 1.5, 3, "3-20240101"),
            ("", "", "", 0, 0, "", "", 0.0, 0, "")]
    df = spark.createDataFrame(rows, EVENT_SCHEMA)
    env = encode_events(df, key=F_lit_str("k"))
    back = decode_events(env).collect()
    assert sorted(tuple(r) for r in back) == sorted(rows)
    junk = env.union(env.limit(1).selectExpr("key", "unhex('ffffff') AS value", "topic", "partition",
                                             "offset", "timestamp"))
    assert decode_events(junk).count() == 2
    rej = decode_rejects(junk).collect()
    assert len(rej) == 1 and rej[0]["reason"] == REASON_UNDECODABLE


def test_decode_runs_once_in_plan(spark):
    rows = [("20240101", "t", "view", 1, 2, "c", "b", 1.5, 3, "s")]
    env = encode_events(spark.createDataFrame(rows, EVENT_SCHEMA))
    plan = plan_text(decode_events(env), "simple")
    # one Python evaluation node (encode and decode chained in it), and the
    # filter on ``_ok`` reads its output instead of decoding again
    assert plan.count("ArrowEvalPython") == 1
    assert plan.count("_decode_batch(") == 1


def F_lit_str(v):
    from pyspark.sql import functions as F
    return F.lit(v)


def test_jvm_decode_needs_jar(spark):
    """The from_protobuf path is used only where the spark-protobuf jar
    exists; with the jar there, a failure is a failure."""
    from tidewater.functions.codec import jvm_decode_available

    if not jvm_decode_available(spark):
        pytest.skip("spark-protobuf jar not on the classpath")
    rows = [("20240101", "t", "view", 1, 2, "c", "b", 1.5, 3, "s")]
    env = encode_events(spark.createDataFrame(rows, EVENT_SCHEMA))
    assert decode_events(env, engine="jvm").collect()[0]["event_type"] == "view"
    assert plan_text(decode_events(env, engine="jvm"), "simple").count("from_protobuf") == 1


def test_a_deterministic_decode_is_evaluated_once(spark):
    """The JVM decode is deterministic: without the barrier the optimizer
    copies it into the filter on its result."""
    from pyspark.sql import functions as F
    from tidewater.functions.codec import evaluated_once

    df = spark.range(3).select(F.concat(F.lit('{"a": '), F.col("id").cast("string"), F.lit("}")).alias("j"))
    decoded = F.from_json("j", "a int, b string")
    out = evaluated_once(df, "e", decoded).where(F.col("e.a") > 0).select("e.a", "e.b")
    assert sorted(r.a for r in out.collect()) == [1, 2]
    assert plan_text(out, "simple").count("from_json") == 1


def test_auto_engine_falls_back_to_python(spark):
    from tidewater.functions.codec import jvm_decode_available

    rows = [("20240101", "t", "view", 1, 2, "c", "b", 1.5, 3, "s")]
    env = encode_events(spark.createDataFrame(rows, EVENT_SCHEMA))
    got = decode_events(env, engine="auto").collect()
    assert got[0]["event_type"] == "view"
    plan = plan_text(decode_events(env, engine="auto"), "simple")
    assert ("ArrowEvalPython" in plan) == (not jvm_decode_available(spark))
