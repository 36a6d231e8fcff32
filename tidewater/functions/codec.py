"""Protobuf encode/decode of the event message as Arrow-batched pandas UDFs.

Neither the Kafka connector nor the spark-protobuf jar ships with this
image, so the JVM ``from_protobuf`` path is used only when its jar is on
the classpath (``engine="jvm"``). The default path decodes with the
installed protobuf runtime inside pandas UDFs: Spark splits the envelope
into Arrow batches (``spark.sql.execution.arrow.maxRecordsPerBatch``) and
decodes them in parallel on the executors; nothing goes through the driver.

Decode semantics: bad wire data or invalid UTF-8 -> reject; unknown fields
are skipped; empty bytes decode to the all-default event; a repeated field
keeps its last value; a null payload is rejected (and counted).
"""

from __future__ import annotations

import operator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.schema import EVENT_COLUMNS, EVENT_FIELDS, TOPIC

MESSAGE_NAME = "tidewater.EventData"

_DEFAULTS = {"string": "", "int64": 0, "float": 0.0}
_NUMPY = {"int64": np.int64, "float": np.float32}

# Reasons carried by rejected records.
REASON_UNDECODABLE = "undecodable"
REASON_NULL = "null payload"

_CLASS = None


def _file_descriptor():
    from google.protobuf import descriptor_pb2

    fdp = descriptor_pb2.FileDescriptorProto(
        name="tidewater_event.proto", package="tidewater", syntax="proto3"
    )
    msg = fdp.message_type.add(name="EventData")
    kinds = {
        "string": descriptor_pb2.FieldDescriptorProto.TYPE_STRING,
        "int64": descriptor_pb2.FieldDescriptorProto.TYPE_INT64,
        "float": descriptor_pb2.FieldDescriptorProto.TYPE_FLOAT,
    }
    for name, number, kind, _ in EVENT_FIELDS:
        msg.field.add(
            name=name,
            number=number,
            type=kinds[kind],
            label=descriptor_pb2.FieldDescriptorProto.LABEL_OPTIONAL,
        )
    return fdp


def message_class():
    """The generated message class, built once per Python worker."""
    global _CLASS
    if _CLASS is None:
        from google.protobuf import descriptor_pool, message_factory

        pool = descriptor_pool.DescriptorPool()
        pool.Add(_file_descriptor())
        _CLASS = message_factory.GetMessageClass(pool.FindMessageTypeByName(MESSAGE_NAME))
    return _CLASS


def descriptor_set_bytes() -> bytes:
    """Serialized FileDescriptorSet, as ``from_protobuf`` expects."""
    from google.protobuf import descriptor_pb2

    fds = descriptor_pb2.FileDescriptorSet()
    fds.file.append(_file_descriptor())
    return fds.SerializeToString()


DECODED_TYPE = T.StructType(
    [T.StructField(n, t, True) for n, _, _, t in EVENT_FIELDS]
    + [T.StructField("_ok", T.BooleanType(), False), T.StructField("_reason", T.StringType(), True)]
)


_DEFAULT_ROW = tuple(_DEFAULTS[kind] for _, _, kind, _ in EVENT_FIELDS)


def _decode_batch(values: pd.Series) -> pd.DataFrame:
    from google.protobuf.message import DecodeError

    msg = message_class()()
    parse = msg.ParseFromString  # clears the message, then merges the bytes
    fields = operator.attrgetter(*EVENT_COLUMNS)  # all 10 fields in one call
    rows, ok, reason = [], [], []
    for payload in values:
        if payload is None:
            rows.append(_DEFAULT_ROW)
            ok.append(False)
            reason.append(REASON_NULL)
            continue
        try:
            parse(payload)
        except DecodeError:
            rows.append(_DEFAULT_ROW)
            ok.append(False)
            reason.append(REASON_UNDECODABLE)
            continue
        rows.append(fields(msg))
        ok.append(True)
        reason.append(None)
    cols = list(zip(*rows)) if rows else [() for _ in EVENT_COLUMNS]
    frame = {}
    for (name, _, kind, _), col in zip(EVENT_FIELDS, cols):
        frame[name] = np.asarray(col, dtype=_NUMPY[kind]) if kind in _NUMPY else list(col)
    frame["_ok"] = np.asarray(ok, dtype=bool)
    frame["_reason"] = reason
    return pd.DataFrame(frame)


# Non-deterministic so the optimizer never duplicates the decode into both
# the filter on ``_ok`` and the projection of the fields.
decode_payload = F.pandas_udf(_decode_batch, DECODED_TYPE).asNondeterministic()


def _fill(msg, row) -> None:
    """Set the 10 fields from a row in declared order (the message contract)."""
    (msg.event_date, msg.event_time, msg.event_type, msg.product_id, msg.category_id,
     msg.category_code, msg.brand, msg.price, msg.user_id, msg.user_session) = row


def _encode_batch(events: pd.DataFrame) -> pd.Series:
    msg = message_class()()
    serialize = msg.SerializeToString
    out = []
    for row in zip(*[events[name].tolist() for name in EVENT_COLUMNS]):
        msg.Clear()
        _fill(msg, row)
        out.append(serialize())
    return pd.Series(out, dtype=object)


encode_payload = F.pandas_udf(_encode_batch, T.BinaryType())


def event_struct(df: DataFrame) -> Column:
    """The 10 event columns, nulls replaced by proto3 defaults, exact types."""
    parts = []
    for name, _, kind, stype in EVENT_FIELDS:
        parts.append(F.coalesce(F.col(name).cast(stype), F.lit(_DEFAULTS[kind]).cast(stype)).alias(name))
    return F.struct(*parts)


def encode_events(
    df: DataFrame,
    topic: str = TOPIC,
    key: Column | None = None,
    partition: Column | None = None,
    offset: Column | None = None,
    timestamp: Column | None = None,
) -> DataFrame:
    """Event rows -> envelope rows (key, value, topic, partition, offset, timestamp).

    Default-valued fields are omitted from the wire bytes (proto3).
    """
    def _or_null(c, t):
        return (c if c is not None else F.lit(None)).cast(t)

    return df.select(
        _or_null(key, "string").alias("key"),
        encode_payload(event_struct(df)).alias("value"),
        F.lit(topic).alias("topic"),
        _or_null(partition, "int").alias("partition"),
        _or_null(offset, "bigint").alias("offset"),
        _or_null(timestamp, "timestamp").alias("timestamp"),
    )


def _decode_jvm(value: Column) -> Column:
    from pyspark.sql.protobuf.functions import from_protobuf

    s = from_protobuf(
        value, MESSAGE_NAME, binaryDescriptorSet=descriptor_set_bytes(),
        options={"mode": "PERMISSIVE", "emit.default.values": "true"},
    )
    ok = value.isNotNull() & s.isNotNull()
    return F.struct(
        *[s[n].alias(n) for n in EVENT_COLUMNS],
        ok.alias("_ok"),
        F.when(value.isNull(), F.lit(REASON_NULL)).when(~ok, F.lit(REASON_UNDECODABLE)).alias("_reason"),
    )


_JVM_OK: dict[str, bool] = {}


def jvm_decode_available(spark) -> bool:
    """Whether the spark-protobuf jar is on the session's classpath; probed
    once per application. With the jar there, a failing ``from_protobuf`` is
    an error and isn't hidden by falling back."""
    app = spark.conf.get("spark.app.id", "") or "default"
    if app not in _JVM_OK:
        try:
            loader = spark.sparkContext._jvm.org.apache.spark.util.Utils.getContextOrSparkClassLoader()
            loader.loadClass("org.apache.spark.sql.protobuf.ProtobufDataToCatalyst")
            _JVM_OK[app] = True
        except Exception:  # class not found, or a session without a JVM gateway
            _JVM_OK[app] = False
    return _JVM_OK[app]


def evaluated_once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """``df`` with ``column``, which the optimizer can't copy into later
    filters: they don't move below a generator."""
    return df.select("*", F.explode(F.array(column)).alias(name))


def decode_status(envelope: DataFrame, engine: str = "auto") -> DataFrame:
    """Envelope plus a ``_e`` struct: the 10 fields, ``_ok`` and ``_reason``.

    ``engine``: ``python`` (pandas UDF), ``jvm`` (``from_protobuf``, needs the
    spark-protobuf jar) or ``auto`` (``jvm`` where the jar is there, else python).
    """
    if engine == "auto":
        engine = "jvm" if jvm_decode_available(envelope.sparkSession) else "python"
    if engine == "jvm":
        return evaluated_once(envelope, "_e", _decode_jvm(F.col("value")))
    return envelope.withColumn("_e", decode_payload(F.col("value")))


def decoded_columns(keep=()) -> list[Column]:
    return [F.col(k) for k in keep] + [F.col(f"_e.{n}").alias(n) for n in EVENT_COLUMNS]


def decode_events(envelope: DataFrame, keep=(), engine: str = "auto") -> DataFrame:
    """Decoded events in declared order; undecodable records are dropped.

    ``keep`` names envelope columns carried in front of the event columns.
    """
    return decode_status(envelope, engine).where(F.col("_e._ok")).select(*decoded_columns(keep))


def decode_rejects(envelope: DataFrame, engine: str = "auto") -> DataFrame:
    """Records that did not decode: where they came from and why."""
    return (
        decode_status(envelope, engine)
        .where(~F.col("_e._ok"))
        .select("topic", "partition", "offset", F.col("_e._reason").alias("reason"))
    )
