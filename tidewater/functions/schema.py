"""Declared schemas: the event message, the landed table, the envelope."""

from __future__ import annotations

from pyspark.sql import types as T

# The event message contract (field name, protobuf field
# number, protobuf type, Spark type), in declared order.
EVENT_FIELDS = [
    ("event_date", 1, "string", T.StringType()),
    ("event_time", 2, "string", T.StringType()),
    ("event_type", 3, "string", T.StringType()),
    ("product_id", 4, "int64", T.LongType()),
    ("category_id", 5, "int64", T.LongType()),
    ("category_code", 6, "string", T.StringType()),
    ("brand", 7, "string", T.StringType()),
    ("price", 8, "float", T.FloatType()),
    ("user_id", 9, "int64", T.LongType()),
    ("user_session", 10, "string", T.StringType()),
]

EVENT_COLUMNS = [f[0] for f in EVENT_FIELDS]

# Fixed value: the topic the ingest job subscribes to.
TOPIC = "ecommerce_tst"

# Landed layout: two directory levels, date then hour.
PARTITION_KEYS = ("event_date", "event_hour")

EVENT_SCHEMA = T.StructType([T.StructField(n, t, False) for n, _, _, t in EVENT_FIELDS])

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])

PEOPLE_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("age", T.IntegerType(), False),
    T.StructField("location", T.StringType(), False),
])


def landed_schema(extra: T.StructType | None = None) -> T.StructType:
    """Schema of the landed table as read back.

    Data columns 2-10 of the event, then ``extra`` data columns, then the two
    partition keys pinned to string/int so inference never turns ``20191001``
    into an int or a date.
    """
    fields = [T.StructField(n, t, True) for n, _, _, t in EVENT_FIELDS[1:]]
    if extra is not None:
        fields += [T.StructField(f.name, f.dataType, True) for f in extra.fields]
    fields += [
        T.StructField("event_date", T.StringType(), True),
        T.StructField("event_hour", T.IntegerType(), True),
    ]
    return T.StructType(fields)


LANDED_SCHEMA = landed_schema()

WITH_EVENT_ID = T.StructType([T.StructField("event_id", T.LongType(), True)])
