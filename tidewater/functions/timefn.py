"""Derived time columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def event_hour(col: str = "event_time"):
    """Hour of a time string in the session time zone; malformed -> null.

    ANSI mode makes ``hour(string)`` raise on bad text, so the string goes
    through ``try_to_timestamp`` first. Zone suffixes (`` UTC``, ``Z``,
    ``+07:00``) are honoured and shifted to the session zone.
    """
    return F.hour(F.try_to_timestamp(F.col(col)))


def with_event_hour(df: DataFrame, src: str = "event_time", dst: str = "event_hour") -> DataFrame:
    return df.withColumn(dst, event_hour(src))
