"""Scalar column expressions. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 24 * 60 * 60


def key_digest(key: str) -> Column:
    return F.md5(F.col(key).cast("string").cast("binary"))


def key_share(key: str, parts: int = 100) -> Column:
    """A number from 0 to ``parts - 1`` fixed by the key."""
    return F.conv(F.substring(key_digest(key), 1, 8), 16, 10).cast("long") % parts


def as_timestamp(column: str) -> Column:
    """The value as a timestamp; text that is no timestamp gives NULL."""
    return F.col(column).try_cast("timestamp")


def value_text(column: Column, kind: str) -> Column:
    """Equal values as equal texts, different ones as different texts, whatever the session's time zone."""
    if kind in ("float", "double"):
        column = column + F.lit(0.0)  # minus zero equals zero
    elif kind == "timestamp":
        column = F.unix_micros(column)
    elif kind == "binary":
        column = F.hex(column)
    elif kind.startswith(("array", "struct", "map")):
        column = F.to_json(column, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timeZone": "UTC"})
    return column.cast("string")


def text_value(text: Column, kind: str) -> Column:
    """The value that ``value_text`` made the text from, for single values."""
    if kind == "timestamp":
        return F.timestamp_micros(text.cast("long"))
    if kind == "binary":
        return F.unhex(text)
    return text.cast(kind)


def elapsed_days(start: str, end: str) -> Column:
    """Absolute distance in days, counted in whole seconds; NULL when either side is."""
    seconds = as_timestamp(end).cast("long") - as_timestamp(start).cast("long")
    return F.abs(seconds) / F.lit(SECONDS_PER_DAY)

