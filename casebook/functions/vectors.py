"""Vectors as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stored(vector: str | Column, slot: str = "slot", value: str = "value") -> Column:
    """The pairs of slot and value that a vector stores: all of a dense one, the listed ones of a sparse one."""
    parts = F.unwrap_udt(vector)
    values = parts["values"]
    dense = F.transform(values, lambda _, place: place)
    slots = F.coalesce(parts["indices"], dense)
    return F.zip_with(slots, values, lambda a, b: F.struct(a.alias(slot), b.alias(value)))


def slots(df: DataFrame, keys: Sequence[str], vector: str, slot: str = "slot", value: str = "value") -> DataFrame:
    """One row per non-zero vector slot; a sparse vector never becomes a dense one.

    The outer form of inline keeps Catalyst from adding a size check that would compute the vector again.
    """
    return df.select(*keys, F.inline_outer(stored(vector, slot, value))).where(F.col(value) != 0)
