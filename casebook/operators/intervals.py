"""Joins of records with the windows of time that hold them; windows may overlap as they like.

Time is cut into bins, and records and windows meet by bin, so the join is on equal values. Bins are as
long as half of the mean window, which bounds the bins of all windows together by four times their
number, however different they are. A bin that holds more records than a task should get is split:
its records are dealt over as many parts as that takes, by a digest, and its windows go to each of them.

Where windows are only counted, ``open_levels`` turns them into windows that do not overlap, so a record
meets one of them however many were open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.workspace import write_table

#: Records of a bin that go to one task, about.
ROWS_PER_PART = 1_000_000

_BIN, _PART = "_bin", "_part"


def _micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def bin_width(windows: DataFrame, start: str, end: str) -> int | None:
    """Microseconds of a bin; None if no window holds any time."""
    length = (_micros(end) - _micros(start)).cast("decimal(38,0)")
    row = windows.agg(F.sum(length).alias("total"), F.count(F.lit(1)).alias("n")).first()
    return max(1, int(row.total) // (2 * row.n)) if row.n else None


def in_windows(
    records: DataFrame,
    windows: DataFrame,
    at: str,
    start: str = "window_start",
    end: str = "window_end",
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """Every record with every window that holds it: ``start <= at < end``.

    Columns of both, whose names must differ. A NULL time is in no window, a window with a NULL bound or
    without length holds nothing. Repeated rows meet each for itself.
    """
    usable = windows.where(F.col(start) < F.col(end))
    width = bin_width(usable, start, end)
    if width is None:
        return records.join(windows, F.lit(False))
    bins = F.sequence(F.floor(_micros(start) / width), F.floor((_micros(end) - 1) / width))
    spread = usable.withColumn(_BIN, F.explode(bins))
    placed = records.where(F.col(at).isNotNull()).withColumn(_BIN, F.floor(_micros(at) / width))
    crowded = placed.groupBy(_BIN).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > rows_per_part)
    crowded = write_table(crowded.select(_BIN, F.ceil(F.col("n") / rows_per_part).cast("int").alias("_parts")), "bins")
    digest = F.xxhash64(*[F.col(f"`{name}`") for name, kind in records.dtypes if not kind.startswith("map")])
    parts = F.coalesce("_parts", F.lit(1))
    # the digest deals equal rows alike; their place among the rows of a task would not be the same twice
    placed = placed.join(crowded, _BIN, "left").withColumn(_PART, F.pmod(digest, parts).cast("int")).drop("_parts")
    spread = spread.join(crowded, _BIN, "left")
    spread = spread.withColumn(_PART, F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    held = (F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))
    return placed.join(spread, [_BIN, _PART]).where(held).drop(_BIN, _PART)


def open_levels(windows: DataFrame, start: str = "window_start", end: str = "window_end") -> DataFrame:
    """start, end and ``n_open``: the spans of time between changes, and how many windows hold each of them.

    The spans do not overlap; those that no window holds are left out. Starts and ends are summed by time
    first, and the times are sorted in ranges. What a range begins with follows from one row for each range.
    """
    usable = windows.where(F.col(start) < F.col(end))
    edges = F.array(
        F.struct(F.col(start).alias("_at"), F.lit(1).alias("_change")),
        F.struct(F.col(end).alias("_at"), F.lit(-1).alias("_change")),
    )
    changes = usable.select(F.inline(edges)).groupBy("_at").agg(F.sum("_change").alias("_change"))
    ordered = changes.orderBy("_at").withColumn("_range", F.spark_partition_id())
    ordered = write_table(ordered, "changes")
    ranges = ordered.groupBy("_range").agg(F.sum("_change").alias("_sum"), F.min("_at").alias("_first"))
    by_range = Window.orderBy("_range")  # one row for each range
    before = F.sum("_sum").over(by_range.rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.select("_range", F.coalesce(before, F.lit(0)).alias("_before"), F.lead("_first").over(by_range).alias("_next"))
    by_time = Window.partitionBy("_range").orderBy("_at")
    spans = ordered.withColumns({"_own": F.sum("_change").over(by_time), "_end": F.lead("_at").over(by_time)})
    level = (F.col("_before") + F.col("_own")).alias("n_open")
    spans = spans.join(ranges, "_range").select(F.col("_at").alias(start), F.coalesce("_end", "_next").alias(end), level)
    return spans.where("n_open > 0")


def window_counts(
    records: DataFrame,
    windows: DataFrame,
    at: str,
    start: str = "window_start",
    end: str = "window_end",
    sums: dict[str, Column] | None = None,
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """``row_count`` and any further sums of the records in each window; windows without records included.

    Counted where records and windows meet, before anything moves.
    """
    names = windows.columns
    held = in_windows(records, windows, at, start, end, rows_per_part).groupBy(*names)
    held = held.agg(F.count(F.lit(1)).alias("row_count"), *[F.sum(value).alias(name) for name, value in (sums or {}).items()])
    same = None
    right = held.select(*[F.col(name).alias(f"_{name}") for name in names], "row_count", *(sums or {}))
    for name in names:
        equal = F.col(name).eqNullSafe(F.col(f"_{name}"))
        same = equal if same is None else same & equal
    found = windows.join(right, same, "left").drop(*[f"_{name}" for name in names])
    return found.fillna(0, ["row_count", *(sums or {})])
