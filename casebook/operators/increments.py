"""Incremental loading: what to read next, and which calendar windows the loaded records cover."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.operators.key_filters import YEAR, KeyFilters
from casebook.schema import FIRST_DATE, KEY, RECEIVED
from casebook.workspace import write_table


def high_water_mark(store: DataFrame, first_date: str = FIRST_DATE, received: str = RECEIVED) -> DataFrame:
    """One row, ``mark``: the newest loaded timestamp, never before ``first_date``."""
    floor = F.lit(first_date).cast("timestamp")
    return store.agg(F.greatest(F.max(received), floor).alias("mark"))


def incremental_slice(
    feed: DataFrame,
    store: DataFrame,
    to_date: str | None = None,
    first_date: str = FIRST_DATE,
    key: str = KEY,
    received: str = RECEIVED,
) -> DataFrame:
    """Records of ``feed`` from the store's mark on (and before ``to_date``) that the store lacks.

    One record per key is kept: downloads of neighbouring windows repeat their shared day. Records
    without a key are kept apart; records without a date are in no slice, and those that arrive
    after the mark has passed them are left to ``unseen_records``. The slice is written first, so
    that appending it to the store later cannot move the mark under it, and because Catalyst then
    knows how small it is beside the store: the store's keys are cut down to those in the slice by
    a broadcast where it fits, and only those are anti-joined.
    """
    mark = high_water_mark(store, first_date, received).scalar()
    due = feed.where(F.col(received) >= mark)
    if to_date is not None:
        due = due.where(F.col(received) < F.lit(to_date).cast("timestamp"))
    new = write_table(newest_copies(due, key, received), "slice")
    replayed = store.select(key).join(new.select(key), key, "left_semi").distinct()
    return new.join(replayed, key, "left_anti")


def newest_copies(records: DataFrame, key: str = KEY, received: str = RECEIVED) -> DataFrame:
    """The newest record of every key (of equally new ones the last by content), and all without a key.

    The newest is found per map task before the shuffle, so copies of one key never gather in a task.
    """
    row = F.struct(*[F.col(name) for name in records.columns])
    order = F.struct(F.col(received), F.to_json(row))
    keyed = records.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key"))
    newest = keyed.agg(F.max_by(row, order).alias("_row")).select("_row.*")
    return newest.unionByName(records.where(F.col(key).isNull()))


def unseen_records(
    records: DataFrame,
    read_years: Callable[[list[int | None]], DataFrame],
    filters: KeyFilters,
    key: str = KEY,
    received: str = RECEIVED,
) -> DataFrame:
    """Records whose key the store lacks, whenever they or the stored ones were received, each key once.

    The filters tell which years may hold which keys. ``read_years`` gives the store's records of some
    years (None: without a date); only those years are read, and of them only the keys that may be there
    are compared. A record whose year of receipt has changed since is found in the year it was stored under.
    Give ``records`` as a written table. Keys are counted and compared alone; whole records move only where
    their key is new, and copies are compared only where the records hold several of a new key.
    """
    counted = records.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    counted = write_table(counted, "keys")
    maybe = write_table(filters.possible_years(counted, key), "maybe-stored")
    years = [row[YEAR] for row in maybe.select(YEAR).distinct().collect()]  # at most one for each year of the store
    if years:
        replayed = read_years(years).select(key).join(maybe.select(key).distinct(), key, "left_semi").distinct()
        counted = write_table(counted.join(replayed, key, "left_anti"), "unseen-keys")
    repeated = counted.where("_n > 1").select(key)
    if years:
        alone = records.join(counted.where("_n = 1").select(key), key, "left_semi")
        alone = alone.unionByName(records.where(F.col(key).isNull()))
    else:
        alone = records.join(repeated, key, "left_anti")
    return alone.unionByName(newest_copies(records.join(repeated, key, "left_semi"), key, received))


def window_unit(from_date: date, to_date: date) -> str | None:
    """Unit of the download windows by length of the span; None is one window for the whole span."""
    days = (to_date - from_date).days
    if days > 365:
        return "year"
    if days > 30:
        return "month"
    if days > 7:
        return "week"
    return None


def plan_windows(spark: SparkSession, from_date: date, to_date: date) -> DataFrame:
    """Half-open windows that cover ``[from_date, to_date)`` without gap or overlap.

    The first window begins at ``from_date``, the others at the start of a calendar unit.
    """
    unit = window_unit(from_date, to_date)
    first, end = F.lit(from_date).cast("timestamp"), F.lit(to_date).cast("timestamp")
    starts = F.array(first)
    if unit:
        last = end - F.expr("interval 1 microsecond")
        starts = F.sequence(F.date_trunc(unit, first), last, F.expr(f"interval 1 {unit}"))
    windows = F.transform(
        starts,
        lambda start, i: F.struct(
            F.greatest(start, first).alias("window_start"),
            F.coalesce(F.get(starts, i + 1), end).alias("window_end"),
        ),
    )
    return spark.range(1).select(F.inline(windows)).where("window_start < window_end")


def _window_start(value: Column, first: Column, unit: str | None) -> Column:
    return F.greatest(F.date_trunc(unit, value), first) if unit else first


def window_coverage(df: DataFrame, from_date: date, to_date: date, received: str = RECEIVED) -> DataFrame:
    """Records per planned window, windows without records included.

    Records are counted per window start first (map-side combined), so the windows are joined to
    one row per window and not to the records.
    """
    unit = window_unit(from_date, to_date)
    first, end = F.lit(from_date).cast("timestamp"), F.lit(to_date).cast("timestamp")
    value = F.col(received)
    counts = (
        df.where((value >= first) & (value < end))
        .groupBy(_window_start(value, first, unit).alias("window_start"))
        .agg(F.count(F.lit(1)).alias("held"))
    )
    windows = plan_windows(df.sparkSession, from_date, to_date)
    return windows.join(counts, "window_start", "left").select(
        "window_start", "window_end", F.coalesce("held", F.lit(0)).alias("row_count")
    )
