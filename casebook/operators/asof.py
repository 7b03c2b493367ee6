"""As-of join: for each row the last state of its key that was known at its time.

Rows and states are sorted together by time within a key, and the last state is carried forward. A key
that holds more rows than a task should get is cut into ranges of time, each sorted in a task of its
own; what a range begins with, the last state of the ranges before it, follows from one row for each
range. Rows move once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casebook.workspace import write_table

#: Rows and states of a key that go to one task, about, and ranges of a key at most.
ROWS_PER_RANGE = 1_000_000
RANGES = 4096


def as_of(
    rows: DataFrame,
    states: DataFrame,
    key: str,
    at: str,
    since: str,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Every row with the columns of the last state of its key at or before its time, NULL without one.

    key: the column that both have. at: the rows' time, since: the states'. Of states of one key and time
    the one with the greatest other columns, in their order, holds. Rows with a NULL key or time have no
    state; states with a NULL key or time are no one's. Repeated rows each get theirs.
    """
    values = [name for name in states.columns if name not in (key, since)]
    state = F.struct(F.col(since).alias("_since"), *[F.col(f"`{name}`") for name in values])
    known = states.where(F.col(key).isNotNull() & F.col(since).isNotNull())
    right = known.select(F.col(key).alias("_key"), F.col(since).cast("timestamp").alias("_at"), state.alias("_state"))
    row = F.struct(*[F.col(f"`{name}`") for name in rows.columns])
    left = rows.select(F.col(key).alias("_key"), F.col(at).cast("timestamp").alias("_at"), row.alias("_row"))
    both = left.unionByName(right, allowMissingColumns=True)
    hot = both.where("_key IS NOT NULL").groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    hot = write_table(hot.where(F.col("_n") > rows_per_range), "hot-keys")
    ranges = F.lit(0)
    cuts = None
    largest = hot.agg(F.max("_n")).first()[0]
    if largest:
        count = min(RANGES, -(-largest // rows_per_range))
        shares = [k / count for k in range(1, count)] or [0.5]
        micros = F.unix_micros("_at")
        cuts = both.join(hot.select("_key"), "_key").where("_at IS NOT NULL").groupBy("_key")
        cuts = write_table(cuts.agg(F.percentile_approx(micros, shares, 10_000).alias("_cuts")), "cuts")
        both = both.join(cuts, "_key", "left")
        ranges = F.coalesce(F.size(F.filter("_cuts", lambda cut: cut < F.unix_micros("_at"))), F.lit(0))
    both = both.withColumn("_range", F.when(F.col("_at").isNull(), F.lit(-1)).otherwise(ranges)).drop("_cuts")
    # rows without a key stand alone: a digest keeps them from gathering
    alone = F.when(F.col("_key").isNull(), F.xxhash64("_row"))
    both = both.withColumn("_alone", alone)
    order = Window.partitionBy("_key", "_range", "_alone").orderBy("_at", F.col("_row").isNotNull(), "_state")
    order = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    usable = F.when(F.col("_key").isNotNull() & F.col("_at").isNotNull(), F.last("_state", ignorenulls=True).over(order))
    found = both.withColumn("_found", usable).where("_row IS NOT NULL").select("_key", "_range", "_row", "_found")
    if cuts is not None:
        found = _carried(found, both, cuts)
    return found.select("_row.*", F.col("_found._since").alias(since), *[F.col(f"_found.`{name}`") for name in values])


def _carried(found: DataFrame, both: DataFrame, cuts: DataFrame) -> DataFrame:
    """Rows of a key's later ranges that met no state there get the last one of the ranges before."""
    every = cuts.select("_key", F.explode(F.sequence(F.lit(0), F.size("_cuts"))).alias("_range"))
    last = both.where("_state IS NOT NULL AND _row IS NULL").join(cuts.select("_key"), "_key")
    last = last.groupBy("_key", "_range").agg(F.max(F.struct("_at", "_state")).alias("_last"))
    before = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carry = every.join(last, ["_key", "_range"], "left")
    carry = carry.withColumn("_carry", F.last("_last._state", ignorenulls=True).over(before))
    carry = write_table(carry.where("_carry IS NOT NULL").select("_key", "_range", "_carry"), "carried")
    joined = found.join(carry, ["_key", "_range"], "left")
    return joined.withColumn("_found", F.coalesce("_found", "_carry")).drop("_carry")
