"""Interval and as-of joins against plain loops."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from casebook.operators import asof, intervals

DAY = dt.datetime(2020, 1, 1)


def moment(hours):
    return None if hours is None else DAY + dt.timedelta(hours=hours)


@pytest.fixture(scope="module")
def times(spark):
    rng = random.Random(2)
    # half of the records at one hour, as one key may hold
    hours = [rng.choice([100, 100, rng.randrange(0, 3000), None]) for _ in range(800)]
    rows = [(k % 790, moment(h)) for k, h in enumerate(hours)]
    return rows, spark.createDataFrame(rows, "id long, at timestamp")


@pytest.fixture(scope="module")
def windows(spark):
    rng = random.Random(3)
    rows = [(k, moment(s), moment(s + rng.choice([0, 1, 24, 500, 5000]))) for k, s in enumerate(rng.randrange(-100, 3000) for _ in range(60))]
    rows += [(60, moment(99), moment(101)), (61, moment(99), moment(101)), (62, None, moment(9)), (63, moment(5), None), (64, moment(9), moment(5))]
    return rows, spark.createDataFrame(rows, "number long, window_start timestamp, window_end timestamp")


@pytest.mark.parametrize("rows_per_part", [10, 1_000_000])
def test_every_record_meets_every_window_that_holds_it(times, windows, rows_per_part):
    expected = sorted(
        (i, n) for i, at in times[0] for n, s, e in windows[0] if None not in (at, s, e) and s <= at < e
    )
    found = intervals.in_windows(times[1], windows[1], "at", rows_per_part=rows_per_part)
    assert sorted((r.id, r.number) for r in found.collect()) == expected
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    counted = intervals.window_counts(times[1], windows[1], "at", sums={"total": F.col("id")}, rows_per_part=rows_per_part)
    counts = {n: [0, 0] for n, _, _ in windows[0]}
    for i, n in expected:
        counts[n][0] += 1
        counts[n][1] += i
    assert {r.number: [r.row_count, r.total] for r in counted.collect()} == counts


@pytest.mark.parametrize("partitions", [8, 3])
def test_open_windows_are_counted_without_pairs(spark, times, windows, monkeypatch, partitions):
    """Each record meets one level, however many windows are open; F1 of round 3."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        levels = intervals.open_levels(windows[1]).cache()
        rows = sorted((r.window_start, r.window_end, r.n_open) for r in levels.collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert all(a[1] <= b[0] for a, b in zip(rows, rows[1:]))
    held = [(i, at, sum(1 for _, s, e in windows[0] if None not in (at, s, e) and s <= at < e)) for i, at in times[0]]
    met = intervals.in_windows(times[1], levels, "at")
    found = sorted((r.id, r.at, r.n_open) for r in met.collect())
    assert found == sorted(row for row in held if row[2])
    assert intervals.open_levels(windows[1].limit(0)).count() == 0


def test_open_cases_makes_no_row_for_each_pair(spark, monkeypatch):
    """What the join gives grows with the cases and not with the pairs of cases and spans."""
    from casebook.catalog.queries import REGISTERED

    met, plain = [], intervals.in_windows
    monkeypatch.setattr(intervals, "in_windows", lambda *args, **kwargs: met.append(plain(*args, **kwargs)) or met[-1])
    found = REGISTERED["open_cases"](spark, "/root/testdata/sf0.001")
    assert met[0].count() <= found.count()


def test_windows_of_any_length_take_bins_in_proportion(spark):
    """A window of a century among windows of a second does not blow up the bins."""
    rows = [(DAY, DAY + dt.timedelta(seconds=1))] * 999 + [(DAY, DAY + dt.timedelta(days=36_500))]
    table = spark.createDataFrame(rows, "window_start timestamp, window_end timestamp")
    width = intervals.bin_width(table, "window_start", "window_end")
    total = sum((e - s).total_seconds() * 1_000_000 // width + 2 for s, e in rows)
    assert total <= 4 * len(rows)


def test_no_windows_and_no_records(times, windows):
    assert intervals.in_windows(times[1], windows[1].limit(0), "at").count() == 0
    assert intervals.in_windows(times[1].limit(0), windows[1], "at").count() == 0
    assert intervals.window_counts(times[1].limit(0), windows[1], "at").agg(F.sum("row_count")).first()[0] == 0


@pytest.mark.parametrize("rows_per_range", [7, 50, 1_000_000])
def test_as_of_equals_a_plain_search(spark, rows_per_range):
    rng = random.Random(4)
    keys = ["hot", "hot", "a", "b", "c", None]
    rows = [(k, rng.choice(keys), moment(rng.choice([None, *range(0, 400, 3)]))) for k in range(500)]
    rows += [(0, "hot", moment(30))] * 2
    states = [(rng.choice(keys[1:]), moment(rng.choice([None, *range(50, 350, 7)])), f"m{k % 40}") for k in range(120)]
    states += [("hot", moment(30), "x"), ("hot", moment(30), None), ("hot", moment(30), "w")]
    left = spark.createDataFrame(rows, "id long, key string, at timestamp")
    right = spark.createDataFrame(states, "key string, since timestamp, model string")
    found = asof.as_of(left, right, "key", "at", "since", rows_per_range)

    def plain(key, at):
        held = [(s, m is not None, m or "") for k, s, m in states if None not in (k, s, key, at) and k == key and s <= at]
        best = max(held, default=None)
        return (None, None) if best is None else (best[0], best[2] if best[1] else None)

    assert found.columns == ["id", "key", "at", "since", "model"]
    got = sorted(map(str, found.collect()))
    expected = spark.createDataFrame([(*row, *plain(*row[1:])) for row in rows], found.schema)
    assert got == sorted(map(str, expected.collect()))


def test_as_of_without_states_or_rows(spark):
    left = spark.createDataFrame([(1, "a", DAY)], "id long, key string, at timestamp")
    right = spark.createDataFrame([("a", DAY, "m")], "key string, since timestamp, model string")
    assert asof.as_of(left, right.limit(0), "key", "at", "since").collect() == [(1, "a", DAY, None, None)]
    assert asof.as_of(left.limit(0), right, "key", "at", "since").count() == 0
