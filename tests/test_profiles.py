"""Profiles from slices, and the model registry."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from casebook.operators import promotion, slice_profiles
from casebook.operators.registry import Champion, ModelRegistry, ServedModel
from casebook.operators.slice_profiles import SliceProfiles

ROWS = [(k, None if k % 3 else "x", f"c{k % 2}" if k % 7 else None, 2000 + k % 4, k * 0.5) for k in range(500)]
SCHEMA = "id long, note string, kind string, year int, price double"


@pytest.fixture(scope="module")
def profiles(spark, tmp_path_factory):
    records = spark.createDataFrame(ROWS, SCHEMA)
    found = SliceProfiles(spark, str(tmp_path_factory.mktemp("profiles")), {"y": F.col("year"), "k": F.col("kind")})
    for number in (0, 1, 2, 1):
        found.add(records.where(F.col("id") % 3 == number), f"s{number}", ["id", "note"], ["id", "price"])
    return found


def test_levels_of_the_cube_add_up(profiles):
    rows = profiles.cube().where("column_name = 'note'").collect()
    by = {(row.over, row.y, row.k): (row.total_row, row.missing_row) for row in rows}
    assert len(by) == len(rows)
    for over in ("", "y", "k", "y,k"):
        own = [value for key, value in by.items() if key[0] == over]
        assert [sum(x) for x in zip(*own)] == [500, sum(row[1] is None for row in ROWS)]
    held = [row for row in ROWS if row[3] == 2001 and row[2] is None]
    assert by["", "2001", None] == (len(held), sum(row[1] is None for row in held))
    assert by["y", None, None][0] == sum(row[2] is None for row in ROWS)  # a NULL value is not a level left out


def test_quantiles_of_merged_sketches(spark, profiles):
    found = {(r.column_name, r.share): (r.n, r.value) for r in profiles.quantiles([0, 0.1, 0.5, 1]).collect()}
    assert found["id", 0] == (500, 0) and found["price", 1] == (500, 249.5)
    for share in (0.1, 0.5):
        assert abs(found["id", share][1] - 500 * share) <= 500 * slice_profiles.RANK_ERROR + 1


def test_columns_without_values_have_no_sketch(spark, tmp_path):
    rows = spark.createDataFrame([(1, None, float("nan"), dt.date(2020, 1, 1))], "a int, b double, c double, d date")
    found = slice_profiles.sketches(rows, ["a", "b", "c", "d"]).select("column_name", "n").collect()
    assert found == [("a", 1), ("d", 1)]
    empty = SliceProfiles(spark, str(tmp_path / "none"), {"y": F.col("a")})
    assert empty.cube().count() == 0 and empty.quantiles([0.5]).count() == 0
    empty.add(rows.limit(0), "s", ["a"], ["a"])
    assert empty.cube().where("over = ''").count() == 0 and empty.quantiles([0.5]).count() == 0


# Registry


def test_one_of_two_writers_gets_a_version(spark, tmp_path):
    one, other = (ModelRegistry(spark, str(tmp_path)) for _ in range(2))
    seen = one.champion()
    assert seen == other.champion() == Champion(0, 0, None)
    assert one.promote("models/a", seen) and not other.promote("models/b", seen)
    assert other.champion() == Champion(1, 1, "models/a")
    assert other.promote("models/b", other.champion(), 0.1)
    rows = one.versions().orderBy("version").collect()
    assert [(row.version, row.model_path, row.beaten) for row in rows] == [(1, "models/a", None), (2, "models/b", "models/a")]


def test_a_torn_version_counts_for_nothing(spark, tmp_path):
    registry = ModelRegistry(spark, str(tmp_path))
    assert registry.promote("models/a", registry.champion())
    (tmp_path / "versions" / "000000002.txt").write_text("")
    assert registry.champion() == Champion(1, 2, "models/a")
    assert registry.promote("models/b", registry.champion())
    assert registry.champion() == Champion(3, 3, "models/b")


def test_the_loser_is_judged_against_the_winner(spark, tmp_path):
    registry = ModelRegistry(spark, str(tmp_path))
    scores = {None: 0, "a": 1, "b": 2, "c": 3}
    asked = []

    def better(name):
        def judge(champion):
            asked.append((name, champion))
            if name == "c" and champion == "a":
                registry.compete("b", better("b"))
            return scores[name] > scores[champion], float(scores[name] - scores[champion])

        return judge

    assert registry.compete("a", better("a"))[1:] == (True, 1)
    assert registry.compete("c", better("c"))[1:] == (True, 2)
    assert asked == [("a", None), ("c", "a"), ("b", "a"), ("c", "b")]
    assert registry.compete("b", better("b"))[1] is False
    assert registry.champion().model_path == "c"


def test_a_model_is_loaded_again_only_if_the_champion_changed(spark, tmp_path):
    registry, loads = ModelRegistry(spark, str(tmp_path)), []
    served = ServedModel(registry, lambda path: loads.append(path) or f"loaded {path}")
    assert served.current() is None
    registry.promote("a", registry.champion())
    assert [served.current() for _ in range(3)] == ["loaded a"] * 3 and loads == ["a"]
    registry.promote("b", registry.champion())
    assert served.current() == "loaded b" and loads == ["a", "b"]


def test_equal_times_are_ordered_by_path(spark, tmp_path):
    moment = dt.datetime(2024, 1, 1)
    rows = [("true", 0.1, f"models/{name}", None, "true", moment) for name in ("b", "c", "a")]
    promotion.append_report(spark.createDataFrame(rows, promotion.REPORT_SCHEMA), str(tmp_path / "report"))
    assert promotion.latest_model(spark, str(tmp_path / "report")) == "models/c"
