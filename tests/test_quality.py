import hashlib

import pytest

from casebook.operators import frequency, quality


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_missing_report_counts_only_null(spark):
    df = frame(spark, [("", float("nan")), (None, 1.0), ("x", None), ("y", 2.0)], "a string, b double")
    report = {r.column_name: r for r in quality.missing_report(df).collect()}
    assert (report["a"].total_row, report["a"].missing_row, report["a"].missing_percentage) == (4, 1, 25.0)
    assert report["b"].missing_row == 1


def test_missing_report_of_no_rows(spark):
    (row,) = quality.missing_report(frame(spark, [], "a string")).collect()
    assert (row.total_row, row.missing_row, row.missing_percentage) == (0, 0, None)


def test_column_names_are_never_read_as_sql(spark):
    df = frame(spark, [(None, 1)], "`a b.c` string, `or 1=1` int")
    assert {r.column_name: r.missing_row for r in quality.missing_report(df).collect()} == {"a b.c": 1, "or 1=1": 0}


def test_threshold_is_strict(spark):
    rows = [(None, None), (1, None), (1, 1), (1, 1), (1, 1)]
    df = frame(spark, rows, "fifth int, more int")
    assert [r.column_name for r in quality.high_missing_columns(df).collect()] == ["more"]


def test_columns_to_drop_are_listed_once(spark):
    df = frame(spark, [(None,)], "sub_product string")
    names = [r.column_name for r in quality.columns_to_drop(df).collect()]
    assert sorted(names) == ["complaint_id", "complaint_what_happened", "sub_product"]


def test_absent_unwanted_columns_do_not_break_the_quarantine(spark):
    df = frame(spark, [("1", None, "a"), ("2", None, None)], "complaint_id string, empty int, issue string")
    rejected = quality.rejected_columns(df)
    assert rejected == ["empty", "issue"]
    assert quality.accepted_rows(df, rejected).columns == ["complaint_id"]


def test_quarantine_and_accepted_rebuild_the_input(spark):
    rows = [(str(i), None if i % 3 else i, f"p{i}", i) for i in range(30)]
    df = frame(spark, rows, "complaint_id string, sparse int, sub_product string, kept int")
    rejected = quality.rejected_columns(df)
    assert rejected == ["sparse", "sub_product"]
    held = quality.quarantine_columns(df, rejected)
    assert held.columns == ["complaint_id", "column_name", "value", "error_msg"]
    wide = held.groupBy("complaint_id").pivot("column_name", rejected).agg({"value": "max"})
    rebuilt = quality.accepted_rows(df, rejected).join(wide, "complaint_id")
    rebuilt = rebuilt.selectExpr("complaint_id", "cast(sparse as int) sparse", "sub_product", "kept")
    assert sorted(map(tuple, rebuilt.collect())) == sorted(rows)


def test_nothing_rejected_gives_an_empty_quarantine(spark):
    df = frame(spark, [("1", 2)], "complaint_id string, kept int")
    assert quality.rejected_columns(df) == []
    held = quality.quarantine_columns(df, [])
    assert held.columns == ["complaint_id", "column_name", "value", "error_msg"] and held.isEmpty()


def test_contract(spark):
    df = frame(spark, [(None, "x"), (None, "y")], "a string, b string")
    assert quality.require_columns(df, ["a", "b"]) is df
    with pytest.raises(quality.ContractError, match="'c'"):
        quality.require_columns(df, ["b", "c"])
    with pytest.raises(quality.ContractError, match=r"too many missing values: \['c'\]"):
        quality.require_columns(df, ["b", "c"], rejected=["c"])
    report = {r.column_name: tuple(r)[1:] for r in quality.contract_report(df, ["a", "b", "c"]).collect()}
    assert report == {"a": (True, 2, False), "b": (True, 0, True), "c": (False, None, False)}
    assert quality.contract_report(df, ["c"]).count() == 1


def test_profile_counts_null_as_a_value(spark):
    long = "w " * 100
    df = frame(spark, [(long, 1), (long + "!", None), (None, 1), (None, 2)], "t string, n int")
    exact = {r.column_name: r for r in quality.column_profile(df).collect()}
    assert (exact["t"].distinct_values, exact["t"].missing_row, exact["t"].missing_percentage) == (3, 2, 50.0)
    assert exact["n"].distinct_values == 3
    rows = [(0.0, [1], b"a"), (-0.0, [1, 2], b"a"), (float("nan"), None, b"b")]
    odd = frame(spark, rows, "d double, a array<int>, b binary")
    assert {r.column_name: r.distinct_values for r in quality.column_profile(odd).collect()} == {"d": 2, "a": 3, "b": 2}
    about = {r.column_name: r.distinct_values for r in quality.column_profile(df, approximate=True).collect()}
    assert about == {"t": 3, "n": 3}


def test_instants_stay_apart_in_every_time_zone(spark):
    """The clock shows half past one twice on that night in New York."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("select timestamp_micros(1604208600000000 + id * 3600000000) t from range(2)")
        (row,) = quality.column_profile(df).collect()
        counts = frequency.frequency_table(df, ["t"]).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.distinct_values == 2 and len(counts) == 2


def test_a_digest_is_no_value(spark):
    long = "w" * 100
    df = frame(spark, [(long,), (hashlib.sha256(long.encode()).hexdigest(),), ("#x",), ("x",)], "t string")
    (row,) = quality.column_profile(df).collect()
    assert row.distinct_values == 4


def test_profile_of_no_rows(spark):
    df = frame(spark, [], "a string, b int")
    for approximate in (False, True):
        rows = {tuple(r) for r in quality.column_profile(df, approximate).collect()}
        assert rows == {("a", 0, 0, 0, None), ("b", 0, 0, 0, None)}
