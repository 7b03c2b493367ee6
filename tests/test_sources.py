import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from casebook.operators import increments
from casebook.sources import feed
from casebook.sources.cases import CASE_COLUMNS, cases

SF = "/root/testdata/sf0.001"

HITS = [
    {"_source": {"complaint_id": "1", "issue": "Loan", "date_received": "2019-09-24T12:00:00-05:00"}},
    {"sort": [1]},
    {"_source": {"complaint_id": "2", "zip_code": 12345, "date_received": "bad"}},
]


@pytest.mark.parametrize("layout", ["array on one line", "element per line", "array over lines"])
def test_envelope_layouts(spark, tmp_path, layout):
    texts = {
        "array on one line": json.dumps(HITS),
        "element per line": "\n".join(map(json.dumps, HITS)),
        "array over lines": json.dumps(HITS, indent=2),
    }
    (tmp_path / "a.json").write_text(texts[layout])
    (tmp_path / "empty.json").write_text("")
    rows = feed.read_envelope(spark, str(tmp_path), multi_line=layout == "array over lines").orderBy("complaint_id")
    first, second = rows.collect()
    assert (first.complaint_id, first.issue, first.date_received.isoformat()) == ("1", "Loan", "2019-09-24T17:00:00")
    assert (second.zip_code, second.date_received) == ("12345", None)


def test_broken_json_is_not_lost_silently(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"_source": {"complaint_id": "1"}}\n{"_source": {"compl')
    with pytest.raises(Exception, match="MALFORMED"):
        feed.read_envelope(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("rebalance", [False, True])
def test_landing_appends_and_prunes(spark, tmp_path, rebalance):
    records = cases(spark, SF)
    feed.write_envelope(records, str(tmp_path / "feed"))
    landed = feed.read_envelope(spark, str(tmp_path / "feed"))
    for _ in range(2):
        feed.append_to_store(landed, str(tmp_path / "store"), rebalance)
    stored = feed.read_store(spark, str(tmp_path / "store"))
    assert stored.count() == 3000
    one = stored.select(CASE_COLUMNS).distinct()
    assert one.exceptAll(records).isEmpty() and records.exceptAll(one).isEmpty()
    late = feed.read_store(spark, str(tmp_path / "store"), from_year=1999)
    assert late.count() == stored.where(F.year("date_received") >= 1999).count()
    assert "PartitionFilters: [isnotnull(received_year" in late._jdf.queryExecution().executedPlan().toString()


def test_landing_an_empty_feed(spark, tmp_path):
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "a.json").write_text("[]")
    feed.append_to_store(cases(spark, SF).limit(3), str(tmp_path / "store"))
    assert feed.land_to_store(spark, str(tmp_path / "feed"), str(tmp_path / "store")).count() == 3


def slice_of(spark, feed_rows, store_rows, **options):
    def records(rows):
        texts = spark.createDataFrame(rows, "complaint_id string, d string")
        return texts.selectExpr("complaint_id", "cast(d as timestamp) date_received")

    result = increments.incremental_slice(records(feed_rows), records(store_rows), **options)
    assert result.columns == ["complaint_id", "date_received"]
    return sorted(r.complaint_id for r in result.collect())


def test_slice_keeps_one_copy_and_drops_replays(spark):
    second = "2020-01-02"
    feed_rows = [("1", "2020-01-01"), ("2", second), ("2", second), ("3", second), ("4", "2020-01-09")]
    store = [("1", "2020-01-01"), ("2", "2020-01-02")]
    assert slice_of(spark, feed_rows, store) == ["3", "4"]
    assert slice_of(spark, feed_rows, store, to_date="2020-01-09") == ["3"]


def test_loading_in_steps_equals_loading_at_once(spark, tmp_path):
    records = cases(spark, SF)
    feed_path, store = str(tmp_path / "feed"), str(tmp_path / "store")
    feed.write_envelope(records.union(records.where("year(date_received) = 1998")), feed_path)
    first = feed.load_increment(spark, feed_path, store, "1998-06-01", "1995-01-01")
    assert first.count() == records.where("date_received < '1998-06-01'").count()
    feed.load_increment(spark, feed_path, store, first_date="1995-01-01")
    assert feed.load_increment(spark, feed_path, store).isEmpty()
    stored = feed.read_store(spark, store).select(CASE_COLUMNS)
    assert stored.exceptAll(records).isEmpty() and records.exceptAll(stored).isEmpty()


def element(**fields):
    return json.dumps({"_source": fields})


def test_nothing_of_a_feed_is_lost(spark, tmp_path):
    """Good, late, undated, keyless, too early and broken records: loaded and rejected make the feed."""
    store = str(tmp_path / "store")
    first, second = tmp_path / "first", tmp_path / "second"
    for folder in (first, second):
        folder.mkdir()
    lines = [
        element(complaint_id="1", date_received="2020-01-01", tags=["a", "b"], sub_issue="s"),
        element(complaint_id="2", date_received="not yet"),
        element(complaint_id="3"),
        element(date_received="2020-01-01", issue="x"),
        element(complaint_id=" ", date_received="2020-01-01", issue="y"),
        element(complaint_id="4", date_received="2001-01-01"),
        '{"_source": {"complaint_id": "5", ',
        json.dumps({"sort": [1]}),
    ]
    (first / "a.json").write_text("\n".join(lines))
    (second / "a.json").write_text(element(complaint_id="6", date_received="2019-06-01"))
    for _ in range(2):
        feed.load_increment(spark, str(first), store)
    feed.load_increment(spark, str(second), store)
    stored = feed.read_store(spark, store).orderBy("complaint_id").collect()
    assert [row.complaint_id for row in stored] == ["1", "6"]
    others = stored[0].other_fields
    assert json.loads(others.pop("tags")) == ["a", "b"] and others == {"sub_issue": "s"}
    assert stored[1].other_fields == {}
    rejected = feed.read_rejected(spark, store).collect()
    assert sorted((row.reason, row.complaint_id) for row in rejected if row.complaint_id) == [
        ("before the first date", "4"),
        ("no date", "2"),
        ("no date", "3"),
        ("no key", " "),
    ]
    assert sorted(row.reason for row in rejected if not row.complaint_id) == ["broken", "no key"]
    assert any(row.record == lines[6] for row in rejected)
    assert len(stored) + len(rejected) == len(lines) - 1 + 1


def test_slices_keep_records_without_a_key_apart(spark):
    texts = spark.createDataFrame([(None, "a"), (None, "b"), ("1", "a"), ("1", "b")], "complaint_id string, issue string")
    rows = texts.selectExpr("*", "timestamp'2020-01-01' date_received")
    assert increments.newest_copies(rows).count() == 3


def test_a_load_keeps_the_newest_copy_of_new_keys_and_parses_once(spark, tmp_path, monkeypatch):
    """Copies of new keys are compared, keys of the store are dropped, and the feed's text is read by one job."""
    folder, store = tmp_path / "feed", str(tmp_path / "store")
    folder.mkdir()
    (folder / "a.json").write_text(element(complaint_id="1", date_received="2019-01-01", issue="old"))
    feed.load_increment(spark, str(folder), store)
    lines = [(1, "2021-01-01", "moved"), (2, "2020-01-01", "a"), (2, "2020-03-01", "c"), (2, "2020-03-01", "b"), (3, "2020-01-01", "d")]
    (folder / "b.json").write_text("\n".join(element(complaint_id=str(k), date_received=d, issue=i) for k, d, i in lines))
    read, plain = [], feed.read_elements
    monkeypatch.setattr(feed, "read_elements", lambda *args: read.append(plain(*args)) or read[-1])
    written = []
    monkeypatch.setattr(feed, "write_table", lambda df, name, plain=feed.write_table: written.append(name) or plain(df, name))
    new = feed.load_increment(spark, str(folder), store)
    assert sorted((r.complaint_id, r.issue) for r in new.collect()) == [("2", "c"), ("3", "d")]
    assert "FileScan json" not in new._jdf.queryExecution().executedPlan().toString()
    assert (len(read), written) == (1, ["parsed"])
    stored = feed.read_store(spark, store).collect()
    assert sorted((r.complaint_id, r.issue) for r in stored) == [("1", "old"), ("2", "c"), ("3", "d")]


def test_a_store_that_cannot_be_read_is_no_new_store(spark, tmp_path):
    (tmp_path / "store").mkdir()
    (tmp_path / "store" / "part-0.parquet").write_text("no parquet")
    assert feed.store_exists(spark, str(tmp_path / "store"))
    assert not feed.store_exists(spark, str(tmp_path / "none"))


def test_first_slice_starts_at_the_first_date(spark):
    assert slice_of(spark, [("0", "2011-12-31"), ("1", "2012-01-01")], []) == ["1"]


@pytest.mark.parametrize(
    ("start", "end", "unit", "windows"),
    [
        (date(2020, 1, 15), date(2020, 1, 15), None, 0),
        (date(2020, 1, 15), date(2020, 1, 20), None, 1),
        (date(2020, 1, 15), date(2020, 2, 1), "week", 3),
        (date(2020, 1, 15), date(2020, 3, 15), "month", 3),
        (date(2019, 6, 1), date(2021, 1, 1), "year", 2),
    ],
)
def test_windows_cover_the_span_once(spark, start, end, unit, windows):
    assert increments.window_unit(start, end) == unit
    plan = [(r.window_start.date(), r.window_end.date()) for r in increments.plan_windows(spark, start, end).collect()]
    assert len(plan) == windows
    if windows:
        assert plan[0][0] == start and plan[-1][1] == end
        assert all(a[1] == b[0] for a, b in zip(plan, plan[1:]))


def test_every_row_is_in_one_window_and_empty_windows_show(spark):
    rows = cases(spark, SF, ["date_received"]).where("year(date_received) <> 1997")
    coverage = increments.window_coverage(rows, date(1995, 1, 1), date(2001, 8, 2)).collect()
    assert sum(r.row_count for r in coverage) == rows.count()
    assert [r.row_count for r in coverage if r.window_start.year == 1997] == [0]
