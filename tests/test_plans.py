"""Plans read only what they need and do not depend on small inputs."""

import inspect
import os

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as contract
from casebook import workspace
from casebook.catalog.queries import REGISTERED
from casebook.functions import vectors
from casebook.functions.vectors import slots
from casebook.operators import frequency, text
from casebook.sources import feed
from casebook.sources.cases import cases

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def untruncated(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_needed_columns_and_tables_are_read(spark):
    text = plan(REGISTERED["mode_fit"](spark, SF))
    assert "lineitem.parquet" not in text and "part.parquet" not in text and "o_totalprice" not in text
    text = plan(cases(spark, SF, ["consumer_disputed"]))
    assert "lineitem.parquet" in text and "part.parquet" not in text and "supplier.parquet" not in text


def test_date_bounds_reach_the_scan(spark):
    text = plan(REGISTERED["window_coverage"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate,1995-01-01" in text and "LessThan(o_orderdate,2001-08-02" in text


def test_counts_are_combined_before_the_shuffle(spark):
    assert "partial_count" in plan(REGISTERED["frequency_table"](spark, SF))
    assert "partial_min" in plan(cases(spark, SF, ["consumer_disputed"]))


def test_words_are_split_once(spark):
    text = plan(REGISTERED["tfidf_terms"](spark, SF))
    assert text.count("UDF(") == 1


def test_undersampling_filters_records_without_a_window(spark):
    text = plan(REGISTERED["balance_undersample"](spark, SF))
    assert "Window" not in text and "BroadcastHashJoin" in text


def test_a_hot_customer_is_split(spark, tmp_path):
    """A third of the orders has one customer and no table is small enough to broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    for name in ("customer", "nation"):
        spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    hot = orders.selectExpr("* except (o_custkey)", "if(o_orderkey % 3 = 0, 7, o_custkey) o_custkey")
    hot.repartition(8).write.parquet(f"{tmp_path}/orders.parquet")
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = cases(spark, str(tmp_path), ["complaint_id", "state"])
        held = rows.collect()
        text = plan(rows)
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert len(held) == orders.count()
    assert "skew=true" in text


def test_entry_is_registered():
    assert REGISTERED.keys() <= contract.queries().keys()


def test_loading_reads_the_years_it_touches(spark, tmp_path):
    """The join against the store is pruned, and ten loads leave few files for a year."""
    store = str(tmp_path / "store")
    records = cases(spark, SF)
    for k in range(10):
        feed.write_envelope(records.where(F.col("complaint_id").cast("long") % 10 == k), str(tmp_path / f"feed{k}"))
        feed.load_increment(spark, str(tmp_path / f"feed{k}"), store, first_date="1995-01-01")
    years = list((tmp_path / "store").glob("received_year=*"))
    assert len(years) > 3 and max(len(list(year.glob("*.parquet"))) for year in years) <= 20
    feed.write_envelope(records.where("year(date_received) = 1997"), str(tmp_path / "again"))
    new = feed.load_increment(spark, str(tmp_path / "again"), store, first_date="1995-01-01")
    shown = plan(new)
    assert "received_year" in shown.split("PartitionFilters")[1] and "1997" in shown and new.isEmpty()


def test_a_run_cleans_up(spark):
    workspace.write_table(spark.range(3), "short-lived")
    folder = workspace.run_folder(spark).removeprefix("file:")
    assert any(name.startswith("short-lived") for name in os.listdir(folder))
    workspace.clear(spark)
    assert not os.path.exists(folder)


def test_a_word_of_every_long_document_is_dealt(spark):
    """Each document holds 300 words, one of them in all documents: 1 in 300 pairs."""
    docs = spark.range(400).selectExpr("id", "concat('all ', array_join(transform(sequence(1, 299), k -> concat('w', id * 300 + k)), ' ')) t")
    vocabulary = workspace.write_table(text.document_frequencies(docs, "t"), "vocabulary")
    assert frequency.hot_values(vocabulary) == {}
    assert frequency.hot_values(vocabulary, rows_per_task=100) == {"all": 4}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        weights = text.tfidf_terms(docs, "id", "t", rows_per_task=100)
        found = weights.where("term = 'all'")
        assert found.count() == 400 and {row.df for row in found.select("df").distinct().collect()} == {400}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_wide_sparse_vector_stays_sparse(spark):
    rows = [(1, Vectors.sparse(300_000, [7, 299_999], [1.5, 2.0])), (2, Vectors.dense([0.0, 3.0])), (3, Vectors.sparse(5, [], []))]
    df = spark.createDataFrame(rows, ["id", "v"])
    found = slots(df, ["id"], "v")
    assert sorted(map(tuple, found.collect())) == [(1, 7, 1.5), (1, 299_999, 2.0), (2, 1, 3.0)]
    assert "vector_to_array" not in inspect.getsource(vectors)


def test_ranks_do_not_pass_the_driver_and_equal_a_window(spark):
    df = spark.range(5000).selectExpr("id", "concat('v', pmod(hash(id), 700)) c", "if(id % 7 = 0, null, id % 3) d")
    found = frequency.index_categories(df, "id", ["c", "d"])
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    counts = frequency.frequency_table(df, ["c", "d"]).where("value is not null")
    place = Window.partitionBy("column_name").orderBy(F.desc("frequency"), "value")
    ranks = {(r.column_name, r.value): r.place - 1 for r in counts.withColumn("place", F.row_number().over(place)).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    values = {r.id: r for r in df.collect()}
    for row in found.collect():
        value = values[row.id][row.column_name]
        assert row.category_index == (3 if value is None else ranks[row.column_name, str(value)])


def test_inputs_are_scored_from_the_written_cases(spark, monkeypatch):
    """The case view is joined once, for training: each further time sends its lookup tables through the driver."""
    from casebook.catalog import queries

    queries._trained(spark, SF)

    def joined_again(*_):
        raise AssertionError("cases were joined again")

    monkeypatch.setattr(queries, "cases", joined_again)
    assert REGISTERED["scored_archive"](spark, SF).count() + REGISTERED["diverted_input"](spark, SF).count() == 1500
