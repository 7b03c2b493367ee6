import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from casebook.operators import sampling


@pytest.fixture(scope="module")
def records(spark):
    rows = spark.range(20_000).selectExpr(
        "cast(id as string) complaint_id",
        "case when id % 3 = 0 then 'big' when id % 11 = 0 then 'small' when id % 50 = 1 then null else 'mid' end"
        " consumer_disputed",
    )
    return rows.persist()


def test_split_is_a_partition(records):
    train, test = sampling.split_frames(records)
    assert train.count() + test.count() == records.count()
    assert train.join(test, "complaint_id").isEmpty()
    assert 0.68 < train.count() / records.count() < 0.72


def test_split_does_not_depend_on_partitioning(records):
    train, _ = sampling.split_frames(records)
    again, _ = sampling.split_frames(records.repartition(3))
    assert train.exceptAll(again).isEmpty() and again.exceptAll(train).isEmpty()


def test_undersample_equals_brute_force(records):
    labelled = records.where("consumer_disputed is not null")
    smallest = min(r["count"] for r in labelled.groupBy("consumer_disputed").count().collect())
    w = Window.partitionBy("consumer_disputed").orderBy(F.md5(F.col("complaint_id").cast("binary")), "complaint_id")
    brute = labelled.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= smallest).drop("rn")
    result = sampling.balance_undersample(records)
    assert result.exceptAll(brute).isEmpty() and brute.exceptAll(result).isEmpty()
    assert {r["count"] for r in result.groupBy("consumer_disputed").count().collect()} == {smallest}


def test_undersample_of_one_class_keeps_all(spark):
    df = spark.range(50).selectExpr("cast(id as string) complaint_id", "'Yes' consumer_disputed")
    assert sampling.balance_undersample(df).count() == 50


def test_copies_of_a_key_stay_together(spark):
    one = spark.range(100).selectExpr("cast(id as string) complaint_id", "if(id < 20, 'a', 'b') consumer_disputed")
    copies = spark.range(500).selectExpr("'50' complaint_id", "'b' consumer_disputed")
    counts = dict(sampling.balance_undersample(one.union(copies)).groupBy("consumer_disputed").count().collect())
    assert counts["a"] == 20 and (counts["b"] == 20 or counts["b"] > 500)


def test_undersample_with_numeric_labels(spark):
    df = spark.range(90).selectExpr("cast(id as string) complaint_id", "if(id < 30, 1, 0) consumer_disputed")
    counts = sampling.balance_undersample(df).groupBy("consumer_disputed").count().collect()
    assert {tuple(r) for r in counts} == {(0, 30), (1, 30)}


def test_undersample_about(records):
    counts = sampling.undersample_about(records).groupBy("consumer_disputed").count().collect()
    sizes = {r.consumer_disputed: r["count"] for r in counts}
    assert set(sizes) == {"big", "mid", "small"}
    assert max(sizes.values()) < 1.2 * min(sizes.values())


def test_balance_counts_null_as_a_class(records):
    rows = sampling.class_balance(records).collect()
    assert None in {r.consumer_disputed for r in rows}
    assert sum(r.share for r in rows) == pytest.approx(1)


def test_fractions(records):
    fractions = {r.consumer_disputed: r.fraction for r in sampling.sampling_fractions(records).collect()}
    assert max(fractions.values()) == fractions["small"] == 1.0 and None not in fractions


def test_shuffle_is_ordered_by_digest(records):
    keys = [r.shuffle_key for r in sampling.shuffle_rows(records).collect()]
    assert keys == sorted(keys) and len(keys) == 20_000
    balanced = sampling.balanced_shuffled(records)
    assert balanced.columns == records.columns
