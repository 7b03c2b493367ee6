"""Reproducible split, class balance and undersampling, all decided by a digest of the record key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casebook.functions.columns import key_digest, key_share
from casebook.schema import KEY, TARGET, TEST_SHARE
from casebook.workspace import write_table

# Hex digits of the digest that name a sampling bucket: 16 ** 4 buckets.
_BUCKET_DIGITS = 4


def train_test_split(df: DataFrame, test_share: float = TEST_SHARE, key: str = KEY) -> DataFrame:
    """Add ``split``: 'train' or 'test'. Row-local, so the split is the same on every run and cluster."""
    train_percent = round((1 - test_share) * 100)
    return df.withColumn("split", F.when(key_share(key) < train_percent, "train").otherwise("test"))


def split_frames(df: DataFrame, test_share: float = TEST_SHARE, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    tagged = train_test_split(df, test_share, key)
    return tuple(tagged.where(F.col("split") == side).drop("split") for side in ("train", "test"))


def class_balance(df: DataFrame, label: str = TARGET) -> DataFrame:
    """Rows per class (NULL is a class) and its share of all rows."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("class_count"))
    total = counts.agg(F.sum("class_count")).scalar()
    return counts.withColumn("share", F.col("class_count") / total)


def sampling_fractions(df: DataFrame, label: str = TARGET) -> DataFrame:
    """Share of each class to keep so that all classes come out as large as the smallest one."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("class_count"))
    smallest = counts.agg(F.min("class_count")).scalar()
    return counts.withColumn("fraction", smallest / F.col("class_count"))


def undersample_cutoffs(df: DataFrame, label: str = TARGET, key: str = KEY) -> DataFrame:
    """Per class, the digest and key of the last record to keep.

    Ranking a class in one window would put the whole class in one task. Instead: count records
    per class and digest bucket (combined map-side), find the bucket in which each class reaches
    the size of the smallest class, and walk only through the keys of that bucket, counted first
    so that copies of a key weigh as one row.
    """
    records = df.where(F.col(label).isNotNull()).select(
        F.col(label).alias("class"), F.col(key).alias("key"), key_digest(key).alias("digest")
    )
    records = records.withColumn("bucket", F.substring("digest", 1, _BUCKET_DIGITS))
    buckets = records.groupBy("class", "bucket").agg(F.count(F.lit(1)).alias("held"))
    sizes = buckets.groupBy("class").agg(F.sum("held").alias("size"))
    smallest = sizes.agg(F.min("size")).scalar()
    so_far = F.sum("held").over(Window.partitionBy("class").orderBy("bucket"))
    last_buckets = (
        buckets.withColumn("before", so_far - F.col("held"))
        .withColumn("quota", smallest - F.col("before"))
        .where((F.col("quota") > 0) & (F.col("quota") <= F.col("held")))
        .select("class", "bucket", "quota")
    )
    last_buckets = write_table(last_buckets, "undersample-buckets")
    keys = (
        records.join(last_buckets, ["class", "bucket"])
        .groupBy("class", "quota", "digest", "key")
        .agg(F.count(F.lit(1)).alias("held"))
    )
    so_far = F.sum("held").over(Window.partitionBy("class").orderBy("digest", "key"))
    return (
        keys.withColumn("so_far", so_far)
        .where((F.col("so_far") >= F.col("quota")) & (F.col("so_far") - F.col("held") < F.col("quota")))
        .select("class", F.col("digest").alias("last_digest"), F.col("key").alias("last_key"))
    )


def balance_undersample(df: DataFrame, label: str = TARGET, key: str = KEY) -> DataFrame:
    """As many records of every class as the smallest class has; NULL labels are left out.

    The count is exact when ``key`` is unique; copies of the last key are kept together.

    The cutoffs are a written table with one row per class, so the big side is filtered where it
    lies: Catalyst sees the table's size and broadcasts it without a hint.
    """
    cutoffs = write_table(undersample_cutoffs(df, label, key), "undersample-cutoffs")
    position = F.struct(key_digest(key), F.col(key))
    last = F.struct("last_digest", "last_key")
    return df.join(cutoffs, (F.col(label) == F.col("class")) & (position <= last)).select(*df.columns)


def undersample_about(df: DataFrame, label: str = TARGET, seed: int = 42) -> DataFrame:
    """Bernoulli undersampling: about as many records per class as the smallest class has, in one pass."""
    rows = sampling_fractions(df, label).collect()
    return df.sampleBy(label, {row[label]: row.fraction for row in rows}, seed)


def shuffle_rows(df: DataFrame, key: str = KEY) -> DataFrame:
    """Global order by digest of the key: looks random, comes out the same every time."""
    return df.withColumn("shuffle_key", key_digest(key)).orderBy("shuffle_key", key)


def balanced_shuffled(df: DataFrame, label: str = TARGET, key: str = KEY) -> DataFrame:
    return shuffle_rows(balance_undersample(df, label, key), key).drop("shuffle_key")
