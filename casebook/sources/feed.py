"""Raw feeds of case records and the Parquet feature store they are landed in."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.operators.increments import unseen_records
from casebook.operators.key_filters import KeyFilters
from casebook.schema import FIRST_DATE, KEY, RECEIVED, RECORD_SCHEMA
from casebook.workspace import write_table

PAYLOAD = "_source"
BROKEN = "_broken"
STORE_YEAR = "received_year"
OTHER = "other_fields"
_REASON, _RECORD = "_reason", "_record"

# Feeds carry everything as text, so a bad date becomes NULL, and undeclared fields are kept by name.
_ENVELOPE = T.StructType(
    [T.StructField(PAYLOAD, T.MapType(T.StringType(), T.StringType())), T.StructField(BROKEN, T.StringType())]
)
STORE_SCHEMA = T.StructType([*RECORD_SCHEMA, T.StructField(OTHER, T.MapType(T.StringType(), T.StringType()))])


def read_elements(spark: SparkSession, path: str, multi_line: bool = False, mode: str = "PERMISSIVE") -> DataFrame:
    """Feed elements: the fields of each one's record, or the text of what is no JSON.

    Every line is an element or an array of elements, so a large file is split among tasks.
    ``multi_line`` reads files that spread one array over many lines, one file per task.
    """
    reader = spark.read.schema(_ENVELOPE).option("columnNameOfCorruptRecord", BROKEN)
    return reader.option("multiLine", multi_line).option("mode", mode).json(path)


def records_of(elements: DataFrame) -> list[Column]:
    """The declared columns and the other fields of an element's record."""
    declared = [field.name for field in RECORD_SCHEMA]
    values = {name: F.col(PAYLOAD)[name] for name in declared}
    for field in RECORD_SCHEMA:
        if isinstance(field.dataType, T.TimestampType):
            values[field.name] = values[field.name].try_cast("timestamp")
    others = F.map_filter(PAYLOAD, lambda name, _: ~name.isin(*declared))
    return [*[value.alias(name) for name, value in values.items()], others.alias(OTHER)]


def read_envelope(
    spark: SparkSession, path: str, multi_line: bool = False, mode: str = "FAILFAST"
) -> DataFrame:
    """Records inside the ``_source`` of feed elements; elements without one are left out.

    Fields that the record type does not declare are kept as text in ``other_fields``.
    """
    elements = read_elements(spark, path, multi_line, mode).where(F.col(PAYLOAD).isNotNull())
    return elements.select(*records_of(elements))


def rejection(first_date: str = FIRST_DATE) -> Column:
    """Why a record cannot be loaded, NULL if it can: it is broken, or lacks a key or a usable date."""
    received = F.col(PAYLOAD)[RECEIVED].try_cast("timestamp")
    key = F.col(PAYLOAD)[KEY]
    return (
        F.when(F.col(BROKEN).isNotNull(), "broken")
        .when(key.isNull() | (F.trim(key) == ""), "no key")
        .when(received.isNull(), "no date")
        .when(received < F.lit(first_date).cast("timestamp"), "before the first date")
    )


def write_envelope(records: DataFrame, path: str) -> None:
    """Write records as feed elements, one per line; NULL fields are left out."""
    texts = [F.col(name).cast("string").alias(name) for name in records.columns]
    records.select(F.struct(*texts).alias(PAYLOAD)).write.mode("append").json(path)


def append_to_store(records: DataFrame, path: str, rebalance: bool = False) -> None:
    """Append to the store, partitioned by year of receipt.

    Feed files hold one download window each, so a task meets a year or two and needs no shuffle.
    For records that were shuffled before, ``rebalance`` gathers them by year into files of even
    size: AQE splits a year that holds a third of the rows among tasks and merges small ones. Where the
    store has key filters the keys are entered first, so that a failure in between leaves none out.
    """
    filters = key_filters(records.sparkSession, path)
    if filters.exists():
        filters.add(records)
    yearly = records.withColumn(STORE_YEAR, F.year(RECEIVED))
    if rebalance:
        yearly = yearly.hint("rebalance", STORE_YEAR)
    yearly.write.mode("append").partitionBy(STORE_YEAR).parquet(path)


def read_store(
    spark: SparkSession,
    path: str,
    from_year: int | None = None,
    to_year: int | None = None,
    years: list[int | None] | None = None,
) -> DataFrame:
    """The store's records; the years bound the partitions that are read (None among ``years``: those without a date)."""
    schema = T.StructType([*STORE_SCHEMA, T.StructField(STORE_YEAR, T.IntegerType())])
    stored = spark.read.schema(schema).parquet(path)
    if from_year is not None:
        stored = stored.where(F.col(STORE_YEAR) >= from_year)
    if to_year is not None:
        stored = stored.where(F.col(STORE_YEAR) <= to_year)
    if years is not None:
        wanted = F.col(STORE_YEAR).isin([year for year in years if year is not None])
        stored = stored.where(wanted | F.col(STORE_YEAR).isNull() if None in years else wanted)
    return stored.drop(STORE_YEAR)


def key_filters(spark: SparkSession, store_path: str) -> KeyFilters:
    return KeyFilters(spark, f"{store_path.rstrip('/')}-keys")


def indexed_filters(spark: SparkSession, store_path: str) -> KeyFilters:
    """The store's key filters; a store that was landed without them is indexed first, a new one from its first rows on."""
    filters = key_filters(spark, store_path)
    if not filters.exists():
        known = read_store(spark, store_path) if store_exists(spark, store_path) else spark.createDataFrame([], STORE_SCHEMA)
        filters.add(known)
    return filters


def store_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema(STORE_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def load_increment(
    spark: SparkSession,
    feed_path: str,
    store_path: str,
    to_date: str | None = None,
    first_date: str = FIRST_DATE,
) -> DataFrame:
    """Append the feed's records that the store lacks, each once; returns what was appended.

    A record that arrives late is loaded like any other, and one that the store has under another year
    of receipt is a replay; see ``key_filters``. What cannot be loaded goes to the rejected
    table with its reason; loading a feed again replaces what it had rejected. Records received
    from ``to_date`` on wait for a later run.
    """
    elements = read_elements(spark, feed_path).withColumn(_REASON, rejection(first_date))
    elements = elements.where(F.col(PAYLOAD).isNotNull() | F.col(BROKEN).isNotNull())
    record = F.when(F.col(_REASON).isNotNull(), F.coalesce(BROKEN, F.to_json(PAYLOAD))).alias(_RECORD)
    # texts are parsed once, for both tables
    parsed = write_table(elements.select(_REASON, record, *records_of(elements)), "parsed")
    rejected = parsed.where(F.col(_REASON).isNotNull()).select(
        F.col(_REASON).alias("reason"),
        F.col(_RECORD).alias("record"),
        F.when(F.col(_REASON) != "broken", F.col(KEY)).alias(KEY),
    )
    feed = hashlib.sha256(feed_path.rstrip("/").encode()).hexdigest()
    rejected.write.mode("overwrite").parquet(f"{rejected_path(store_path)}/feed={feed}")
    usable = parsed.where(F.col(_REASON).isNull()).drop(_REASON, _RECORD)
    if to_date is not None:
        usable = usable.where(F.col(RECEIVED) < F.lit(to_date).cast("timestamp"))

    filters = indexed_filters(spark, store_path)

    def read_years(years: list[int | None]) -> DataFrame:
        # a first append that failed has left its keys in the filters and no store
        return read_store(spark, store_path, years=years) if store_exists(spark, store_path) else usable.limit(0)

    new = unseen_records(usable, read_years, filters)
    append_to_store(new, store_path, rebalance=True)
    return new


def rejected_path(store_path: str) -> str:
    return f"{store_path.rstrip('/')}-rejected"


def read_rejected(spark: SparkSession, store_path: str) -> DataFrame:
    """reason, record (as text) and key of everything that the feeds of a store could not load."""
    schema = f"reason string, record string, {KEY} string, feed string"
    return spark.read.schema(schema).parquet(rejected_path(store_path)).drop("feed")


def land_to_store(spark: SparkSession, feed_path: str, store_path: str, multi_line: bool = False) -> DataFrame:
    """Read all feed files of a folder in one job, append their records, return the whole store."""
    append_to_store(read_envelope(spark, feed_path, multi_line), store_path)
    return read_store(spark, store_path)
