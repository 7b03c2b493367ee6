"""Bloom filters of a store's keys by year: which years may hold a key, without reading them.

A filter is a table of bitmaps. A key's hash picks one bitmap, and ``HASHES`` further hashes pick its
bits there. Bitmaps of one year and size are merged by an aggregation, so every append adds a few rows
and changes none. A size (generation) takes ``CAPACITY`` keys of a year and has four times as many
bitmaps as the one before; what would overfill a year's generation goes to the next that takes it whole. A key that a year
holds is always found. One that it lacks is found with about 14 in a million, for which the store's own
rows decide.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.schema import KEY, RECEIVED
from casebook.workspace import write_table

#: Bits of a bitmap, as Spark's bitmap aggregates make them.
BITS = 32_768
#: Bits that each key sets, and bits there are for each key when a generation is full.
HASHES = 12
BITS_PER_KEY = 24
#: Bitmaps of the first generation.
BITMAPS = 64
CAPACITY = BITMAPS * BITS // BITS_PER_KEY

YEAR = "filter_year"
FILTERS = f"{YEAR} int, generation int, bitmap int, bits binary, n_keys long"


def bitmaps_in(generation: Column) -> Column:
    return F.lit(BITMAPS) * F.pow(F.lit(4), generation).cast("long")


def bitmap_of(key: Column, generation: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("bitmap"), key), bitmaps_in(generation)).cast("int")


def position(key: Column, number: Column) -> Column:
    """One of the key's bits in its bitmap."""
    return F.pmod(F.xxhash64(number, key), F.lit(BITS)).cast("int")


def positions(key: Column) -> Column:
    """The key's bits in its bitmap."""
    return F.transform(F.sequence(F.lit(1), F.lit(HASHES)), lambda number: position(key, number))


def words_of(bits: Column) -> Column:
    """A bitmap as numbers of 64 bits, of which a test reads those that it needs."""
    places = F.sequence(F.lit(1), F.lit(BITS // 8), F.lit(8))
    return F.transform(places, lambda place: F.conv(F.hex(F.substring(bits, place, F.lit(8))), 16, -10).cast("long"))


def has_bits(words: Column, key: Column) -> Column:
    """Whether all of a key's bits are set in a bitmap's words; the first that is not decides."""

    def is_set(number: Column) -> Column:
        place = position(key, number)
        # the first byte is the highest of its word, the first bit the lowest of its byte
        shift = (F.lit(7) - F.shiftright(place, 3) % 8) * 8 + place % 8
        return F.call_function("shiftright", F.get(words, F.shiftright(place, 6)), shift) % 2 != 0

    return F.forall(F.sequence(F.lit(1), F.lit(HASHES)), is_set)


def filter_rows(records: DataFrame, generations: DataFrame, key: str = KEY, received: str = RECEIVED) -> DataFrame:
    """The filter of some records: bitmaps by year, in the generation that the year has come to.

    generations: one row for each year, ``filter_year`` and ``generation``; the first for other years.
    Keys move to the place of their bitmap, each once, and not bitmaps to one another.
    """
    keyed = _keys_by_year(records, key, received).distinct()
    keyed = keyed.join(generations, keyed[YEAR].eqNullSafe(generations[YEAR]), "left").select(
        keyed[YEAR], "key", F.coalesce("generation", F.lit(0)).alias("generation")
    )
    bitmap = bitmap_of(F.col("key"), F.col("generation")).alias("bitmap")
    keyed = keyed.select(YEAR, "generation", bitmap, "key").repartition(YEAR, "generation", "bitmap")
    placed = keyed.select(YEAR, "generation", "bitmap", F.posexplode(positions(F.col("key"))))
    return placed.groupBy(YEAR, "generation", "bitmap").agg(
        F.bitmap_construct_agg(F.col("col").cast("long")).alias("bits"), F.count_if(F.col("pos") == 0).alias("n_keys")
    )


def _keys_by_year(records: DataFrame, key: str, received: str) -> DataFrame:
    return records.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.year(received).alias(YEAR))


class KeyFilters:
    """The filters of one store, in a folder beside it. Rows without a date are under a null year."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def exists(self) -> bool:
        try:
            self.spark.read.schema(FILTERS).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return False
        return True

    def rows(self) -> DataFrame:
        if not self.exists():
            return self.spark.createDataFrame([], FILTERS)
        return self.spark.read.schema(FILTERS).parquet(self.path)

    def generations(self, capacity: int = CAPACITY) -> DataFrame:
        """The generation that keys of each year go to now: the last one, or the next if that is full."""
        held = self.rows().groupBy(YEAR, "generation").agg(F.sum("n_keys").alias("n"))
        newest = held.groupBy(YEAR).agg(F.max(F.struct("generation", "n")).alias("last"))
        full = F.col("last.n") >= capacity * F.pow(F.lit(4), F.col("last.generation"))
        return newest.select(YEAR, (F.col("last.generation") + full.cast("int")).alias("generation"))

    def with_room(self, generations: DataFrame, added: DataFrame) -> DataFrame:
        """The generations, or later ones where these have no room for ``n_added`` keys of a year at once."""
        held = self.rows().groupBy(F.col(YEAR).alias("_held"), F.col("generation").alias("_of")).agg(F.sum("n_keys").alias("_n"))
        own = generations.select(F.col(YEAR).alias("_year"), F.col("generation").alias("_now"))
        now, n = F.coalesce("_now", F.lit(0)), F.coalesce("_n", F.lit(0))
        both = added.join(own, F.col(YEAR).eqNullSafe(F.col("_year")), "left")
        both = both.join(held, F.col(YEAR).eqNullSafe(F.col("_held")) & (now == F.col("_of")), "left")
        fits = n + F.col("n_added") <= CAPACITY * F.pow(F.lit(4), now)
        large = F.ceil(F.log2(F.col("n_added") / CAPACITY) / 2).cast("int")
        later = F.greatest(large, now + (n > 0).cast("int"))
        return both.select(YEAR, F.when(fits, now).otherwise(later).alias("generation"))

    def add(self, records: DataFrame, key: str = KEY, received: str = RECEIVED) -> None:
        """Enter the records' keys. Done before the records are appended, so a failure between leaves no key out."""
        added = _keys_by_year(records, key, received).groupBy(YEAR).agg(F.count(F.lit(1)).alias("n_added"))
        generations = write_table(self.with_room(self.generations(), added), "generations")  # a row for each year
        filter_rows(records, generations, key, received).write.mode("append").parquet(self.path)

    def possible_years(self, keys: DataFrame, key: str = KEY) -> DataFrame:
        """key and filter_year: the years that may hold each key. Each bitmap that keys fall in is tested once."""
        merged = self.rows().groupBy(YEAR, "generation", "bitmap").agg(F.bitmap_or_agg("bits").alias("bits"))
        merged = write_table(merged.select(YEAR, "generation", "bitmap", words_of(F.col("bits")).alias("words")), "bitmaps")
        asked = keys.where(F.col(key).isNotNull()).select(F.col(key).alias("key")).distinct()
        # one generation for each factor of four that the largest year has grown by
        used = [row.generation for row in merged.select("generation").distinct().collect()]
        asked = asked.withColumn("generation", F.explode(F.array(*map(F.lit, used)).cast("array<int>")))
        asked = asked.withColumn("bitmap", bitmap_of(F.col("key"), F.col("generation")))
        hits = asked.join(merged, ["generation", "bitmap"]).where(has_bits(F.col("words"), F.col("key")))
        return hits.select(F.col("key").alias(key), YEAR).distinct()
