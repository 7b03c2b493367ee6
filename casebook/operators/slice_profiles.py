"""Profiles of a store from what its slices left behind, without reading the store.

Every slice leaves additive counts (rows and missing values by column and level) and KLL sketches of its
numbers and times. Counts add up and sketches merge, so the profile of any part of the store, by any of
the levels, is an aggregation over a few rows for each slice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Size of a sketch: its quantiles are off by about 1.65 / K of the rows in rank, at 99 % certainty.
K = 400
RANK_ERROR = 1.65 / K * 2

SKETCHES = "column_name string, kind string, n long, sketch binary"


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def level_counts(records: DataFrame, levels: Mapping[str, Column], columns: Sequence[str]) -> DataFrame:
    """The levels' values, column_name, total_row and missing_row: one aggregate over one scan.

    The finest counts there are; ``quality_cube`` adds them up.
    """
    counted = records.groupBy(*[value.cast("string").alias(name) for name, value in levels.items()]).agg(
        F.count(F.lit(1)).alias("_total"), *[F.count(_named(name)).alias(f"_filled_{i}") for i, name in enumerate(columns)]
    )
    lines = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col("_total").alias("total_row"),
            (F.col("_total") - F.col(f"_filled_{i}")).alias("missing_row"),
        )
        for i, name in enumerate(columns)
    ]
    return counted.select(*levels, F.inline(F.array(*lines)))


def quality_cube(counts: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Missing values by column at every combination of the levels, those over all values of a level included.

    ``over`` names the levels that a row goes over, so a NULL there is told apart from a NULL value.
    """
    over = F.concat_ws(",", *[F.when(F.grouping(name) == 1, F.lit(name)) for name in levels])
    sums = [F.sum(name).alias(name) for name in ("total_row", "missing_row")]
    # a grouping set for each combination; the column is part of all of them
    sets = [[name for k, name in enumerate(levels) if not bits >> k & 1] for bits in range(1 << len(levels))]
    grouped = counts.groupingSets([[F.col("column_name"), *map(F.col, own)] for own in sets], "column_name", *levels)
    cube = grouped.agg(*sums, over.alias("over"))
    share = F.try_divide(F.col("missing_row") * F.lit(100.0), F.col("total_row"))
    return cube.select("column_name", *levels, "over", "total_row", "missing_row", share.alias("missing_percentage"))


def sketches(records: DataFrame, columns: Sequence[str], k: int = K) -> DataFrame:
    """column_name, kind, n and sketch of the numbers and times among the columns; times as microseconds.

    NULL and NaN are in no sketch; a column without values has none.
    """
    kinds = dict(records.dtypes)
    parts = []
    for i, name in enumerate(columns):
        value = _named(name)
        if kinds[name].startswith("timestamp") or kinds[name] == "date":
            value, kind = F.unix_micros(value.cast("timestamp")), "long"
        elif kinds[name] in ("tinyint", "smallint", "int", "bigint"):
            value, kind = value.cast("long"), "long"
        else:
            value, kind = F.when(~F.isnan(value.cast("double")), value.cast("double")), "double"
        agg = F.kll_sketch_agg_bigint if kind == "long" else F.kll_sketch_agg_double
        parts.append((name, kind, agg(value, k).alias(f"_sketch_{i}"), F.count(value).alias(f"_n_{i}")))
    row = records.agg(*[column for part in parts for column in part[2:]])
    lines = [
        F.struct(
            F.lit(name).alias("column_name"), F.lit(kind).alias("kind"), F.col(f"_n_{i}").alias("n"), F.col(f"_sketch_{i}").alias("sketch")
        )
        for i, (name, kind, *_) in enumerate(parts)
    ]
    return row.select(F.inline(F.array(*lines))).where("n > 0")


def quantiles(parts: DataFrame, shares: Sequence[float]) -> DataFrame:
    """column_name, n, share and value of the columns' quantiles, from sketches merged by an aggregation.

    Values are doubles, times in microseconds since 1970. Shares of 0 and 1 are the least and greatest value.
    """
    found = None
    for kind, merge, get in (
        ("long", F.kll_merge_agg_bigint, F.kll_sketch_get_quantile_bigint),
        ("double", F.kll_merge_agg_double, F.kll_sketch_get_quantile_double),
    ):
        merged = parts.where(F.col("kind") == kind).groupBy("column_name")
        merged = merged.agg(F.sum("n").alias("n"), merge("sketch").alias("sketch"))
        wanted = [
            F.struct(F.lit(float(share)).alias("share"), get("sketch", F.lit(float(share))).cast("double").alias("value"))
            for share in shares
        ]
        own = merged.select("column_name", "n", F.inline(F.array(*wanted)))
        found = own if found is None else found.unionByName(own)
    return found


class SliceProfiles:
    """Counts and sketches of a store's slices, in a folder beside it."""

    def __init__(self, spark: SparkSession, path: str, levels: Mapping[str, Column]):
        self.spark, self.path, self.levels = spark, path.rstrip("/"), dict(levels)

    def add(self, records: DataFrame, slice_name: str, columns: Sequence[str], measured: Sequence[str]) -> None:
        """Enter a slice. Entering it again replaces what it had left; other slices are not touched.

        columns: whose missing values are counted. measured: numbers and times that are sketched.
        """
        counts = level_counts(records, self.levels, columns)
        counts.write.mode("overwrite").parquet(f"{self.path}/counts/slice={slice_name}")
        sketches(records, measured).write.mode("overwrite").parquet(f"{self.path}/sketches/slice={slice_name}")

    def _rows(self, kind: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{kind}/*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def cube(self) -> DataFrame:
        names = ", ".join(f"`{name}` string" for name in self.levels)
        schema = f"{names}, column_name string, total_row long, missing_row long"
        return quality_cube(self._rows("counts", schema), list(self.levels))

    def quantiles(self, shares: Sequence[float]) -> DataFrame:
        return quantiles(self._rows("sketches", SKETCHES), shares)
