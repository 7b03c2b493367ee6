"""Data-quality operators: missing values, unwanted columns, quarantine, column contracts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.functions.columns import value_text
from casebook.schema import KEY, MISSING_THRESHOLD, QUARANTINE_REASON, UNWANTED_COLUMNS


class ContractError(ValueError):
    """A required column is absent."""


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _percentage() -> Column:
    return F.try_divide(F.col("missing_row") * F.lit(100.0), F.col("total_row"))


def missing_report(df: DataFrame) -> DataFrame:
    """Per column: rows, NULL rows and their percentage (NULL when there are no rows).

    One aggregate over one scan, then one output row per column.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count(_named(name)).alias(f"filled_{i}") for i, name in enumerate(df.columns)],
    )
    lines = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col("total").alias("total_row"),
            (F.col("total") - F.col(f"filled_{i}")).alias("missing_row"),
        )
        for i, name in enumerate(df.columns)
    ]
    return counts.select(F.inline(F.array(*lines))).withColumn("missing_percentage", _percentage())


def high_missing_columns(df: DataFrame, threshold: float = MISSING_THRESHOLD) -> DataFrame:
    """Columns whose share of NULLs is strictly above the threshold."""
    return missing_report(df).where(F.col("missing_percentage") > threshold * 100)


def columns_to_drop(
    df: DataFrame, unwanted: Sequence[str] = UNWANTED_COLUMNS, threshold: float = MISSING_THRESHOLD
) -> DataFrame:
    """Names of the always unwanted columns and of the columns with too many NULLs, once each."""
    high = high_missing_columns(df, threshold).select("column_name")
    if not unwanted:
        return high
    fixed = high.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, unwanted))))
    return high.union(fixed).distinct()


def rejected_columns(
    df: DataFrame,
    unwanted: Sequence[str] = UNWANTED_COLUMNS,
    threshold: float = MISSING_THRESHOLD,
    keep: Iterable[str] = (KEY,),
) -> list[str]:
    """The columns of ``df`` to reject, in column order. Runs one aggregate; brings back names only."""
    names = {row.column_name for row in columns_to_drop(df, unwanted, threshold).collect()}
    return [name for name in df.columns if name in names and name not in set(keep)]


def quarantine_columns(
    df: DataFrame, rejected: Sequence[str], key: str = KEY, reason: str = QUARANTINE_REASON
) -> DataFrame:
    """One row per record and rejected column, so the store keeps one schema whatever is rejected."""
    if not rejected:
        text = F.lit(None).cast("string")
        empty = [text.alias("column_name"), text.alias("value"), text.alias("error_msg")]
        return df.select(_named(key).cast("string").alias(key), *empty).limit(0)
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("column_name"), _named(name).cast("string").alias("value"))
            for name in rejected
        ]
    )
    return df.select(_named(key).cast("string").alias(key), F.inline(cells)).withColumn("error_msg", F.lit(reason))


def accepted_rows(df: DataFrame, rejected: Sequence[str]) -> DataFrame:
    return df.drop(*rejected)


def require_columns(df: DataFrame, required: Sequence[str], rejected: Sequence[str] = ()) -> DataFrame:
    """Return ``df``, or raise when a required column is absent. Looks at the schema only.

    ``rejected`` names columns dropped before, so that the error tells why they are absent.
    """
    found = [name for name in df.columns if name in set(required)]
    absent = [name for name in required if name not in set(found)]
    if absent:
        dropped = [name for name in absent if name in set(rejected)]
        cause = f"; dropped for too many missing values: {dropped}" if dropped else ""
        raise ContractError(f"required columns missing: {absent}{cause}; expected {list(required)}, found {found}")
    return df


def contract_report(
    df: DataFrame, required: Sequence[str], threshold: float = MISSING_THRESHOLD
) -> DataFrame:
    """Per required column: is it there, how many values are NULL, is that within the threshold.

    A column beyond the threshold is dropped before training, so this names the cause of a
    contract failure that would otherwise look like an absent column.
    """
    present = [name for name in required if name in df.columns]
    absent = [name for name in required if name not in df.columns]
    gaps = df.sparkSession.range(1).select(
        F.explode(F.array(*map(F.lit, absent)).cast("array<string>")).alias("column_name"),
        F.lit(False).alias("present"),
        F.lit(None).cast("long").alias("missing_row"),
        F.lit(False).alias("within_threshold"),
    )
    if not present:
        return gaps
    held = missing_report(df.select(*[_named(name) for name in present])).select(
        "column_name",
        F.lit(True).alias("present"),
        "missing_row",
        F.coalesce(F.col("missing_percentage") <= threshold * 100, F.lit(True)).alias("within_threshold"),
    )
    return held.unionByName(gaps) if absent else held


# Values longer than a digest are counted by digest, which bounds the width of what is shuffled. A
# mark in front keeps a digest apart from a value that happens to be its text.
_DIGEST_LENGTH = 64


def _as_text(name: str, kind: str) -> Column:
    """Equal values give equal texts, different values different ones."""
    text = value_text(_named(name), kind)
    digest = F.concat(F.lit("#"), F.sha2(text, 256))
    return F.when(F.length(text) > _DIGEST_LENGTH, digest).otherwise(F.concat(F.lit("="), text))


def column_profile(df: DataFrame, approximate: bool = False, error: float = 0.02) -> DataFrame:
    """Distinct values (NULL counts as one), NULL rows and their percentage, per column.

    The exact form counts the rows of every value of every column in one aggregate, so it shuffles
    the distinct values of each task; ``approximate`` shuffles HyperLogLog sketches only.
    """
    names = df.columns
    texts = df.select(*[_as_text(name, kind).alias(f"c{i}") for i, (name, kind) in enumerate(df.dtypes)])
    if approximate:
        sketches = [F.approx_count_distinct(f"c{i}", error).alias(f"distinct_{i}") for i in range(len(names))]
        filled = [F.count(f"c{i}").alias(f"filled_{i}") for i in range(len(names))]
        counts = texts.agg(F.count(F.lit(1)).alias("total_row"), *sketches, *filled)
        lines = [
            F.struct(
                F.lit(name).alias("column_name"),
                F.col(f"distinct_{i}").alias("seen"),
                (F.col("total_row") - F.col(f"filled_{i}")).alias("missing_row"),
            )
            for i, name in enumerate(names)
        ]
        profile = counts.select("total_row", F.inline(F.array(*lines)))
        seen = F.col("seen") + F.when(F.col("missing_row") > 0, 1).otherwise(0)
    else:
        cells = [F.struct(F.lit(n).alias("column_name"), F.col(f"c{i}").alias("value")) for i, n in enumerate(names)]
        values = texts.select(F.inline(F.array(*cells))).groupBy("column_name", "value")
        counted = values.agg(F.count(F.lit(1)).alias("held"))
        # A table without rows still has a line per column.
        lines = df.sparkSession.range(1).select(
            F.explode(F.array(*map(F.lit, names))), F.lit(None).cast("string"), F.lit(0).cast("long")
        )
        profile = counted.union(lines).groupBy("column_name").agg(
            F.sum("held").alias("total_row"),
            F.count_if(F.col("held") > 0).alias("seen"),
            F.sum(F.when(F.col("value").isNull(), F.col("held")).otherwise(0)).alias("missing_row"),
        )
        seen = F.col("seen")
    return profile.select("column_name", "total_row", seen.alias("distinct_values"), "missing_row").withColumn(
        "missing_percentage", _percentage()
    )
