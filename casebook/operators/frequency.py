"""Value frequencies: tables of counts, most frequent values, and encoding values by their count."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.functions.columns import text_value, value_text
from casebook.workspace import write_table

# Rows of one value that a join task should get at most. A value with more is dealt over as many join
# keys as that takes. At most HOT_VALUES values are dealt: for larger tables the rows per task grow.
ROWS_PER_TASK = 1_000_000
HOT_VALUES = 4096


def frequency_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per column and value (NULL is a value), all columns in one aggregate.

    Timestamps are shown as microseconds since 1970, so instants stay apart in every time zone.
    """
    kinds = dict(df.dtypes)
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("column_name"), value_text(F.col(name), kinds[name]).alias("value"))
            for name in columns
        ]
    )
    values = df.select(F.inline(cells))
    return values.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("frequency"))


def mode_fit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent non-NULL value per column, the smallest one on ties.

    Values are counted before they are compared, so no task holds the distinct values of a column.
    """
    counted = frequency_table(df, columns).where(F.col("value").isNotNull())
    best_first = F.struct(-F.col("frequency"), F.col("value"))
    return counted.groupBy("column_name").agg(
        F.min_by("value", best_first).alias("mode_value"), F.max("frequency").alias("frequency")
    )


def fitted_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """One value per column, brought to the driver to become a fitted parameter."""
    modes = {row.column_name: row.mode_value for row in mode_fit(df, columns).collect()}
    empty = [name for name in columns if name not in modes]
    if empty:
        raise ValueError(f"no value to impute from: {empty} hold only NULL")
    return modes


def impute_modes(df: DataFrame, outputs: Mapping[str, str], modes: Mapping[str, str]) -> DataFrame:
    """Copy each input column to its output column and fill NULL with the fitted value."""
    kinds = dict(df.dtypes)
    fills = {name: text_value(F.lit(modes[name]), kinds[name]) for name in outputs}
    return df.withColumns({out: F.coalesce(F.col(name), fills[name]) for name, out in outputs.items()})


def _copies(counts: DataFrame, total: Column, frequency: str, rows_per_task: int) -> DataFrame:
    """Adds ``copies``, a power of two: the join keys that each value's rows are dealt over."""
    most = F.greatest(F.lit(rows_per_task), F.ceil(total / HOT_VALUES))
    doublings = F.greatest(F.ceil(F.log2(F.col(frequency) / most)), F.lit(0))
    return counts.withColumn("copies", F.pow(F.lit(2), doublings).cast("int"))


def hot_values(
    counts: DataFrame, value: str = "value", frequency: str = "frequency", rows_per_task: int = ROWS_PER_TASK
) -> dict[str, int]:
    """Values with more rows than a join task should get, and the join keys to deal them over."""
    hot = _copies(counts, counts.agg(F.sum(frequency)).scalar(), frequency, rows_per_task)
    rows = hot.where(F.col(value).isNotNull() & (F.col("copies") > 1)).select(value, "copies").collect()
    return {row[0]: row[1] for row in rows}


def attach_counts(
    df: DataFrame,
    counts: DataFrame,
    key: str,
    output: str,
    unseen: str = "drop",
    hot: Mapping[str, int] | None = None,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Look up ``key`` in ``counts(value, frequency)``, one row per value, and add it as ``output``.

    ``unseen="drop"`` leaves out rows whose key is NULL or has no count; ``"zero"`` keeps them
    with 0. Give ``counts`` as a written table: Catalyst then broadcasts it if its size allows and
    otherwise shuffles both sides. For that case every hot value has its copies in ``counts`` and
    its rows pick one by a digest of the row, so a retried task picks the same one.
    """
    if unseen not in ("drop", "zero"):
        raise ValueError("unseen must be 'drop' or 'zero'")
    table = counts.select(
        F.col("value").alias("_value"),
        F.col("frequency").alias("_frequency"),
    ).where(F.col("_value").isNotNull())
    kind = dict(df.dtypes)[key]
    keyed = df.withColumn("_key", value_text(F.col(key), kind))
    matches: Column = F.col("_key") == F.col("_value")
    if hot:

        def held(value: str) -> Column:
            copies = F.lit(1)
            for number in sorted(set(hot.values())):  # powers of two, so few
                alike = [name for name, own in hot.items() if own == number]
                copies = F.when(F.col(value).isin(*alike), number).otherwise(copies)
            return copies

        table = table.withColumn("_copy", F.explode(F.sequence(F.lit(0), held("_value") - 1)))
        pick = F.pmod(F.xxhash64(*(spread_by or df.columns)), held("_key")).cast("int")
        keyed = keyed.withColumn("_pick", pick)
        matches = matches & (F.col("_pick") == F.col("_copy"))
    joined = keyed.join(table, matches, "inner" if unseen == "drop" else "left")
    # a text is its own key, which then moves once
    kept = [F.col("_key").alias(name) if (name, kind) == (key, "string") else name for name in df.columns if name != output]
    return joined.select(*kept, F.coalesce("_frequency", F.lit(0)).alias(output))


def encode_frequencies(
    df: DataFrame,
    counts: DataFrame,
    outputs: Mapping[str, str],
    unseen: str = "drop",
    hot: Mapping[str, Mapping[str, int]] | None = None,
) -> DataFrame:
    """Encode several columns with a written ``frequency_table``."""
    for name, output in outputs.items():
        one = counts.where(F.col("column_name") == name)
        df = attach_counts(df, one, name, output, unseen, (hot or {}).get(name))
    return df


def hot_by_column(counts: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> dict[str, dict[str, int]]:
    """The hot values of every column of a ``frequency_table``, in two passes whatever the columns."""
    totals = counts.groupBy("column_name").agg(F.sum("frequency").alias("total")).collect()
    hot: dict[str, dict[str, int]] = {row.column_name: {} for row in totals}
    if hot:
        total = F.coalesce(*[F.when(F.col("column_name") == row.column_name, row.total) for row in totals])
        dealt = _copies(counts, total, "frequency", rows_per_task)
        for row in dealt.where(F.col("value").isNotNull() & (F.col("copies") > 1)).collect():
            hot[row.column_name][row.value] = row.copies
    return hot


def ranked_values(counts: DataFrame) -> DataFrame:
    """column_name, value, category_index (by falling frequency, ties by value) and size, the column's categories.

    The counted values of all columns are sorted in ranges. A value's place is that in its range plus
    the sizes of the ranges before, so neither a task nor the driver holds a column's values.
    """
    order = ["column_name", F.desc("frequency"), "value"]
    ordered = counts.where("value IS NOT NULL").orderBy(*order).withColumn("_place", F.monotonically_increasing_id())
    ordered = write_table(ordered, "ranks").withColumn("_part", F.shiftright("_place", 33))
    parts = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_held"))  # one row for each range
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_before"))
    local = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    placed = ordered.join(parts, "_part").withColumn("_rank", F.col("_before") + local)
    columns = placed.groupBy("column_name").agg(F.min("_rank").alias("_first"), F.count(F.lit(1)).alias("size"))
    index = (F.col("_rank") - F.col("_first")).alias("category_index")
    return placed.join(columns, "column_name").select("column_name", "value", index, "size")


def index_categories(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """key, column_name and category_index of every record and column; NULL gets the index after the last."""
    ranks = write_table(ranked_values(frequency_table(df, columns)), "category-index")
    sizes = ranks.groupBy("column_name").agg(F.max("size").alias("_size"))
    kinds = dict(df.dtypes)
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("column_name"), value_text(F.col(name), kinds[name]).alias("value"))
            for name in columns
        ]
    )
    tall = df.select(key, F.inline(cells)).join(ranks.drop("size"), ["column_name", "value"], "left")
    index = F.coalesce("category_index", "_size", F.lit(0)).alias("category_index")
    return tall.join(sizes, "column_name", "left").select(key, "column_name", index)
