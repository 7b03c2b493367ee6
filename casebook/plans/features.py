"""The feature pipeline: case records in, one scaled vector per record out."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import (
    IDF,
    HashingTF,
    Imputer,
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    Tokenizer,
    VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.functions.columns import elapsed_days
from casebook.operators.frequency import frequency_table
from casebook.plans.stages import CategoryEncoderModel, ElapsedDays, ModeImputer, ModeImputerModel
from casebook.schema import (
    ASSEMBLED,
    CATEGORY_COLUMNS,
    DATE_COLUMNS,
    ELAPSED,
    ENCODED,
    IMPUTED,
    INDEXED,
    SCALED,
    TEXT_BUCKETS,
    TEXT_COLUMN,
    prefixed,
)
from casebook.workspace import write_table

# Categories that are indexed by a list kept with the model; the index of columns with more is a table.
LISTED_CATEGORIES = 100_000

_TEXT = "filled_text"


def feature_stages(strict: bool = False) -> list:
    """All stages in order.

    A category first seen after fitting gets a zero vector; ``strict`` makes it an error and drops
    the rarest category's slot, as plain MLlib indexing does.
    """
    imputed = prefixed(IMPUTED, CATEGORY_COLUMNS)
    indexed = prefixed(INDEXED, CATEGORY_COLUMNS)
    encoded = prefixed(ENCODED, CATEGORY_COLUMNS)
    text = SQLTransformer(statement=f"SELECT *, coalesce({TEXT_COLUMN}, '') AS {_TEXT} FROM __THIS__")
    return [
        ElapsedDays(inputCols=DATE_COLUMNS, outputCols=[ELAPSED]),
        Imputer(inputCols=[ELAPSED], outputCols=[IMPUTED + ELAPSED]),
        ModeImputer(inputCols=CATEGORY_COLUMNS, outputCols=imputed),
        StringIndexer(inputCols=imputed, outputCols=indexed, handleInvalid="error" if strict else "keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded),
        text,
        Tokenizer(inputCol=_TEXT, outputCol="words"),
        HashingTF(inputCol="words", outputCol="rawFeatures", numFeatures=TEXT_BUCKETS),
        IDF(inputCol="rawFeatures", outputCol=ENCODED + TEXT_COLUMN),
        VectorAssembler(inputCols=[*encoded, IMPUTED + ELAPSED, ENCODED + TEXT_COLUMN], outputCol=ASSEMBLED),
        StandardScaler(inputCol=ASSEMBLED, outputCol=SCALED),
    ]


def fitted_categories(df: DataFrame, strict: bool, most: int) -> list[Transformer]:
    """Mode imputer, indexers and one-hot encoders of the category columns, from one count of all their values.

    Columns of up to ``most`` categories are indexed by a list, the others by a table; vectors are alike.
    Raises, naming the columns no stage can be fitted on, and with ``strict``, which needs a list.
    """
    known = F.when(elapsed_days(*DATE_COLUMNS).isNotNull(), "")
    counts = frequency_table(df.withColumn(ELAPSED, known), [*CATEGORY_COLUMNS, ELAPSED])
    counts = write_table(counts, "categories")
    sizes = counts.where("value IS NOT NULL").groupBy("column_name").agg(F.count(F.lit(1)).alias("held"))
    held = {row.column_name: row.held for row in sizes.collect()}
    empty = [name for name in (ELAPSED, *CATEGORY_COLUMNS) if name not in held]
    if empty:
        raise ValueError(f"cannot fit features: no values in {empty}")
    wide = [name for name in CATEGORY_COLUMNS if held[name] > most]
    if wide and strict:
        raise ValueError(f"cannot one-hot encode {wide}: more than {most} categories")
    narrow = [name for name in CATEGORY_COLUMNS if name not in wide]
    found: dict[str, dict[str | None, int]] = {name: {} for name in narrow}
    for row in counts.where(F.col("column_name").isin(narrow)).collect():  # at most ``most`` for each column
        found[row.column_name][row.value] = row.frequency
    best = F.struct(-F.col("frequency"), "value")
    many = counts.where(F.col("column_name").isin(wide) & F.col("value").isNotNull()).groupBy("column_name")
    mode_of = {row.column_name: row.mode for row in many.agg(F.min_by("value", best).alias("mode")).collect()}
    modes, labels = [], []
    for name in CATEGORY_COLUMNS:
        if name in wide:
            modes.append(mode_of[name])
            continue
        missing = found[name].pop(None, 0)
        mode = min(found[name], key=lambda value: (-found[name][value], value))
        found[name][mode] += missing
        modes.append(mode)
        labels.append(sorted(found[name], key=lambda value: (-found[name][value], value)))
    imputed = prefixed(IMPUTED, CATEGORY_COLUMNS)
    imputer = ModeImputerModel(fillValues=modes).setInputCols(CATEGORY_COLUMNS).setOutputCols(imputed)
    invalid = "error" if strict else "keep"
    # one model for each column: a shared one would fill up the shorter lists of labels
    indexers = [
        StringIndexerModel.from_labels(own, name, output, invalid)
        for own, name, output in zip(labels, prefixed(IMPUTED, narrow), prefixed(INDEXED, narrow), strict=True)
    ]
    encoders: list = []
    if narrow:
        encoders.append(OneHotEncoder(inputCols=prefixed(INDEXED, narrow), outputCols=prefixed(ENCODED, narrow)))
    if wide:
        # the mode has most rows without those of NULL, too, so imputing changes no place in the order
        listed = write_table(counts.where(F.col("column_name").isin(wide)), "wide-categories", ("column_name",))
        model = CategoryEncoderModel.from_counts(listed, names={name: IMPUTED + name for name in wide})
        encoders.append(model.setInputCols(prefixed(IMPUTED, wide)).setOutputCols(prefixed(ENCODED, wide)))
    return [imputer, *indexers, *encoders]


def fit_features(train: DataFrame, strict: bool = False, max_categories: int = LISTED_CATEGORIES) -> PipelineModel:
    """Fit on training records only. Give a written table: counting, mean, IDF and scaler each make
    a column-pruned pass of their own. ``max_categories``: of a column whose index is kept as a list."""
    imputer, *others = fitted_categories(train, strict, max_categories)
    stages: list = []
    for stage in feature_stages(strict):
        fitted = {ModeImputer: [imputer], StringIndexer: others, OneHotEncoder: []}
        stages += fitted.get(type(stage), [stage])
    return Pipeline(stages=stages).fit(train)


def join_models(*models: Transformer) -> PipelineModel:
    """One model that applies the stages of all given ones in turn."""
    return PipelineModel([stage for model in models for stage in getattr(model, "stages", [model])])
