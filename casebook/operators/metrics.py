"""Classification metrics, all derived from one confusion matrix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows per label and prediction; rows without a label are left out."""
    pairs = df.where(F.col(label).isNotNull())
    return pairs.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))


def per_label_metrics(matrix: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Support, rates, precision, recall and F-measure of every label.

    ``by`` names extra columns of the matrix (such as the model) that separate the results.
    """
    held = F.col("row_count")
    hit = F.when(F.col("label").eqNullSafe(F.col("prediction")), held).otherwise(0)
    as_label = F.struct(
        F.col("label").alias("label"),
        held.alias("support"),
        hit.cast("long").alias("hits"),
        F.lit(0).cast("long").alias("predicted"),
    )
    as_prediction = F.struct(
        F.col("prediction").alias("label"),
        F.lit(0).cast("long").alias("support"),
        F.lit(0).cast("long").alias("hits"),
        held.alias("predicted"),
    )
    sides = matrix.select(*by, F.inline(F.array(as_label, as_prediction)))
    classes = sides.groupBy(*by, "label").agg(
        F.sum("support").alias("support"), F.sum("hits").alias("hits"), F.sum("predicted").alias("predicted")
    )
    totals = matrix.groupBy(*by).agg(F.sum("row_count").alias("total"))
    if by:
        classes = classes.join(totals, list(by))
    else:
        classes = classes.withColumn("total", totals.scalar())
    hits, support, predicted = F.col("hits"), F.col("support"), F.col("predicted")
    precision, recall = _ratio(hits, predicted), _ratio(hits, support)
    return classes.where(support > 0).select(
        *by,
        "label",
        "support",
        recall.alias("true_positive_rate"),
        _ratio(predicted - hits, F.col("total") - support).alias("false_positive_rate"),
        precision.alias("precision"),
        recall.alias("recall"),
        _ratio(precision * recall * 2, precision + recall).alias("f_measure"),
    )


# Metric names, in report order, and the per-label value each one is made of.
WEIGHTED_METRICS = {
    "f1": "f_measure",
    "weightedPrecision": "precision",
    "weightedRecall": "recall",
    "weightedTruePositiveRate": "true_positive_rate",
    "weightedFalsePositiveRate": "false_positive_rate",
    "weightedFMeasure": "f_measure",
}
FIRST_LABEL_METRICS = {
    "truePositiveRateByLabel": "true_positive_rate",
    "falsePositiveRateByLabel": "false_positive_rate",
    "precisionByLabel": "precision",
    "recallByLabel": "recall",
    "fMeasureByLabel": "f_measure",
}


def weighted_metrics(matrix: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``(metric, value)`` rows: support-weighted means, and the values of the most frequent label."""
    support = F.col("support")
    most_frequent = F.struct(-support, F.col("label"))
    values = {
        name: F.sum(F.col(column) * support) / F.sum(support) for name, column in WEIGHTED_METRICS.items()
    } | {name: F.min_by(column, most_frequent) for name, column in FIRST_LABEL_METRICS.items()}
    wide = per_label_metrics(matrix, by).groupBy(*by).agg(*[v.alias(name) for name, v in values.items()])
    return wide.unpivot(list(by), list(values), "metric", "value")
