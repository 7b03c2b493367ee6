"""Label index, forest, label strings, and metrics of a trained model."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.operators.metrics import weighted_metrics
from casebook.schema import KEY, LABEL_INDEX, PREDICTED_LABEL, PREDICTION, SCALED, TARGET
from casebook.workspace import checkpointed


# Parts that training rows are dealt into, at least, and rows of a part. A forest samples each part by
# its number, so the same data, seed and number of parts give the same trees on any cluster.
TRAINING_PARTS = 32
ROWS_PER_PART = 250_000


def training_parts(n_rows: int) -> int:
    """Parts for so many training rows."""
    return max(TRAINING_PARTS, -(-n_rows // ROWS_PER_PART))


def dealt(rows: DataFrame, key: str = KEY, parts: int = TRAINING_PARTS) -> DataFrame:
    """Rows in a layout that only their keys decide: dealt by a hash of the key, sorted in each part.

    Computed once, whatever passes a fit makes over them.
    """
    return checkpointed(rows.repartition(parts, key).sortWithinPartitions(key))


def fit_label_index(train: DataFrame, label: str = TARGET, output: str = LABEL_INDEX) -> StringIndexerModel:
    """Number the labels by falling frequency, ties by name. Rows without a label are not counted."""
    return StringIndexer(inputCol=label, outputCol=output, handleInvalid="skip").fit(train)


def fit_forest(train: DataFrame, labels: StringIndexerModel, seed: int = 42, **params) -> PipelineModel:
    """Forest on the scaled vectors, followed by the label string of its prediction."""
    forest = RandomForestClassifier(
        labelCol=labels.getOutputCol(), featuresCol=SCALED, predictionCol=PREDICTION, seed=seed, **params
    )
    names = IndexToString(inputCol=PREDICTION, outputCol=PREDICTED_LABEL, labels=labels.labels)
    return Pipeline(stages=[forest, names]).fit(labels.transform(train))


def training_metrics(
    scored: DataFrame, by: str = "split", label: str = TARGET, prediction: str = PREDICTED_LABEL
) -> DataFrame:
    """All metrics of the scored rows, separately for every value of ``by``, from one aggregate."""
    pairs = scored.where(F.col(label).isNotNull()).groupBy(
        by, F.col(label).alias("label"), F.col(prediction).alias("prediction")
    )
    return weighted_metrics(pairs.agg(F.count(F.lit(1)).alias("row_count")), (by,))

