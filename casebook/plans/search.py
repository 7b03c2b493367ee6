"""Choice of forest parameters by cross-validation, the same on any cluster."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.operators.metrics import weighted_metrics
from casebook.plans.training import fit_forest
from casebook.schema import KEY, PREDICTED_LABEL, TARGET

# Fits that run at a time; each has the whole cluster's tasks between its own.
PARALLEL = 2
FOLD = "fold"


def fold_of(key: Column, folds: int) -> Column:
    """The fold of a record, by a digest of its key other than that of the split."""
    digest = F.md5(F.concat(F.lit("fold "), key.cast("string")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % folds).cast("int")


@dataclass(frozen=True)
class Score:
    """The weighted F1 of one fit on the rows of the fold that it had not seen."""

    params: dict[str, Any]
    fold: int
    row_count: int
    f1: float


def fold_score(
    rows: DataFrame, labels: StringIndexerModel, params: dict[str, Any], fold: int, seed: int, label: str = TARGET
) -> Score:
    forest = fit_forest(rows.where(F.col(FOLD) != fold), labels, seed, **params)
    scored = forest.transform(labels.transform(rows.where(F.col(FOLD) == fold)))
    pairs = scored.groupBy(F.col(label).alias("label"), F.col(PREDICTED_LABEL).alias("prediction"))
    counted = pairs.agg(F.count(F.lit(1)).alias("row_count")).collect()  # at most one row for each pair of labels
    matrix = rows.sparkSession.createDataFrame(counted, "label string, prediction string, row_count long")
    f1 = weighted_metrics(matrix).where("metric = 'f1'").select("value").first()
    return Score(params, fold, sum(row.row_count for row in counted), f1.value if f1 else 0.0)


def search_forest(
    training: DataFrame,
    labels: StringIndexerModel,
    grid: Sequence[dict[str, Any]],
    folds: int = 3,
    seed: int = 42,
    key: str = KEY,
) -> tuple[dict[str, Any], list[Score]]:
    """The parameters with the best mean F1 over the folds, of equally good ones the first, and all scores.

    training: rows as ``dealt`` gives them, computed once. A fold is left out where the rows lie, so the parts
    and their order, and with them the trees, follow from keys, seed and number of parts alone. Fits run side
    by side over the one table.
    """
    rows = training.withColumn(FOLD, fold_of(F.col(key), folds))
    cells = [(params, fold) for params in grid for fold in range(folds)]
    with ThreadPoolExecutor(PARALLEL) as pool:
        work = inheritable_thread_target(training.sparkSession)(
            lambda cell: fold_score(rows, labels, cell[0], cell[1], seed)
        )
        scores = list(pool.map(work, cells))
    means = [sum(scores[k * folds + fold].f1 for fold in range(folds)) / folds for k in range(len(grid))]
    return dict(grid[max(range(len(grid)), key=lambda k: (means[k], -k))]), scores
