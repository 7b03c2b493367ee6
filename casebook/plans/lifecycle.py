"""One training run: validate, split, fit features, train, compare with the champion, report."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.operators.promotion import append_report, latest_model, promotion_gate, report_row
from casebook.operators.quality import accepted_rows, quarantine_columns, rejected_columns, require_columns
from casebook.operators.sampling import split_frames, train_test_split
from casebook.plans.features import fit_features, join_models
from casebook.plans.search import search_forest
from casebook.plans.training import dealt, fit_forest, fit_label_index, training_metrics, training_parts
from casebook.schema import (
    KEY,
    PREDICTED_LABEL,
    PROMOTION_MARGIN,
    SCALED,
    TARGET,
    TRAINING_COLUMNS,
)
from casebook.workspace import ROWS_PER_FILE, in_many_tasks


@dataclass(frozen=True)
class TrainingRun:
    """Paths of what one run leaves behind. Every step reads what the step before has written."""

    folder: str

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    @property
    def model(self) -> str:
        return self.path("model")


@in_many_tasks
def validate(records: DataFrame, run: TrainingRun) -> DataFrame:
    """Quarantine the rejected columns, check the contract, write and return the accepted rows."""
    rejected = rejected_columns(records)
    accepted = require_columns(accepted_rows(records, rejected), TRAINING_COLUMNS, rejected)
    if rejected:
        quarantine_columns(records, rejected).write.mode("append").parquet(run.path("quarantine"))
    accepted.write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(run.path("accepted"))
    return records.sparkSession.read.schema(accepted.schema).parquet(run.path("accepted"))


@in_many_tasks
def train(
    accepted: DataFrame,
    run: TrainingRun,
    seed: int = 42,
    parts: int | None = None,
    grid: Sequence[dict[str, Any]] = (),
    folds: int = 3,
) -> PipelineModel:
    """Fit on the training split, write vectors and metrics, return the model that takes raw records.

    ``seed`` and ``parts`` decide the forest and are recorded in the run's folder. Parts follow from the
    number of training rows unless told otherwise. With a ``grid`` of parameters the forest is fitted with
    those that cross-validation finds best; all scores are in the run's folder.
    """
    spark = accepted.sparkSession
    labelled = accepted.where(F.col(TARGET).isNotNull())
    tagged = train_test_split(labelled)
    features = fit_features(tagged.where("split = 'train'"))
    vectors = features.transform(tagged).select(KEY, SCALED, TARGET, "split")
    vectors.write.option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy("split").parquet(run.path("vectors"))
    vectors = spark.read.parquet(run.path("vectors"))
    training = vectors.where("split = 'train'")
    parts = parts or training_parts(training.count())
    settings = spark.createDataFrame([(seed, parts)], "seed long, parts int")
    settings.coalesce(1).write.mode("overwrite").parquet(run.path("settings"))
    training = dealt(training, KEY, parts)
    labels = fit_label_index(training)
    labels.write().overwrite().save(run.path("label_index"))
    params: dict[str, Any] = {}
    if grid:
        params, scores = search_forest(training, labels, grid, folds, seed)
        found = [(json.dumps(one.params, sort_keys=True), one.fold, one.row_count, one.f1, one.params == params) for one in scores]
        found = spark.createDataFrame(found, "params string, fold int, row_count long, f1 double, chosen boolean")
        found.coalesce(1).write.mode("overwrite").parquet(run.path("search"))
    forest = fit_forest(training, labels, seed, **params)
    scored = forest.transform(vectors)
    training_metrics(scored).write.parquet(run.path("metrics"))
    return join_models(features, forest)


def compare(
    holdout: DataFrame,
    candidate: PipelineModel,
    champion: PipelineModel | None,
    margin: float = PROMOTION_MARGIN,
    floor: float | None = None,
) -> DataFrame:
    """Score the holdout with both models in one pass over it and put them through the gate."""
    names = holdout.columns
    scored = candidate.transform(holdout).select(*names, F.col(PREDICTED_LABEL).alias("candidate"))
    if champion is not None:
        scored = champion.transform(scored).select(TARGET, "candidate", F.col(PREDICTED_LABEL).alias("champion"))
    return promotion_gate(scored, TARGET, "candidate", "champion" if champion else None, margin, floor)


@in_many_tasks
def run_training(records: DataFrame, folder: str, report: str, seed: int = 42) -> TrainingRun:
    """The whole run. The champion is the newest accepted model of the report table."""
    run = TrainingRun(folder)
    accepted = validate(records, run)
    model = train(accepted, run, seed)
    model.write().overwrite().save(run.model)
    champion_path = latest_model(records.sparkSession, report)
    champion = PipelineModel.load(champion_path) if champion_path else None
    _, holdout = split_frames(accepted)
    append_report(report_row(compare(holdout, model, champion), run.model, champion_path), report)
    return run
