"""Candidate against champion: the F1 gate, its report table, and the newest accepted model."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.operators.metrics import weighted_metrics
from casebook.schema import PROMOTION_MARGIN

# Columns of the report.
REPORT_SCHEMA = T.StructType(
    [
        T.StructField("model_accepted", T.StringType()),
        T.StructField("changed_accuracy", T.FloatType()),
        T.StructField("trained_model_path", T.StringType()),
        T.StructField("best_model_path", T.StringType()),
        T.StructField("active", T.StringType()),
        T.StructField("evaluated_at", T.TimestampType()),
    ]
)


def promotion_gate(
    df: DataFrame,
    label: str,
    candidate: str,
    champion: str | None,
    margin: float = PROMOTION_MARGIN,
    floor: float | None = None,
) -> DataFrame:
    """One row: both F1 scores, their change, and whether the candidate replaces the champion.

    Labels and predictions are compared as label strings, so models that number the labels
    differently can be compared. Both models are counted in one pass. Without a champion the
    candidate is accepted with change 0.0. ``floor`` is an optional least F1 of the candidate.
    """
    models = {"candidate": candidate} | ({"champion": champion} if champion else {})
    pairs = df.where(F.col(label).isNotNull()).groupBy(
        F.col(label).alias("label"), *[F.col(column).alias(f"by_{name}") for name, column in models.items()]
    )
    counted = pairs.agg(F.count(F.lit(1)).alias("held"))
    sides = F.array(
        *[
            F.struct(
                F.lit(name).alias("model"),
                F.col("label").alias("label"),
                F.col(f"by_{name}").alias("prediction"),
                F.col("held").alias("row_count"),
            )
            for name in models
        ]
    )
    scores = weighted_metrics(counted.select(F.inline(sides)), ("model",)).where("metric = 'f1'")

    def score(model: str):
        return F.max(F.when(F.col("model") == model, F.col("value")))

    row = scores.agg(score("candidate").alias("candidate_f1"), score("champion").alias("champion_f1"))
    change = F.col("candidate_f1") - F.col("champion_f1") if champion else F.lit(0.0)
    better = change >= margin if champion else F.lit(True)
    if floor is not None:
        better = better & (F.col("candidate_f1") >= floor)
    return row.withColumns({"changed_accuracy": change, "model_accepted": better, "active": better})


def report_row(gate: DataFrame, trained_model_path: str, best_model_path: str | None) -> DataFrame:
    """The gate's result in the shape of the report table."""
    return gate.select(
        F.col("model_accepted").cast("string"),
        F.col("changed_accuracy").cast("float"),
        F.lit(trained_model_path).alias("trained_model_path"),
        F.lit(best_model_path).cast("string").alias("best_model_path"),
        F.col("active").cast("string"),
        F.current_timestamp().alias("evaluated_at"),
    )


def append_report(row: DataFrame, path: str) -> None:
    row.write.mode("append").parquet(path)


def latest_model(spark: SparkSession, report_path: str) -> str | None:
    """Path of the newest accepted model, of equally new ones the last by path; None without any."""
    try:
        report = spark.read.schema(REPORT_SCHEMA).parquet(report_path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    accepted = report.where(F.col("model_accepted") == "true")
    newest = accepted.agg(F.max(F.struct("evaluated_at", "trained_model_path")).alias("newest"))
    return newest.select("newest.trained_model_path").first()[0]
