import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from casebook.operators import metrics, promotion
from casebook.plans import lifecycle, scoring, training
from casebook.plans.lifecycle import TrainingRun, compare, run_training
from casebook.schema import KEY, PREDICTED_LABEL, SCORING_COLUMNS
from casebook.sources.cases import cases
from casebook.streaming.scoring import score_stream
from casebook.workspace import LEAST_TASKS, in_many_tasks, write_table

SF = "/root/testdata/sf0.001"
PAIRS = [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0), (0.0, 0.0), (2.0, 1.0)]


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame(PAIRS, "label double, prediction double")


def test_metrics_equal_the_evaluator(pairs):
    matrix = metrics.confusion_matrix(pairs, "label", "prediction")
    values = {r.metric: r.value for r in metrics.weighted_metrics(matrix).collect()}
    evaluator = MulticlassClassificationEvaluator(metricLabel=0.0)
    expected = {name: evaluator.setMetricName(name).evaluate(pairs) for name in values}
    assert len(values) == 11 and values == pytest.approx(expected)
    assert values["f1"] == pytest.approx(0.6222222)
    assert values["weightedFalsePositiveRate"] == pytest.approx(0.1666667)


def test_prediction_outside_the_labels_counts_as_false(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "new"), ("b", "b"), (None, "a")], "label string, prediction string")
    rows = metrics.per_label_metrics(metrics.confusion_matrix(df, "label", "prediction")).collect()
    assert {r.label: (r.support, r.recall, r.precision) for r in rows} == {"a": (2, 0.5, 1.0), "b": (1, 1.0, 1.0)}


def test_one_class_has_no_false_positive_rate(spark):
    df = spark.createDataFrame([("a", "a")], "label string, prediction string")
    (row,) = metrics.per_label_metrics(metrics.confusion_matrix(df, "label", "prediction")).collect()
    assert (row.recall, row.false_positive_rate) == (1.0, 0.0)


def gate(spark, rows, **options):
    df = spark.createDataFrame(rows, "label string, candidate string, champion string")
    return promotion.promotion_gate(df, "label", "candidate", "champion", **options).first()


def test_gate(spark):
    better = [("Yes", "Yes", "No"), ("No", "No", "No")]
    same = [("Yes", "Yes", "Yes"), ("No", "No", "No")]
    row = gate(spark, better)
    assert row.model_accepted and row.active and row.changed_accuracy == pytest.approx(1 - 1 / 3)
    assert not gate(spark, same).model_accepted
    assert gate(spark, same, margin=0.0).model_accepted
    assert not gate(spark, better, floor=1.1).model_accepted


def test_gate_accepts_exactly_the_margin(spark):
    rows = [("Yes", "Yes", "No"), ("No", "No", "No")]
    change = gate(spark, rows).changed_accuracy
    assert gate(spark, rows, margin=change).model_accepted
    assert not gate(spark, rows, margin=change + 1e-9).model_accepted


def test_gate_without_champion(spark):
    df = spark.createDataFrame([("Yes", "No")], "label string, candidate string")
    row = promotion.promotion_gate(df, "label", "candidate", None).first()
    assert row.model_accepted and row.changed_accuracy == 0.0 and row.champion_f1 is None


def test_latest_model_is_the_newest_accepted(spark, tmp_path):
    path = str(tmp_path / "report")
    assert promotion.latest_model(spark, path) is None
    rows = [("true", "m1", "2020-01-01"), ("true", "m2", "2020-01-03"), ("false", "m3", "2020-01-04")]
    for accepted, model, at in rows:
        row = spark.range(1).select(
            F.lit(accepted).alias("model_accepted"),
            F.lit(0.1).cast("float").alias("changed_accuracy"),
            F.lit(model).alias("trained_model_path"),
            F.lit(None).cast("string").alias("best_model_path"),
            F.lit(accepted).alias("active"),
            F.lit(at).cast("timestamp").alias("evaluated_at"),
        )
        promotion.append_report(row, path)
    assert promotion.latest_model(spark, path) == "m2"


def test_label_index_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "consumer_disputed string")
    model = training.fit_label_index(df)
    assert model.labels == ["c", "a", "b"] and model.transform(df).count() == 4


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("runs")
    records = write_table(cases(spark, SF), "model-records")
    first = run_training(records, str(base / "first"), str(base / "report"))
    second = run_training(records, str(base / "second"), str(base / "report"), seed=7)
    return records, first, second, str(base / "report")


def test_runs_leave_their_artifacts(spark, trained):
    records, first, _, _ = trained
    assert spark.read.parquet(first.path("accepted")).count() == 1500
    quarantined = spark.read.parquet(first.path("quarantine"))
    assert {r[0] for r in quarantined.select("column_name").distinct().collect()} == {
        "sub_product",
        "company_public_response",
    }
    values = {(r.split, r.metric): r.value for r in spark.read.parquet(first.path("metrics")).collect()}
    assert len(values) == 22 and values["test", "f1"] > 0.8


def test_passes_over_accepted_rows_have_several_tasks_for_each_core(spark, tmp_path, monkeypatch):
    """Files that are packed into one task for each core, and one more, cost every pass a second round."""
    seen = []
    rejected = lifecycle.rejected_columns
    monkeypatch.setattr(lifecycle, "rejected_columns", lambda df: seen.append(spark.conf.get(LEAST_TASKS)) or rejected(df))
    monkeypatch.setattr(lifecycle, "ROWS_PER_FILE", 50)
    records = write_table(cases(spark, SF), "model-records", rows_per_file=50)
    accepted = lifecycle.validate(records, TrainingRun(str(tmp_path)))
    tasks = in_many_tasks(lambda df: [df.rdd.getNumPartitions(), len(df.inputFiles())])
    cores = spark.sparkContext.defaultParallelism
    assert seen == [str(4 * cores)] and spark.conf.get(LEAST_TASKS, None) is None
    for table in (records, accepted):
        held, files = tasks(table)
        assert held >= 3 * cores and files >= 30 and table.count() == 1500


def test_report_names_champion_and_candidate(spark, trained):
    _, first, second, report = trained
    rows = spark.read.schema(promotion.REPORT_SCHEMA).parquet(report).orderBy("evaluated_at").collect()
    assert (rows[0].model_accepted, rows[0].changed_accuracy, rows[0].best_model_path) == ("true", 0.0, None)
    assert (rows[1].trained_model_path, rows[1].best_model_path) == (second.model, first.model)


def test_equal_models_tie_whatever_their_label_order(spark, trained):
    records, first, _, _ = trained
    model = PipelineModel.load(first.model)
    *rest, forest, names = model.stages
    assert names.getLabels() == ["No", "Yes"]
    row = compare(records, model, PipelineModel.load(first.model)).first()
    assert row.candidate_f1 == row.champion_f1 and not row.model_accepted


def test_metrics_of_the_forest_equal_the_evaluator(spark, trained):
    _, first, _, _ = trained
    model = PipelineModel.load(first.model)
    vectors = spark.read.parquet(first.path("vectors"))
    labels = training.fit_label_index(vectors.where("split = 'train'"))
    scored = labels.transform(PipelineModel(model.stages[-2:]).transform(vectors)).where("split = 'test'")
    evaluator = MulticlassClassificationEvaluator(labelCol="indexed_consumer_disputed", metricName="f1")
    (row,) = spark.read.parquet(first.path("metrics")).where("split = 'test' and metric = 'f1'").collect()
    assert row.value == pytest.approx(evaluator.evaluate(scored))


def test_inputs_are_scored_archived_or_diverted(spark, trained, tmp_path):
    """Two inputs of equal name, one with a file that lacks a column, one with a column of another type."""
    records, first, _, _ = trained
    inputs = records.select(KEY, *SCORING_COLUMNS)
    one, two, three = str(tmp_path / "1/day"), str(tmp_path / "2/day"), str(tmp_path / "a b=c")
    inputs.write.parquet(one)
    inputs.limit(100).write.parquet(two)
    inputs.drop("issue").write.mode("append").parquet(two)
    inputs.withColumn("issue", F.lit(5)).write.parquet(three)
    model = PipelineModel.load(first.model)
    outputs = [str(tmp_path / name) for name in ("predictions", "archive", "failed")]
    for _ in range(2):  # a repeated run overwrites its output
        scoring.score_inputs(model, spark, [one, two, three], *outputs, run="7")
    scored = spark.read.parquet(outputs[0])
    assert {KEY, *SCORING_COLUMNS, PREDICTED_LABEL, "source"} <= set(scored.columns)
    assert dict(scored.groupBy("source").count().collect()) == {one: 1500, two: 100}
    archived = spark.read.parquet(outputs[1]).where(F.col("source") == one).select(*inputs.columns)
    assert archived.exceptAll(inputs).isEmpty() and archived.count() == 1500
    failed = [spark.read.parquet(str(path)) for path in sorted((tmp_path / "failed" / "run=7").iterdir())]
    assert sorted((df.first().source, df.count(), "issue" in df.columns) for df in failed) == [
        (two, 1500, False),
        (three, 1500, True),
    ]


def test_contract_names_problems(spark):
    df = spark.createDataFrame([("a", 1, "2020-01-01")], "issue string, submitted_via int, date_received string")
    assert scoring.contract_problems(df.schema) == [
        "company_response",
        "consumer_consent_provided",
        "date_sent_to_company",
        "submitted_via int",
    ]


def test_stream_equals_batch(spark, trained, tmp_path):
    records, first, _, _ = trained
    inputs = records.select(KEY, *SCORING_COLUMNS)
    inputs.repartition(4).write.parquet(str(tmp_path / "in"))
    model = PipelineModel.load(first.model)
    outputs = [str(tmp_path / name) for name in ("predictions", "archive", "failed", "progress")]

    def drain():
        score_stream(
            model, spark, str(tmp_path / "in"), inputs.schema, *outputs, files_per_batch=2
        ).awaitTermination()
        return spark.read.parquet(outputs[0])

    streamed = drain().select(*inputs.columns, PREDICTED_LABEL)
    batch = scoring.score(model, inputs)
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()
    assert spark.read.parquet(outputs[1]).count() == 1500
    assert drain().select("run").distinct().count() == 2  # nothing new, nothing scored again
    inputs.limit(10).write.mode("append").parquet(str(tmp_path / "in"))
    inputs.limit(20).drop("issue", "company_response").write.mode("append").parquet(str(tmp_path / "in"))
    assert drain().count() == 1510 and spark.read.parquet(outputs[2]).count() == 20


def test_layout_does_not_change_the_forest(spark, trained, tmp_path):
    """The same vectors in one file and in eight give the same trees."""
    _, first, _, _ = trained
    vectors = spark.read.parquet(first.path("vectors")).where("split = 'train'")
    predicted = []
    for parts in (1, 8):
        rows = write_table(vectors.repartition(parts), "layout")
        labels = training.fit_label_index(rows)
        forest = training.fit_forest(training.dealt(rows), labels)
        predicted.append(forest.transform(rows).select(KEY, PREDICTED_LABEL))
    assert predicted[0].exceptAll(predicted[1]).isEmpty() and predicted[0].count() > 900
    (row,) = spark.read.parquet(first.path("settings")).collect()
    assert (row.seed, row.parts) == (42, training.TRAINING_PARTS)


def test_run_paths():
    assert TrainingRun("x").model == "x/model"


def test_the_search_is_the_same_on_any_layout_and_finds_what_helps(spark):
    """A forest of depth 1 cannot tell an exclusive or; the search takes the deeper one, however rows are laid out."""
    import random

    from pyspark.ml.feature import VectorAssembler

    from casebook.plans import search, training
    from casebook.schema import SCALED, TARGET

    rng = random.Random(1)
    values = [(str(k), rng.random(), rng.random()) for k in range(400)]
    rows = spark.createDataFrame(values, "complaint_id string, x double, y double")
    rows = rows.withColumn(TARGET, F.when((F.col("x") > 0.5) != (F.col("y") > 0.5), "Yes").otherwise("No"))
    rows = VectorAssembler(inputCols=["x", "y"], outputCol=SCALED).transform(rows)
    grid = [{"maxDepth": 1, "numTrees": 3}, {"maxDepth": 6, "numTrees": 3}]
    found = []
    for layout in (rows.repartition(2), rows.repartition(7).orderBy("x")):
        dealt = training.dealt(layout, parts=4)
        found.append(search.search_forest(dealt, training.fit_label_index(dealt), grid, folds=2))
    assert found[0] == found[1]
    chosen, scores = found[0]
    assert chosen == grid[1] and len(scores) == 4
    assert sum(score.row_count for score in scores) == 2 * 400
    assert min(score.f1 for score in scores if score.params == grid[1]) > 0.85
