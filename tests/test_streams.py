"""A stream that scores each record once."""

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer

from casebook.schema import KEY, PREDICTED_LABEL
from casebook.streaming import records

SCHEMA = "complaint_id string, issue string, date_received timestamp"


def wave(spark, path, rows):
    made = spark.createDataFrame([(key, issue, day and dt.datetime.fromisoformat(day)) for key, issue, day in rows], SCHEMA)
    made.coalesce(1).write.mode("append").parquet(path)


def run(spark, base, model=None, **options):
    model = model or PipelineModel([SQLTransformer(statement=f"SELECT *, upper(issue) {PREDICTED_LABEL} FROM __THIS__")])
    schema = spark.createDataFrame([], SCHEMA).schema
    query = records.score_records(model, spark, f"{base}/in", schema, f"{base}/out", f"{base}/state", keep=[KEY, "issue"], **options)
    query.awaitTermination()
    return sorted((row[KEY] or "", row[PREDICTED_LABEL]) for row in spark.read.parquet(f"{base}/out").collect())


def test_repeats_across_restarts_are_scored_once(spark, tmp_path):
    base = str(tmp_path)
    wave(spark, f"{base}/in", [("1", "a", "2020-01-01"), ("2", "b", "2020-06-01"), ("2", "b", "2020-06-01")])
    assert run(spark, base) == [("1", "A"), ("2", "B")]
    assert run(spark, base) == [("1", "A"), ("2", "B")]  # started again, nothing new
    # a repeat, a record older than all others, and records without a key or date
    wave(spark, f"{base}/in", [("1", "a", "2020-01-01"), ("3", "c", "1999-01-01"), (None, "d", None), (None, "d", None)])
    assert run(spark, base) == [("", "D"), ("", "D"), ("1", "A"), ("2", "B"), ("3", "C")]
    for _ in range(2):
        wave(spark, f"{base}/in", [("3", "c", "1999-01-01"), ("4", "e", None)])
    assert run(spark, base, files_per_batch=1)[-2:] == [("3", "C"), ("4", "E")]


def test_a_batch_that_failed_is_scored_after_a_restart(spark, tmp_path):
    base = str(tmp_path)
    wave(spark, f"{base}/in", [("1", "a", "2020-01-01")])
    assert run(spark, base) == [("1", "A")]
    wave(spark, f"{base}/in", [("1", "a", "2020-01-01"), ("2", "b", "2020-01-01")])
    broken = PipelineModel(
        [SQLTransformer(statement=f"SELECT *, raise_error('down') {PREDICTED_LABEL} FROM __THIS__")]
    )
    try:
        run(spark, base, broken)
        raise AssertionError("the query should have failed")
    except Exception as error:
        assert "down" in str(error)
    assert run(spark, base) == [("1", "A"), ("2", "B")]


def test_state_is_let_go_after_a_while(spark, tmp_path):
    """With nothing remembered a record that comes again is scored again."""
    base = str(tmp_path)
    for _ in range(3):
        wave(spark, f"{base}/in", [("1", "a", "2020-01-01")])
        found = run(spark, base, remembered="0 seconds")
    assert len(found) > 1


def test_remembered_records_are_those_of_the_stream(spark, tmp_path):
    wave(spark, f"{tmp_path}/in", [("1", "a", "2020-01-01")])
    stream = records.arriving_once(spark, f"{tmp_path}/in", spark.createDataFrame([], SCHEMA).schema)
    assert stream.isStreaming and {KEY, "issue"} <= set(stream.columns)
