"""Scoring of files as they arrive."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from casebook.plans.scoring import score_inputs

# Files that a restart has to read again at most.
FILES_PER_BATCH = 1000


def score_stream(
    model: Transformer,
    spark: SparkSession,
    source: str,
    schema: StructType,
    predictions: str,
    archive: str,
    failed: str,
    checkpoint: str,
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Start a query that scores all waiting files and then ends.

    The stream tells which files are new; they then go through the same contract as a batch: each
    file's footer is checked, valid files are scored and archived, the others diverted. Every
    micro-batch writes to folders of its own and overwrites them when it is repeated, so a restart
    after a failure neither loses nor doubles rows.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    arrivals = reader.parquet(source).select("_metadata.file_path")

    def write_batch(batch: DataFrame, number: int) -> None:
        files = sorted(unquote(row.file_path) for row in batch.distinct().collect())
        score_inputs(model, spark, files, predictions, archive, failed, run=str(number))

    return (
        arrivals.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
