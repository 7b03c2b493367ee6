"""Scoring of records as they arrive, each record once however often it is sent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from casebook.plans.scoring import score
from casebook.schema import KEY, SCORING_COLUMNS

# How long after it came a record is remembered, and files that a micro-batch takes at most.
REMEMBERED = "30 days"
FILES_PER_BATCH = 1000

_ARRIVED, _RECORD = "_arrived", "_record"


def arriving_once(
    spark: SparkSession,
    source: str,
    schema: StructType,
    remembered: str = REMEMBERED,
    files_per_batch: int = FILES_PER_BATCH,
) -> DataFrame:
    """A stream of the records of arriving Parquet files, those that were seen before left out.

    State is kept by record. Its clock is the arrival: a watermark on the time of the micro-batch lets go
    of records that came longer than ``remembered`` ago, so state is bounded by what arrives in that time,
    and no record is ever too late, whatever its own dates say. A record sent again after that is scored
    again. Of copies in one micro-batch any one stays. Records without a key are each their own.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    place = F.concat_ws(":", F.lit("row"), "_metadata.file_path", F.col("_metadata.row_index").cast("string"))
    known = F.when(F.col(KEY).isNotNull(), F.concat(F.lit("key:"), F.col(KEY))).otherwise(place)
    rows = reader.parquet(source).withColumns({_RECORD: known, _ARRIVED: F.current_timestamp()})
    return rows.withWatermark(_ARRIVED, remembered).dropDuplicatesWithinWatermark([_RECORD])


def score_records(
    model: Transformer,
    spark: SparkSession,
    source: str,
    schema: StructType,
    predictions: str,
    checkpoint: str,
    remembered: str = REMEMBERED,
    files_per_batch: int = FILES_PER_BATCH,
    keep: Sequence[str] = (KEY, *SCORING_COLUMNS),
) -> StreamingQuery:
    """Start a query that scores the new records of all waiting files and then ends.

    Progress and state are in the checkpoint, and the sink lists the files of finished micro-batches, so a
    query that was stopped at any moment goes on where it was: each record is in the output once.
    """
    scored = score(model, arriving_once(spark, source, schema, remembered, files_per_batch), keep)
    return (
        scored.writeStream.format("parquet")
        .option("path", predictions)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
