"""Batch scoring: check input files, score the valid ones, archive them, divert the others."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from casebook.schema import DATE_COLUMNS, KEY, PREDICTED_LABEL, SCORING_COLUMNS
from casebook.sources.footers import FILE, footers, read_files, schema_classes, with_places
from casebook.workspace import write_table

SOURCE = "source"
_TEXTS, _DATES = {"string"}, {"string", "date", "timestamp", "timestamp_ntz"}


def missing_columns(df: DataFrame, required: Sequence[str] = SCORING_COLUMNS) -> list[str]:
    return [name for name in required if name not in df.columns]


def contract_problems(schema: StructType, required: Sequence[str] = SCORING_COLUMNS) -> list[str]:
    """Required columns that a schema lacks or has with a type that no stage accepts."""
    kinds = {field.name: field.dataType.simpleString() for field in schema}
    lacking = [name for name in required if name not in kinds]
    wrong = [
        f"{name} {kinds[name]}"
        for name in required
        if name in kinds and kinds[name] not in (_DATES if name in DATE_COLUMNS else _TEXTS)
    ]
    return lacking + wrong


@dataclass(frozen=True)
class FileGroup:
    """Files of one schema, by the input they were found under, and what the contract says of them."""

    schema: StructType
    files: DataFrame
    problems: list[str]

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows, with the input they came from."""
        return read_files(spark, self.schema, self.files, SOURCE)


def file_groups(
    spark: SparkSession, inputs: Iterable[str], required: Sequence[str] = SCORING_COLUMNS
) -> list[FileGroup]:
    """The inputs' files by schema. Every file's own footer decides; names and types are compared.

    All footers are one job. The driver sees the different schemas; file names stay in a written table
    but for those of inputs that hold several schemas, which the readers are given.
    """
    found = write_table(with_places(footers(spark, inputs)), "footers")
    broken = found.where("schema IS NULL").select(FILE).first()
    if broken:
        raise ValueError(f"no Parquet file: {broken[0]}")
    return [
        FileGroup(schema, found.where(F.col("schema") == text), contract_problems(schema, required))
        for text, schema, _ in schema_classes(found)
    ]


def score(model: Transformer, df: DataFrame, keep: Sequence[str] = (KEY, *SCORING_COLUMNS)) -> DataFrame:
    """The kept input columns and the predicted label of every row."""
    kept = [name for name in keep if name in df.columns]
    return model.transform(df).select(*kept, PREDICTED_LABEL)


def score_inputs(
    model: Transformer,
    spark: SparkSession,
    inputs: Sequence[str],
    predictions: str,
    archive: str,
    failed: str,
    run: str,
) -> list[str]:
    """Score the valid files of all inputs, archive their rows, divert the files that break the contract.

    Files of one schema are one job, whatever inputs they belong to. A run writes
    ``<base>/run=<run>/group=<number>/source=<whole input path>``, so inputs of equal name stay
    apart. Repeating a run overwrites its output. Returns the folders with predictions.
    """
    written = []
    for number, group in enumerate(file_groups(spark, inputs)):
        rows, place = group.read(spark), f"run={run}/group={number}"

        def write(df: DataFrame, base: str, place: str = place) -> str:
            target = f"{base.rstrip('/')}/{place}"
            df.write.mode("overwrite").partitionBy(SOURCE).parquet(target)
            return target

        if group.problems:
            write(rows, failed)
        else:
            written.append(write(score(model, rows, (KEY, *SCORING_COLUMNS, SOURCE)), predictions))
            write(rows, archive)
    return written
