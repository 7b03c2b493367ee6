"""A registry of model versions: of all that try for a version at once one gets it.

A version is a file that is created where none may be; the file system decides who was first. Its text
names the entry, a row that was written before. A writer that dies in between leaves a version without a
readable entry, which counts for nothing: the next one takes the number after it. The champion is the
entry of the greatest version, so equal times do not matter.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.workspace import new_folder

ENTRY = "entry string, model_path string, beaten string, change double, entered_at timestamp"


@dataclass(frozen=True)
class Champion:
    """The accepted model: its version (0 before the first) and the greatest number that anyone took."""

    version: int
    taken: int
    model_path: str | None


class ModelRegistry:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        place = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self._system = place.getFileSystem(spark._jsc.hadoopConfiguration())

    def _read(self, reader: Callable[[], DataFrame], schema: str) -> DataFrame:
        try:
            return reader()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def versions(self) -> DataFrame:
        """version, entry, model_path, beaten (the champion before), change and entered_at; entry is NULL for torn ones."""
        marks = self._read(
            lambda: self.spark.read.text(f"{self.path}/versions/*.txt", wholetext=True).select(
                F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)", 1).cast("int").alias("version"),
                F.col("value").alias("entry"),
            ),
            "version int, entry string",
        )
        entries = self._read(lambda: self.spark.read.schema(ENTRY).parquet(f"{self.path}/entries/*"), ENTRY)
        return marks.join(entries, "entry", "left").select("version", *[name for name in entries.columns])

    def _numbers(self) -> list[int]:
        """The taken versions, torn ones included: names only."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/versions")
        if not self._system.exists(folder):
            return []
        return [int(status.getPath().getName().removesuffix(".txt")) for status in self._system.listStatus(folder)]

    def champion(self) -> Champion:
        taken = max(self._numbers(), default=0)
        row = self.versions().where("model_path IS NOT NULL").agg(F.max(F.struct("version", "model_path"))).first()[0]
        return Champion(row.version, taken, row.model_path) if row else Champion(0, taken, None)

    def promote(self, model_path: str, over: Champion, change: float | None = None) -> bool:
        """Make the model the champion, if nobody has taken a version since ``over`` was read."""
        entry = new_folder(self.spark, "entry").rsplit("/", 1)[-1]
        row = self.spark.createDataFrame(
            [(entry, model_path, over.model_path, change)], "entry string, model_path string, beaten string, change double"
        )
        row.withColumn("entered_at", F.current_timestamp()).coalesce(1).write.parquet(f"{self.path}/entries/{entry}")
        return self._claim(over.taken + 1, entry)

    def _claim(self, version: int, text: str) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/versions/{version:09d}.txt")
        try:
            stream = self._system.create(place, False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        stream.write(bytearray(text.encode()))
        stream.close()
        return True

    def compete(
        self, model_path: str, better: Callable[[str | None], tuple[bool, float | None]]
    ) -> tuple[Champion, bool, int]:
        """Put a candidate against the champion until a decision holds: the champion it met, accepted, and tries.

        better: whether the candidate beats the model at a path (None: there is none), and by how much. Asked
        again against the new champion if another candidate has won in between.
        """
        tries = 0
        while True:
            tries += 1
            over = self.champion()
            accepted, change = better(over.model_path)
            if not accepted:
                return over, False, tries
            if self.promote(model_path, over, change):
                return over, True, tries


class ServedModel:
    """The champion, loaded; loaded again only when another model has become the champion."""

    def __init__(self, registry: ModelRegistry, load: Callable[[str], Any]):
        self.registry, self.load = registry, load
        self.version, self.model = 0, None

    def current(self) -> Any:
        champion = self.registry.champion()
        if champion.version != self.version:
            self.model = self.load(champion.model_path)
            self.version = champion.version
        return self.model
