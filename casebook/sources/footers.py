"""Parquet footers, read where the tasks run, and file sets whose types drift read as one table.

Footers are one job for all files: a task opens the files dealt to it and sends their schemas. Files in
a store that only Spark's readers reach come with their content. The driver sees the different schemas
and how often each occurs, and the names of files only in inputs that hold several schemas.

A column's types in all files have a least type that holds all of them: whole numbers widen among
themselves, to doubles (or decimals) with fractions, dates to timestamps; values of different kinds
meet as text. Types without a text, structs and lists and maps, only go with themselves: of a column
that has them beside other types, the type of most files stays and the files of the others are diverted.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casebook.workspace import write_table

INPUT, FILE = "input", "file"
FOOTERS = f"{INPUT} string, {FILE} string, schema string, n_rows long"


def plain_path(path: str) -> str:
    """A full path without the slashes that its writers differ in."""
    path = path.rstrip("/")
    return "file:/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path


def full_path(spark: SparkSession, path: str) -> str:
    """The path with its file system, as the session resolves it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return plain_path(place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString())


def file_of_row() -> Column:
    """The file a row was read from, as ``plain_path`` writes it."""
    decoded = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def footers(spark: SparkSession, inputs: Iterable[str]) -> DataFrame:
    """input (as it was named), file, schema (Spark's JSON, all columns nullable) and n_rows of every file.

    Inputs are files or folders with data files at any depth. A file that is no Parquet file has no schema;
    one of no bytes is passed over, as Spark's readers do.
    """
    names = {full_path(spark, name): name for name in inputs}
    if not names:
        return spark.createDataFrame([], FOOTERS)
    local = all(path.startswith("file:") for path in names)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(names))
    listed = listed.select("path", (F.lit(None).cast("binary") if local else F.col("content")).alias("content"))
    return listed.mapInArrow(_reader_of(names), FOOTERS)


def _reader_of(names: dict[str, str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What a task does with paths and contents; it needs no module of this package there.

    names: the inputs by their full paths.
    """

    def footer(source) -> tuple[str | None, int | None]:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema

        try:
            with pq.ParquetFile(source) as file:
                meta = file.metadata
                own = (meta.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
                schema = T.StructType.fromJson(json.loads(own)) if own else from_arrow_schema(file.schema_arrow)
                nullable = T.StructType([T.StructField(field.name, field.dataType) for field in schema])
                return nullable.json(), meta.num_rows
        except pa.ArrowInvalid:
            return None, None

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            found: list[list] = [[], [], [], []]
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                local = path.removeprefix("file:")
                file = path if local == path else "file:/" + local.lstrip("/")
                owner = file
                while owner not in names and "/" in owner:
                    owner = owner.rsplit("/", 1)[0]
                source = pa.BufferReader(content.as_buffer()) if content.is_valid else "/" + local.lstrip("/")
                for column, value in zip(found, (names.get(owner, owner), file, *footer(source)), strict=True):
                    column.append(value)
            columns = [pa.array(x, kind) for x, kind in zip(found, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["input", "file", "schema", "n_rows"])

    return rows


def read_files(spark: SparkSession, schema: T.StructType, known: DataFrame, name: str = "source") -> DataFrame:
    """All rows of the files that ``known`` (input and file) holds, with ``name``, the input they came from.

    known: a written table of files of one schema. An input whose files are all known is read as a
    folder; ``known`` decides by file what stays.
    """
    paths = [row[0] for row in known.select("place").distinct().collect()]
    if not paths:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(name, T.StringType())]))
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*paths)
    rows = rows.withColumn("_file", file_of_row())
    return rows.join(known.select(F.col(FILE).alias("_file"), F.col(INPUT).alias(name)), "_file").drop("_file")


def with_places(found: DataFrame) -> DataFrame:
    """footers with ``place``: what to read for a file, its whole input if all of that has one schema."""
    uniform = found.groupBy(INPUT).agg(
        (F.min(F.coalesce("schema", F.lit(""))) == F.max(F.coalesce("schema", F.lit("")))).alias("uniform")
    )
    place = F.when(F.col("uniform"), F.col(INPUT)).otherwise(F.col(FILE))
    return found.join(uniform, INPUT).withColumn("place", place).drop("uniform")


def schema_classes(found: DataFrame) -> list[tuple[str | None, T.StructType | None, int]]:
    """The different schemas with their JSON and the number of files, in a fixed order."""
    rows = found.groupBy("schema").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("schema").asc_nulls_last()).collect()
    return [(row.schema, T.StructType.fromJson(json.loads(row.schema)) if row.schema else None, row.n) for row in rows]


# The lattice


_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
_TIMES = [T.DateType(), T.TimestampNTZType(), T.TimestampType()]


def _is_nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StructType, T.ArrayType, T.MapType))


def least_common(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The least type that holds the values of both, exactly or as text; None if there is none.

    Whole numbers beside doubles would lose digits from 2**53 on, so long with double is text.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if _is_nested(a) or _is_nested(b):
        return None
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    if a in _TIMES and b in _TIMES:
        return max(a, b, key=_TIMES.index)
    binary = isinstance(a, T.BinaryType) or isinstance(b, T.BinaryType)
    if binary:
        return None
    for x, y in ((a, b), (b, a)):
        if isinstance(x, T.DoubleType) and (isinstance(y, T.FloatType) or y in _WHOLE[:3]):
            return x
        if isinstance(x, T.FloatType) and y in _WHOLE:
            return T.DoubleType() if y in _WHOLE[:3] else T.StringType()
        if isinstance(x, T.DecimalType) and y in _WHOLE:
            whole = max(x.precision - x.scale, _DIGITS[y])
            return T.DecimalType(whole + x.scale, x.scale) if whole + x.scale <= 38 else T.StringType()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.StringType()
    return T.StringType()


def reconciled(classes: list[tuple[T.StructType, int]]) -> tuple[T.StructType, dict[str, set[str]]]:
    """The common schema of some schemas with their numbers of files, and the types it diverts by column.

    Columns are in order of first appearance, the schema of most files first.
    """
    ordered = sorted(classes, key=lambda one: (-one[1], one[0].json()))
    votes: dict[str, dict[str, list]] = {}
    for schema, n in ordered:
        for field in schema:
            entry = votes.setdefault(field.name, {}).setdefault(field.dataType.json(), [field.dataType, 0])
            entry[1] += n
    fields, diverted = [], {}
    for name, kinds in votes.items():
        ranked = sorted(kinds.values(), key=lambda kind: (-kind[1], kind[0].json()))
        # text and numbers go together; a nested or binary type only with itself: the side of most files stays
        sides: list[list] = []
        for kind, n in ranked:
            side = next((s for s in sides if least_common(s[0], kind) is not None), None)
            if side is None:
                sides.append([kind, n, {kind.json()}])
            else:
                side[0], side[1] = least_common(side[0], kind), side[1] + n
                side[2].add(kind.json())
        best = max(sides, key=lambda side: side[1])
        fields.append(T.StructField(name, best[0]))
        others = set().union(*[side[2] for side in sides if side is not best])
        if others:
            diverted[name] = others
    return T.StructType(fields), diverted


def as_common(rows: DataFrame, common: T.StructType) -> DataFrame:
    """The rows in the common schema; lacking columns are NULL. Widening loses nothing, so casts cannot fail."""
    held = {field.name: field.dataType for field in rows.schema}
    columns = []
    for field in common:
        value = F.col(f"`{field.name}`") if field.name in held else F.lit(None)
        if held.get(field.name) != field.dataType:
            value = value.cast(field.dataType)
        columns.append(value.alias(field.name))
    return rows.select(*columns, *[name for name in rows.columns if name not in {f.name for f in common} and name == "source"])


class FileSet:
    """Files of inputs whose types may differ from file to file, as one table."""

    def __init__(self, spark: SparkSession, inputs: Iterable[str]):
        self.spark = spark
        self.found = write_table(with_places(footers(spark, inputs)), "footers")
        self.classes = [(text, schema, n) for text, schema, n in schema_classes(self.found) if schema is not None]
        self.common, self.diverted = reconciled([(schema, n) for _, schema, n in self.classes])

    def diverts(self, schema: T.StructType) -> bool:
        return any(field.dataType.json() in self.diverted.get(field.name, ()) for field in schema)

    def _read(self, wanted: bool) -> list[tuple[T.StructType, DataFrame]]:
        """Files that are read as the common table, or those that are diverted: one scan for each schema."""
        parts = []
        for text, schema, _ in self.classes:
            if self.diverts(schema) != wanted:
                known = self.found.where(F.col("schema") == text)
                parts.append((schema, read_files(self.spark, schema, known)))
        return parts

    def table(self) -> DataFrame:
        """All rows of the files that go together, in the common schema, with ``source``, their input."""
        parts = [as_common(rows, self.common) for _, rows in self._read(True)]
        if not parts:
            return self.spark.createDataFrame([], T.StructType([*self.common.fields, T.StructField("source", T.StringType())]))
        return reduce(DataFrame.unionByName, parts)

    def report(self) -> DataFrame:
        """One row for each file and column of the common schema: its type there, the common one, and what was done.

        action: ``kept``, ``widened``, ``absent`` (NULL for the file's rows) or ``diverted`` (the whole
        file); ``no parquet`` for a file without a schema, which has one row.
        """
        cells = []
        for text, schema, _ in self.classes:
            held = {field.name: field.dataType for field in schema}
            out = self.diverts(schema)
            for field in self.common:
                own = held.get(field.name)
                bad = own is not None and own.json() in self.diverted.get(field.name, ())
                action = "diverted" if bad else "absent" if own is None else "kept" if own == field.dataType else "widened"
                cells.append((text, field.name, own.simpleString() if own else None, field.dataType.simpleString(), action, out))
        kind = "schema string, column_name string, file_type string, common_type string, action string, file_diverted boolean"
        # one row for each different schema and column
        known = self.spark.createDataFrame(cells, kind)
        rows = self.found.select(INPUT, FILE, "schema", "n_rows").join(known, "schema", "left").drop("schema")
        return rows.fillna("no parquet", ["action"]).fillna(True, ["file_diverted"])

    def diverted_rows(self, path: str) -> None:
        """Write the rows of the diverted files as they are, one folder for each schema."""
        for number, (_, rows) in enumerate(self._read(False)):
            rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/schema={number}")
