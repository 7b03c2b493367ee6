"""Feature stages that MLlib lacks. Fitted state lives in params or in a table saved with the stage."""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
)
from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.functions.columns import as_timestamp, elapsed_days
from casebook.operators.frequency import (
    ROWS_PER_TASK,
    attach_counts,
    encode_frequencies,
    fitted_modes,
    frequency_table,
    hot_by_column,
    impute_modes,
    ranked_values,
)
from casebook.workspace import write_table


class _Columns(HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Input and output columns with setters, shared by all stages."""

    def setInputCols(self, value: list[str]):
        return self._set(inputCols=value)

    def setOutputCols(self, value: list[str]):
        return self._set(outputCols=value)

    def _outputs(self) -> dict[str, str]:
        return dict(zip(self.getInputCols(), self.getOutputCols(), strict=True))


class ElapsedDays(Transformer, _Columns):
    """Turn two date columns into timestamps and add the days between them."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        start, end = self.getInputCols()
        (output,) = self.getOutputCols()
        days = elapsed_days(start, end)
        return dataset.withColumns({start: as_timestamp(start), end: as_timestamp(end), output: days})


class ModeImputer(Estimator, _Columns):
    """Fill NULL with the most frequent value of the column."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ModeImputerModel:
        names = self.getInputCols()
        modes = fitted_modes(dataset, names)
        model = ModeImputerModel(fillValues=[modes[name] for name in names])
        return self._copyValues(model)


class ModeImputerModel(Model, _Columns):
    fillValues = Param(
        Params._dummy(), "fillValues", "value for NULL, per input column", typeConverter=TypeConverters.toListString
    )

    @keyword_only
    def __init__(self, *, fillValues: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        modes = dict(zip(self.getInputCols(), self.getOrDefault(self.fillValues), strict=True))
        return impute_modes(dataset, self._outputs(), modes)


class _Unseen(Params):
    unseen = Param(
        Params._dummy(),
        "unseen",
        "rows whose value is NULL or was not counted: 'drop' them or encode as 'zero'",
        typeConverter=TypeConverters.toString,
    )


class FrequencyEncoder(Estimator, _Columns, _Unseen):
    """Replace values by how many rows of the fitted data hold them."""

    rowsPerTask = Param(
        Params._dummy(),
        "rowsPerTask",
        "rows of one value that a task of the lookup may get",
        typeConverter=TypeConverters.toInt,
    )

    @keyword_only
    def __init__(
        self,
        *,
        inputCols: list[str] | None = None,
        outputCols: list[str] | None = None,
        unseen: str = "drop",
        rowsPerTask: int = ROWS_PER_TASK,
    ):
        super().__init__()
        self._setDefault(unseen="drop", rowsPerTask=ROWS_PER_TASK)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> FrequencyEncoderModel:
        names = self.getInputCols()
        counts = write_table(frequency_table(dataset, names), "frequencies", ("column_name",))
        hot = hot_by_column(counts, self.getOrDefault(self.rowsPerTask))
        model = FrequencyEncoderModel(hotValues=json.dumps(hot))
        model.frequencies = counts
        return self._copyValues(model)


class _TableWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.frequencies.write.partitionBy("column_name").parquet(f"{path}/frequencies")


class _TableReader(DefaultParamsReader):
    def load(self, path: str) -> FrequencyEncoderModel:
        model = super().load(path)
        reader = self.sparkSession.read.schema("column_name string, value string, frequency long")
        model.frequencies = reader.parquet(f"{path}/frequencies")
        return model


class FrequencyEncoderModel(Model, _Columns, _Unseen):
    """The counts stay a distributed table: ``frequencies(column_name, value, frequency)``."""

    hotValues = Param(
        Params._dummy(), "hotValues", "very frequent values per column and their join keys, as JSON", typeConverter=TypeConverters.toString
    )

    frequencies: DataFrame

    @keyword_only
    def __init__(self, *, hotValues: str | None = None):
        super().__init__()
        self._setDefault(unseen="drop")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        hot = json.loads(self.getOrDefault(self.hotValues))
        return encode_frequencies(dataset, self.frequencies, self._outputs(), self.getOrDefault(self.unseen), hot)

    def write(self) -> _TableWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> _TableReader:
        return _TableReader(cls)


class CategoryEncoder(Estimator, _Columns):
    """One-hot vectors of columns with any number of categories.

    The index of the categories, by falling frequency, is a distributed table and no list in the model.
    A value that is NULL or was not there at fitting gets the zero vector.
    """

    rowsPerTask = Param(
        Params._dummy(),
        "rowsPerTask",
        "rows of one value that a task of the lookup may get",
        typeConverter=TypeConverters.toInt,
    )

    @keyword_only
    def __init__(
        self,
        *,
        inputCols: list[str] | None = None,
        outputCols: list[str] | None = None,
        rowsPerTask: int = ROWS_PER_TASK,
    ):
        super().__init__()
        self._setDefault(rowsPerTask=ROWS_PER_TASK)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> CategoryEncoderModel:
        counts = write_table(frequency_table(dataset, self.getInputCols()), "frequencies", ("column_name",))
        return self._copyValues(CategoryEncoderModel.from_counts(counts, self.getOrDefault(self.rowsPerTask)))


class _IndexWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.index.write.partitionBy("column_name").parquet(f"{path}/index")


class _IndexReader(DefaultParamsReader):
    def load(self, path: str) -> CategoryEncoderModel:
        model = super().load(path)
        schema = "value string, category_index long, size long, column_name string"
        model.index = self.sparkSession.read.schema(schema).parquet(f"{path}/index")
        return model


class CategoryEncoderModel(Model, _Columns):
    """The categories stay a distributed table: ``index(column_name, value, category_index, size)``."""

    sizes = Param(
        Params._dummy(), "sizes", "number of categories per column, as JSON", typeConverter=TypeConverters.toString
    )
    hotValues = Param(
        Params._dummy(), "hotValues", "very frequent values per column and their join keys, as JSON", typeConverter=TypeConverters.toString
    )

    index: DataFrame

    @keyword_only
    def __init__(self, *, sizes: str | None = None, hotValues: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    @classmethod
    def from_counts(
        cls, counts: DataFrame, rows_per_task: int = ROWS_PER_TASK, names: dict[str, str] | None = None
    ) -> CategoryEncoderModel:
        """From a written ``frequency_table``; names: under which input column each counted one is looked up."""
        index = write_table(ranked_values(counts), "category-index", ("column_name",))
        sizes = {row.column_name: row.n for row in index.groupBy("column_name").agg(F.max("size").alias("n")).collect()}
        hot = hot_by_column(counts, rows_per_task)
        if names:
            index = index.replace(names, subset=["column_name"])
            sizes, hot = ({names[name]: value for name, value in found.items()} for found in (sizes, hot))
        model = cls(sizes=json.dumps(sizes), hotValues=json.dumps(hot))
        model.index = index
        return model

    def _transform(self, dataset: DataFrame) -> DataFrame:
        sizes, hot = (json.loads(self.getOrDefault(param)) for param in (self.sizes, self.hotValues))
        for name, output in self._outputs().items():
            size, place = sizes.get(name, 0), f"_{output}_index"
            # places count from 1 in the lookup, so that 0 is for values without one
            known = self.index.where(F.col("column_name") == name)
            known = known.select("value", (F.col("category_index") + 1).alias("frequency"))
            dataset = attach_counts(dataset, known, name, place, "zero", hot.get(name))
            index = F.when(F.col(place) == 0, size).otherwise(F.col(place) - 1).cast("double")
            nominal = {"ml_attr": {"type": "nominal", "num_vals": size + 1}}
            dataset = dataset.withColumn(place, index).withMetadata(place, nominal)
            # the number of categories is known from the column, so this fit reads no data
            encoder = OneHotEncoder(inputCols=[place], outputCols=[output]).fit(dataset)
            # slots need no names: a name for each of very many would fill the plan
            dataset = encoder.transform(dataset).withMetadata(output, {"ml_attr": {"num_attrs": size}}).drop(place)
        return dataset

    def write(self) -> _IndexWriter:
        return _IndexWriter(self)

    @classmethod
    def read(cls) -> _IndexReader:
        return _IndexReader(cls)
