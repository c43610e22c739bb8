"""A string indexer whose fitted state is a table, for columns with any number of labels.

Spark ML's own indexer holds the labels of a column on the driver, in the model and in the column's metadata. Here the
estimator writes (label, label_index) to the shared folder, the model joins it, and saving a pipeline copies it into the
pipeline's folder. The numbers are the same: by falling frequency, ties by label.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasHandleInvalid, HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.operators.encode import label_index
from featureflow.operators.lookup import join_table
from featureflow.session import scratch_path

INVALID = ("error", "keep", "skip")


class _Columns(HasInputCols, HasOutputCols, HasHandleInvalid):
    def _checked(self) -> list[tuple[str, str]]:
        if self.getHandleInvalid() not in INVALID:
            raise ValueError(f"handleInvalid must be one of {INVALID}, not {self.getHandleInvalid()!r}")
        return list(zip(self.getInputCols(), self.getOutputCols(), strict=True))


class TableIndexer(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Numbers the labels of string columns. Null is no label.

    ``handleInvalid``, for nulls and labels that were not there when fitted: "error", "keep" (one number more than there
    are labels) or "skip" (such rows are left out).
    """

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] = (), outputCols: Sequence[str] = (), handleInvalid: str = "error") -> None:  # noqa: N803
        super().__init__()
        self._setDefault(handleInvalid="error")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TableIndexerModel:
        spark, tables = dataset.sparkSession, []
        for column, _ in self._checked():
            tables.append(scratch_path(spark, "labels"))
            label_index(dataset.select(F.col(column).alias("label")), "label").write.parquet(tables[-1])
        sizes = [spark.read.parquet(t).count() for t in tables]
        return self._copyValues(TableIndexerModel(tables, sizes))


class TableIndexerModel(Model, _Columns, MLReadable, MLWritable):
    """The fitted numbers. ``tables`` are the folders of (label, label_index), ``sizes`` how many labels each has."""

    tables = Param(Params._dummy(), "tables", "folders of the labels' numbers", TypeConverters.toListString)
    sizes = Param(Params._dummy(), "sizes", "number of labels per column", TypeConverters.toListInt)

    def __init__(self, tables: Sequence[str] = (), sizes: Sequence[int] = ()) -> None:
        super().__init__()
        self._setDefault(handleInvalid="error")
        self._set(tables=list(tables), sizes=list(sizes))

    def labels(self, spark: SparkSession, number: int = 0) -> DataFrame:
        """(label, label_index) of a column."""
        return spark.read.schema("label string, label_index bigint").parquet(self.getOrDefault(self.tables)[number])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spark, invalid, out = dataset.sparkSession, self.getHandleInvalid(), dataset
        for i, (column, output) in enumerate(self._checked()):
            size, number = self.getOrDefault(self.sizes)[i], f"__{output}"
            table = self.labels(spark, i).select(F.col("label").alias(column), F.col("label_index").cast("double").alias(number))
            out = join_table(out, table, [column])
            if invalid == "skip":
                out = out.where(F.col(number).isNotNull())
            elif invalid == "keep":
                out = out.withColumn(number, F.coalesce(number, F.lit(float(size))))
            else:
                message = F.concat(F.lit(f"Unseen label in {column}: "), F.coalesce(column, F.lit("null")))
                out = out.withColumn(number, F.coalesce(number, F.raise_error(message).cast("double")))
            # How many numbers there are, and no labels.
            nominal = {"type": "nominal", "name": output, "num_vals": size + (invalid == "keep")}
            out = out.withColumn(output, F.col(number).alias(output, metadata={"ml_attr": nominal})).drop(number)
        return out

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader()


class _TableWriter(MLWriter):
    """Parameters as metadata, tables beside it."""

    def __init__(self, model: TableIndexerModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:  # noqa: N802
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        for i in range(len(self.model.getInputCols())):
            self.model.labels(self.sparkSession, i).write.parquet(f"{path}/labels/{i}")


class _TableReader(MLReader):
    def load(self, path: str) -> TableIndexerModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = TableIndexerModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model._set(tables=[f"{path}/labels/{i}" for i in range(len(model.getInputCols()))])
