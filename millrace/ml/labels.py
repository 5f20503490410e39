"""Numbers for the labels of several columns as one stage that can be saved and loaded.

The labels are a table, so their number is not bounded by one machine's memory: fitting counts
the labels of all columns in one pass and numbers them with one sort, scoring joins."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import row_position
from millrace.scratch import keep


class _Columns(Params):
    inputs = Param(Params._dummy(), "inputs", "columns with labels", TypeConverters.toListString)
    outputs = Param(Params._dummy(), "outputs", "columns for their numbers", TypeConverters.toListString)

    def pairs(self) -> list[tuple[str, str]]:
        return list(zip(self.getOrDefault(self.inputs), self.getOrDefault(self.outputs)))


class LabelNumbers(Estimator, _Columns, MLReadable, MLWritable):
    """Most frequent label of a column is 0, ties alphabetical; nulls are no labels."""

    @keyword_only
    def __init__(self, *, inputs: list[str] | None = None, outputs: list[str] | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> "LabelNumbersModel":
        each = F.array(*[F.struct(F.lit(i).alias("column"), F.col(c).cast("string").alias("label")) for i, (c, _) in enumerate(self.pairs())])
        # rows that agree in all columns are counted before they become a row for each column
        alike = df.groupBy(*dict.fromkeys(c for c, _ in self.pairs())).agg(F.count("*").alias("__rows"))
        counts = (
            alike.select("__rows", F.inline(each)).where(F.col("label").isNotNull())
            .groupBy("column", "label").agg((-F.sum("__rows")).alias("__n"))
        )
        numbered = row_position(counts, ["column"], ["__n", "label"], "position")
        labels = keep(numbered.select("column", "label", (F.col("position") - 1).cast("double").alias("number")), "labels")
        sizes = {r["column"]: r["n"] for r in labels.groupBy("column").agg(F.count("*").alias("n")).collect()}
        model = LabelNumbersModel(labels, [sizes.get(i, 0) for i in range(len(self.pairs()))])
        return self._copyValues(model)

    def write(self) -> MLWriter:
        return DefaultParamsWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return DefaultParamsReader(cls)


class LabelNumbersModel(Model, _Columns, MLReadable, MLWritable):
    """Adds each column's number; rows with a null or unknown label drop out.

    The new columns say how many categories there are, so that later stages need not look."""

    def __init__(self, labels: DataFrame | None = None, sizes: list[int] | None = None):
        super().__init__()
        self.labels, self.sizes = labels, sizes or []

    def _transform(self, df: DataFrame) -> DataFrame:
        names = df.columns
        for i, ((column, out), size) in enumerate(zip(self.pairs(), self.sizes)):
            about = {"ml_attr": {"type": "nominal", "name": out, "num_vals": size}}
            own = self.labels.where(F.col("column") == i).select(F.col("label").alias("__label"), F.col("number").alias("__number"))
            df = df.join(own, F.col(column).cast("string") == F.col("__label"))
            names = [n for n in names if n != out]
            df = df.select(*names, F.col("__number").alias(out, metadata=about))
            names.append(out)
        return df

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: LabelNumbersModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"sizes": self.model.sizes})
        self.model.labels.write.mode("error").parquet(f"{path}/labels")


class _Reader(MLReader):
    def load(self, path: str) -> LabelNumbersModel:
        spark = self.sparkSession
        about = DefaultParamsReader.loadMetadata(path, spark)
        labels = spark.read.schema("column int, label string, number double").parquet(f"{path}/labels")
        model = LabelNumbersModel(labels, [int(n) for n in about["sizes"]])
        model._resetUid(about["uid"])
        DefaultParamsReader.getAndSetParams(model, about)
        return model
