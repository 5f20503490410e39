"""Stages that look at few columns only, applied once to each distinct value and not to each row.

The values and what was made of them are a stored table that joins the rows, so neither is bounded by one
machine's memory.  Where all rows differ, that costs one shuffle of the values and one join more."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.scratch import keep


class _Values(Params):
    columns = Param(Params._dummy(), "columns", "columns that the stages look at", TypeConverters.toListString)


class EachValue(Estimator, _Values, MLReadable, MLWritable):
    """``stages`` are fitted to all rows, since it matters how often a value comes, and applied to the
    distinct values of ``columns``.  A row's result may depend on nothing else."""

    @keyword_only
    def __init__(self, *, columns: list[str] | None = None, stages: Sequence | None = None):
        super().__init__()
        self.stages = list(stages or [])
        if columns is not None:
            self._set(columns=columns)

    def _fit(self, df: DataFrame) -> "EachValueModel":
        return self._copyValues(EachValueModel(Pipeline(stages=self.stages).fit(df)))

    def write(self) -> MLWriter:
        return _Writer(self, Pipeline(stages=self.stages))

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls, lambda path: cls(stages=Pipeline.load(path).getStages()))


class EachValueModel(Model, _Values, MLReadable, MLWritable):
    """Adds the columns of the stages to every row; nulls are a value like others."""

    def __init__(self, fitted: PipelineModel | None = None):
        super().__init__()
        self.fitted = fitted

    def _transform(self, df: DataFrame) -> DataFrame:
        columns = self.getOrDefault(self.columns)
        made = keep(self.fitted.transform(df.select(*columns).distinct()), "values")
        own = made.withColumnsRenamed({c: f"__{c}" for c in columns})
        same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in columns]
        return df.join(own, same).drop(*[f"__{c}" for c in columns])

    def write(self) -> MLWriter:
        return _Writer(self, self.fitted)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls, lambda path: cls(PipelineModel.load(path)))


class _Writer(MLWriter):
    def __init__(self, stage: EachValue | EachValueModel, inner: Pipeline | PipelineModel):
        super().__init__()
        self.stage, self.inner = stage, inner

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        self.inner.write().save(f"{path}/stages")


class _Reader(MLReader):
    def __init__(self, kind: type, made):
        super().__init__()
        self.kind, self.made = kind, made

    def load(self, path: str) -> EachValue | EachValueModel:
        about = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.made(f"{path}/stages")
        stage._resetUid(about["uid"])
        DefaultParamsReader.getAndSetParams(stage, about)
        return stage
