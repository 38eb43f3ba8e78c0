"""D11 — mode imputation of text columns as a pyspark.ml estimator with persistence (Spark's Imputer takes numbers only)."""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class _Columns(HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    blanks = Param(Params._dummy(), "blanks", "texts that count as missing beside null", typeConverter=TypeConverters.toListString)

    def missing(self, column: str):
        return F.col(column).isNull() | F.col(column).isin(*self.getOrDefault(self.blanks))


class ModeImputer(Estimator, _Columns):
    """Learns the most frequent value of each column (the smallest of equally frequent ones) from the rows it is fitted on."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, blanks=None):
        super().__init__()
        self._setDefault(blanks=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> ModeImputerModel:
        columns = self.getInputCols()
        kept = dataset.select(*[F.when(~self.missing(c), F.col(c).cast("string")).alias(c) for c in columns])
        counts = kept.unpivot([], columns, "column", "value").where("value is not null").groupBy("column", "value").agg(F.count("*").alias("n"))
        best = counts.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))
        modes = {r["column"]: r["mode"] for r in best.collect()}  # a row per column
        if missing := [c for c in columns if c not in modes]:
            raise ValueError(f"no value to learn a mode from in {missing}")
        return self._copyValues(ModeImputerModel().setModes(modes))


class ModeImputerModel(Model, _Columns):
    modes = Param(Params._dummy(), "modes", "column to mode, as JSON", typeConverter=TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(blanks=[], modes="{}")

    def setModes(self, modes: dict[str, str]) -> ModeImputerModel:
        return self._set(modes=json.dumps(modes, sort_keys=True))

    def getModes(self) -> dict[str, str]:
        return json.loads(self.getOrDefault(self.modes))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        modes = self.getModes()
        return dataset.withColumns({out: F.when(self.missing(c), F.lit(modes[c])).otherwise(F.col(c).cast("string"))
                                    for c, out in zip(self.getInputCols(), self.getOutputCols(), strict=True)})
