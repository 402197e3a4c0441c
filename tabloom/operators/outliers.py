"""Outlier treatment with limits learned once per table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.aggregates import describe, outlier_limits
from tabloom.operators.columns import keep_unless, outside
from tabloom.operators.stages import FittedStage
from tabloom.operators.vartypes import variable_types

STRATEGIES = ("discard", "truncate", "fixed")


class OutlierModel(FittedStage):
    """Discard rows, clamp values, or put the median in place of values outside the limits.

    Null values are inside: a row with an unknown value is never discarded for it.
    """

    def _transform(self, df: DataFrame) -> DataFrame:
        limits = {c: v for c, v in self.state["limits"].items() if c in df.columns and v["top"] is not None}
        if not limits:
            return df
        if self.state["strategy"] == "discard":
            flags = [outside(F.col(c), v["bottom"], v["top"]) for c, v in limits.items()]
            return keep_unless(df, reduce(lambda a, b: a | b, [F.coalesce(f, F.lit(False)) for f in flags]))
        out = {}
        for c, v in limits.items():
            x = F.col(c).cast("double")
            if self.state["strategy"] == "truncate":
                out[c] = F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(v["bottom"])), F.lit(v["top"])))
            else:
                out[c] = F.when(outside(x, v["bottom"], v["top"]), F.lit(v["median"])).otherwise(x)
        return df.withColumns(out)


class Outliers(Estimator):
    """Learn the limits by quartiles (factor 7) or by mean and std (factor 2)."""

    def __init__(self, strategy: str = "discard", *, std_based: bool = False, factor: float | None = None,
                 columns: Sequence[str] | None = None):
        super().__init__()
        if strategy not in STRATEGIES:
            raise ValueError(f"outlier strategy {strategy} not recognized")
        self.strategy, self.std_based = strategy, std_based
        self.factor = factor if factor is not None else (2.0 if std_based else 7.0)
        self.columns = columns

    def _fit(self, df: DataFrame) -> OutlierModel:
        columns = list(self.columns) if self.columns is not None else variable_types(df)["numeric"]
        limits = {}
        for c, s in describe(df, columns).items():
            bottom, top = outlier_limits(s, std_based=self.std_based, threshold=self.factor)
            limits[c] = {"bottom": bottom, "top": top, "median": s["q50"]}
        return OutlierModel({"strategy": self.strategy, "limits": limits})
