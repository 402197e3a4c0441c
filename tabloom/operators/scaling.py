"""Min-max and z-score scaling with state learned on the training rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators.columns import columns_of_type
from tabloom.operators.stages import FittedStage

STRATEGIES = ("minmax", "zscore")


class ScalingModel(FittedStage):
    """``(x - shift) / scale``; a constant column becomes 0 and nothing is clipped."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({
            c: (F.col(c).cast("double") - F.lit(shift)) / F.lit(scale)
            for c, (shift, scale) in self.state["columns"].items() if c in df.columns
        })


class Scaling(Estimator):
    """Learn shift and scale of the numeric features; the target is left alone."""

    def __init__(self, strategy: str = "minmax", columns: Sequence[str] | None = None, target: str | None = None):
        super().__init__()
        if strategy not in STRATEGIES:
            raise ValueError(f"scaling strategy {strategy} not recognized")
        self.strategy, self.columns, self.target = strategy, columns, target

    def _fit(self, df: DataFrame) -> ScalingModel:
        names = [c for c in (self.columns or columns_of_type(df, "number")) if c != self.target]
        if not names:
            raise ValueError("no numeric features to scale")
        exprs = []
        for i, c in enumerate(names):
            x = F.col(c).cast("double")
            if self.strategy == "minmax":
                exprs += [F.min(x).alias(f"a{i}"), (F.max(x) - F.min(x)).alias(f"b{i}")]
            else:
                exprs += [F.avg(x).alias(f"a{i}"), F.stddev_pop(x).alias(f"b{i}")]
        row = df.agg(*exprs).first()
        learned = {c: (row[f"a{i}"] or 0.0, row[f"b{i}"] or 1.0) for i, c in enumerate(names)}
        return ScalingModel({"strategy": self.strategy, "columns": learned})


def scale_splits(train: DataFrame, test: DataFrame, strategy: str = "minmax", *, target: str | None = None,
                 columns: Sequence[str] | None = None, fit_per_split: bool = False) -> tuple[DataFrame, DataFrame]:
    """Scale both splits with the training state, or each with its own if ``fit_per_split``."""
    stage = Scaling(strategy, columns, target)
    model = stage.fit(train)
    return model.transform(train), (stage.fit(test) if fit_per_split else model).transform(test)
