"""Feature selection by variance or redundancy, fitted on the training rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator
from pyspark.sql import DataFrame

from tabloom.operators.aggregates import low_variance
from tabloom.operators.columns import columns_of_type
from tabloom.operators.correlation import correlations, redundant_variables
from tabloom.operators.stages import FittedStage

STRATEGIES = ("lowvar", "redundant")


class SelectionModel(FittedStage):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.state["dropped"])


class FeatureSelection(Estimator):
    """Learn the columns to drop: ``lowvar`` below ``max_threshold``, ``redundant`` from ``min_threshold`` on."""

    def __init__(self, strategy: str, target: str, *, min_threshold: float = 0.4, max_threshold: float = 0.45,
                 rule: str = "earlier", exclude: Sequence[str] = ()):
        super().__init__()
        if strategy not in STRATEGIES:
            raise ValueError(f"selection strategy {strategy} not recognized")
        self.strategy, self.target, self.rule, self.exclude = strategy, target, rule, set(exclude)
        self.min_threshold, self.max_threshold = min_threshold, max_threshold

    def _fit(self, df: DataFrame) -> SelectionModel:
        names = [c for c in columns_of_type(df, "number") if c != self.target and c not in self.exclude]
        if self.strategy == "lowvar":
            dropped = low_variance(df, self.max_threshold, self.target, names)
        else:
            dropped = redundant_variables(correlations(df, names), names, self.min_threshold, self.rule)
        return SelectionModel({"dropped": dropped})


def select_features(train: DataFrame, test: DataFrame, strategy: str, target: str, **options) -> tuple[DataFrame, DataFrame]:
    """Drop the same columns from both splits."""
    model = FeatureSelection(strategy, target, **options).fit(train)
    return model.transform(train), model.transform(test)
