"""Base of the fitted stages: a Spark ML model with bounded state and lookup tables."""

from __future__ import annotations

import json

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession

_classes: dict[str, type] = {}


class FittedStage(Model):
    """A transformer whose learned facts can be saved.

    ``state`` holds JSON-serialisable facts of bounded size; ``tables`` holds
    lookups that may grow with the data and therefore stay DataFrames.
    """

    def __init__(self, state: dict | None = None, tables: dict[str, DataFrame] | None = None):
        super().__init__()
        self.state = state or {}
        self.tables = tables or {}

    def __init_subclass__(cls, **kwargs):
        super().__init_subclass__(**kwargs)
        _classes[cls.__name__] = cls

    def save(self, spark: SparkSession, path: str) -> None:
        spec = {"class": type(self).__name__, "state": self.state, "tables": sorted(self.tables)}
        spark.createDataFrame([(json.dumps(spec),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/stage")
        for name, table in self.tables.items():
            table.write.mode("overwrite").parquet(f"{path}/table_{name}")


def load_stage(spark: SparkSession, path: str) -> FittedStage:
    spec = json.loads(spark.read.text(f"{path}/stage").first()[0])
    tables = {name: spark.read.parquet(f"{path}/table_{name}") for name in spec["tables"]}
    return _classes[spec["class"]](spec["state"], tables)
