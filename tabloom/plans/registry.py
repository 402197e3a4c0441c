"""Saved models with one default, batch scoring and evaluation."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    GBTClassificationModel,
    LogisticRegressionModel,
    MultilayerPerceptronClassificationModel,
    RandomForestClassificationModel,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.operators.metrics import metrics_long, wide_metrics
from tabloom.operators.sampling import split_flag
from tabloom.plans.neighbor_model import NeighborModel
from tabloom.plans.prep import PreparationModel, load_preparation
from tabloom.plans.studies import ForestPrefix
from tabloom.session import local_table

_MODELS = {
    c.__name__: c
    for c in (
        PipelineModel, DecisionTreeClassificationModel, GBTClassificationModel, LogisticRegressionModel,
        MultilayerPerceptronClassificationModel, RandomForestClassificationModel,
    )
}


def write_json(spark: SparkSession, value: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(value),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


def save_model(spark: SparkSession, model: Transformer, path: str, params: dict | None = None) -> None:
    """Write a model and, beside it, the hyperparameters it was chosen with."""
    if isinstance(model, NeighborModel):
        kind = {"class": "NeighborModel", "neighbors": model.save(spark, f"{path}/model")}
    else:
        inner = model.model if isinstance(model, ForestPrefix) else model
        inner.write().overwrite().save(f"{path}/model")
        kind = {"class": type(inner).__name__, "size": model.size if isinstance(model, ForestPrefix) else None}
    write_json(spark, {**kind, "params": params or {}}, f"{path}/kind")


def load_model(spark: SparkSession, path: str) -> Transformer:
    kind = read_json(spark, f"{path}/kind")
    if kind["class"] == "NeighborModel":
        return NeighborModel.load(spark, f"{path}/model", kind["neighbors"])
    model = _MODELS[kind["class"]].load(f"{path}/model")
    return ForestPrefix(model, kind["size"]) if kind["size"] else model


def load_params(spark: SparkSession, path: str) -> dict:
    """The hyperparameters saved beside a model."""
    return read_json(spark, f"{path}/kind").get("params", {})


@dataclass
class ModelRegistry:
    """A preparation, named models with their parameters, and a default name."""

    preparation: PreparationModel
    models: dict[str, Transformer] = field(default_factory=dict)
    hyperparams: dict[str, dict] = field(default_factory=dict)
    default_model: str | None = None
    test_size: float = 0.25

    def add(self, name: str, model: Transformer, params: dict | None = None, *, default: bool = False) -> None:
        self.models[name] = model
        self.hyperparams[name] = params or {}
        if default or self.default_model is None:
            self.default_model = name

    def list_models(self) -> list[str]:
        return list(self.models)

    def save(self, spark: SparkSession, path: str) -> None:
        self.preparation.save(spark, f"{path}/preparation")
        for name, model in self.models.items():
            save_model(spark, model, f"{path}/{name}", self.hyperparams.get(name))
        write_json(spark, {
            "models": self.list_models(), "hyperparams": self.hyperparams, "default": self.default_model,
        }, f"{path}/descriptor")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ModelRegistry:
        spec = read_json(spark, f"{path}/descriptor")
        models = {name: load_model(spark, f"{path}/{name}") for name in spec["models"]}
        return cls(load_preparation(spark, f"{path}/preparation"), models, spec["hyperparams"], spec["default"])

    def _assembled(self, df: DataFrame) -> DataFrame:
        prepared = self.preparation.transform(df)
        return VectorAssembler(inputCols=self.preparation.features, outputCol="features").transform(prepared)

    def predict(self, df: DataFrame, name: str | None = None) -> DataFrame:
        """(key, model, prediction) of a batch or streaming table."""
        chosen = name or self.default_model
        if chosen not in self.models:
            raise KeyError(f"model {chosen} not found")
        key = self.preparation.state["key"]
        scored = self.models[chosen].transform(self._assembled(df))
        return scored.select(key, F.lit(chosen).alias("model"), "prediction")

    def evaluate(self, df: DataFrame) -> DataFrame:
        """(model, split, metric, value, hyperparams) of every model on a 75/25 split of a labelled table.

        The features are made once; each model adds a column of predictions to
        the same rows, and all of them are counted in one pass.
        """
        key, target = self.preparation.state["key"], self.preparation.state["target"]
        flag = split_flag(key, 1 - self.test_size)
        wide = self._assembled(df).select(
            "features", F.col(target).cast("double").alias("label"),
            F.when(flag, F.lit("train")).otherwise(F.lit("test")).alias("split"),
        )
        columns = {}
        for i, (name, model) in enumerate(self.models.items()):
            kept = wide.columns
            columns[name] = f"_prediction{i}"
            wide = model.transform(wide).withColumnRenamed("prediction", columns[name]).select(*kept, columns[name])
        scores = metrics_long(wide_metrics(wide.drop("features"), "label", columns, ["split"]), ["model", "split"])
        params = local_table(df.sparkSession, [(n, json.dumps(self.hyperparams.get(n, {}), sort_keys=True)) for n in self.models], "model string, hyperparams string")
        return scores.join(F.broadcast(params), "model")
