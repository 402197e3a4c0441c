"""The fitted preparation: clean, encode, split, treat outliers, scale, balance, select."""

from __future__ import annotations

import json
from collections.abc import Sequence
from copy import copy as shallow_copy

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.operators.balancing import STRATEGIES as BALANCING
from tabloom.operators.balancing import balance
from tabloom.operators.cleaning import Cleaning
from tabloom.operators.columns import align_columns, columns_of_type, guard_compatible, require_columns
from tabloom.operators.encoding import (
    ACCIDENT_PERIODS,
    LIGHTING_ORDER,
    CyclicByPeriod,
    FrequencyEncoder,
    OneHot,
    PlaceEncoder,
    encode_binary,
    encode_calendar,
    ordinal_encode,
)
from tabloom.operators.outliers import Outliers
from tabloom.operators.sampling import tag_split
from tabloom.operators.scaling import Scaling
from tabloom.operators.selection import FeatureSelection
from tabloom.operators.stages import FittedStage, load_stage
from tabloom.operators.vartypes import variable_types
from tabloom.session import materialize


class OrdinalStage(FittedStage):
    def _transform(self, df: DataFrame) -> DataFrame:
        return ordinal_encode(df, self.state["mappings"])


class CalendarStage(FittedStage):
    def _transform(self, df: DataFrame) -> DataFrame:
        return encode_calendar(df)


class BinaryStage(FittedStage):
    """0/1 from booleans and fixed two-valued texts."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return encode_binary(df, self.state["mappings"])


class PreparationModel(Model):
    """Everything a preparation learned; the same transform serves tables, single rows and streams."""

    def __init__(self, state: dict, stages: list[FittedStage], scaler: FittedStage | None, selector: FittedStage | None,
                 prepared: DataFrame | None = None):
        super().__init__()
        self.state, self.stages, self.scaler, self.selector, self.prepared = state, stages, scaler, selector, prepared

    @property
    def features(self) -> list[str]:
        return self.state["features"]

    def encode(self, df: DataFrame) -> DataFrame:
        for stage in self.stages:
            df = stage.transform(df)
        return df

    def _transform(self, df: DataFrame) -> DataFrame:
        key, target = self.state["key"], self.state["target"]
        encoded = self.encode(df)
        has_target = target in df.columns
        present = set(encoded.columns)
        scaled = encoded.withColumns({c: F.lit(0.0) for c in self.state["scaled"] if c not in present})
        if self.scaler is not None:
            scaled = self.scaler.transform(scaled)
        if self.selector is not None:
            scaled = self.selector.transform(scaled)
        kept = [c for c in (key, target) if c in scaled.columns and (c != target or has_target)]
        aligned = align_columns(scaled, [*kept, *self.features])
        if not aligned.isStreaming and self.state["guard"]:
            guard_compatible(aligned, self.features)
        return aligned

    def save(self, spark: SparkSession, path: str) -> None:
        parts = {f"stage{i}": s for i, s in enumerate(self.stages)}
        if self.scaler is not None:
            parts["scaler"] = self.scaler
        if self.selector is not None:
            parts["selector"] = self.selector
        for name, stage in parts.items():
            stage.save(spark, f"{path}/{name}")
        spec = {"state": self.state, "stages": len(self.stages), "parts": sorted(parts)}
        spark.createDataFrame([(json.dumps(spec),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/spec")


def load_preparation(spark: SparkSession, path: str) -> PreparationModel:
    spec = json.loads(spark.read.text(f"{path}/spec").first()[0])
    stages = [load_stage(spark, f"{path}/stage{i}") for i in range(spec["stages"])]
    scaler = load_stage(spark, f"{path}/scaler") if "scaler" in spec["parts"] else None
    selector = load_stage(spark, f"{path}/selector") if "selector" in spec["parts"] else None
    return PreparationModel(spec["state"], stages, scaler, selector)


class Preparation(Estimator):
    """Configuration of a preparation; ``fit`` returns the model with its prepared splits.

    ``encoders`` are fitted in order after cleaning.  Outliers, balancing and
    selection look at training rows only; the split stays visible as a column,
    so synthetic rows cannot reach the test rows.
    """

    def __init__(
        self,
        *,
        key: str,
        target: str,
        cleaning: Cleaning | None = None,
        encoders: Sequence[Estimator | FittedStage] = (),
        outliers: str | None = None,
        scaling: str | None = None,
        balancing: str | None = None,
        feature_selection: str | None = None,
        min_threshold: float = 0.4,
        max_threshold: float = 0.45,
        test_size: float = 0.3,
        seed: int = 42,
        guard: bool = True,
    ):
        super().__init__()
        if balancing is not None and balancing not in BALANCING:
            raise ValueError(f"balancing strategy {balancing} not recognized")
        self.key, self.target = key, target
        self.cleaning, self.encoders = cleaning, list(encoders)
        self.outliers, self.scaling = outliers, scaling
        self.balancing, self.feature_selection = balancing, feature_selection
        self.min_threshold, self.max_threshold = min_threshold, max_threshold
        self.test_size, self.seed, self.guard = test_size, seed, guard

    def _fit(self, df: DataFrame) -> PreparationModel:
        key, target = self.key, self.target
        require_columns(df, [key, target])
        stages: list[FittedStage] = []
        current = df
        types = variable_types(df)
        if self.cleaning is not None:
            cleaning = shallow_copy(self.cleaning)
            cleaning.keep = self.cleaning.keep | {key, target}
            cleaning.types = self.cleaning.types or types
            stages.append(cleaning.fit(current))
            current = stages[-1].transform(current)
        for encoder in self.encoders:
            stage = encoder if isinstance(encoder, FittedStage) else encoder.fit(current)
            stages.append(stage)
            current = stage.transform(current)

        numeric = [c for c in columns_of_type(current, "number") if c not in (key, target)]
        current = current.select(key, *numeric, target)
        # Several learning passes follow, so the encoded table is written once.
        current = materialize(tag_split(current, key, self.test_size, self.seed), "encoded")
        train = current.filter("split = 'train'").drop("split")
        test = current.filter("split = 'test'").drop("split")
        if self.outliers:
            # Two-valued columns (one-hot, flags) have no outliers.
            measured = variable_types(train.select(*numeric))["numeric"]
            train = Outliers(self.outliers, columns=measured).fit(train).transform(train)
        scaler = selector = None
        if self.scaling:
            scaler = Scaling(self.scaling, numeric, target).fit(train)
            train, test = scaler.transform(train), scaler.transform(test)
        if self.balancing:
            train = balance(train, target, key, self.balancing, features=numeric, seed=self.seed)
        if self.feature_selection:
            selector = FeatureSelection(
                self.feature_selection, target, min_threshold=self.min_threshold, max_threshold=self.max_threshold,
                exclude=[key],
            ).fit(train)
            train, test = selector.transform(train), selector.transform(test)
        dropped = set(selector.state["dropped"]) if selector else set()
        features = [c for c in numeric if c not in dropped]
        order = [key, *features, target]
        prepared = train.select(*order).withColumn("split", F.lit("train")).unionByName(
            test.select(*order).withColumn("split", F.lit("test")))
        state = {
            "key": key, "target": target, "features": features, "scaled": numeric if self.scaling else [],
            "types": types, "input_columns": df.columns, "guard": self.guard,
        }
        return PreparationModel(state, stages, scaler, selector, prepared)


def flights_preparation(key: str, target: str = "Cancelled", **options) -> Preparation:
    """The settings for the flights table."""
    # Name patterns and columns the flights cleaning drops, and its thresholds.
    cleaning = Cleaning(
        drop_patterns=["Flight_Num", "Code", "Div", "Wac", "Fips", "Marketing", "Tail"],
        drop_names=["OriginStateName", "DestStateName", "Operating_Airline"],
        time_columns=["CRSDepTime", "CRSArrTime"],
    )
    encoders = [
        PlaceEncoder([("OriginState", "OriginCityName", "OriginGeoNum"), ("DestState", "DestCityName", "DestGeoNum")]),
        OneHot(["Airline"]),
        CalendarStage(),
        BinaryStage({"mappings": {}}),
        FrequencyEncoder(["Origin", "Dest"]),
    ]
    return Preparation(key=key, target=target, cleaning=cleaning, encoders=encoders,
                       **{"min_threshold": 0.7, "max_threshold": 0.18, **options})


def accidents_preparation(key: str, target: str = "crash_type", **options) -> Preparation:
    """The settings for the accidents table."""
    # Leakage columns, one-hot columns and two-valued texts of the accidents table.
    cleaning = Cleaning(
        drop_patterns=["injur"], drop_names=["damage", "crash_month"], date_columns=["crash_date"],
        drop_null_columns=False, drop_constant=False,
    )
    encoders = [
        OrdinalStage({"mappings": {"lighting_condition": LIGHTING_ORDER}}),
        OneHot([
            "alignment", "trafficway_type", "traffic_control_device", "weather_condition", "first_crash_type",
            "roadway_surface_cond", "road_defect", "prim_contributory_cause",
        ]),
        CyclicByPeriod(ACCIDENT_PERIODS, ranked=["crash_date_year"]),
        BinaryStage({"mappings": {
            "intersection_related_i": {"N": 0, "Y": 1},
            "crash_type": {"NO INJURY / DRIVE AWAY": 0, "INJURY AND / OR TOW DUE TO CRASH": 1},
        }}),
    ]
    return Preparation(key=key, target=target, cleaning=cleaning, encoders=encoders, **options)
