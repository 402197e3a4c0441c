import random

import pytest
from pyspark.sql import functions as F

from tabloom.operators.cleaning import Cleaning
from tabloom.operators.encoding import LIGHTING_ORDER, FrequencyEncoder, OneHot
from tabloom.plans.experiment import ExperimentConfig, run_experiment
from tabloom.plans.prep import Preparation, accidents_preparation, flights_preparation, load_preparation
from tabloom.session import scratch_path


def flights(spark, n=300):
    rng = random.Random(1)
    cities = {"TX": ["Dallas", "Austin"], "CA": ["Los Angeles", "Fresno"], "NY": ["Albany"]}
    rows = []
    for i in range(n):
        o, d = rng.choice(list(cities)), rng.choice(list(cities))
        oc, dc = rng.choice(cities[o]), rng.choice(cities[d])
        hour = rng.randrange(24)
        rows.append((
            i, f"2022-01-{1 + i % 28:02d}", rng.choice(["Blue", "Red", "Green"]), oc[:3].upper(), dc[:3].upper(), rng.random() < 0.2,
            hour * 100 + 15, f"{hour:02d}00-{hour:02d}59", float(rng.randrange(100, 900)), None if i % 9 == 0 else 5.0, f"{oc}, {o}", o, f"{dc}, {d}", d,
            "Texas", rng.randrange(1, 8), 1 + i % 12, 77, rng.randrange(9), "N1",
        ))
    schema = """flight_id int, FlightDate string, Airline string, Origin string, Dest string, Cancelled boolean, CRSDepTime int, DepTimeBlk string,
      Distance double, DepDelay double, OriginCityName string, OriginState string, DestCityName string, DestState string, OriginStateName string,
      DayOfWeek int, Month int, Same int, DivAirportLandings int, Tail_Number string"""
    return spark.createDataFrame(rows, schema)


def accidents(spark, n=240):
    rng = random.Random(2)
    pick = lambda *v: rng.choice(v)
    rows = [(
        i, f"{1 + i % 12:02d}/{1 + i % 28:02d}/{2018 + i % 3} 03:{i % 60:02d}:00 PM", rng.randrange(24), 1 + i % 7, 1 + i % 12, rng.randrange(1, 4),
        0.0, pick("NO INJURY / DRIVE AWAY", "INJURY AND / OR TOW DUE TO CRASH"), pick("Y", "N"), pick(*list(LIGHTING_ORDER)[:5]),
        *[pick(f"{c}1", f"{c}2", f"{c}3") for c in "abcdefgh"], "$500",
    ) for i in range(n)]
    schema = """crash_id int, crash_date string, crash_hour int, crash_day_of_week int, crash_month int, num_units int, injuries_total double, crash_type string,
      intersection_related_i string, lighting_condition string, alignment string, trafficway_type string, traffic_control_device string,
      weather_condition string, first_crash_type string, roadway_surface_cond string, road_defect string, prim_contributory_cause string, damage string"""
    return spark.createDataFrame(rows, schema)


def test_flights(spark):
    df = flights(spark)
    model = flights_preparation("flight_id", scaling="minmax", balancing="smote", feature_selection="redundant").fit(df)
    gone = {"OriginStateName", "DepDelay", "Same", "DivAirportLandings", "Tail_Number", "OriginCityName", "Origin", "CRSDepTime", "DepTimeBlk"}
    assert not gone & set(model.features)
    assert {"OriginGeoNum", "Origin_freq", "Distance", "DayOfWeek_sin", "Airline_Blue"} <= set(model.features) | set(model.selector.state["dropped"])
    train, test = (model.prepared.filter(F.col("split") == s) for s in ("train", "test"))
    counts = {r["Cancelled"]: r["count"] for r in train.groupBy("Cancelled").count().collect()}
    assert counts[0] == counts[1]
    # Synthetic rows have no key and never reach the test rows.
    assert test.filter("flight_id is null").count() == 0
    extremes = train.agg(*[F.min(c).alias(f"a{i}") for i, c in enumerate(model.features)], *[F.max(c).alias(f"b{i}") for i, c in enumerate(model.features)]).first()
    assert min(extremes) >= -1e-9 and max(extremes) <= 1 + 1e-9

    path = scratch_path(spark, "flights")
    model.save(spark, path)
    again = load_preparation(spark, path)
    one = df.filter("flight_id = 5").drop("Cancelled")
    single, whole = again.transform(one), model.transform(df).filter("flight_id = 5")
    assert single.columns == ["flight_id", *model.features]
    # A single row is prepared exactly as it is within the whole table.
    assert list(single.first()) == list(whole.select(*single.columns).first())


def test_accidents(spark):
    df = accidents(spark)
    model = accidents_preparation("crash_id", scaling="zscore").fit(df)
    names = set(model.features)
    assert "injuries_total" not in names and "crash_month" not in names and "damage" not in names
    assert {"crash_hour_sin", "crash_date_year_cos", "crash_date_quarter_sin", "lighting_condition", "alignment_a1", "num_units"} <= names
    assert model.prepared.select("crash_type").distinct().count() == 2
    assert model.prepared.count() == 240
    out = model.transform(df)
    assert out.columns == ["crash_id", "crash_type", *model.features]


def test_transform_of_partial_tables(spark):
    df = accidents(spark)
    model = accidents_preparation("crash_id").fit(df)
    partial = model.transform(df.drop("weather_condition", "crash_type"))
    assert partial.columns == ["crash_id", *model.features]
    assert partial.agg(F.sum("weather_condition_d1")).first()[0] == 0
    with pytest.raises(ValueError):
        model.transform(spark.createDataFrame([(1,)], "crash_id int"))


def small(spark):
    rng = random.Random(3)
    rows = [(i, rng.gauss(i % 2, 0.6), rng.random() * 100, rng.choice("abc"), int(i % 5 == 0)) for i in range(200)]
    return spark.createDataFrame(rows, "id int, x double, z double, c string, y int")


def test_strategies_are_checked(spark):
    with pytest.raises(ValueError):
        Preparation(key="id", target="y", balancing="other")
    with pytest.raises(ValueError):
        Preparation(key="id", target="nothere").fit(small(spark))
    with pytest.raises(ValueError):
        Preparation(key="id", target="y", scaling="other").fit(small(spark))


def test_outliers_and_splits(spark):
    df = small(spark)
    plain = Preparation(key="id", target="y", cleaning=Cleaning(), encoders=[OneHot(["c"])]).fit(df)
    splits = plain.prepared
    assert splits.select("id").distinct().count() == 200
    for strategy in ("discard", "truncate", "fixed"):
        model = Preparation(key="id", target="y", cleaning=Cleaning(), encoders=[FrequencyEncoder(["c"])], outliers=strategy).fit(df)
        assert model.prepared.filter("split = 'test'").count() == splits.filter("split = 'test'").count()


def test_experiment_label_and_dry_run(spark):
    config = ExperimentConfig(outliers="truncate", scaling="zscore", dry_run=True)
    assert config.label == "truncate_zscore" and ExperimentConfig().label == "baseline"
    rows = {r["setting"]: r["value"] for r in run_experiment(config, small(spark), key="id", target="y").collect()}
    assert rows["label"] == "truncate_zscore" and rows["balancing"] == "None"
    out = run_experiment(ExperimentConfig(scaling="minmax", balancing="over", metric="f1"), small(spark).drop("c"), key="id", target="y")
    assert {r["metric"] for r in out.collect()} == {"accuracy", "recall", "precision", "auc_hard", "f1"}
