import math

import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabloom.functions.dates import clock_angle, clock_label, slot_angle
from tabloom.operators import columns as C
from tabloom.operators.cleaning import Cleaning, RareCategoryGrouping, road_alignment_features
from tabloom.operators.encoding import (
    CyclicByMax, CyclicByPeriod, FrequencyEncoder, OneHot, OneHotVector, PlaceEncoder, Refit, category_codes, encode_calendar,
    hierarchy_codes,
)
from tabloom.operators.missing import Filling, drop_missing
from tabloom.operators.outliers import Outliers
from tabloom.operators.scaling import Scaling
from tabloom.operators.stages import load_stage
from tabloom.operators.vartypes import variable_types
from tabloom.session import scratch_path


def values(df, column):
    return [r[column] for r in df.collect()]


def test_variable_types_on_edge_columns(spark):
    rows = [
        ("1", "2020-01-05", "a", "x", None, 1, True, "05/28/2021 03:00:00 PM", "1.5"),
        ("2.5", "2020-02-30", "b", "y", None, 1, False, "06/01/2021 11:59:59 AM", "9"),
        ("-3e2", "2020-03-01", "c", "x", None, 1, True, None, "ten"),
        (None, None, None, "y", None, 1, None, "12/31/2021 12:00:00 AM", "4"),
    ]
    schema = "num string, baddate string, word string, two string, none string, same int, flag boolean, stamp string, mixed string"
    types = variable_types(spark.createDataFrame(rows, schema), force_symbolic=["same"])
    assert types["numeric"] == ["num", "none"]
    assert types["binary"] == ["two", "flag"]
    assert types["date"] == ["stamp"]
    assert types["symbolic"] == ["baddate", "word", "same", "mixed"]


def test_column_drops(spark):
    df = spark.createDataFrame([(1, None, 5, "a"), (2, None, 5, None)], "id int, none string, same int, part string")
    assert C.drop_columns_with_nulls(df).columns == ["id", "same"]
    assert C.constant_columns(df) == ["none", "same", "part"]
    assert C.constant_columns(df, include_empty=False) == ["same", "part"]
    assert C.drop_empty_columns(df).columns == ["id", "same", "part"]
    assert C.drop_id_columns(df.toDF("EventID", "none", "idle", "part")).columns == ["none", "idle", "part"]
    with pytest.raises(ValueError):
        C.require_columns(df, ["target"])


def test_outlier_filter_keeps_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (99.0,), (2.0,), (3.0,), (2.5,)], "x double")
    kept = Outliers("discard", factor=1.5, columns=["x"]).fit(df).transform(df)
    assert sorted(values(kept, "x"), key=lambda v: (v is None, v)) == [1.0, 2.0, 2.5, 3.0, None]
    cut = Outliers("truncate", factor=1.5, columns=["x"]).fit(df).transform(df)
    assert cut.filter("x is null").count() == 1 and cut.agg(F.max("x")).first()[0] < 99
    fixed = Outliers("fixed", factor=1.5, columns=["x"]).fit(df).transform(df)
    assert 2.5 in values(fixed, "x") and 99.0 not in values(fixed, "x")
    with pytest.raises(ValueError):
        Outliers("other")


def test_nan_becomes_null(spark):
    df = C.nan_to_null(spark.createDataFrame([(1, float("nan")), (2, 3.0)], "id int, x double"))
    assert df.filter("x is null").count() == 1


def test_zero_guard(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 0.0)], "a int, b double")
    with pytest.raises(ValueError):
        C.guard_compatible(df, ["a", "b"])
    assert C.zero_share(df.withColumn("b", F.lit(None).cast("double")), ["a", "b"]) == 0.5


def test_rare_categories(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 3 + [("c",)] + [(None,)] * 5, "c string")
    model = RareCategoryGrouping(["c"], 0.3).fit(df)
    assert model.state["frequent"] == {"c": ["a", "b"]}
    fresh = spark.createDataFrame([("a",), ("c",), ("z",), (None,)], "c string")
    assert values(model.transform(fresh), "c") == ["a", "OTHERS", "OTHERS", "OTHERS"]
    kept = RareCategoryGrouping(["c"], 0.3, null_policy="keep").fit(df).transform(fresh)
    assert values(kept, "c") == ["a", "OTHERS", "OTHERS", None]


def test_cleaning_learns_its_drops(spark):
    df = spark.createDataFrame([(1, 930, None, 7, "u"), (2, 1545, 4, 7, "v"), (3, 5, 5, 7, "w")], "id int, t int, gap int, same int, TailCode string")
    model = Cleaning(drop_patterns=["Code"], time_columns=["t"], keep=["id"], types={"numeric": [], "symbolic": [], "binary": [], "date": []}).fit(df)
    # The fresh table has no nulls and no constant, but its columns stay the learned ones.
    fresh = spark.createDataFrame([(9, 2400, 1, 1, "x"), (8, 100, 2, 2, "y")], df.schema)
    out = model.transform(fresh)
    assert out.columns == ["id", "t"]
    assert values(out, "t") == ["24:00", "01:00"]


def test_clock_and_slots(spark):
    df = spark.createDataFrame([("24:00",), ("06:30",), ("6:30",), ("25:00",), ("",)], "t string")
    got = values(df.select(clock_angle(F.col("t")).alias("a")), "a")
    assert got[0] == 0 and got[1] == pytest.approx(2 * math.pi * 390 / 1440) and got[2:] == [None, None, None]
    slots = spark.createDataFrame([("0600-0659",), ("0001-0559",), ("0600-0759",)], "s string")
    got = values(slots.select(slot_angle(F.col("s")).alias("a")), "a")
    assert got[0] == pytest.approx(2 * math.pi * 389.5 / 1440) and got[1] == pytest.approx(2 * math.pi * 180 / 1440) and got[2] is None
    label = spark.createDataFrame([("930",), ("x",), (None,), ("7.0",)], "v string").select(clock_label(F.col("v")).alias("l"))
    assert values(label, "l") == ["09:30", "", "", "00:07"]


def test_calendar_replaces_columns(spark):
    df = spark.createDataFrame([(1, 1, 32)], "DayOfWeek int, Quarter int, DayofMonth int")
    out = encode_calendar(df)
    assert set(out.columns) == {f"{c}_{p}" for c in ("DayOfWeek", "Quarter", "DayofMonth") for p in ("sin", "cos")}
    row = out.first()
    assert row["DayOfWeek_cos"] == 1.0 and row["DayofMonth_sin"] is None


def test_one_hot(spark):
    df = spark.createDataFrame([("b", 2, "y"), ("a", 10, "n"), (None, 1, "y")], "c string, k int, two string")
    model = OneHot(["c", "k", "two"]).fit(df)
    assert model.feature_names == ["c_a", "c_b", "c_nan", "k_1", "k_2", "k_10", "two_y"]
    fresh = spark.createDataFrame([("z", 3, "q")], df.schema)
    assert list(model.transform(fresh).first()) == [0.0] * 7
    absent = model.transform(fresh.drop("c"))
    assert absent.columns == model.feature_names
    sums = model.transform(df).select((F.col("c_a") + F.col("c_b") + F.col("c_nan")).alias("s"))
    assert values(sums, "s") == [1.0, 1.0, 1.0]
    with pytest.raises(ValueError):
        OneHot(["k"], max_categories=2).fit(df)
    wide = OneHotVector(["c"]).fit(df).transform(spark.createDataFrame([("a",), ("b",), ("z",)], "c string"))
    assert sorted(map(tuple, values(wide.select(vector_to_array("c_vec").alias("v")), "v"))) == [(0, 0, 1), (0, 1, 0), (1, 0, 0)]


def test_category_codes_and_hierarchy(spark):
    df = spark.createDataFrame([("R2", "s1", "x"), ("R1", "s1", "b"), ("R1", "s1", "a"), ("R1", "s0", "a")], "r string, s string, c string")
    codes = {(x["r"], x["s"], x["c"]): (x["r_code"], x["s_code"], x["c_code"]) for x in hierarchy_codes(df, ["r", "s", "c"]).collect()}
    assert codes == {("R1", "s0", "a"): (1, 1, 1), ("R1", "s1", "a"): (1, 2, 1), ("R1", "s1", "b"): (1, 2, 2), ("R2", "s1", "x"): (2, 1, 1)}
    got = {r["c"]: r["c_code"] for r in category_codes(df, "c").collect()}
    assert got == {"a": 0, "b": 1, "x": 2}


def test_place_codes(spark):
    df = spark.createDataFrame([
        (1, "TX", "Dallas, TX", "CA", "Los Angeles, CA"), (2, "TX", "Austin, TX", "ZZ", "Nowhere, ZZ"), (3, "TX", "no comma", "CA", None),
    ], "id int, OriginState string, OriginCityName string, DestState string, DestCityName string")
    roles = [("OriginState", "OriginCityName", "o"), ("DestState", "DestCityName", "d")]
    model = PlaceEncoder(roles).fit(df)
    path = scratch_path(spark, "place")
    model.save(spark, path)
    got = {r["id"]: (r["o"], r["d"]) for r in load_stage(spark, path).transform(df).collect()}
    # South is the fourth region and Texas its 15th state; West the fifth and California its third state.
    assert got == {1: (4 * 1000 + 15 * 100 + 2, 5301), 2: (4 * 1000 + 15 * 100 + 1, 1), 3: (4 * 1000 + 15 * 100, 5300)}


def test_cyclic(spark):
    df = spark.createDataFrame([(0, 2020), (6, 2022), (12, 2021)], "m int, y int")
    out = CyclicByMax(["m"]).fit(df).transform(df).collect()
    assert [r["m_cos"] for r in out] == [1.0, -1.0, 1.0]
    zero = CyclicByMax(["m"]).fit(df.limit(1)).transform(df.limit(1)).first()
    assert (zero["m_sin"], zero["m_cos"]) == (0.0, 1.0)
    model = CyclicByPeriod({"m": 12}, ranked=["y"]).fit(df)
    row = model.transform(spark.createDataFrame([(3, 2021), (3, 1999)], df.schema)).collect()
    assert row[0]["y_sin"] == pytest.approx(math.sin(2 * math.pi / 3)) and row[0]["m_sin"] == pytest.approx(1.0)
    assert row[1]["y_sin"] is None


def test_frequency_of_unseen_values(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string")
    model = FrequencyEncoder(["c"]).fit(df)
    fresh = spark.createDataFrame([("a",), ("z",)], "c string")
    assert sorted(values(model.transform(fresh), "c_freq")) == [0.0, pytest.approx(2 / 3)]


def test_scaling(spark):
    train = spark.createDataFrame([(0.0, 5, 1), (10.0, 5, 0), (5.0, 5, 1)], "x double, same int, y int")
    test = spark.createDataFrame([(20.0, 7, 1)], train.schema)
    assert Scaling("minmax", target="y").fit(train).transform(test).first()["x"] == 2.0
    assert values(Scaling("minmax", target="y").fit(train).transform(train), "same") == [0.0, 0.0, 0.0]
    z = Scaling("zscore", ["x"]).fit(train).transform(train).agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).first()
    assert z["m"] == pytest.approx(0) and z["s"] == pytest.approx(1)
    with pytest.raises(ValueError):
        Scaling("minmax", target="y").fit(train.select("y"))
    with pytest.raises(ValueError):
        Scaling("other")


def test_missing_values(spark):
    df = spark.createDataFrame([(1, 2.0, None, "a", True), (2, None, None, None, None), (3, 4.0, 1, "a", None)],
                               "id int, x double, rare int, c string, f boolean")
    assert drop_missing(df, 0.5).columns == ["id", "x", "c"]
    # The row threshold counts the original five columns.
    assert drop_missing(df, 0.5, 0.6).count() == 2
    types = {"numeric": ["x", "rare"], "symbolic": ["c"], "binary": ["f"], "date": []}
    frequent = Filling("frequent", types).fit(df).transform(df).orderBy("id").collect()
    assert (frequent[1]["x"], frequent[1]["c"], frequent[1]["f"], frequent[0]["rare"]) == (3.0, "a", True, 1)
    constant = Filling("constant", types).fit(df).transform(df).orderBy("id").collect()
    assert (constant[1]["x"], constant[1]["c"], constant[1]["f"], constant[0]["rare"]) == (-1.0, "NA", False, -1)


def test_alignment_features(spark):
    rows = ["STRAIGHT AND LEVEL", "CURVE ON GRADE", "STRAIGHT ON HILLCREST", "OTHERS"]
    out = road_alignment_features(spark.createDataFrame([(r,) for r in rows], "alignment string")).toPandas()
    assert out["is_curve"].tolist() == [0, 1, 0, 0] and out["alignment_grade"].tolist() == [0, 1, 2, 0]


def test_stage_state_survives_saving(spark):
    df = spark.createDataFrame(pd.DataFrame({"x": [1.0, 3.0], "c": ["a", "b"]}))
    for i, stage in enumerate((Scaling("minmax", ["x"]).fit(df), OneHot(["c"]).fit(df), FrequencyEncoder(["c"]).fit(df))):
        path = scratch_path(spark, f"stage{i}")
        stage.save(spark, path)
        assert sorted(map(tuple, load_stage(spark, path).transform(df).collect())) == sorted(map(tuple, stage.transform(df).collect()))


def test_an_encoder_can_follow_the_table_at_hand(spark, tmp_path):
    train = spark.createDataFrame([("a",), ("a",), ("b",), ("b",)], "c string")
    other = spark.createDataFrame([("a",), ("b",), ("b",), ("b",)], "c string")
    fitted = Refit(FrequencyEncoder(["c"])).fit(train)
    fitted.save(spark, str(tmp_path / "stage"))
    for model in (fitted, load_stage(spark, str(tmp_path / "stage"))):
        assert sorted(r[0] for r in model.transform(other).collect()) == [0.25, 0.75, 0.75, 0.75]
        assert model.transform(other.limit(1)).first()[0] == 1.0
    ranks = Refit(CyclicByPeriod({}, ["y"])).fit(train)
    assert ranks.transform(spark.createDataFrame([(2001,)], "y int")).first()["y_cos"] == 1.0


def test_more_ranks_than_the_plan_holds(spark):
    df = spark.range(40).selectExpr("id * 3 as y")
    few, many = (CyclicByPeriod({}, ["y"], max_ranks=n).fit(df) for n in (100, 5))
    rows = lambda m: sorted(tuple(r) for r in m.transform(df).collect())
    assert many.state["sizes"] == {"y": 40} and rows(many) == rows(few)


def test_guard_accepts_by_the_first_rows_and_refuses_by_all(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    def counted(df):
        return df.mapInArrow(count, df.schema)

    good = counted(spark.range(0, 400_000, 1, 4).selectExpr("cast(1 as double) as a", "cast(0 as double) as b"))
    assert C.guard_compatible(good, ["a", "b"]) is good and seen.value < 200_000
    late = spark.range(0, 5_000, 1, 1).selectExpr("cast(id > 4990 as double) as a", "cast(0 as double) as b")
    assert C.guard_compatible(late, ["a", "b"]) is late
    with pytest.raises(ValueError, match="100.0% of the feature columns are all zero"):
        C.guard_compatible(late.filter("a = 0"), ["a", "b"])
