import numpy as np
import pandas as pd
import pytest

from tabloom.operators.aggregates import (
    box_statistics, class_balance, count_outliers, describe, describe_groups, distinct_counts, histogram, most_frequent,
)
from tabloom.operators.correlation import correlations, redundant_variables
from tabloom.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.mark.parametrize("settings", [
    {}, {"small_cells": 0}, {"small_cells": 0, "accuracy": 50}, {"small_cells": 0, "accuracy": 20, "collect_rows": 5},
])
def test_quantiles_match_numpy(spark, settings):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({
        "smooth": rng.normal(size=3000),
        "hot": np.where(rng.random(3000) < 0.4, 7.0, rng.exponential(10, 3000)),
        "few": rng.integers(0, 4, 3000).astype(float),
        "constant": np.full(3000, 2.5),
    })
    gaps = pdf.copy()
    gaps.loc[::7, "smooth"] = np.nan
    df = spark.createDataFrame(gaps.astype(object).where(gaps.notna(), None), "smooth double, hot double, few double, constant double")
    got = exact_quantiles(df, list(pdf.columns), PROBS, **settings)
    for c in pdf.columns:
        np.testing.assert_allclose(got[c], np.quantile(gaps[c].dropna(), PROBS), rtol=0, atol=1e-12, err_msg=c)


def test_all_null_column(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    for settings in ({}, {"small_cells": 0}):
        got = exact_quantiles(df, ["a", "b"], [0.5], **settings)
        assert got == {"a": [1.5], "b": [None]}
    assert describe(df, ["b"])["b"]["count"] == 0
    assert count_outliers(df, ["b"]).first()["iqr"] == 0


def test_describe_matches_pandas(spark):
    pdf = pd.DataFrame({"x": [5.0, 1.0, 4.0, 9.0, 2.0, 100.0]})
    got, want = describe(spark.createDataFrame(pdf), ["x"])["x"], pdf["x"].describe()
    for ours, theirs in (("mean", "mean"), ("std", "std"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")):
        assert got[ours] == pytest.approx(want[theirs])


def test_box_and_histogram(spark):
    values = [1.0, 2.0, 2.5, 3.0, 4.0, 50.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    box = box_statistics(df, ["x"]).first()
    assert (box["whisker_low"], box["whisker_high"], box["nr_fliers"]) == (1.0, 4.0, 1)
    got = histogram(df, "x", 7, density=True).orderBy("bin").toPandas()
    counts, edges = np.histogram(values, 7)
    assert got["n"].tolist() == counts.tolist()
    np.testing.assert_allclose(got["low"], edges[:-1])
    np.testing.assert_allclose(got["density"], np.histogram(values, 7, density=True)[0])
    many = np.random.default_rng(2).exponential(5, 1000)
    auto = histogram(spark.createDataFrame(pd.DataFrame({"x": many})), "x", "auto").orderBy("bin").toPandas()
    assert auto["n"].tolist() == np.histogram(many, "auto")[0].tolist()


def test_ties_and_nulls_in_frequencies(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("a",)], "c string")
    assert most_frequent(df, ["c"]).first()["value"] == "a"
    assert distinct_counts(df, ["c"]).first()["nr_distinct"] == 2
    assert distinct_counts(df, ["c"], keep_null=True).first()["nr_distinct"] == 3
    balance = class_balance(df, "c")
    assert (balance.minority, balance.majority, balance.proportion) == ("a", "a", 1.0)
    many = class_balance(spark.range(20_001).selectExpr("least(id, 20000 - 1) as id"), "id")
    assert (many.minority, many.majority, many.n_minority, many.n_majority) == (0, 19_999, 1, 2) and many.counts.count() == 20_000


def test_correlation_paths_agree(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame(rng.normal(size=(500, 4)), columns=list("abcd"))
    pdf["e"] = pdf["a"] * 2 + 1e6
    pdf["f"] = 0.1
    pdf.loc[::5, "b"] = np.nan
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), ", ".join(f"{c} double" for c in pdf))
    narrow, wide = correlations(df, list(pdf), wide=False), correlations(df, list(pdf), wide=True)
    want = pdf.corr()
    for (x, y), r in narrow.items():
        if "f" in (x, y):
            assert r is None and wide[(x, y)] is None
        else:
            assert r == pytest.approx(want.loc[x, y], abs=1e-9) and wide[(x, y)] == pytest.approx(want.loc[x, y], abs=1e-9)


def test_redundancy_rules():
    found = {("a", "b"): 0.95, ("a", "c"): 0.1, ("b", "c"): -0.92, ("a", "d"): None, ("b", "d"): 0.2, ("c", "d"): 0.0}
    assert redundant_variables(found, list("abcd"), 0.9, "earlier") == ["b", "c"]
    assert redundant_variables(found, list("abcd"), 0.9, "mutual") == ["a", "c"]
    with pytest.raises(ValueError):
        redundant_variables(found, list("abcd"), 0.9, "other")


def test_nan_is_missing_in_both_ways(spark):
    df = spark.range(100).selectExpr("cast(id as double) as v").union(spark.range(40).selectExpr("double('NaN') as v")).repartition(4)
    assert exact_quantiles(df, ["v"])["v"] == [24.75, 49.5, 74.25]
    assert exact_quantiles(df, ["v"], small_cells=10, accuracy=50, collect_rows=20)["v"] == [24.75, 49.5, 74.25]
    facts = describe(df, ["v"])["v"]
    assert (facts["count"], facts["min"], facts["max"]) == (100, 0.0, 99.0)


def test_equally_frequent_numbers_are_compared_as_numbers(spark):
    df = spark.createDataFrame([(9, "9"), (10, "10"), (9, "9"), (10, "10")], "n int, s string")
    assert {r["variable"]: r["value"] for r in most_frequent(df, ["n", "s"]).collect()} == {"n": "9", "s": "10"}


def test_histogram_has_bins_without_rows(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (float("nan"),)], "v double")
    assert [(r["bin"], r["n"]) for r in histogram(df, "v", 5).orderBy("bin").collect()] == [(0, 1), (1, 0), (2, 0), (3, 0), (4, 1)]


def scans_of(spark, run, rows=2000):
    """How often ``run`` reads a table, by counting its rows as they pass."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"x": rng.normal(size=rows), "y": rng.exponential(3, rows), "g": np.arange(rows) % 7})
    run(spark.createDataFrame(pdf).mapInArrow(count, "x double, y double, g long"))
    return seen.value / rows


@pytest.mark.parametrize("settings", [{}, {"small_cells": 0, "accuracy": 200}, {"small_cells": 0, "accuracy": 100, "collect_rows": 3}])
def test_two_scans_describe_all_columns(spark, settings):
    assert scans_of(spark, lambda df: describe(df, ["x", "y", "g"], **settings)) == 2


def test_outliers_and_boxes_need_one_more_scan(spark):
    assert scans_of(spark, lambda df: count_outliers(df, ["x", "y"], small_cells=0, accuracy=200).collect()) == 3
    assert scans_of(spark, lambda df: box_statistics(df, ["x", "y"]).collect()) == 3


@pytest.mark.parametrize("settings", [{}, {"accuracy": 20}, {"accuracy": 20, "group_rows": 400}])
def test_any_number_of_groups(spark, settings):
    rng = np.random.default_rng(4)
    group = np.where(rng.random(4000) < 0.3, 0, rng.integers(1, 600, 4000))
    pdf = pd.DataFrame({"g": group, "x": np.where(rng.random(4000) < 0.2, 5.0, rng.normal(size=4000))})
    rows = [(int(g), float(x)) for g, x in pdf.itertuples(index=False)] + [(None, 1.0), (None, 2.0), (1000, None), (1000, float("nan"))]
    got = {r["g"]: r for r in describe_groups(spark.createDataFrame(rows, "g int, x double").repartition(5), "g", "x", **settings).collect()}
    want = pdf.groupby("g")["x"].describe()
    assert len(got) == len(want) + 2
    for g, row in want.iterrows():
        assert [got[g][f] for f in ("count", "min", "q25", "q50", "q75", "max")] == pytest.approx([row[c] for c in ("count", "min", "25%", "50%", "75%", "max")], abs=1e-12)
    assert (got[None]["count"], got[None]["q50"]) == (2, 1.5) and (got[1000]["count"], got[1000]["q50"]) == (0, None)
