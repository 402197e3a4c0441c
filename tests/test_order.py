import numpy as np
import pandas as pd
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tabloom.operators.encoding import hierarchy_codes
from tabloom.operators.order import (
    Ordered, assign_row_index, difference, group_positions, head_share, lagged, prefix_sum, rolling_mean, windowed,
)


def frame(spark, n=400, seed=1):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"id": np.arange(n), "ts": rng.integers(0, n // 3, n), "g": rng.integers(0, 3, n), "x": rng.integers(-50, 50, n).astype(float)})
    # One series holds most rows.
    pdf.loc[pdf.id % 2 == 0, "g"] = 0
    return spark.createDataFrame(pdf), pdf


@pytest.mark.parametrize("n_partitions", [1, 4, 17])
def test_row_index_is_partition_invariant(spark, partitions, n_partitions):
    partitions(n_partitions)
    df, pdf = frame(spark)
    ordered = assign_row_index(df, ["ts", "id"])
    got = ordered.df.orderBy("row_idx").toPandas()
    assert ordered.n == len(pdf)
    assert got["row_idx"].tolist() == list(range(len(pdf)))
    assert got["id"].tolist() == pdf.sort_values(["ts", "id"])["id"].tolist()


@pytest.mark.parametrize("block_rows", [7, 50, 1000])
def test_windows_cross_block_borders(spark, block_rows):
    df, pdf = frame(spark)
    ordered = assign_row_index(df, ["ts", "id"])
    want = pdf.sort_values(["ts", "id"]).reset_index(drop=True)
    lags = lagged(ordered, "x", 6, 3, block_rows=block_rows).orderBy("row_idx").toPandas()
    for k in (1, 3, 6):
        pd.testing.assert_series_equal(lags[f"lag_{k}"], want["x"].shift(k), check_names=False)
    diffs = difference(ordered, ["x"], block_rows=block_rows).orderBy("row_idx").toPandas()
    pd.testing.assert_series_equal(diffs["x_diff"], want["x"].diff(), check_names=False)
    means = rolling_mean(ordered, "x", [4, 20], block_rows=block_rows).orderBy("row_idx").toPandas()
    for n in (4, 20):
        pd.testing.assert_series_equal(means[f"mean_{n}"], want["x"].rolling(n).mean(), check_names=False)


def test_windows_stay_inside_a_series(spark):
    df, pdf = frame(spark)
    ordered = assign_row_index(df, ["g", "ts", "id"])
    got = rolling_mean(ordered, "x", [5], series=["g"], block_rows=11).orderBy("row_idx").toPandas()
    want = pdf.sort_values(["g", "ts", "id"])
    expected = want.groupby("g")["x"].rolling(5).mean().reset_index(drop=True)
    pd.testing.assert_series_equal(got["mean_5"], expected, check_names=False)


def test_following_rows(spark):
    df, pdf = frame(spark, 60)
    ordered = assign_row_index(df, ["id"])
    got = windowed(ordered, lambda w: {"nxt": F.lead("x", 2).over(w)}, after=2, block_rows=5).orderBy("row_idx").toPandas()
    pd.testing.assert_series_equal(got["nxt"], pdf["x"].shift(-2), check_names=False)


def test_prefix_sum_over_blocks(spark):
    df, pdf = frame(spark)
    ordered = assign_row_index(df, ["ts", "id"])
    got = prefix_sum(ordered, F.col("x").cast("long"), "total", block_rows=13).orderBy("row_idx").toPandas()
    assert got["total"].tolist() == pdf.sort_values(["ts", "id"])["x"].cumsum().astype(int).tolist()


def test_group_positions_restart_per_group(spark):
    df, pdf = frame(spark)
    got = group_positions(df, ["g"], ["id"]).toPandas().sort_values("id")
    want = pdf.groupby("g").cumcount() + 1
    assert got["position"].tolist() == want.tolist()
    assert (got.groupby("g")["position_size"].first() == pdf.groupby("g").size()).all()


def test_group_positions_keep_a_null_group(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id int, g string")
    got = {r["id"]: (r["position"], r["position_size"]) for r in group_positions(df, ["g"], ["id"]).collect()}
    assert got == {1: (1, 2), 2: (2, 2), 3: (1, 1)}


def test_head_share(spark):
    df, _ = frame(spark, 95)
    train, test = head_share(assign_row_index(df, ["id"]), 0.9)
    assert (train.count(), test.count()) == (85, 10)


def test_no_single_task_and_no_row_python(spark):
    df, _ = frame(spark)
    ordered = assign_row_index(df, ["ts", "id"])
    for out in (ordered.df, rolling_mean(ordered, "x", [5]), prefix_sum(ordered, F.col("x"), "s"), group_positions(df, ["g"], ["id"])):
        plan = plan_of(out)
        assert "SinglePartition" not in plan
        assert "BatchEvalPython" not in plan
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_empty_table(spark):
    ordered = assign_row_index(spark.createDataFrame([], "id long, x double"), ["id"])
    assert ordered.n == 0 and ordered.df.count() == 0
    assert rolling_mean(Ordered(ordered.df, 0), "x", [3]).count() == 0


@pytest.mark.parametrize("block_rows", [120, 1000])
def test_long_windows_equal_pandas(spark, block_rows):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"id": np.arange(700), "g": np.arange(700) // 260, "x": rng.normal(size=700) + 1e6})
    pdf.loc[[100, 101, 400], "x"] = np.nan
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "id long, g long, x double")
    sizes = [5, 33, 50, 130]
    plain = rolling_mean(assign_row_index(df, ["id"]), "x", sizes, block_rows=block_rows).orderBy("id").toPandas()
    series = rolling_mean(assign_row_index(df, ["g", "id"]), "x", sizes, series=["g"], block_rows=block_rows).orderBy("id").toPandas()
    for n in sizes:
        np.testing.assert_allclose(plain[f"mean_{n}"].astype(float), pdf["x"].rolling(n).mean(), rtol=1e-12)
        np.testing.assert_allclose(series[f"mean_{n}"].astype(float), pdf.groupby("g")["x"].rolling(n).mean().to_numpy(), rtol=1e-12)


def test_long_windows_do_the_same_work_whatever_their_length(spark):
    df, _ = frame(spark, 95)
    ordered = assign_row_index(df, ["id"])
    plans = [plan_of(rolling_mean(ordered, "x", [n], block_rows=1000)) for n in (40, 45)]
    assert plans[0].count("Window") == plans[1].count("Window") and "specifiedwindowframe(RowFrame, -39, currentrow" not in plans[0]


@pytest.mark.parametrize("block_rows", [2, 7, 1000])
def test_hierarchy_codes_across_blocks(spark, block_rows, monkeypatch):
    monkeypatch.setattr("tabloom.operators.order.BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(8)
    rows = [tuple(f"{p}{rng.integers(4)}" for p in "abc") for _ in range(90)] + [(None, "b1", "c1")]
    got = {tuple(r)[:3]: tuple(r)[3:] for r in hierarchy_codes(spark.createDataFrame(rows, "u string, v string, w string"), ["u", "v", "w"]).collect()}
    paths = sorted({r for r in rows if None not in r})
    want = {p: tuple(sorted({q[d] for q in paths if q[:d] == p[:d]}).index(p[d]) + 1 for d in range(3)) for p in paths}
    assert got == want
