from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest


from tabloom.operators.distributions import fit_lognormal
from tabloom.operators.order import assign_row_index
from tabloom.operators.series import (
    aggregate_by_period, autocorrelation, critical_values, decompose, dickey_fuller, mackinnon_p, rebuild_timestamps, regular_grid,
    segment_means, stationarity_line,
)


def series(spark, x):
    start = datetime(2024, 1, 1)
    pdf = pd.DataFrame({"ts": [start + timedelta(hours=i) for i in range(len(x))], "x": x})
    return assign_row_index(spark.createDataFrame(pdf), ["ts"])


@pytest.mark.parametrize("period", [4, 7])
@pytest.mark.parametrize("block_rows", [10, 1000])
def test_decomposition(spark, period, block_rows):
    rng = np.random.default_rng(1)
    n = 60
    x = np.arange(n) * 0.5 + np.tile(rng.normal(size=period), n)[:n] + rng.normal(size=n) * 0.1
    got = decompose(series(spark, x), "x", period, block_rows=block_rows).orderBy("row_idx").toPandas()
    weights = np.full(period, 1 / period) if period % 2 else np.r_[0.5, np.ones(period - 1), 0.5] / period
    half = period // 2
    trend = np.full(n, np.nan)
    trend[half:n - half] = np.convolve(x, weights, "valid")
    phase = np.array([np.nanmean((x - trend)[i::period]) for i in range(period)])
    seasonal = np.tile(phase - phase.mean(), n)[:n]
    np.testing.assert_allclose(got["trend"].astype(float), trend, atol=1e-9)
    np.testing.assert_allclose(got["seasonal"].astype(float), seasonal, atol=1e-9)
    whole = got.dropna()
    np.testing.assert_allclose(whole["trend"] + whole["seasonal"] + whole["residual"], whole["x"], atol=1e-9)
    with pytest.raises(ValueError):
        decompose(series(spark, x[:5]), "x", period)


def adf_by_hand(x, lags):
    """The same regressions on explicit lag matrices."""
    dx = np.diff(x)

    def fit(count, drop):
        rows = np.arange(drop, len(dx))
        design = np.column_stack([np.ones(len(rows)), x[rows], *[dx[rows - k] for k in range(1, count + 1)]])
        beta, *_ = np.linalg.lstsq(design, dx[rows], rcond=None)
        ssr = ((dx[rows] - design @ beta) ** 2).sum()
        n, k = design.shape
        aic = n * (np.log(2 * np.pi) + np.log(ssr / n) + 1) + 2 * k
        se = np.sqrt(np.linalg.inv(design.T @ design)[1, 1] * ssr / (n - k))
        return aic, beta[1] / se, n

    best = min(range(lags + 1), key=lambda c: fit(c, lags)[0])
    return best, *fit(best, best)[1:]


@pytest.mark.parametrize("kind", ["noise", "walk", "ar"])
def test_dickey_fuller(spark, kind):
    rng = np.random.default_rng(7)
    e = rng.normal(size=220)
    x = {"noise": e, "walk": np.cumsum(e), "ar": pd.Series(e).ewm(alpha=0.3).mean().to_numpy()}[kind] + 50
    got = dickey_fuller(series(spark, x), "x", block_rows=40)
    lags = int(np.ceil(12 * (len(x) / 100) ** 0.25))
    best, statistic, n = adf_by_hand(x, lags)
    assert (got["used_lag"], got["nobs"]) == (best, n)
    assert got["statistic"] == pytest.approx(statistic, abs=1e-6)
    assert got["stationary"] == (kind != "walk")


def test_mackinnon_values():
    # The asymptotic critical values have these p-values by definition.
    for p, level in ((0.01, "1%"), (0.05, "5%"), (0.10, "10%")):
        assert mackinnon_p(critical_values(10**9)[level]) == pytest.approx(p, abs=0.002)
    assert mackinnon_p(5.0) == 1.0 and mackinnon_p(-30.0) == 0.0


def test_autocorrelation_is_not_centred(spark):
    x = np.array([3.0, 1.0, 4.0, 1.0, 5.0])
    got = {r["lag"]: r["acorr"] for r in autocorrelation(series(spark, x), "x", 2).collect()}
    assert got[0] == 1.0 and got[2] == got[-2] == pytest.approx((x[2:] * x[:-2]).sum() / (x * x).sum())
    centred = {r["lag"]: r["acorr"] for r in autocorrelation(series(spark, x), "x", 1, center=True).collect()}
    d = x - x.mean()
    assert centred[1] == pytest.approx((d[1:] * d[:-1]).sum() / (d * d).sum())


def test_segments(spark):
    x = np.arange(23, dtype=float)
    got = segment_means(series(spark, x), "x", 5).orderBy("segment").toPandas()["segment_mean"].tolist()
    want = [x[i * 23 // 5:(i + 1) * 23 // 5].mean() for i in range(5)]
    assert got == want
    line = stationarity_line(series(spark, x), "x", 5).orderBy("row_idx").toPandas()["segment_mean"].tolist()
    expected = [m for m in want for _ in range(4)]
    assert line == expected + [expected[-1]] * 3


def test_periods_and_grid(spark):
    df = spark.sql("""SELECT * FROM VALUES (timestamp_ntz'2024-01-07 23:50:00', 1D), (timestamp_ntz'2024-01-08 00:20:00', 3D),
      (CAST(NULL AS timestamp_ntz), 9D) AS t(ts, x)""")
    weeks = aggregate_by_period(df, "ts", ["x"], "W", "sum").orderBy("ts").collect()
    assert [(str(r["ts"].date()), r["x"]) for r in weeks] == [("2024-01-01", 1.0), ("2024-01-08", 3.0)]
    grid = regular_grid(df.filter("ts is not null"), "ts", "15 minutes").orderBy("ts").collect()
    assert [(r["ts"].strftime("%H:%M"), r["x"]) for r in grid] == [("23:50", 1.0), ("00:05", None), ("00:20", 3.0)]


def test_months_from_day_resets(spark):
    rows = [(0, 31, "11:59:00 PM"), (1, 1, "12:00:00 AM"), (2, 15, "1:02:03 PM"), (3, 2, "1:00:00 AM")]
    out = rebuild_timestamps(spark.createDataFrame(rows, "i int, Date int, Time string"), ["i"], block_rows=2).orderBy("i").collect()
    assert [str(r["datetime"]) for r in out] == ["2025-07-31 23:59:00", "2025-08-01 00:00:00", "2025-08-15 13:02:03", "2025-09-02 01:00:00"]


def test_lognormal_fit_recovers_parameters(spark):
    rng = np.random.default_rng(11)
    x = 5 + 20 * np.exp(0.6 * rng.normal(size=4000))
    loc, scale, sigma = fit_lognormal(spark.createDataFrame(pd.DataFrame({"x": x})), "x")
    assert loc == pytest.approx(5, abs=1.0) and scale == pytest.approx(20, rel=0.06) and sigma == pytest.approx(0.6, rel=0.06)
    assert fit_lognormal(spark.createDataFrame([(1.0,), (1.0,)], "x double"), "x") is None
