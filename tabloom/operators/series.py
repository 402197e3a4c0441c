"""Time-series operators: calendar grouping, grids, autocorrelation, decomposition, stationarity."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import ceil, erf, log, pi, sqrt

import numpy as np
from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from tabloom.functions.dates import clock_parts, timestamp_from_parts
from tabloom.functions.text import recode
from tabloom.operators.aggregates import describe_groups
from tabloom.operators.correlation import gramian
from tabloom.operators.encoding import TRAFFIC_ORDER, WEEKDAY_ORDER
from tabloom.operators.order import ROW, Ordered, assign_row_index, difference, prefix_sum, windowed

# Calendar levels by their short and long names.
LEVELS = {"H": "hour", "D": "day", "W": "week", "M": "month", "Q": "quarter", "Y": "year"}
AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "count": F.count,
    "std": F.stddev_samp, "var": F.var_samp, "median": F.median,
}


def period_start(ts: Column, level: str) -> Column:
    """Start of the calendar period; weeks start on Monday."""
    return F.date_trunc(LEVELS.get(level, level), ts)


def aggregate_by_period(
    df: DataFrame, ts: str, values: Sequence[str], level: str = "D", agg: str | Callable[[Column], Column] = "mean",
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per period that occurs; rows without a time are dropped."""
    fn = AGGREGATES[agg] if isinstance(agg, str) else agg
    kind = df.schema[ts].dataType.simpleString()
    kind = kind if kind.startswith("timestamp") else "timestamp"
    return (
        df.filter(F.col(ts).isNotNull())
        .groupBy(*by, period_start(F.col(ts), level).cast(kind).alias(ts))
        .agg(*[fn(F.col(v)).alias(v) for v in values])
    )


def summary_by_granularity(df: DataFrame, ts: str, value: str, levels: Sequence[str] = ("H", "D", "W")) -> DataFrame:
    """The summary of the raw values and of their sums per calendar level."""
    parts = df.select(F.lit("raw").alias("level"), F.col(value).cast("double").alias("value"))
    for level in levels:
        summed = aggregate_by_period(df, ts, [value], level, "sum")
        parts = parts.unionByName(summed.select(F.lit(level).alias("level"), F.col(value).cast("double").alias("value")))
    return describe_groups(parts, "level", "value")


def segment_means(ordered: Ordered, column: str, segments: int = 10) -> DataFrame:
    """Mean of each of the equal index segments."""
    n = ordered.n
    bounds = [i * n // segments for i in range(segments + 1)]
    idx = F.col(ordered.index)
    segment = F.lit(0)
    for start in bounds[1:-1]:
        segment = segment + (idx >= start).cast("int")
    return ordered.df.groupBy(segment.alias("segment")).agg(F.avg(column).alias("segment_mean"))


def stationarity_line(ordered: Ordered, column: str, segments: int = 10) -> DataFrame:
    """Each row with its mean line and the series' band of one population std.

    The line repeats every segment mean ``n // segments`` times, and the last
    mean to the end.
    """
    step = max(1, ordered.n // segments)
    means = F.broadcast(segment_means(ordered, column, segments))
    line = F.least(F.floor(F.col(ordered.index) / F.lit(step)).cast("int"), F.lit(segments - 1))
    band = ordered.df.agg(F.round(F.stddev_pop(column), 3)).first()[0]
    return (
        ordered.df.withColumn("segment", line).join(means, "segment", "left")
        .withColumns({"band_low": F.col(column) - F.lit(band), "band_high": F.col(column) + F.lit(band)})
    )


def std_band(df: DataFrame, column: str) -> DataFrame:
    """Value plus and minus the rounded population std of the column."""
    band = df.agg(F.round(F.stddev_pop(column), 3)).first()[0]
    return df.withColumns({"band_low": F.col(column) - F.lit(band), "band_high": F.col(column) + F.lit(band)})


def autocorrelation(ordered: Ordered, column: str, max_lag: int, *, center: bool = False,
                    block_rows: int | None = None) -> DataFrame:
    """Sum of x(t) x(t+k) over sum of x(t)^2 for the lags -K..K."""
    mean = ordered.df.agg(F.avg(column)).first()[0] if center else 0.0
    base = Ordered(ordered.df.select(ordered.index, (F.col(column).cast("double") - F.lit(mean)).alias("_x")), ordered.n, ordered.index)
    wide = windowed(
        base, lambda w: {f"_l{k}": F.lag("_x", k).over(w) for k in range(1, max_lag + 1)},
        before=max_lag, block_rows=block_rows,
    )
    x = F.col("_x")
    sums = wide.agg(F.sum(x * x).alias("_0"), *[F.sum(x * F.col(f"_l{k}")).alias(f"_{k}") for k in range(1, max_lag + 1)])
    entries = [
        F.struct(F.lit(k).alias("lag"), (F.coalesce(F.col(f"_{abs(k)}"), F.lit(0.0)) / F.nullif("_0", F.lit(0.0))).alias("acorr"))
        for k in range(-max_lag, max_lag + 1)
    ]
    return sums.select(F.explode(F.array(*entries)).alias("e")).select("e.lag", "e.acorr")


def lag_pairs(ordered: Ordered, column: str, lags: Sequence[int], *, block_rows: int | None = None) -> DataFrame:
    """(lag, lagged value, value) points for the lag scatter charts."""
    wide = windowed(
        ordered, lambda w: {f"_l{k}": F.lag(column, k).over(w) for k in lags}, before=max(lags), block_rows=block_rows
    )
    points = F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"_l{k}").alias("lagged")) for k in lags])
    return (
        wide.select(F.col(column).alias("value"), F.explode(points).alias("e"))
        .select("e.lag", "e.lagged", "value").filter("lagged is not null")
    )


# Seconds per unit of a grid step.
STEP_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def step_seconds(step: str) -> int:
    """Seconds of a step such as ``15 minutes``."""
    number, unit = step.split()
    return int(number) * STEP_SECONDS[unit.rstrip("s")]


def regular_grid(df: DataFrame, ts: str, step: str = "15 minutes") -> DataFrame:
    """One row per step from the first to the last time; null where none was recorded.

    The grid is a distributed range of step numbers, so it is never one row's
    array or one task's work, however long the series.
    """
    kind = df.schema[ts].dataType.simpleString()
    seconds = step_seconds(step)
    span = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).select(
        "lo", F.expr("timestampdiff(SECOND, lo, hi)").alias("width")
    ).first()
    if span["lo"] is None:
        return df.limit(0)
    steps = df.sparkSession.range(span["width"] // seconds + 1)
    start = F.lit(span["lo"]).cast(kind)
    grid = steps.select((start + F.make_dt_interval(secs=(F.col("id") * seconds).cast("decimal(18,6)"))).cast(kind).alias(ts))
    return grid.join(df, ts, "left")


def moving_weights(period: int) -> tuple[int, list[float]]:
    """Half width and weights of the centred mean; an even period halves the two ends."""
    if period % 2:
        return period // 2, [1.0 / period] * period
    return period // 2, [0.5 / period, *[1.0 / period] * (period - 1), 0.5 / period]


def decompose(ordered: Ordered, column: str, period: int, *, block_rows: int | None = None) -> DataFrame:
    """Additive trend, seasonal and residual parts; the trend is null at both ends."""
    if ordered.n < 2 * period:
        raise ValueError(f"{ordered.n} rows are fewer than two periods of {period}")
    half, _ = moving_weights(period)
    x = F.col(column).cast("double")

    def build(w: WindowSpec) -> dict[str, Column]:
        full = w.rowsBetween(-half, half)
        total = F.sum(x).over(full)
        if period % 2 == 0:
            total = total - (F.lag(x, half).over(w) + F.lead(x, half).over(w)) / 2
        return {"trend": F.when(F.count(x).over(full) == 2 * half + 1, total / F.lit(float(period)))}

    trended = windowed(ordered, build, before=half, after=half, block_rows=block_rows)
    trended = trended.withColumn("_phase", F.pmod(F.col(ordered.index), F.lit(period)))
    phases = trended.groupBy("_phase").agg(F.avg(x - F.col("trend")).alias("_mean")).collect()
    known = [r["_mean"] for r in phases if r["_mean"] is not None]
    level = sum(known) / len(known)
    table = F.broadcast(trended.sparkSession.createDataFrame(
        [(r["_phase"], r["_mean"] - level if r["_mean"] is not None else None) for r in phases], "_phase long, seasonal double"
    ))
    joined = trended.join(table, trended["_phase"] == table["_phase"], "left").drop("_phase")
    return joined.withColumn("residual", x - F.col("trend") - F.col("seasonal"))


def rebuild_timestamps(
    df: DataFrame, order_by: Sequence[str], *, day: str = "Date", time: str = "Time", first_month: int = 7, year: int = 2025,
    name: str = "datetime", block_rows: int | None = None,
) -> DataFrame:
    """Timestamps from a day of month that falls back at each new month and a clock text."""
    ordered = assign_row_index(df, order_by)
    steps = difference(ordered, [day], suffix="_step", block_rows=block_rows)
    reset = F.coalesce((F.col(f"{day}_step") < 0).cast("long"), F.lit(0).cast("long"))
    months = prefix_sum(Ordered(steps, ordered.n), reset, "_month", block_rows=block_rows)
    clock = clock_parts(F.col(time))
    stamp = timestamp_from_parts(
        F.lit(year), F.col("_month") + first_month, F.col(day), clock["hour"], clock["minute"], clock["second"]
    )
    return months.withColumn(name, stamp).drop("_month", f"{day}_step", time, ROW)


def encode_traffic(df: DataFrame, weekday: str = "Day of the week", level: str = "Traffic Situation") -> DataFrame:
    """Weekday 1..7 and traffic level 1..4."""
    return df.withColumns({
        weekday: recode(F.col(weekday), WEEKDAY_ORDER, strict=True),
        level: recode(F.col(level), TRAFFIC_ORDER, strict=True),
    })


def series_long(df: DataFrame, ts: str, columns: Sequence[str]) -> DataFrame:
    """Every value column against time."""
    typed = df.select(ts, *[F.col(c).cast("double").alias(c) for c in columns])
    return typed.unpivot([ts], list(columns), "variable", "value")


# --- augmented Dickey-Fuller ------------------------------------------------

# MacKinnon's response surfaces for one series with a constant.
TAU_STAR, TAU_MIN, TAU_MAX = -1.61, -18.83, 2.74
TAU_SMALL_P = (2.1659, 1.4412, 0.038269)
TAU_LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)
CRITICAL = {
    "1%": (-3.43035, -6.5393, -16.786, -79.433),
    "5%": (-2.86154, -2.8903, -4.234, -40.040),
    "10%": (-2.56677, -1.5384, -2.809, 0.0),
}


def mackinnon_p(statistic: float) -> float:
    """Approximate p-value of the unit-root statistic."""
    if statistic > TAU_MAX:
        return 1.0
    if statistic < TAU_MIN:
        return 0.0
    coefficients = TAU_SMALL_P if statistic <= TAU_STAR else TAU_LARGE_P
    z = sum(c * statistic**i for i, c in enumerate(coefficients))
    return 0.5 * (1 + erf(z / sqrt(2)))


def critical_values(n: int) -> dict[str, float]:
    return {level: sum(b / n**i for i, b in enumerate(beta)) for level, beta in CRITICAL.items()}


def _least_squares(products: np.ndarray, y: int, xs: list[int], n: float) -> tuple[np.ndarray, np.ndarray, float]:
    a = products[np.ix_(xs, xs)]
    b = products[xs, y]
    beta = np.linalg.solve(a, b)
    ssr = float(products[y, y] - beta @ b)
    errors = np.sqrt(np.diag(np.linalg.inv(a)) * ssr / (n - len(xs)))
    return beta, errors, ssr


def dickey_fuller(ordered: Ordered, column: str, max_lag: int | None = None, *, block_rows: int | None = None) -> dict:
    """Unit-root test with a constant and the lag count of the best AIC.

    All regressions share one Gram matrix of the lagged columns, computed in
    one scan; only the tiny normal equations are solved on the driver.
    """
    n = ordered.n
    lags = max_lag if max_lag is not None else min(ceil(12.0 * (n / 100.0) ** 0.25), n // 2 - 2)
    if lags < 0:
        raise ValueError("the series is too short")
    mean = ordered.df.agg(F.avg(column)).first()[0]
    base = Ordered(ordered.df.select(ordered.index, (F.col(column).cast("double") - F.lit(mean)).alias("_x")), n, ordered.index)

    def build(w: WindowSpec) -> dict[str, Column]:
        out = {"_level": F.lag("_x", 1).over(w)}
        for k in range(lags + 1):
            out[f"_d{k}"] = F.lag("_x", k).over(w) - F.lag("_x", k + 1).over(w)
        return out

    wide = windowed(base, build, before=lags + 1, block_rows=block_rows).withColumn("_one", F.lit(1.0))
    names = ["_d0", "_one", "_level", *[f"_d{k}" for k in range(1, lags + 1)]]

    def fit(count: int, first_row: int):
        part = wide.filter(F.col(ordered.index) >= first_row)
        used = names[: 3 + count]
        return gramian(part, used)

    products = fit(lags, lags + 1)
    rows = float(n - lags - 1)
    best, best_aic = 0, None
    for count in range(lags + 1):
        xs = list(range(1, 3 + count))
        _, _, ssr = _least_squares(products["sij"], 0, xs, rows)
        aic = rows * (log(2 * pi) + log(ssr / rows) + 1) + 2 * len(xs)
        if best_aic is None or aic < best_aic:
            best, best_aic = count, aic
    final = fit(best, best + 1)
    used_rows = float(n - best - 1)
    beta, errors, _ = _least_squares(final["sij"], 0, list(range(1, 3 + best)), used_rows)
    statistic = float(beta[1] / errors[1])
    p = mackinnon_p(statistic)
    return {
        "statistic": statistic, "p_value": p, "used_lag": best, "nobs": int(used_rows),
        "critical": critical_values(int(used_rows)), "stationary": p <= 0.05,
    }
