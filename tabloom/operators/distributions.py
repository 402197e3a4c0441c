"""Fits of the normal, exponential and three-parameter log-normal distribution."""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.densities import exponential_pdf, lognormal_pdf, normal_pdf
from tabloom.operators.aggregates import histogram
from tabloom.session import local_table

GRID = 12
ROUNDS = 8


@dataclass
class Fits:
    normal: tuple[float, float]
    exponential: tuple[float, float]
    lognormal: tuple[float, float, float] | None

    def densities(self, x: Column) -> dict[str, Column]:
        out = {"normal": normal_pdf(x, *self.normal), "exponential": exponential_pdf(x, *self.exponential)}
        if self.lognormal:
            out["lognormal"] = lognormal_pdf(x, *self.lognormal)
        return out


def _profile(df: DataFrame, x: Column, locations: list[float]) -> list[tuple[float, float]]:
    """Mean and population std of log(x - loc) for several locations from one aggregate."""
    exprs = []
    for i, loc in enumerate(locations):
        y = F.log(x - F.lit(loc))
        exprs += [F.avg(y).alias(f"m{i}"), F.stddev_pop(y).alias(f"s{i}")]
    row = df.agg(*exprs).first()
    return [(row[f"m{i}"], row[f"s{i}"]) for i in range(len(locations))]


def fit_lognormal(df: DataFrame, column: str) -> tuple[float, float, float] | None:
    """(loc, scale, sigma) by profile likelihood over the location.

    Each round scores a grid of locations below the minimum in one scan and
    narrows the grid around the best.  The likelihood grows without limit as
    the location approaches the minimum, so the search starts one
    thousandth of the range away from it.
    """
    x = F.col(column).cast("double")
    known = df.filter(x.isNotNull())
    facts = known.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    if facts["lo"] is None or facts["hi"] == facts["lo"]:
        return None
    low, span = facts["lo"], facts["hi"] - facts["lo"]
    left, right = log(span * 1e-3), log(span * 1e3)
    best = None
    for _ in range(ROUNDS):
        step = (right - left) / (GRID - 1)
        points = [left + i * step for i in range(GRID)]
        scored = []
        for t, (m, s) in zip(points, _profile(known, x, [low - exp(t) for t in points])):
            if s and s > 0:
                scored.append((-(m + log(s)), t, m, s))
        best = max(scored)
        left, right = best[1] - step, best[1] + step
    _, t, m, s = best
    return low - exp(t), exp(m), s


def fit_distributions(df: DataFrame, column: str, *, lognormal: bool = True) -> Fits:
    x = F.col(column).cast("double")
    row = df.agg(F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), F.min(x).alias("min")).first()
    return Fits(
        (row["mean"], row["std"]), (row["min"], row["mean"] - row["min"]),
        fit_lognormal(df, column) if lognormal else None,
    )


def fit_table(df: DataFrame, column: str, *, lognormal: bool = True) -> DataFrame:
    """(distribution, parameter, value) rows."""
    fits = fit_distributions(df, column, lognormal=lognormal)
    rows = [
        ("normal", "mean", fits.normal[0]), ("normal", "sigma", fits.normal[1]),
        ("exponential", "loc", fits.exponential[0]), ("exponential", "scale", fits.exponential[1]),
    ]
    if fits.lognormal:
        rows += [("lognormal", n, v) for n, v in zip(("loc", "scale", "sigma"), fits.lognormal)]
    return local_table(df.sparkSession, rows, "distribution string, parameter string, value double")


def density_at_values(df: DataFrame, column: str, *, lognormal: bool = True) -> DataFrame:
    """Each row with the fitted densities at its value."""
    fits = fit_distributions(df, column, lognormal=lognormal)
    return df.withColumns({f"pdf_{n}": d for n, d in fits.densities(F.col(column).cast("double")).items()})


def histogram_with_fits(df: DataFrame, column: str, bins: int = 20, *, lognormal: bool = True) -> DataFrame:
    """Density histogram with the fitted densities at the bin centres."""
    fits = fit_distributions(df, column, lognormal=lognormal)
    centre = (F.col("low") + F.col("high")) / 2
    counted = histogram(df, column, bins, density=True).withColumn("centre", centre)
    return counted.withColumns({f"pdf_{n}": d for n, d in fits.densities(F.col("centre")).items()})
