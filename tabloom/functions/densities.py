"""Probability densities as Column expressions."""

from __future__ import annotations

from math import log, pi, sqrt

from pyspark.sql import Column
from pyspark.sql import functions as F


def normal_pdf(x: Column, mean: float, sigma: float) -> Column:
    z = (x - F.lit(mean)) / F.lit(sigma)
    return F.exp(F.lit(-0.5) * z * z) / F.lit(sigma * sqrt(2 * pi))


def exponential_pdf(x: Column, loc: float, scale: float) -> Column:
    return F.when(x < loc, F.lit(0.0)).otherwise(F.exp(-(x - F.lit(loc)) / F.lit(scale)) / F.lit(scale))


def lognormal_pdf(x: Column, loc: float, scale: float, sigma: float) -> Column:
    shifted = F.when(x > loc, x - F.lit(loc))
    z = (F.log(shifted) - F.lit(log(scale))) / F.lit(sigma)
    return F.coalesce(F.exp(F.lit(-0.5) * z * z) / (shifted * F.lit(sigma * sqrt(2 * pi))), F.lit(0.0))
