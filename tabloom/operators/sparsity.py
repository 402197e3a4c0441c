"""Pairs of variables worth a scatter chart, and their binned or sampled points."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.hashing import digest_uniform, key_digest
from tabloom.operators.aggregates import bin_index, distinct_counts
from tabloom.operators.encoding import category_codes
from tabloom.operators.vartypes import variable_types
from tabloom.session import local_table

MAX_CATEGORIES = 50
JITTER = 0.05


def sparsity_pairs(df: DataFrame, columns: Sequence[str] | None = None, *, max_categories: int = MAX_CATEGORIES) -> DataFrame:
    """(var1, var2, kind) of every pair that is drawn.

    Constants, two binary columns, two symbolic columns, and categories with
    too many values are skipped.
    """
    names = list(columns or df.columns)
    slim = df.select(*names)
    types = variable_types(slim)
    kind_of = {c: k for k, group in types.items() for c in group}
    counts = {r["variable"]: r["nr_distinct"] for r in distinct_counts(slim, names).collect()}
    rows = []
    for a, b in combinations(names, 2):
        if counts[a] <= 1 or counts[b] <= 1:
            continue
        numeric = [kind_of[c] == "numeric" for c in (a, b)]
        if all(numeric):
            rows.append((a, b, "numeric"))
        elif any(numeric):
            category = b if numeric[0] else a
            if kind_of[category] in ("binary", "symbolic") and counts[category] <= max_categories:
                rows.append((a, b, "category"))
    return local_table(df.sparkSession, rows, "var1 string, var2 string, kind string")


def pair_density(df: DataFrame, x: str, y: str, bins: int = 20, by: Sequence[str] = ()) -> DataFrame:
    """Counts per cell of an equal-width grid over two numeric columns."""
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    facts = df.agg(F.min(xs).alias("xl"), F.max(xs).alias("xh"), F.min(ys).alias("yl"), F.max(ys).alias("yh")).first()
    if facts["xl"] is None or facts["yl"] is None:
        return df.limit(0).groupBy(*by, F.lit(0).alias("xbin"), F.lit(0).alias("ybin")).agg(F.count(F.lit(1)).alias("n"))
    return (
        df.filter(xs.isNotNull() & ys.isNotNull())
        .groupBy(*by, bin_index(xs, facts["xl"], facts["xh"], bins).alias("xbin"), bin_index(ys, facts["yl"], facts["yh"], bins).alias("ybin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def category_points(df: DataFrame, category: str, value: str, key: str, seed: int = 42) -> DataFrame:
    """(key, category code with a small jitter, value) points."""
    coded = category_codes(df.select(key, category, value), category, "_code")
    shift = (digest_uniform(key_digest(key, seed)) * 2 - 1) * F.lit(JITTER)
    return coded.filter(F.col("_code").isNotNull()).select(
        key, F.col("_code").alias("code"), (F.col("_code") + shift).alias("position"), value
    )
