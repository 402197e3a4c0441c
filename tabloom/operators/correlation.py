"""Absolute Pearson correlation over pairwise complete rows, and Gram matrices."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.session import local_table

# Up to this many pairs the JVM aggregate stays inside generated code.
MAX_PAIRS_AGGREGATE = 8


def gramian(df: DataFrame, columns: Sequence[str], shifts: Sequence[float] | None = None) -> dict[str, np.ndarray]:
    """Pairwise counts, sums and products of many columns from one scan.

    Each task folds its Arrow batches into p x p matrices with BLAS and emits
    them once, so what is shuffled depends on the columns and tasks only.
    Entry [i, j] covers the rows where both columns are known.
    """
    p = len(columns)
    offsets = np.zeros(p) if shifts is None else np.asarray(shifts, dtype=float)
    schema = "i int, j int, n double, si double, sii double, sij double"

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, si, sii, sij = (np.zeros((p, p)) for _ in range(4))
        for batch in batches:
            raw = np.column_stack([
                batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(p)
            ])
            known = ~np.isnan(raw)
            x = np.where(known, raw - offsets, 0.0)
            mask = known.astype(float)
            n += mask.T @ mask
            si += x.T @ mask
            sii += (x * x).T @ mask
            sij += x.T @ x
        left, right = np.indices((p, p)).reshape(2, -1).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(left), pa.array(right), *[pa.array(m.ravel()) for m in (n, si, sii, sij)]],
            names=["i", "j", "n", "si", "sii", "sij"],
        )

    slim = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    parts = slim.mapInArrow(fold, schema)
    rows = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "si", "sii", "sij")]).collect()
    out = {name: np.zeros((p, p)) for name in ("n", "si", "sii", "sij")}
    for r in rows:
        for name in out:
            out[name][r["i"], r["j"]] = r[name]
    return out


def _correlations_by_columns(df: DataFrame, pairs: list[tuple[str, str]]) -> dict:
    exprs = []
    for i, (a, b) in enumerate(pairs):
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        xs, ys = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
        spread = F.nullif(F.sqrt(F.var_pop(xs) * F.var_pop(ys)), F.lit(0.0))
        exprs.append((F.covar_pop(x, y) / spread).alias(f"r{i}"))
    row = df.agg(*exprs).first()
    return {pair: row[f"r{i}"] for i, pair in enumerate(pairs)}


def _correlations_by_gramian(df: DataFrame, columns: list[str], pairs: list[tuple[str, str]]) -> dict:
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    g = gramian(df, columns, [m or 0.0 for m in means])
    at = {c: i for i, c in enumerate(columns)}
    out = {}
    for a, b in pairs:
        i, j = at[a], at[b]
        n = g["n"][i, j]
        if n == 0:
            out[(a, b)] = None
            continue
        cov = g["sij"][i, j] - g["si"][i, j] * g["si"][j, i] / n
        vi = g["sii"][i, j] - g["si"][i, j] ** 2 / n
        vj = g["sii"][j, i] - g["si"][j, i] ** 2 / n
        # The values are centred, so what rounding leaves of a constant is far below this share.
        varies = vi > 1e-15 * g["sii"][i, j] and vj > 1e-15 * g["sii"][j, i]
        out[(a, b)] = float(cov / np.sqrt(vi * vj)) if varies else None
    return out


def correlations(df: DataFrame, columns: Sequence[str], *, wide: bool | None = None) -> dict[tuple[str, str], float | None]:
    """Pearson r of every pair; null when a side is constant on the shared rows.

    Either way the table is scanned once: few pairs are one JVM aggregate, more
    take the Gram matrix.
    """
    columns = list(columns)
    pairs = list(combinations(columns, 2))
    if not pairs:
        return {}
    if wide if wide is not None else len(pairs) > MAX_PAIRS_AGGREGATE:
        return _correlations_by_gramian(df, columns, pairs)
    return _correlations_by_columns(df, pairs)


def correlation_table(df: DataFrame, columns: Sequence[str], **options) -> DataFrame:
    """Long form (var1, var2, abs_corr), each unordered pair once in column order."""
    found = correlations(df, columns, **options)
    rows = [(a, b, abs(r) if r is not None else None) for (a, b), r in found.items()]
    return local_table(df.sparkSession, rows, "var1 string, var2 string, abs_corr double")


def redundant_variables(
    found: dict[tuple[str, str], float | None], columns: Sequence[str], threshold: float, rule: str = "earlier"
) -> list[str]:
    """Columns to drop by one of the two redundancy rules.

    ``earlier``: a column correlated with any column before it.
    ``mutual``: all partners of a column that has at least two of them.
    """
    strong = {pair for pair, r in found.items() if r is not None and abs(r) >= threshold}
    if rule == "earlier":
        return [c for k, c in enumerate(columns) if any((e, c) in strong for e in columns[:k])]
    if rule != "mutual":
        raise ValueError(f"redundancy rule {rule} not recognized")
    drop: list[str] = []
    for v in columns:
        partners = [c for c in columns if (v, c) in strong or (c, v) in strong]
        if len(partners) >= 2:
            drop += [c for c in partners if c not in drop]
    return drop
