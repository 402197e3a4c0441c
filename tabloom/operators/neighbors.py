"""Exact k-nearest-neighbour joins over a metric index, votes, and donors for missing values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.operators.metric_index import LEAF_ROWS, METRICS, TASK_CELLS, MetricIndex, build_index, chunks, index_neighbors, pair_distances
from tabloom.operators.pair_sweep import index_helps, sweep_neighbors
from tabloom.session import local_table, materialize

BLOCK_ROWS = 4096
#: So many candidates are compared with every query; more get a tree.
DIRECT_ROWS = 16_384
#: Copies of candidates a direct comparison may send, as a multiple of the rows of both sides.
COPIES = 4

__all__ = ["METRICS", "knn_join", "knn_vote", "missing_value_donors", "pair_distances"]


def feature_vector(columns: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in columns])


def _measurable(rows: DataFrame, missing: str, side: str) -> tuple[DataFrame, int, int]:
    """(the rows whose features are all finite, how many, and how many features); others are refused or left out.

    The rows are counted while they are written.
    """
    whole = F.coalesce(F.forall("_vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))
    seen = Observation()
    marked = rows.withColumn("_whole", whole).observe(
        seen, F.count_if("_whole").alias("whole"), F.count_if(~F.col("_whole")).alias("faulty"), F.max(F.size("_vec")).alias("width"))
    written = materialize(marked, f"knn-{side}")
    counts = seen.get
    if missing == "error" and counts["faulty"]:
        raise ValueError(f"{counts['faulty']} {side} have a feature that is null, NaN or infinite")
    return written.filter("_whole").drop("_whole"), counts["whole"], counts["width"] or 0


def index_points(candidates: DataFrame, k: int, metric: str, missing: str = "error", leaf_rows: int | None = None) -> MetricIndex:
    """The index of candidates (_cid, _vec, kept columns) for the ``k`` nearest at most.

    Up to ``DIRECT_ROWS`` candidates stay one leaf unless ``leaf_rows`` is given.

    Of equal vectors only the ``k`` smallest ids can be among them, so further copies stay outside.
    """
    return _index_of(*_measurable(candidates, missing, "candidates"), k, metric, leaf_rows)


def _index_of(rows: DataFrame, n: int, width: int, k: int, metric: str, leaf_rows: int | None) -> MetricIndex:
    """The index of ``n`` measured candidates."""
    direct, leaf_rows = leaf_rows or DIRECT_ROWS, leaf_rows or LEAF_ROWS
    if n > direct:
        copies = Window.partitionBy("_vec").orderBy("_cid")
        seen = Observation()
        few = rows.withColumn("_copy", F.row_number().over(copies)).filter(F.col("_copy") <= k).drop("_copy")
        rows = materialize(few.observe(seen, F.count("*").alias("n")), "different-points")
        n = seen.get["n"]
    return build_index(rows, metric, width, n, leaf_rows=leaf_rows if n > direct else direct)


def _sweeps(candidates: DataFrame, queries: DataFrame, n: int, n_queries: int, metric: str, width: int) -> bool:
    """Whether blocks of queries had better sweep over all candidates, as an index or a direct comparison would copy either too often."""
    if not n or not n_queries or not width:
        return False
    if n <= DIRECT_ROWS:
        return ceil(n_queries * n / TASK_CELLS) * n > COPIES * (n + n_queries)
    return not index_helps(candidates, queries, metric, width)


def knn_join(
    queries: DataFrame,
    candidates: DataFrame,
    k: int,
    *,
    query_id: str,
    candidate_id: str,
    features: Sequence[str] | str,
    metric: str = "euclidean",
    exclude_self: bool = False,
    keep: Sequence[str] = (),
    missing: str = "error",
    block_rows: int | None = None,
) -> DataFrame:
    """The k nearest candidates of every query: (query id, candidate id, distance, rank, kept columns).

    ``features`` is a list of numeric columns or one array column.  Equal
    distances rank by candidate id.  ``exclude_self`` removes the pair of equal ids.
    A feature that is null, NaN or infinite has no distance: with ``missing="error"``
    such rows are counted and refused, with ``"drop"`` they are left out on both sides.
    Leaves of the index hold about ``block_rows`` candidates, if it is given;
    else there is an index only where it rules out enough.
    """
    if metric not in METRICS:
        raise ValueError(f"metric {metric} not recognized")
    if k < 1:
        raise ValueError("k must be at least 1")
    if missing not in ("error", "drop"):
        raise ValueError(f"treatment {missing} of missing features not recognized")
    vec = F.col(features).cast("array<double>") if isinstance(features, str) else feature_vector(features)
    out_id = candidate_id if candidate_id != query_id else f"neighbor_{candidate_id}"
    kept = [F.col(c).alias(f"_keep_{c}") for c in keep]
    wanted = k + 1 if exclude_self else k
    c, n, width = _measurable(candidates.select(F.col(candidate_id).alias("_cid"), vec.alias("_vec"), *kept), missing, "candidates")
    q, n_queries, _ = _measurable(queries.select(F.col(query_id).alias("_id"), vec.alias("_vec")), missing, "queries")
    names = [f"_keep_{c}" for c in keep]
    if block_rows is None and _sweeps(c, q, n, n_queries, metric, width):
        near = sweep_neighbors(c, q, k, metric, width, n, n_queries, exclude_self=exclude_self)
    else:
        index = _index_of(c, n, width, wanted, metric, block_rows)
        near = index_neighbors(index, q.withColumn("_pay", F.lit(None).cast("boolean")), k, exclude_self=exclude_self, n_queries=n_queries)
    ranking = Window.partitionBy("_id").orderBy("_d", "_cid")
    ranked = near.withColumn("_rank", F.row_number().over(ranking)).filter(F.col("_rank") <= k)
    return ranked.select("_id", "_cid", "_d", "_rank", *names).toDF(query_id, out_id, "distance", "rank", *keep)


def knn_vote(neighbors: DataFrame, query_id: str, label: str, ks: Sequence[int]) -> DataFrame:
    """Majority label among the first k neighbours for each k; the smallest label wins a tie.

    One neighbour table serves every k, because a smaller k is a prefix.
    """
    each = neighbors.filter(F.col("rank") <= max(ks)).withColumn(
        "k", F.explode(F.filter(F.array(*[F.lit(k) for k in ks]), lambda x: x >= F.col("rank")))
    )
    votes = each.groupBy(query_id, "k", label).agg(F.count(F.lit(1)).alias("_votes"))
    return votes.groupBy(query_id, "k").agg(
        F.min_by(label, F.struct(-F.col("_votes"), F.col(label))).alias("prediction")
    )


def missing_value_donors(
    df: DataFrame, key: str, columns: Sequence[str], k: int = 5, *, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """For each missing value the k nearest rows that have it: (key, variable, donor, distance, value).

    A value is missing if it is null or NaN.  The distance uses the columns
    both rows know, scaled up by their share, so it is no metric as a whole.
    Between rows that know the same columns it is one: donors are taken by the
    pattern of columns they know, and each pattern of more than ``block_rows``
    donors gets an index per set of shared columns, which rows with gaps of one
    pattern search.  Donors of rare patterns meet them in bounded blocks.
    """
    spark = df.sparkSession
    columns = list(columns)
    named = df.select(F.col(key).alias("_id"), F.transform(feature_vector(columns), lambda x: F.nanvl(x, F.lit(None).cast("double"))).alias("_vec"))
    known = F.array_join(F.transform("_vec", lambda x: F.when(x.isNull(), F.lit("0")).otherwise(F.lit("1"))), "")
    base = materialize(named.withColumn("_known", known), "knn-impute")
    patterns = {r["_known"]: r["n"] for r in base.groupBy("_known").agg(F.count("*").alias("n")).collect()}
    common = sorted(p for p, n in patterns.items() if n > block_rows and "1" in p)
    rare = [p for p in patterns if p not in common]
    parts = []
    if rare:
        gaps = base.filter(F.contains("_known", F.lit("0"))).drop("_known")
        donors = base.filter(F.col("_known").isin(rare)).drop("_known")
        n_gaps = sum(n for p, n in patterns.items() if "0" in p)
        parts.append(_donors_in_blocks(gaps, donors, len(columns), k, n_gaps, sum(patterns[p] for p in rare), block_rows))
    indexes: dict[tuple[str, tuple[int, ...]], MetricIndex] = {}
    for theirs in common:
        for mine in sorted(p for p in patterns if "0" in p):
            shared = tuple(j for j, (a, b) in enumerate(zip(mine, theirs)) if a == b == "1")
            wanted = [j for j, (a, b) in enumerate(zip(mine, theirs)) if (a, b) == ("0", "1")]
            if not shared or not wanted:
                continue
            projected = F.array(*[F.get("_vec", F.lit(j)) for j in shared])
            if (theirs, shared) not in indexes:
                donors = base.filter(F.col("_known") == theirs).select(F.col("_id").alias("_cid"), projected.alias("_p"), F.col("_vec").alias("_keep_vec"))
                indexes[theirs, shared] = index_points(donors.withColumnRenamed("_p", "_vec"), k, "euclidean")
            asking = base.filter(F.col("_known") == mine)
            parts.append(_donors_by_index(indexes[theirs, shared], asking, projected, shared, wanted, len(columns), k, patterns[mine]))
    if not parts:
        kind = df.schema[key].dataType.simpleString()
        return spark.createDataFrame([], f"`{key}` {kind}, variable string, donor {kind}, distance double, value double")
    pairs = reduce(DataFrame.unionByName, parts)
    ranking = Window.partitionBy("_id", "_var").orderBy("_d", "_donor")
    ranked = pairs.withColumn("_rank", F.row_number().over(ranking)).filter(F.col("_rank") <= k)
    labels = F.broadcast(local_table(spark, list(enumerate(columns)), "_var int, variable string"))
    return ranked.join(labels, "_var").select(
        F.col("_id").alias(key), "variable", F.col("_donor").alias("donor"), F.col("_d").alias("distance"),
        F.col("_value").alias("value"),
    )


def _donors_by_index(index: MetricIndex, asking: DataFrame, projected: Column, shared: Sequence[int], wanted: Sequence[int],
                     width: int, k: int, n: int) -> DataFrame:
    """(_id, _var, _donor, _d, _value) of the k nearest donors of one pattern for rows of one pattern."""
    q = materialize(asking.select("_id", projected.alias("_vec"), F.lit(None).cast("boolean").alias("_pay")), "asking")
    near = index_neighbors(index, q, k, n_queries=n)
    ranking = Window.partitionBy("_id").orderBy("_d", "_cid")
    best = near.withColumn("_rank", F.row_number().over(ranking)).filter(F.col("_rank") <= k)
    # The scaled distance comes from the values, so that equal ones of different patterns stay equal.
    both = best.join(asking.select("_id", F.col("_vec").alias("_mine")), "_id")
    total = reduce(lambda a, b: a + b, [F.pow(F.get("_mine", F.lit(j)) - F.get("_keep_vec", F.lit(j)), F.lit(2.0)) for j in shared])
    scaled = F.sqrt(total * F.lit(float(width)) / F.lit(float(len(shared))))
    entries = F.explode(F.array(*[F.struct(F.lit(j).alias("_var"), F.get("_keep_vec", F.lit(j)).alias("_value")) for j in wanted]))
    return both.select("_id", entries.alias("e"), F.col("_cid").alias("_donor"), scaled.alias("_d")).select("_id", "e._var", "_donor", "_d", "e._value")


def _donors_in_blocks(gaps: DataFrame, donors: DataFrame, width: int, k: int, n_gaps: int, n_donors: int, block_rows: int) -> DataFrame:
    """(_id, _var, _donor, _d, _value): every row with a gap meets every donor, both in blocks of bounded size."""
    qblocks, cblocks = max(1, ceil(n_gaps / block_rows)), max(1, ceil(n_donors / block_rows))
    q = gaps.withColumn("_a", F.pmod(F.xxhash64("_id"), F.lit(qblocks)).cast("int"))
    q = q.withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(cblocks - 1))))
    c = donors.select(F.col("_id").alias("_donor"), F.col("_vec").alias("_dvec"))
    c = c.withColumn("_b", F.pmod(F.xxhash64("_donor"), F.lit(cblocks)).cast("int"))
    c = c.withColumn("_a", F.explode(F.sequence(F.lit(0), F.lit(qblocks - 1))))
    kind = gaps.schema["_id"].dataType
    schema = T.StructType([
        T.StructField("_id", kind), T.StructField("_var", T.IntegerType()), T.StructField("_donor", kind),
        T.StructField("_d", T.DoubleType()), T.StructField("_value", T.DoubleType()),
    ])

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = ["_id", "_var", "_donor", "_d", "_value"]
        if left.empty or right.empty:
            return pd.DataFrame(columns=names)
        x = np.array([np.asarray(v, dtype=float) for v in left["_vec"]])
        right = right.sort_values("_donor")
        y = np.array([np.asarray(v, dtype=float) for v in right["_dvec"]])
        donors, ids = right["_donor"].to_numpy(), left["_id"].to_numpy()
        parts = []
        known, filled = ~np.isnan(y), np.nan_to_num(y)
        for part in chunks(len(x), len(y), 1):
            total, shared = np.zeros((len(x[part]), len(y))), np.zeros((len(x[part]), len(y)), dtype=np.int64)
            for j in range(width):
                both = ~np.isnan(x[part][:, j])[:, None] & known[None, :, j]
                gap = np.nan_to_num(x[part][:, j])[:, None] - filled[None, :, j]
                total += np.where(both, gap * gap, 0.0)
                shared += both
            with np.errstate(divide="ignore", invalid="ignore"):
                d = np.where(shared > 0, np.sqrt(total * width / shared), np.inf)
            for var in range(width):
                need = np.flatnonzero(np.isnan(x[part][:, var]))
                have = np.flatnonzero(~np.isnan(y[:, var]))
                if not len(need) or not len(have):
                    continue
                block = d[np.ix_(need, have)]
                keep = min(k, len(have))
                bound = np.partition(block, keep - 1, axis=1)[:, keep - 1:keep]
                rows, cols = np.nonzero((block <= bound) & np.isfinite(block))
                order = np.lexsort((cols, block[rows, cols], rows))
                rows, cols = rows[order], cols[order]
                best_rows = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") < k
                rows, cols = rows[best_rows], cols[best_rows]
                parts.append(pd.DataFrame({
                    "_id": ids[part][need[rows]], "_var": var, "_donor": donors[have[cols]],
                    "_d": block[rows, cols], "_value": y[have[cols], var],
                }))
        return pd.concat(parts) if parts else pd.DataFrame(columns=names)

    return q.groupBy("_a", "_b").cogroup(c.groupBy("_a", "_b")).applyInPandas(best, schema)
