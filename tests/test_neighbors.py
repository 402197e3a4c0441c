import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.operators.balancing import smote_balance, synthetic_rows
from tabloom.operators.missing import impute_by_neighbors
from tabloom.operators.metric_index import build_index, index_neighbors, visited_leaves
from tabloom.operators.neighbors import METRICS, feature_vector, index_points, knn_join, knn_vote, missing_value_donors, pair_distances
from tabloom.session import materialize

COLUMNS = ["a", "b", "c"]


def table(spark, x, key):
    return spark.createDataFrame(pd.DataFrame(x, columns=COLUMNS).assign(**{key: np.arange(len(x))}))


def brute(q, c, k, metric, exclude=False):
    d = pair_distances(q, c, metric)
    if exclude:
        np.fill_diagonal(d, np.inf)
    order = np.lexsort((np.broadcast_to(np.arange(len(c)), d.shape), d), axis=1)[:, :k]
    return order, np.take_along_axis(d, order, 1)


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("block_rows", [40, 5000])
def test_matches_brute_force(spark, metric, block_rows):
    rng = np.random.default_rng(2)
    c = np.concatenate([rng.normal(size=(150, 3)), rng.normal(8, 0.5, size=(80, 3)), rng.integers(0, 3, size=(70, 3)).astype(float)])
    q = rng.normal(3, 4, size=(60, 3))
    got = knn_join(table(spark, q, "qid"), table(spark, c, "cid"), 4, query_id="qid", candidate_id="cid", features=COLUMNS,
                   metric=metric, block_rows=block_rows).orderBy("qid", "rank").toPandas()
    order, dist = brute(q, c, 4, metric)
    np.testing.assert_allclose(got["distance"].to_numpy().reshape(60, 4), dist, atol=1e-12)
    assert (got["cid"].to_numpy().reshape(60, 4) == order).all()


@pytest.mark.parametrize("block_rows", [25, 5000])
def test_a_third_of_the_rows_are_copies(spark, block_rows):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(180, 3))
    x[::3] = [0.5, 0.5, 0.5]
    df = table(spark, x, "id")
    got = knn_join(df, df, 5, query_id="id", candidate_id="id", features=COLUMNS, exclude_self=True, block_rows=block_rows)
    got = got.orderBy("id", "rank").toPandas()
    order, dist = brute(x, x, 5, "euclidean", exclude=True)
    assert (got["neighbor_id"].to_numpy().reshape(180, 5) == order).all()
    np.testing.assert_allclose(got["distance"].to_numpy().reshape(180, 5), dist, atol=1e-12)


def test_fewer_candidates_than_k_and_none(spark):
    q, c = table(spark, np.zeros((2, 3)), "qid"), table(spark, np.ones((3, 3)), "cid")
    got = knn_join(q, c, 10, query_id="qid", candidate_id="cid", features=COLUMNS)
    assert got.count() == 6
    empty = knn_join(q, c.limit(0), 3, query_id="qid", candidate_id="cid", features=COLUMNS, keep=["a"])
    assert empty.columns == ["qid", "cid", "distance", "rank", "a"] and empty.count() == 0


def test_vote_prefers_the_smallest_label_on_ties(spark):
    near = spark.createDataFrame([(1, 1, 2), (1, 2, 0), (1, 3, 2)], "q int, rank int, y int")
    got = {r["k"]: r["prediction"] for r in knn_vote(near, "q", "y", [1, 2, 3]).collect()}
    assert got == {1: 2, 2: 0, 3: 2}


def test_imputation_by_neighbors(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(90, 3))
    x[::4, 0] = np.nan
    x[1::6, 1] = np.nan
    x[8] = np.nan
    pdf = pd.DataFrame(x, columns=COLUMNS).assign(id=np.arange(90))
    holes = pdf.astype(object).where(pdf.notna(), None)
    holes.loc[4, "a"] = float("nan")  # a NaN is a gap as well
    df = spark.createDataFrame([tuple(r) for r in holes.itertuples(index=False)], "a double, b double, c double, id long")
    for block_rows in (20, 5000):
        got = impute_by_neighbors(df, "id", COLUMNS, 5, block_rows=block_rows).orderBy("id").toPandas()[COLUMNS].to_numpy()
        for i in range(90):
            for j in range(3):
                if not np.isnan(x[i, j]):
                    assert got[i, j] == x[i, j]
                    continue
                options = []
                for o in range(90):
                    shared = ~np.isnan(x[i]) & ~np.isnan(x[o])
                    if not np.isnan(x[o, j]) and shared.any():
                        options.append((np.sqrt(((x[i] - x[o])[shared] ** 2).sum() * 3 / shared.sum()), o))
                want = np.mean([x[o, j] for _, o in sorted(options)[:5]]) if options else np.nanmean(x[:, j])
                assert got[i, j] == pytest.approx(want)


def test_synthetic_rows_lie_between_neighbors(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(60, 3))
    df = table(spark, x, "id").selectExpr("*", "CASE WHEN id < 12 THEN 1 ELSE 0 END AS y")
    new = synthetic_rows(df, "y", "id", COLUMNS).toPandas()
    assert len(new) == 36 and (new["y"] == 1).all()
    rare = x[:12]
    assert (new[COLUMNS].to_numpy().min(0) >= rare.min(0) - 1e-9).all() and (new[COLUMNS].to_numpy().max(0) <= rare.max(0) + 1e-9).all()
    counts = {r["y"]: r["count"] for r in smote_balance(df, "y", "id", COLUMNS).groupBy("y").count().collect()}
    assert counts == {0: 48, 1: 48}
    again = synthetic_rows(df.repartition(7), "y", "id", COLUMNS).toPandas()
    pd.testing.assert_frame_equal(new.sort_values("synthetic_id", ignore_index=True), again.sort_values("synthetic_id", ignore_index=True))


@pytest.mark.parametrize("block_rows", [4096, 8])
def test_incomplete_features_are_refused_or_left_out(spark, block_rows):
    rows = [(i, float(i)) for i in range(20)]
    whole = spark.createDataFrame(rows, "id int, x double")
    faulty = spark.createDataFrame([*rows, (40, None), (41, float("nan")), (42, float("inf"))], "id int, x double")
    settings = dict(k=1, query_id="id", candidate_id="id", features=["x"], exclude_self=True, block_rows=block_rows)
    with pytest.raises(ValueError, match="3 candidates"):
        knn_join(whole, faulty, **settings)
    with pytest.raises(ValueError, match="3 queries"):
        knn_join(faulty, whole, **settings)
    left = knn_join(faulty, faulty, missing="drop", **settings)
    assert sorted((r["id"], r["neighbor_id"]) for r in left.collect()) == [(0, 1), *((i, i - 1) for i in range(1, 20))]


@pytest.mark.parametrize("metric", METRICS)
def test_deep_trees_equal_brute_force(spark, metric):
    rng = np.random.default_rng(12)
    c = np.concatenate([rng.normal(size=(500, 3)), rng.integers(0, 2, size=(100, 3)).astype(float), np.full((40, 3), 7.0)])
    q = np.concatenate([rng.normal(size=(60, 3)), np.full((5, 3), 7.0), rng.normal(50, 1, size=(5, 3))])
    rows = materialize(table(spark, c, "_cid").select("_cid", feature_vector(COLUMNS).alias("_vec")), "points")
    index = build_index(rows, metric, 3, len(c), leaf_rows=60, fanout=3)
    assert index.depth >= 2 and index.nodes.filter("level = 1").agg(F.sum("n")).first()[0] == len(c)
    asking = materialize(table(spark, q, "_id").select("_id", feature_vector(COLUMNS).alias("_vec"), F.lit(None).cast("boolean").alias("_pay")), "asking")
    near = index_neighbors(index, asking, 6).toPandas().sort_values(["_id", "_d", "_cid"])
    got = near.groupby("_id")["_cid"].apply(lambda v: list(v[:6]))
    order, _ = brute(q, c, 6, metric)
    assert [got[k] for k in range(len(q))] == order.tolist()


def test_visits_do_not_grow_with_the_points(spark):
    """Ten times the points cost a query no more leaves, because the leaves get smaller."""
    seen = []
    for n in (2_000, 20_000):
        rng = np.random.default_rng(3)
        points = spark.createDataFrame(pd.DataFrame(rng.uniform(size=(n, 2)), columns=["a", "b"]).assign(_cid=np.arange(n)))
        index = index_points(points.select("_cid", feature_vector(["a", "b"]).alias("_vec")), 5, "euclidean", leaf_rows=200)
        asking = points.filter("_cid < 300").select(F.col("_cid").alias("_id"), feature_vector(["a", "b"]).alias("_vec"), F.lit(None).cast("boolean").alias("_pay"))
        asking = materialize(asking, "asking")
        near = index_neighbors(index, asking, 5, n_queries=300).groupBy("_id").agg(F.sort_array(F.collect_list("_d"))[4].alias("bound"))
        visits = visited_leaves(index, asking.join(near, "_id"), "bound").agg(F.avg("n")).first()[0]
        seen.append(visits)
        assert index.nodes.count() >= n / 400
    assert max(seen) < 8 and seen[1] < 1.5 * seen[0]


def test_common_patterns_of_gaps_use_an_index(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 6, size=(400, 3)).astype(float)
    x[:60, 0] = np.nan
    x[60:100, 1] = np.nan
    x[100:104, :2] = np.nan
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) + (i,) for i, r in enumerate(x)], "a double, b double, c double, id long")
    want = {}
    for i in range(400):
        for j in range(3):
            if np.isnan(x[i, j]):
                options = []
                for o in range(400):
                    shared = ~np.isnan(x[i]) & ~np.isnan(x[o])
                    if not np.isnan(x[o, j]) and shared.any():
                        options.append((np.sqrt(((x[i] - x[o])[shared] ** 2).sum() * 3 / shared.sum()), o))
                want[i, COLUMNS[j]] = [o for _, o in sorted(options)[:4]]
    for block_rows in (30, 4096):
        rows = missing_value_donors(df, "id", COLUMNS, 4, block_rows=block_rows).toPandas().sort_values(["id", "variable", "distance", "donor"])
        got = {k: list(v) for k, v in rows.groupby(["id", "variable"])["donor"]}
        assert got == want


@pytest.mark.parametrize("metric", METRICS)
@pytest.mark.parametrize("exclude_self", [False, True])
def test_a_sweep_matches_brute_force(spark, monkeypatch, metric, exclude_self):
    from tabloom.operators import neighbors, pair_sweep

    monkeypatch.setattr(neighbors, "_sweeps", lambda *_: True)
    for name, value in (("QUERY_BLOCK", 30), ("POINT_BLOCK", 40), ("LEAST_BLOCK", 30), ("PART_CELLS", 300), ("SCREEN_PAIRS", 500)):
        monkeypatch.setattr(pair_sweep, name, value)
    rng = np.random.default_rng(7)
    # Copies, ties, and vectors that single precision does not hold.
    x = np.concatenate([rng.normal(size=(90, 3)), rng.integers(0, 3, size=(70, 3)).astype(float), np.full((20, 3), 0.5), rng.normal(1e6, 1e-3, size=(30, 3))])
    df = table(spark, x, "id")
    got = knn_join(df, df, 6, query_id="id", candidate_id="id", features=COLUMNS, metric=metric, exclude_self=exclude_self, keep=["a"])
    got = got.orderBy("id", "rank").toPandas()
    order, dist = brute(x, x, 6, metric, exclude=exclude_self)
    assert (got["neighbor_id"].to_numpy().reshape(-1, 6) == order).all()
    np.testing.assert_allclose(got["distance"].to_numpy().reshape(-1, 6), dist, atol=1e-12)
    np.testing.assert_array_equal(got["a"].to_numpy().reshape(-1, 6), x[order, 0])


def test_a_sweep_with_fewer_points_than_k_and_text_ids(spark, monkeypatch):
    from tabloom.operators import neighbors

    monkeypatch.setattr(neighbors, "_sweeps", lambda *_: True)
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 3.0)], "id string, x double")
    got = knn_join(df, df, 5, query_id="id", candidate_id="id", features=["x"], exclude_self=True).orderBy("id", "rank")
    assert [(r["id"], r["neighbor_id"], r["distance"]) for r in got.collect()] == [
        ("a", "b", 0.0), ("a", "c", 2.0), ("b", "a", 0.0), ("b", "c", 2.0), ("c", "a", 2.0), ("c", "b", 2.0)]


def test_many_dimensions_write_no_copies_of_queries(spark, monkeypatch):
    """Written tables follow the rows of both sides, not their product; a few dimensions keep the index."""
    import os

    from tabloom.operators import neighbors
    from tabloom.session import shared_folder

    monkeypatch.setattr(neighbors, "DIRECT_ROWS", 512)
    monkeypatch.setattr(neighbors, "LEAF_ROWS", 64)
    rng = np.random.default_rng(9)
    c, q = rng.normal(size=(4000, 32)), rng.normal(size=(1500, 32))
    names = [f"x{j}" for j in range(32)]
    sides = [materialize(spark.createDataFrame(pd.DataFrame(x, columns=names).assign(**{key: np.arange(len(x))})), "sides") for x, key in ((q, "qid"), (c, "cid"))]

    def written() -> int:
        return sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(shared_folder(spark)) for f in files)

    before = written()
    got = knn_join(*sides, 5, query_id="qid", candidate_id="cid", features=names).orderBy("qid", "rank").toPandas()
    assert written() - before < 3 * 8 * 32 * (len(c) + len(q))
    order, dist = brute(q, c, 5, "euclidean")
    assert (got["cid"].to_numpy().reshape(-1, 5) == order).all()
    np.testing.assert_allclose(got["distance"].to_numpy().reshape(-1, 5), dist, atol=1e-12)
    few = [spark.createDataFrame(pd.DataFrame(rng.normal(size=(3000, 2)), columns=["x", "y"])).select(
        F.monotonically_increasing_id().alias(key), F.array("x", "y").alias("_vec")) for key in ("_cid", "_id")]
    assert not neighbors._sweeps(materialize(few[0], "c"), materialize(few[1], "q"), 3000, 3000, "euclidean", 2)
