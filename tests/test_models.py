import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tabloom.operators.metrics import binary_metrics, confusion_matrix, forecast_errors, roc_points, weighted_metrics, wide_metrics
from tabloom.plans import studies as S
from tabloom.plans.neighbor_model import NeighborModel
from tabloom.plans.prep import Preparation
from tabloom.plans.registry import ModelRegistry, load_model, load_params, save_model
from tabloom.session import scratch_path
from tabloom.streaming.streams import read_stream, run_available, score_stream, stream_by_period


@pytest.fixture(scope="module")
def splits(spark):
    rng = random.Random(5)
    rows = [(i, rng.gauss(i % 2, 0.7), rng.random(), float(i % 2)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, a double, b double, y double")
    train, test = df.filter("id < 200"), df.filter("id >= 200")
    return S.assemble(train, ["a", "b"], "y", "id").cache(), S.assemble(test, ["a", "b"], "y", "id").cache()


def test_a_winner_needs_a_clear_gain():
    study = S.Study("x", "accuracy")
    for i, v in enumerate((0.5, 0.5005, 0.502, 0.4)):
        study.offer({"i": i}, v, None)
    assert (study.best_params, study.best_value) == ({"i": 2}, 0.502)
    assert S._first_best([{m: 0.0 for m in S.CLASS_METRICS}], "f1") == {}


def test_grid_sizes():
    assert S.tree_sizes(2500, 500, 100) == [100, 500, 1000, 1500, 2000, 2500]
    assert S.tree_sizes(20, 10) == [10, 20]


def test_full_prefix_is_the_model(splits):
    train, test = splits
    for model in (RandomForestClassifier(numTrees=7, maxDepth=3, seed=1).fit(train), GBTClassifier(maxIter=5, maxDepth=2, seed=1).fit(train)):
        size = len(model.trees)
        want = {r["id"]: r["prediction"] for r in model.transform(test).collect()}
        totals = S.ensemble_totals(test, model, [2, size])
        got = {r["id"]: r["p"] for r in totals.select("id", S.ensemble_prediction(model, size).alias("p")).collect()}
        assert got == want
        assert {r["id"]: r["prediction"] for r in S.ForestPrefix(model, size).transform(test).collect()} == want


def test_models_score_after_a_table_was_observed(spark, splits):
    seen = Observation()
    spark.range(3).observe(seen, F.count("*").alias("n")).collect()
    assert seen.get == {"n": 3}
    train, test = (d.drop("id") for d in splits)
    linear = S.logistic_regression_study(train, test, max_iterations=10, lag=5)
    forest = S.random_forest_study(train, test, max_trees=4, lag=2, depths=(2,), shares=(0.9,))
    for study, n in ((linear, 4), (forest, 2)):
        assert len(study.scores) == n
        assert study.best_model.transform(test).where("prediction = label").count() / test.count() == pytest.approx(study.best_value)
    done = S.train_models(train, test, ["LR"], options={"LR": {"max_iterations": 5, "lag": 5}})
    assert done[0].scores[0] == linear.scores[0]


def test_boosting_prefix_is_a_shorter_model(splits):
    train, test = splits
    long, short = (GBTClassifier(maxIter=n, maxDepth=2, seed=1).fit(train) for n in (6, 3))
    got = S.ForestPrefix(long, 3).transform(test).select("id", "prediction")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, short.transform(test).select("id", "prediction").collect()))


def test_all_sizes_of_a_large_forest_in_one_pass(spark, splits, tmp_path):
    train, test = splits
    model = RandomForestClassifier(numTrees=30, maxDepth=4, seed=1).fit(train)
    totals = S.ensemble_totals(test, model, [1, 10, 30])
    rows = {r["id"]: r for r in totals.collect()}
    for size in (1, 10, 30):
        want = {}
        for tree in model.trees[:size]:
            for r in tree.transform(test.select("id", "features")).collect():
                want[r["id"]] = want.get(r["id"], 0.0) + r["probability"][1]
        assert {i: r[f"_at_{size}"] for i, r in rows.items()} == pytest.approx(want)
    plan = totals._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    test.select("id", "features").write.parquet(str(tmp_path / "rows"))
    stream = S.ForestPrefix(model, 29).transform(read_stream(spark, str(tmp_path / "rows"), test.select("id", "features").schema))
    got = run_available(stream.select("id", "prediction"), str(tmp_path / "scored"))
    batch = S.ForestPrefix(model, 29).transform(test).select("id", "prediction")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_saved_prefix(spark, splits):
    train, test = splits
    model = S.ForestPrefix(RandomForestClassifier(numTrees=5, maxDepth=3, seed=1).fit(train), 3)
    path = scratch_path(spark, "forest")
    save_model(spark, model, path)
    again = load_model(spark, path)
    assert again.size == 3
    assert again.transform(test).select("id", "prediction").orderBy("id").collect() == model.transform(test).select("id", "prediction").orderBy("id").collect()


def test_train_models_and_errors(splits):
    train, test = splits
    done = S.train_models(train, test, ["DT", "MLP"], options={"DT": {"max_depth": 4}, "MLP": {"max_iterations": 10, "lag": 10, "rates": (0.1,), "hidden": 4}})
    assert [len(s.scores) for s in done] == [4, 1] and done[0].best_value > 0.6
    with pytest.raises(ValueError):
        S.train_models(train, test, ["unknown"])


def test_importance_ranks(spark, splits):
    train, _ = splits
    model = RandomForestClassifier(numTrees=5, maxDepth=3, seed=1).fit(train)
    rows = S.importance_table(spark, model, ["a", "b"]).orderBy("rank").collect()
    assert rows[0]["variable"] == "a" and rows[0]["importance"] > rows[1]["importance"] and rows[0]["std"] is not None


def test_metrics_of_one_class(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (1, 1)], "label int, prediction int")
    row = binary_metrics(df).first()
    assert (row["recall"], row["auc_hard"]) == (1.0, 0.5) and row["precision"] == pytest.approx(2 / 3)
    none = binary_metrics(spark.createDataFrame([(0, 0)], "label int, prediction int")).first()
    assert (none["accuracy"], none["recall"], none["precision"], none["f1"]) == (1.0, 0.0, 0.0, 0.0)
    assert {(r["label"], r["prediction"]): r["n"] for r in confusion_matrix(df, "label", "prediction", [0, 1]).collect()} == {
        (0, 0): 0, (0, 1): 1, (1, 0): 0, (1, 1): 2}
    weighted = weighted_metrics(df, "label", "prediction").first()
    assert weighted["precision"] == pytest.approx(2 / 3 * 2 / 3) and weighted["recall"] == pytest.approx(2 / 3)


def test_roc_with_tied_scores(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1)], "y int, s double")
    got = [(r["threshold"], r["fpr"], r["tpr"]) for r in roc_points(df, "y", "s").orderBy("threshold", ascending=False).collect()]
    assert got == [(0.9, 0.5, 0.5), (0.5, 0.5, 1.0), (0.1, 1.0, 1.0)]


def test_forecast_errors(spark):
    y, p = np.array([1.0, 2.0, 0.0, 4.0]), np.array([1.5, 2.0, 0.0, 3.0])
    row = forecast_errors(spark.createDataFrame(pd.DataFrame({"y": y, "p": p})), "y", "p").first()
    assert row["mse"] == pytest.approx(((y - p) ** 2).mean()) and row["mae"] == pytest.approx(0.375)
    assert row["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert row["mape"] == pytest.approx((0.5 + 0.25) / 4)


def test_registry_and_streams(spark):
    rng = random.Random(9)
    df = spark.createDataFrame([(i, rng.gauss(i % 2, 0.5), rng.random(), i % 2) for i in range(150)], "id int, a double, b double, y int")
    prep = Preparation(key="id", target="y", scaling="zscore").fit(df)
    train = S.assemble(prep.prepared.filter("split = 'train'"), prep.features, "y")
    registry = ModelRegistry(prep)
    registry.add("tree", S.DecisionTreeClassifier(maxDepth=3, seed=1).fit(train))
    path = scratch_path(spark, "registry")
    registry.save(spark, path)
    again = ModelRegistry.load(spark, path)
    assert again.list_models() == ["tree"] and again.default_model == "tree"
    with pytest.raises(KeyError):
        again.predict(df, "other")
    assert again.evaluate(df).count() == 10
    source = scratch_path(spark, "stream-in")
    df.drop("y").repartition(3).write.parquet(source)
    scored = run_available(score_stream(read_stream(spark, source, "id int, a double, b double"), again), scratch_path(spark, "stream-out"))
    assert sorted(map(tuple, scored.collect())) == sorted(map(tuple, again.predict(df).collect()))


def test_late_rows_are_dropped(spark):
    source, sink, state = (scratch_path(spark, n) for n in ("late-in", "late-out", "late-state"))
    schema = "ts timestamp_ntz, v double"

    def add(*rows):
        spark.sql("SELECT " + " UNION ALL SELECT ".join(f"timestamp_ntz'2024-01-01 {t}' AS ts, {v}D AS v" for t, v in rows)).coalesce(1).write.mode("append").parquet(source)

    add(("00:10:00", 1), ("03:30:00", 2))
    def run():
        stream = stream_by_period(read_stream(spark, source, schema), "ts", ["v"], "H", "sum", watermark="1 hour")
        return run_available(stream, sink, checkpoint=state)
    assert [(r["ts"].hour, r["v"]) for r in run().orderBy("ts").collect()] == [(0, 1.0)]
    # The first row of the next file is older than the watermark of 02:30, the second is not.
    add(("00:20:00", 50), ("02:45:00", 4), ("06:00:00", 8))
    assert [(r["ts"].hour, r["v"]) for r in run().orderBy("ts").collect()] == [(0, 1.0), (2, 4.0), (3, 2.0)]


def neighbor_rows(spark, n=120):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(n, 2)).round(1)
    rows = [(i, float(a), float(b), int(a + b > 0), "t") for i, (a, b) in enumerate(x)]
    return rows, spark.createDataFrame(rows, "id long, a double, b double, y int, note string")


def brute_votes(train, test, k):
    out = {}
    for i, a, b, *_ in test:
        near = sorted(((a - c) ** 2 + (b - d) ** 2, j, y) for j, c, d, y, _ in train)[:k]
        ones = sum(y for *_, y in near)
        out[i] = float(ones * 2 > k)
    return out


def test_neighbor_model_scores_batches_and_streams_after_loading(spark, tmp_path):
    rows, df = neighbor_rows(spark)
    train, test = df.filter("id >= 40"), df.filter("id < 40")
    parts = [S.assemble(d, ["a", "b"], "y", "id") for d in (train, test)]
    S.train_models(*parts, ["KNN"], options={"KNN": {"ks": (5,), "distances": ("euclidean",), "key": "id"}}, save_to=str(tmp_path / "m"))
    model = load_model(spark, str(tmp_path / "m" / "KNN"))
    assert load_params(spark, str(tmp_path / "m" / "KNN")) == {"metric": "euclidean", "k": 5}
    batch = model.transform(parts[1])
    assert batch.columns == ["id", "features", "label", "prediction"]
    want = brute_votes(rows[40:], rows[:40], 5)
    assert {r["id"]: r["prediction"] for r in batch.collect()} == want
    # Repeated rows and other columns travel with the stream.
    twice = test.unionByName(test).select("id", "note", F.array("a", "b").alias("features"))
    twice.write.parquet(str(tmp_path / "rows"))
    scored = model.transform(read_stream(spark, str(tmp_path / "rows"), twice.schema))
    got = run_available(scored, str(tmp_path / "scored"))
    assert sorted((r["id"], r["note"], r["prediction"]) for r in got.collect()) == sorted((i, "t", p) for i, p in want.items() for _ in range(2))


def test_neighbor_model_in_a_registry(spark, tmp_path):
    rows, df = neighbor_rows(spark)
    fitted = Preparation(key="id", target="y", scaling="minmax").fit(df.drop("note"))
    train = S.assemble(fitted.prepared.filter("split = 'train'"), fitted.features, "y", "id")
    registry = ModelRegistry(fitted)
    registry.add("near", NeighborModel.fit_rows(train, 3, key="id"), {"k": 3})
    registry.save(spark, str(tmp_path / "r"))
    loaded = ModelRegistry.load(spark, str(tmp_path / "r"))
    assert loaded.list_models() == ["near"] and loaded.hyperparams == {"near": {"k": 3}}
    got = {r["id"]: r["prediction"] for r in loaded.predict(df.drop("note")).collect()}
    scaled = [(r["id"], *r["features"].toArray().tolist(), int(r["label"]), "t") for r in train.collect()]
    every = VectorAssembler(inputCols=fitted.features, outputCol="features").transform(fitted.transform(df.drop("note"))).collect()
    assert got == brute_votes(scaled, [(r["id"], *r["features"].toArray().tolist()) for r in every], 3)
    with pytest.raises(ValueError, match="up to 3"):
        loaded.models["near"].with_k(4)


def test_curves_of_several_models(spark):
    rng = np.random.default_rng(3)
    rows = [(m, float(rng.integers(0, 9)), int(rng.integers(0, 2))) for m in ("a", "b", None) for _ in range(60)] + [("c", 1.0, 1), ("c", 2.0, 1)]
    df = spark.createDataFrame(rows, "model string, score double, y int")
    got = {(r["model"], r["threshold"]): (r["fpr"], r["tpr"]) for r in roc_points(df, "y", "score", by=["model"]).collect()}
    want = {}
    for m in {r[0] for r in rows}:
        own = [(s, y) for n, s, y in rows if n == m]
        yes, no = sum(y for _, y in own), sum(1 - y for _, y in own)
        for t in {s for s, _ in own}:
            want[m, t] = (sum(1 - y for s, y in own if s >= t) / no if no else 0.0, sum(y for s, y in own if s >= t) / yes)
    near = lambda points: {k: pytest.approx(v) for k, v in points.items()}
    assert got == near(want)
    single = {r["threshold"]: (r["fpr"], r["tpr"]) for r in roc_points(df.filter("model = 'a'"), "y", "score").collect()}
    assert single == near({t: v for (m, t), v in want.items() if m == "a"})


def test_metrics_of_predictions_side_by_side(spark):
    df = spark.createDataFrame([(i % 2, i % 3 % 2, 1, "tr" if i < 20 else "te") for i in range(60)], "y int, p int, q int, split string")
    got = {(r["model"], r["split"]): r.asDict() for r in wide_metrics(df, "y", {"first": "p", "second": "q"}, ["split"]).collect()}
    for name, column in (("first", "p"), ("second", "q")):
        for r in binary_metrics(df, "y", column, ["split"]).collect():
            assert {k: got[name, r["split"]][k] for k in S.CLASS_METRICS} == {k: r[k] for k in S.CLASS_METRICS}


def test_iterations_go_on_from_the_last_weights(spark, splits):
    train, test = splits
    table, losses = S.iteration_overfitting(spark, {"train": train, "test": test}, [2, 5, 2], [3, 9, 30], rate=0.3)
    assert losses == sorted(losses, reverse=True) and losses[-1] < losses[0]
    assert {(r["param"], r["split"]) for r in table.collect()} == {(n, s) for n in (3.0, 9.0, 30.0) for s in ("train", "test")}
