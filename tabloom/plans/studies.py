"""Model studies on Spark ML: walk a grid, score every candidate, keep the best."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce
from time import perf_counter

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import Binarizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.operators.metrics import CLASS_METRICS, binary_metrics, weighted_metrics
from tabloom.operators.neighbors import knn_join, knn_vote
from tabloom.plans.flat_trees import flat_trees, running_totals
from tabloom.plans.neighbor_model import NeighborModel
from tabloom.session import local_table, materialize, scratch_path

# Fixed value: a candidate replaces the best one only by more than this.
DELTA_IMPROVE = 0.001
SEED = 42


@dataclass
class Study:
    """All scores of a grid and the winner."""

    name: str
    metric: str
    scores: list[tuple[dict, float]] = field(default_factory=list)
    best_params: dict | None = None
    best_value: float = 0.0
    best_model: Transformer | None = None
    seconds: float = 0.0

    def offer(self, params: dict, value: float, model: Transformer | None) -> None:
        self.scores.append((params, value))
        if value - self.best_value > DELTA_IMPROVE:
            self.best_params, self.best_value, self.best_model = params, value, model

    def rows(self) -> list[tuple[str, str, str, float]]:
        text = [(", ".join(f"{k}={v}" for k, v in p.items()), s) for p, s in self.scores]
        return [(self.name, p, self.metric, float(s)) for p, s in text]


STUDY_SCHEMA = "model string, params string, metric string, value double"


def study_table(spark, studies: Sequence[Study]) -> DataFrame:
    return local_table(spark, [r for s in studies for r in s.rows()], STUDY_SCHEMA)


def assemble(df: DataFrame, features: Sequence[str], target: str, key: str | None = None) -> DataFrame:
    """Feature vector and double label; rows with an unknown feature are rejected by the assembler."""
    named = df.select(*([key] if key else []), *features, F.col(target).cast("double").alias("label"))
    stage = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    return stage.transform(named).select(*([key] if key else []), "features", "label")


@contextmanager
def cached(*tables: DataFrame):
    """Keep training tables in memory for the passes of a study."""
    kept = [t.persist() for t in tables]
    try:
        yield kept
    finally:
        for t in kept:
            t.unpersist()


def run_grid(tasks: Sequence[Callable], parallelism: int = 4) -> list:
    """Submit independent fits from a few driver threads; Spark runs them side by side."""
    if parallelism <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(lambda t: t(), [inheritable_thread_target(SparkSession.active())(t) for t in tasks]))


def tagged_predictions(models: Sequence[tuple[int, Transformer]], splits: dict[str, DataFrame]) -> DataFrame:
    """(candidate, split, label, prediction) of every model on every split, in one plan."""
    parts = []
    for i, model in models:
        for split, df in splits.items():
            parts.append(model.transform(df).select(
                F.lit(i).alias("candidate"), F.lit(split).alias("split"), "label", "prediction"))
    return reduce(DataFrame.unionByName, parts)


def score_models(models: Sequence[tuple[int, Transformer]], splits: dict[str, DataFrame]) -> dict[tuple[int, str], dict]:
    rows = binary_metrics(tagged_predictions(models, splits), by=["candidate", "split"]).collect()
    return {(r["candidate"], r["split"]): r.asDict() for r in rows}


def run_study(name: str, grid: Sequence[tuple[dict, Callable]], test: DataFrame, metric: str, parallelism: int = 4) -> Study:
    """Fit every grid point, score all on the test split in one job, offer them in grid order."""
    start = perf_counter()
    study = Study(name, metric)
    models = run_grid([make for _, make in grid], parallelism)
    scores = score_models(list(enumerate(models)), {"test": test})
    for i, (params, _) in enumerate(grid):
        study.offer(params, scores[(i, "test")][metric], models[i])
    study.seconds = perf_counter() - start
    return study


# --- estimators --------------------------------------------------------------


def fitted(learner, train: DataFrame) -> Transformer:
    """A model without its training summary: it is saved and loaded.

    The summary of a learner of two classes holds the session, which cannot be
    sent to tasks any more once a table of it has been observed; a model that
    keeps its summary then scores nothing.
    """
    model = learner.fit(train)
    path = scratch_path(train.sparkSession, "model")
    model.write().save(path)
    return type(model).load(path)


def naive_bayes(kind: str) -> Pipeline:
    if kind == "bernoulli":
        flags = Binarizer(threshold=0.0, inputCol="features", outputCol="flags")
        return Pipeline(stages=[flags, NaiveBayes(modelType="bernoulli", featuresCol="flags")])
    return Pipeline(stages=[NaiveBayes(modelType=kind)])


def logistic_regression(penalty: str, iterations: int, n: int, c: float = 1.0) -> LogisticRegression:
    return LogisticRegression(
        elasticNetParam=1.0 if penalty == "l1" else 0.0, regParam=1.0 / (c * max(n, 1)),
        maxIter=iterations, standardization=False,
    )


def naive_bayes_study(train, test, *, kinds=("gaussian", "multinomial", "bernoulli"), metric="accuracy", parallelism=4) -> Study:
    grid = [({"kind": k}, lambda k=k: naive_bayes(k).fit(train)) for k in kinds]
    return run_study("NB", grid, test, metric, parallelism)


def logistic_regression_study(train, test, *, max_iterations=5000, lag=500, metric="accuracy", parallelism=4) -> Study:
    n = train.count()
    steps = range(lag, max_iterations + 1, lag)
    grid = [
        ({"penalty": p, "iterations": i}, lambda p=p, i=i: fitted(logistic_regression(p, i, n), train))
        for p in ("l1", "l2") for i in steps
    ]
    return run_study("LR", grid, test, metric, parallelism)


def decision_tree_study(train, test, *, max_depth=10, lag=2, metric="accuracy", parallelism=4) -> Study:
    if max_depth > 30:
        raise ValueError("trees are at most 30 deep")
    grid = [
        ({"impurity": c, "depth": d},
         lambda c=c, d=d: DecisionTreeClassifier(impurity=c, maxDepth=d, seed=SEED).fit(train))
        for c in ("entropy", "gini") for d in range(2, max_depth + 1, lag)
    ]
    return run_study("DT", grid, test, metric, parallelism)


def mlp_study(train, test, n_features: int, *, max_iterations=1000, lag=250, rates=(0.5, 0.05, 0.005, 0.0005),
              hidden=100, metric="accuracy", parallelism=4) -> Study:
    """One hidden layer trained by gradient descent at a constant rate."""
    steps = [lag * i for i in range(1, max(1, max_iterations // lag) + 1)]
    grid = [
        ({"rate": r, "iterations": i},
         lambda r=r, i=i: MultilayerPerceptronClassifier(
             layers=[n_features, hidden, 2], solver="gd", stepSize=r, maxIter=i, seed=SEED).fit(train))
        for r in rates for i in steps
    ]
    return run_study("MLP", grid, test, metric, parallelism)


class ForestPrefix(Transformer):
    """The first ``size`` trees of a trained ensemble as a predictor, for batches and streams.

    ``total`` adds the trees' outputs; the class is 1 when the total passes
    ``cut * size`` (share of votes) or 0 (margin).
    """

    def __init__(self, model, size: int):
        super().__init__()
        self.model, self.size = model, size

    def _transform(self, df: DataFrame) -> DataFrame:
        if self.size == len(self.model.trees):
            return self.model.transform(df).drop("rawPrediction", "probability")
        scored = ensemble_totals(df, self.model, [self.size])
        return scored.withColumn("prediction", ensemble_prediction(self.model, self.size)).drop(f"_at_{self.size}")


def _is_forest(model) -> bool:
    return "RandomForest" in type(model).__name__


def ensemble_totals(df: DataFrame, model, sizes: Sequence[int]) -> DataFrame:
    """Running totals of the tree outputs at the wanted ensemble sizes, as columns ``_at_<size>``.

    All trees score a batch of rows in one pass, whatever the number of sizes
    or trees, and nothing is written on the way.
    """
    sizes = sorted(sizes)
    sent = df.sparkSession.sparkContext.broadcast(flat_trees(df.sparkSession, model, sizes[-1]))

    @F.pandas_udf("array<double>")
    def totals(features: pd.Series) -> pd.Series:
        x = np.stack(features.to_numpy()) if len(features) else np.empty((0, 0))
        return pd.Series(list(running_totals(x, sent.value, sizes)))

    scored = df.withColumn("_totals", totals(vector_to_array("features")))
    return scored.withColumns({f"_at_{n}": F.get("_totals", F.lit(i)) for i, n in enumerate(sizes)}).drop("_totals")


def ensemble_prediction(model, size: int):
    total = F.col(f"_at_{size}")
    return ((total > F.lit(size / 2.0)) if _is_forest(model) else (total > 0)).cast("double")


def ensemble_scores(model, splits: dict[str, DataFrame], sizes: Sequence[int]) -> dict[tuple[int, str], dict]:
    """Metrics of every prefix size from one trained ensemble."""
    parts = []
    for split, df in splits.items():
        totals = ensemble_totals(df.select("features", "label"), model, sizes)
        entries = F.array(*[F.struct(F.lit(s).alias("size"), ensemble_prediction(model, s).alias("prediction")) for s in sizes])
        parts.append(totals.select(F.lit(split).alias("split"), "label", F.explode(entries).alias("e"))
                     .select("split", "label", "e.size", "e.prediction"))
    rows = binary_metrics(reduce(DataFrame.unionByName, parts), by=["size", "split"]).collect()
    return {(r["size"], r["split"]): r.asDict() for r in rows}


def tree_sizes(max_trees: int, lag: int, first: int | None = None) -> list[int]:
    start = first or min(lag, max_trees)
    return [start, *range(lag if start != lag else 2 * lag, max_trees + 1, lag)]


def ensemble_study(name: str, train, test, grid: Sequence[tuple[dict, Callable]], sizes: Sequence[int], metric: str,
                   parallelism: int = 4) -> Study:
    """Train each grid point once at full size; smaller sizes are prefixes of its trees."""
    start = perf_counter()
    study = Study(name, metric)
    models = run_grid([make for _, make in grid], parallelism)
    for (params, _), model in zip(grid, models):
        built = len(model.trees)
        usable = [s for s in sizes if s <= built]
        scores = ensemble_scores(model, {"test": test}, usable)
        for s in usable:
            study.offer({**params, "trees": s}, scores[(s, "test")][metric], ForestPrefix(model, s))
    study.seconds = perf_counter() - start
    return study


def random_forest_study(train, test, *, max_trees=2500, lag=500, depths=(2, 5, 7), shares=(0.1, 0.3, 0.5, 0.7, 0.9),
                        first=100, metric="accuracy", parallelism=4) -> Study:
    sizes = tree_sizes(max_trees, lag, first if first < lag else None)
    grid = [
        ({"depth": d, "share": f},
         lambda d=d, f=f: fitted(RandomForestClassifier(
             maxDepth=d, featureSubsetStrategy=str(f), numTrees=max(sizes), seed=SEED), train))
        for d in depths for f in shares
    ]
    return ensemble_study("RF", train, test, grid, sizes, metric, parallelism)


def gradient_boosting_study(train, test, *, max_trees=2500, lag=500, depths=(2, 5, 7), rates=(0.1, 0.3, 0.5, 0.7, 0.9),
                            first=100, metric="accuracy", parallelism=4) -> Study:
    sizes = tree_sizes(max_trees, lag, first if first < lag else None)
    grid = [
        ({"depth": d, "rate": r},
         lambda d=d, r=r: GBTClassifier(maxDepth=d, stepSize=r, maxIter=max(sizes), seed=SEED).fit(train))
        for d in depths for r in rates
    ]
    return ensemble_study("GB", train, test, grid, sizes, metric, parallelism)


# --- nearest neighbours --------------------------------------------------------


def knn_scores(train: DataFrame, test: DataFrame, key: str, features, target: str, ks: Sequence[int],
               distance: str = "euclidean") -> DataFrame:
    """Metrics for every k from one neighbour join."""
    near = knn_join(test, train, max(ks), query_id=key, candidate_id=key, features=features, metric=distance, keep=[target])
    votes = knn_vote(near, key, target, ks)
    truth = test.select(key, F.col(target).cast("double").alias("label"))
    joined = votes.withColumn("prediction", F.col("prediction").cast("double")).join(truth, key)
    return binary_metrics(joined, by=["k"])


def knn_study(train, test, key: str | None, features, target: str, *, k_max=19, lag=2,
              distances=("manhattan", "euclidean", "chebyshev"), ks: Sequence[int] | None = None, metric="accuracy", parallelism=1) -> Study:
    """Score every k and distance: one index per distance, one neighbour list for all k.  ``features`` are columns or one vector column."""
    study = Study("KNN", metric)
    start = perf_counter()
    ks = list(ks or range(1, k_max + 1, lag))
    vector = F.col(features) if isinstance(features, str) else F.array(*[F.col(c).cast("double") for c in features])
    rows = [d.select(*([key] if key else []), vector.alias("features"), F.col(target).cast("double").alias("label")) for d in (train, test)]
    for d in distances:
        model = NeighborModel.fit_rows(rows[0], max(ks), key=key, metric=d)
        votes = model.votes(rows[1].select("features", "label"), ks)
        each = votes.select("label", F.posexplode("_votes").alias("place", "prediction"))
        scores = {ks[r["place"]]: r[metric] for r in binary_metrics(each, by=["place"]).collect()}
        for k in ks:
            study.offer({"metric": d, "k": k}, scores[k], model.with_k(k))
    study.seconds = perf_counter() - start
    return study


def neighbor_study(train, test, *, metric="accuracy", parallelism=4, key: str | None = None, **options) -> Study:
    """``knn_study`` on assembled splits."""
    return knn_study(train, test, key, "features", "label", metric=metric, parallelism=parallelism, **options)


# The neighbour counts of the reference learner.
KNN_GRID = (1, 5, 10, 15, 20, 25)


def best_naive_bayes(train: DataFrame, test: DataFrame, metric: str = "accuracy",
                     shifted: tuple[DataFrame, DataFrame] | None = None) -> dict[str, float]:
    """The five metrics of the best naive Bayes kind.

    Multinomial naive Bayes takes non-negative input, so it alone is given
    ``shifted`` = (train, test) where that is set; the others see the features as they are.
    """
    kinds = ["gaussian", "multinomial", "bernoulli"]
    scores = []
    for kind in kinds:
        a, b = shifted if shifted and kind == "multinomial" else (train, test)
        scores.append(score_models([(kind, naive_bayes(kind).fit(a))], {"test": b})[(kind, "test")])
    return _first_best(scores, metric)


def best_knn(train: DataFrame, test: DataFrame, key: str, features, target: str, metric: str = "accuracy") -> dict[str, float]:
    rows = {r["k"]: r.asDict() for r in knn_scores(train, test, key, features, target, KNN_GRID).collect()}
    return _first_best([rows[k] for k in KNN_GRID], metric)


def _first_best(scores: Sequence[dict], metric: str) -> dict[str, float]:
    best, top = {}, 0.0
    for s in scores:
        if s[metric] - top > DELTA_IMPROVE:
            best, top = s, s[metric]
    return {m: best[m] for m in CLASS_METRICS} if best else {}


def evaluate_approach(train: DataFrame, test: DataFrame, key: str, features: Sequence[str], target: str,
                      metric: str = "accuracy") -> DataFrame:
    """(metric, nb, knn) of the two reference learners on a prepared pair of splits.

    Multinomial naive Bayes needs non-negative input, so a feature with negative
    values is shifted by its training minimum, for that kind only.
    """
    lows = train.agg(*[F.min(c).alias(f"m{i}") for i, c in enumerate(features)]).first()
    shift = {c: F.greatest(F.col(c) - F.lit(min(0.0, float(lows[f"m{i}"] or 0.0))), F.lit(0.0)) for i, c in enumerate(features)}
    negative = any(float(lows[f"m{i}"] or 0.0) < 0 for i in range(len(features)))
    with cached(*(assemble(d, features, target) for d in (train, test))) as (a, b):
        shifted = tuple(assemble(d.withColumns(shift), features, target) for d in (train, test)) if negative else None
        nb = best_naive_bayes(a, b, metric, shifted)
    knn = best_knn(train, test, key, list(features), target, metric)
    rows = [(m, nb.get(m), knn.get(m)) for m in CLASS_METRICS] if nb and knn else []
    return local_table(train.sparkSession, rows, "metric string, nb double, knn double")


# --- importance, over-fitting, comparison -----------------------------------------


def variable_importance(model, features: Sequence[str]) -> list[tuple[str, float, float | None]]:
    """(variable, importance, std over the trees), most important first."""
    from statistics import pstdev

    total = model.featureImportances.toArray()
    trees = [t.featureImportances.toArray() for t in model.trees] if hasattr(model, "trees") else []
    rows = [(c, float(total[i]), float(pstdev([t[i] for t in trees])) if trees else None) for i, c in enumerate(features)]
    return sorted(rows, key=lambda r: (-r[1], r[0]))


def importance_table(spark, model, features: Sequence[str]) -> DataFrame:
    ranked = [(i + 1, *r) for i, r in enumerate(variable_importance(model, features))]
    return local_table(spark, ranked, "rank int, variable string, importance double, std double")


def overfitting_table(spark, name: str, grid: Sequence[tuple[float, Transformer]], splits: dict[str, DataFrame],
                      metric: str = "accuracy") -> DataFrame:
    """(model, param, split, value) along one axis, all scored in one job."""
    scores = score_models([(i, m) for i, (_, m) in enumerate(grid)], splits)
    rows = [(name, float(p), s, float(scores[(i, s)][metric])) for i, (p, _) in enumerate(grid) for s in splits]
    return local_table(spark, rows, "model string, param double, split string, value double")


def ensemble_overfitting(spark, name: str, model, splits: dict[str, DataFrame], sizes: Sequence[int],
                         metric: str = "accuracy") -> DataFrame:
    scores = ensemble_scores(model, splits, sizes)
    rows = [(name, float(n), s, float(scores[(n, s)][metric])) for n in sizes for s in splits]
    return local_table(spark, rows, "model string, param double, split string, value double")


def neighbor_overfitting(spark, train: DataFrame, test: DataFrame, key: str, features, target: str, ks: Sequence[int],
                         distance: str = "euclidean", metric: str = "accuracy") -> DataFrame:
    """(model, param, split, value) along k, on both splits, from one index and one neighbour list.

    A training row is among its own neighbours, so k = 1 shows what is learned by heart.
    """
    vector = F.col(features) if isinstance(features, str) else F.array(*[F.col(c).cast("double") for c in features])
    rows = {s: d.select(key, vector.alias("features"), F.col(target).cast("double").alias("label")) for s, d in (("train", train), ("test", test))}
    model = NeighborModel.fit_rows(rows["train"], max(ks), key=key, metric=distance)
    both = reduce(DataFrame.unionByName, [d.select(F.lit(s).alias("split"), "features", "label") for s, d in rows.items()])
    votes = model.votes(both, list(ks)).select("split", "label", F.posexplode("_votes").alias("place", "prediction"))
    scores = {(r["place"], r["split"]): r[metric] for r in binary_metrics(votes, by=["place", "split"]).collect()}
    found = [("KNN", float(k), s, float(scores[(i, s)])) for i, k in enumerate(ks) for s in rows]
    return local_table(spark, found, "model string, param double, split string, value double")


def iteration_overfitting(spark, splits: dict[str, DataFrame], layers: Sequence[int], steps: Sequence[int], rate: float = 0.05,
                          metric: str = "accuracy") -> tuple[DataFrame, list[float]]:
    """((model, param, split, value) along the iterations, the training loss at each): each fit goes on from the weights of the last one."""
    models, losses, weights, done = [], [], None, 0
    for n in steps:
        learner = MultilayerPerceptronClassifier(layers=list(layers), solver="gd", stepSize=rate, maxIter=n - done, seed=SEED, tol=0.0)
        model = (learner if weights is None else learner.setInitialWeights(weights)).fit(splits["train"])
        weights, done = model.weights, n
        models.append((float(n), model))
        losses.append(float(list(model.summary().objectiveHistory)[-1]))
    return overfitting_table(spark, "MLP", models, splits, metric), losses


def loss_curve(spark, model) -> DataFrame:
    """Training loss per iteration."""
    history = list(model.summary().objectiveHistory if callable(model.summary) else model.summary.objectiveHistory)
    return local_table(spark, [(i, float(v)) for i, v in enumerate(history)], "iteration int, loss double")


def best_models(spark, predictions: DataFrame, params: dict[str, str], by: str = "model") -> DataFrame:
    """Per model: best parameters, accuracy and class-weighted precision and recall to four digits."""
    scored = weighted_metrics(predictions, "label", "prediction", [by])
    chosen = F.broadcast(local_table(spark, list(params.items()), f"{by} string, best_params string"))
    return scored.join(chosen, by, "left").select(
        by, "best_params", *[F.round(c, 4).alias(c) for c in ("accuracy", "precision", "recall")]
    )


STUDIES: dict[str, Callable[..., Study]] = {
    "NB": naive_bayes_study, "LR": logistic_regression_study, "DT": decision_tree_study,
    "RF": random_forest_study, "GB": gradient_boosting_study, "MLP": mlp_study, "KNN": neighbor_study,
}


def train_models(train: DataFrame, test: DataFrame, names: Sequence[str], *, metric: str = "accuracy",
                 options: dict[str, dict] | None = None, save_to: str | None = None, parallelism: int = 4) -> list[Study]:
    """Run the named studies on cached splits; the winners can be saved."""
    options = options or {}
    done = []
    with cached(train, test) as (a, b):
        for name in names:
            if name not in STUDIES:
                raise ValueError(f"model {name} not recognized")
            extra = dict(options.get(name, {}))
            if name == "MLP":
                extra.setdefault("n_features", int(a.first()["features"].size))
            study = STUDIES[name](a, b, metric=metric, parallelism=parallelism, **extra)
            if save_to and study.best_model is not None:
                from tabloom.plans.registry import save_model

                save_model(a.sparkSession, study.best_model, f"{save_to}/{name}", study.best_params)
            done.append(study)
    return done
