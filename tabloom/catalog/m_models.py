"""Model training, studies and comparison on the labelled documents."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabloom.catalog.a_aggregates import rounded
from tabloom.catalog.base import digest_sql, query
from tabloom.catalog.j_joins import DISTANCE_SQL, DOCS_SQL, labelled_documents
from tabloom.catalog.q_metrics import SCORES, metrics_sql
from tabloom.operators.sampling import split_train_test
from tabloom.plans import studies as S
from tabloom.plans.experiment import redundancy_study, variance_study
from tabloom.plans.registry import load_model
from tabloom.session import local_table, scratch_path
from tabloom.streaming.streams import read_stream, run_available

FEATURES = ["n_chars", "words", "en", "toxic"]
FEATURES_SQL = f"(select doc_id, n_chars, words, (lang = 'en')::int::double as en, toxic::double as toxic, quality, {{train}} as train from {DOCS_SQL})"
DATA_SQL = FEATURES_SQL.format(train=f"substr({digest_sql('doc_id')}, 1, 8) < 'b3333333'")


def featured(t):
    docs = labelled_documents(t)
    return docs.select("doc_id", "n_chars", "words", (F.col("lang") == "en").cast("double").alias("en"), F.col("toxic").cast("double").alias("toxic"), "quality")


def splits(t):
    return split_train_test(featured(t), "doc_id")


def assembled(t):
    train, test = splits(t)
    return S.assemble(train, FEATURES, "quality"), S.assemble(test, FEATURES, "quality")


def log_sum(terms) -> str:
    return " + ".join(terms)


def bayes_sql() -> str:
    """Predictions of the three naive Bayes kinds by their closed forms (smoothing 1)."""
    moments = ", ".join(f"avg({c}) as m_{c}, greatest(avg({c} * {c}) - avg({c}) ** 2, 0) as v_{c}, sum({c}) as s_{c}, sum(({c} > 0)::int)::double as b_{c}" for c in FEATURES)
    whole = ", ".join(f"var_pop({c})" for c in FEATURES)
    gaussian = log_sum(["ln(n / total)", *[f"(-0.5 * (ln(2 * pi() * (v_{c} + eps)) + (d.{c} - m_{c}) ** 2 / (v_{c} + eps)))" for c in FEATURES]])
    total_s = "(" + log_sum(f"s_{c}" for c in FEATURES) + ")"
    multinomial = log_sum(["ln((n + 1) / (total + 2))", *[f"d.{c} * ln((s_{c} + 1) / ({total_s} + {len(FEATURES)}))" for c in FEATURES]])
    bernoulli = log_sum(["ln((n + 1) / (total + 2))", *[
        f"case when d.{c} > 0 then ln((b_{c} + 1) / (n + 2)) else ln((n - b_{c} + 1) / (n + 2)) end" for c in FEATURES]])
    return f"""data as {DATA_SQL},
fit as (select quality as cls, count(*)::double as n, {moments} from data where train group by 1),
aux as (select greatest({whole}) * 1e-9 as eps, count(*)::double as total from data where train),
scored as (select d.doc_id, d.quality as label, cls, {gaussian} as gaussian, {multinomial} as multinomial, {bernoulli} as bernoulli
  from data d, fit, aux where not d.train),
long as (unpivot scored on gaussian, multinomial, bernoulli into name kind value score),
picked as (select doc_id, label, kind, arg_max(cls, score) as prediction from long group by 1, 2, 3)"""


def best_bayes_sql() -> str:
    """CTEs up to ``x``, the metrics of the naive Bayes kind that wins in the order of the kinds."""
    return f"""{bayes_sql()}, k as ({metrics_sql('kind', 'select * from picked')}), o as (select *, list_position(['gaussian', 'multinomial', 'bernoulli'], kind) as pos from k),
b as (select case when g.accuracy >= greatest(m.accuracy, n.accuracy) - 0.001 then 'gaussian'
  when m.accuracy - g.accuracy > 0.001 and n.accuracy - m.accuracy <= 0.001 then 'multinomial' else 'bernoulli' end as kind
  from (select accuracy from o where pos = 1) g, (select accuracy from o where pos = 2) m, (select accuracy from o where pos = 3) n),
x as (select {', '.join(SCORES)} from o join b using (kind))"""


@query("m04_naive_bayes_study", f"""
with {bayes_sql()} select 'NB' as model, concat('kind=', kind) as params, 'accuracy' as metric, round(avg((label = prediction)::int), 6) as value from picked group by kind
""")
def m04(t):
    with S.cached(*assembled(t)) as (train, test):
        study = S.naive_bayes_study(train, test)
    return rounded(S.study_table(t.spark, [study]), ["value"], 6)


@query("m01_best_naive_bayes", f"with {best_bayes_sql()} select metric, round(value, 6) as value from (unpivot x on {', '.join(SCORES)} into name metric value value)")
def m01(t):
    with S.cached(*assembled(t)) as (train, test):
        best = S.best_naive_bayes(train, test)
    return local_table(t.spark, [(m, round(v, 6)) for m, v in best.items()], "metric string, value double")


def votes_sql(ks, metric="euclidean", columns=("n_chars", "words")) -> str:
    vector = "[" + ", ".join(columns) + "]"
    return f"""v as (select doc_id, quality, train, {vector} as e from {DATA_SQL}),
dist as (select a.doc_id, a.quality as label, b.doc_id as other, b.quality as cls, {DISTANCE_SQL[metric]} as distance from v a join v b on not a.train and b.train),
near as (select *, row_number() over (partition by doc_id order by distance, other) as rank from dist),
votes as (select doc_id, label, k, cls, count(*) as n from near join (select unnest({list(ks)}) as k) on rank <= k group by all),
picked as (select doc_id, label, k, arg_min(cls, -n * 10 + cls) as prediction from votes group by all)"""


@query("m02_knn_metrics", f"""
with {votes_sql(S.KNN_GRID)}, m as ({metrics_sql('k', 'select * from picked')}) select k, {', '.join(f'round({m}, 6) as {m}' for m in SCORES)} from m
""")
def m02(t):
    train, test = splits(t)
    return rounded(S.knn_scores(train, test, "doc_id", ["n_chars", "words"], "quality", S.KNN_GRID), SCORES, 6)


def best_neighbors_sql() -> str:
    """CTEs up to ``kx``, the metrics of the k that wins when they are tried in order."""
    votes = votes_sql(S.KNN_GRID, columns=FEATURES).replace("v as (", "kv as (", 1).replace("from v a join v b", "from kv a join kv b")
    for name, uses in (("dist", ("from dist)",)), ("near", ("from near join",)), ("votes", ("from votes group",)), ("picked", ())):
        votes = votes.replace(f"{name} as (", f"k{name} as (", 1)
        for use in uses:
            votes = votes.replace(use, use.replace(name, f"k{name}"))
    return f"""{votes}, km as ({metrics_sql('k', 'select * from kpicked')}), tried as (select *, row_number() over (order by k) as pos from km),
walk(pos, top, best) as (select 0, 0.0::double, null::bigint union all
  select w.pos + 1, case when t.accuracy - w.top > 0.001 then t.accuracy else w.top end, case when t.accuracy - w.top > 0.001 then t.pos else w.best end
  from walk w join tried t on t.pos = w.pos + 1),
kx as (select {', '.join(SCORES)} from tried where pos = (select best from walk order by pos desc limit 1))"""


@query("m03_evaluate_approach", f"""
with recursive {best_bayes_sql()}, {best_neighbors_sql()}
select metric, round(a.value, 6) as nb, round(b.value, 6) as knn from (unpivot x on {', '.join(SCORES)} into name metric value value) a
join (unpivot kx on {', '.join(SCORES)} into name metric value value) b using (metric)
""")
def m03(t):
    train, test = splits(t)
    return rounded(S.evaluate_approach(train, test, "doc_id", FEATURES, "quality"), ["nb", "knn"], 6)


@query("m05_logistic_regression_study")
def m05(t):
    with S.cached(*assembled(t)) as (train, test):
        return S.study_table(t.spark, [S.logistic_regression_study(train, test, max_iterations=100, lag=50)])


@query("m06_knn_study", "with " + ", ".join(
    votes_sql([1, 3, 5, 7, 9], m).replace("v as", f"v{i} as", 1).replace("from v a join v b", f"from v{i} a join v{i} b")
    .replace("dist as", f"dist{i} as").replace("from dist)", f"from dist{i})").replace("near as", f"near{i} as").replace("from near join", f"from near{i} join")
    .replace("votes as", f"votes{i} as").replace("from votes group", f"from votes{i} group").replace("picked as", f"picked{i} as")
    for i, m in enumerate(("manhattan", "euclidean", "chebyshev"))) + " " + " union all ".join(
    f"select 'KNN' as model, concat('metric={m}, k=', k) as params, 'accuracy' as metric, round(avg((label = prediction)::int), 6) as value from picked{i} group by k"
    for i, m in enumerate(("manhattan", "euclidean", "chebyshev"))))
def m06(t):
    train, test = splits(t)
    study = S.knn_study(train, test, "doc_id", ["n_chars", "words"], "quality", k_max=9)
    return rounded(S.study_table(t.spark, [study]), ["value"], 6)


@query("m07_decision_tree_study")
def m07(t):
    with S.cached(*assembled(t)) as (train, test):
        return S.study_table(t.spark, [S.decision_tree_study(train, test, max_depth=6)])


@query("m08_random_forest_study")
def m08(t):
    with S.cached(*assembled(t)) as (train, test):
        return S.study_table(t.spark, [S.random_forest_study(train, test, max_trees=20, lag=10, first=5, depths=(2, 5), shares=(0.3, 0.7))])


@query("m09_gradient_boosting_study")
def m09(t):
    with S.cached(*assembled(t)) as (train, test):
        return S.study_table(t.spark, [S.gradient_boosting_study(train, test, max_trees=10, lag=5, first=2, depths=(2, 5), rates=(0.1, 0.5))])


@query("m10_mlp_study")
def m10(t):
    with S.cached(*assembled(t)) as (train, test):
        return S.study_table(t.spark, [S.mlp_study(train, test, len(FEATURES), max_iterations=40, lag=20, rates=(0.5, 0.05), hidden=20)])


@query("m11_variable_importance")
def m11(t):
    with S.cached(*assembled(t)) as (train, _):
        model = S.RandomForestClassifier(numTrees=10, maxDepth=4, seed=S.SEED).fit(train)
        return S.importance_table(t.spark, model, FEATURES)


@query("m12_overfitting_depth")
def m12(t):
    with S.cached(*assembled(t)) as (train, test):
        grid = [(d, S.DecisionTreeClassifier(maxDepth=d, seed=S.SEED).fit(train)) for d in (2, 6, 10, 14)]
        return S.overfitting_table(t.spark, "DT", grid, {"train": train, "test": test})


@query("m12_overfitting_trees")
def m12_trees(t):
    with S.cached(*assembled(t)) as (train, test):
        model = S.GBTClassifier(maxDepth=3, maxIter=8, seed=S.SEED).fit(train)
        return S.ensemble_overfitting(t.spark, "GB", model, {"train": train, "test": test}, [2, 4, 8])


OVER_KS = (1, 5, 9, 19)
BOTH_SQL = votes_sql(OVER_KS).replace("on not a.train and b.train", "on b.train").replace("select a.doc_id,", "select a.doc_id, a.train,", 1).replace(
    "select doc_id, label, k, cls,", "select doc_id, train, label, k, cls,").replace("select doc_id, label, k, arg_min", "select doc_id, train, label, k, arg_min")


@query("m12_overfitting_k", f"""
with {BOTH_SQL} select 'KNN' as model, cast(k as double) as param, case when train then 'train' else 'test' end as split,
  round(avg((label = prediction)::int), 6) as value from picked group by all
""")
def m12_k(t):
    train, test = splits(t)
    return rounded(S.neighbor_overfitting(t.spark, train, test, "doc_id", ["n_chars", "words"], "quality", OVER_KS), ["value"], 6)


@query("m12_overfitting_iterations")
def m12_iterations(t):
    with S.cached(*assembled(t)) as (train, test):
        return S.iteration_overfitting(t.spark, {"train": train, "test": test}, [len(FEATURES), 10, 2], [5, 10, 20, 40])[0]


@query("m13_loss_curve")
def m13(t):
    with S.cached(*assembled(t)) as (train, _):
        model = S.MultilayerPerceptronClassifier(layers=[len(FEATURES), 10, 2], solver="gd", stepSize=0.05, maxIter=15, seed=S.SEED).fit(train)
        return S.loss_curve(t.spark, model)


@query("m14_train_models")
def m14(t):
    train, test = assembled(t)
    done = S.train_models(train, test, ["NB", "DT", "LR"], metric="recall", options={"DT": {"max_depth": 4}, "LR": {"max_iterations": 50, "lag": 50}})
    return S.study_table(t.spark, done)


@query("m14_neighbors_stream", f"""
with {votes_sql([5])} select doc_id, cast(prediction as double) as prediction from picked where k = 5
""")
def m14_neighbors(t):
    """A kNN model trained and saved with the others, loaded again, scores a stream."""
    train, test = (S.assemble(d, ["n_chars", "words"], "quality", "doc_id") for d in splits(t))
    folder = scratch_path(t.spark, "models")
    S.train_models(train, test, ["KNN"], options={"KNN": {"distances": ("euclidean",), "key": "doc_id", "ks": (5,)}}, save_to=folder)
    rows = scratch_path(t.spark, "unscored")
    test.select("doc_id", vector_to_array("features").alias("features")).write.parquet(rows)
    stream = read_stream(t.spark, rows, "doc_id long, features array<double>")
    scored = load_model(t.spark, f"{folder}/KNN").transform(stream)
    return run_available(scored.select("doc_id", "prediction"), scratch_path(t.spark, "scored"))


@query("v03_variance_study")
def v03(t):
    train, test = splits(t)
    return variance_study(train, test, "doc_id", "quality", max_threshold=0.4, lag=0.1)


@query("v04_redundancy_study")
def v04(t):
    train, test = splits(t)
    return redundancy_study(train, test, "doc_id", "quality", min_threshold=0.9, lag=0.05, rule="earlier")
