"""Evaluation of given predictions."""

from pyspark.sql import functions as F

from tabloom.catalog.a_aggregates import HOURLY_SQL, hourly, rounded
from tabloom.catalog.base import query
from tabloom.catalog.j_joins import DOCS_SQL, labelled_documents
from tabloom.operators.metrics import (
    align_forecast,
    binary_metrics,
    confusion_matrix,
    forecast_errors,
    metrics_long,
    roc_points,
    weighted_metrics,
    wide_metrics,
)
from tabloom.operators.order import lagged
from tabloom.operators.sampling import tag_split
from tabloom.plans.studies import best_models

# Predictions by fixed rules, so that every engine can repeat them.
RULES = {"chars": "n_chars > 1500", "words": "words > 900", "clean": "toxic = 0"}
RULES_SQL = " union all ".join(
    f"select doc_id, '{name}' as model, quality as label, case when {rule} then 1 else 0 end as prediction from {DOCS_SQL}" for name, rule in RULES.items())
SCORES = ("accuracy", "recall", "precision", "auc_hard", "f1")


def ruled(t):
    from functools import reduce

    docs = labelled_documents(t)
    parts = [docs.select("doc_id", F.lit(n).alias("model"), F.col("quality").alias("label"), F.expr(f"CASE WHEN {r} THEN 1 ELSE 0 END").alias("prediction"))
             for n, r in RULES.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def metrics_sql(by: str, source: str) -> str:
    return f"""select {by}, (tp + tn) / (tp + tn + fp + fn) as accuracy, case when tp + fn > 0 then tp / (tp + fn) else 0 end as recall,
  case when tp + fp > 0 then tp / (tp + fp) else 0 end as precision,
  (case when tp + fn > 0 then tp / (tp + fn) else 0 end + case when tn + fp > 0 then tn / (tn + fp) else 0 end) / 2 as auc_hard,
  case when 2 * tp + fp + fn > 0 then 2 * tp / (2 * tp + fp + fn) else 0 end as f1
from (select {by}, count(*) filter (label = 1 and prediction = 1)::double as tp, count(*) filter (label = 0 and prediction = 0)::double as tn,
  count(*) filter (label = 0 and prediction = 1)::double as fp, count(*) filter (label = 1 and prediction = 0)::double as fn from ({source}) group by {by})"""


ROUNDED_SCORES = ", ".join(f"round({m}, 6) as {m}" for m in SCORES)


@query("q01_binary_metrics", f"select model, {', '.join(f'round({m}, 6) as {m}' for m in SCORES if m != 'auc_hard')} from ({metrics_sql('model', RULES_SQL)})")
def q01(t):
    return rounded(binary_metrics(ruled(t), by=["model"]).drop("auc_hard"), [m for m in SCORES if m != "auc_hard"], 6)


@query("q02_auc_of_labels", f"select model, round(auc_hard, 6) as auc_hard from ({metrics_sql('model', RULES_SQL)})")
def q02(t):
    return rounded(binary_metrics(ruled(t), by=["model"]).select("model", "auc_hard"), ["auc_hard"], 6)


WEIGHTED_SQL = f"""
with p as ({RULES_SQL}), k as (select model, cls, (select count(*) from p where p.model = m.model and label = cls)::double as s,
  (select count(*) from p where p.model = m.model and prediction = cls)::double as said,
  (select count(*) from p where p.model = m.model and label = cls and prediction = cls)::double as hit
  from (select distinct model from p) m, (values (0), (1)) as c(cls)),
w as (select model, sum(hit) / sum(s) as accuracy, sum(s * case when said > 0 then hit / said else 0 end) / sum(s) as precision,
  sum(s * case when s > 0 then hit / s else 0 end) / sum(s) as recall from k group by 1)
"""


@query("q03_weighted_metrics", WEIGHTED_SQL + "select model, round(accuracy, 6) as accuracy, round(precision, 6) as precision, round(recall, 6) as recall from w")
def q03(t):
    return rounded(weighted_metrics(ruled(t), "label", "prediction", ["model"]), ["accuracy", "precision", "recall"], 6)


@query("q04_confusion_matrix", f"""
with p as ({RULES_SQL})
select m.model, a.v as label, b.v as prediction, (select count(*) from p where p.model = m.model and p.label = a.v and p.prediction = b.v) as n
from (select distinct model from p) m, (values (0), (1), (2)) as a(v), (values (0), (1), (2)) as b(v)
""")
def q04(t):
    return confusion_matrix(ruled(t), "label", "prediction", [0, 1, 2], ["model"])


SPLIT_RULES_SQL = f"select *, case when substr(md5(concat(cast(doc_id as varchar), ':42')), 1, 8) < 'b3333333' then 'train' else 'test' end as split from ({RULES_SQL}) where model = 'chars'"


@query("q05_evaluation_by_split", f"""
with m as ({metrics_sql('split', SPLIT_RULES_SQL)})
select split, metric, round(value, 6) as value from (unpivot m on accuracy, recall, precision, auc_hard, f1 into name metric value value)
""")
def q05(t):
    tagged = tag_split(ruled(t).filter(F.col("model") == "chars"), "doc_id")
    return rounded(metrics_long(binary_metrics(tagged, by=["split"]), ["split"]), ["value"], 6)


@query("q06_roc_points", f"""
with d as (select n_chars as threshold, count(*) filter (quality = 1) as p, count(*) filter (quality = 0) as n from {DOCS_SQL} group by 1)
select threshold, round(sum(n) over w / (select sum(n) from d), 6) as fpr, round(sum(p) over w / (select sum(p) from d), 6) as tpr
from d window w as (order by threshold desc)
""")
def q06(t):
    return rounded(roc_points(labelled_documents(t), "quality", "n_chars"), ["fpr", "tpr"], 6)


SCORE_COLUMNS = {"chars": "n_chars", "words": "words", "toxic": "toxic"}
ROC_SQL = " union all ".join(f"select '{m}' as model, cast({c} as double) as score, quality from {DOCS_SQL}" for m, c in SCORE_COLUMNS.items())


@query("q06_roc_by_model", f"""
with d as (select model, score as threshold, count(*) filter (quality = 1) as p, count(*) filter (quality = 0) as n from ({ROC_SQL}) group by 1, 2)
select model, threshold, round(sum(n) over w / sum(n) over (partition by model), 6) as fpr, round(sum(p) over w / sum(p) over (partition by model), 6) as tpr
from d window w as (partition by model order by threshold desc)
""")
def q06_models(t):
    entries = F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias("score")) for m, c in SCORE_COLUMNS.items()])
    scored = labelled_documents(t).select("quality", F.explode(entries).alias("e")).select("e.model", "e.score", "quality")
    return rounded(roc_points(scored, "quality", "score", by=["model"]), ["fpr", "tpr"], 6)


@query("q07_scores_of_models", f"""
with m as ({metrics_sql('model', RULES_SQL)}) select model, metric, round(value, 6) as value from (unpivot m on {", ".join(SCORES)} into name metric value value)
""")
def q07_scores(t):
    docs = labelled_documents(t)
    wide = docs.select(F.col("quality").alias("label"), *[F.expr(f"CASE WHEN {r} THEN 1 ELSE 0 END").alias(n) for n, r in RULES.items()])
    return rounded(metrics_long(wide_metrics(wide, "label", {n: n for n in RULES}), ["model"]), ["value"], 6)


PERSISTENCE_SQL = f"""(select i, ts, value as y, lag(value) over (order by i) as p,
  case when i < floor(count(*) over () * 0.9::double) then 'train' else 'test' end as role from {HOURLY_SQL})"""


def persistence(t):
    """Hourly sums with the value of the hour before as forecast."""
    ordered = hourly(t)
    cut = int(ordered.n * 0.9)
    role = F.when(F.col("row_idx") < cut, "train").otherwise("test")
    return lagged(ordered, "value", 1).withColumn("role", role)


@query("q08_forecast_errors", f"""
with f as (select * from {PERSISTENCE_SQL} where p is not null)
select role, round(avg((y - p) ** 2), 2) as mse, round(sqrt(avg((y - p) ** 2)), 4) as rmse, round(avg(abs(y - p)), 4) as mae,
  round(1 - sum((y - p) ** 2) / (var_pop(y) * count(*)), 6) as r2, round(avg(abs(y - p) / abs(y)), 6) as mape from f group by 1
""")
def q08(t):
    scored = forecast_errors(persistence(t).filter("lag_1 is not null"), "value", "lag_1", ["role"])
    return rounded(rounded(rounded(scored, ["mse"], 2), ["rmse", "mae"]), ["r2", "mape"], 6)


@query("q09_aligned_forecast", f"""
select ts, role, round(y, 4) as value from {PERSISTENCE_SQL} union all select ts, 'prediction', round(p, 4) from {PERSISTENCE_SQL} where role = 'test'
""")
def q09(t):
    df = persistence(t)
    train, test = df.filter("role = 'train'"), df.filter("role = 'test'")
    predicted = test.select("ts", F.col("lag_1").alias("value"))
    return rounded(align_forecast(train, test, predicted, "ts", "value"), ["value"])


@query("m15_best_models", WEIGHTED_SQL + """
select model, concat('rule=', model) as best_params, round(accuracy, 4) as accuracy, round(precision, 4) as precision, round(recall, 4) as recall from w
""")
def m15(t):
    return best_models(t.spark, ruled(t), {m: f"rule={m}" for m in RULES})
