"""Whole preparations, experiments, saved models and scoring."""

from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from tabloom.catalog.a_aggregates import rounded
from tabloom.catalog.base import digest_sql, query
from tabloom.catalog.j_joins import labelled_documents
from tabloom.catalog.m_models import featured
from tabloom.operators.cleaning import Cleaning
from tabloom.operators.encoding import FrequencyEncoder, OneHot
from tabloom.operators.joins import lookup_join
from tabloom.plans.experiment import ExperimentConfig, run_experiment
from tabloom.plans.prep import Preparation, load_preparation
from tabloom.plans.registry import ModelRegistry
from tabloom.plans.studies import DecisionTreeClassifier, ForestPrefix, assemble, naive_bayes
from tabloom.session import materialize, scratch_path
from tabloom.streaming.streams import prepare_stream, read_stream, run_available, score_stream

NUMBERS = ["o_totalprice", "c_nationkey", "c_acctbal", "o_orderdate_year", "o_orderdate_quarter", "o_orderdate_month", "o_orderdate_day"]


def customer_orders(t):
    """Orders with their customers; the target tells finished orders."""
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_acctbal", "c_mktsegment")
    joined = lookup_join(t.orders, customers, ["o_custkey"], how="inner")
    return joined.select(
        "o_orderkey", "o_totalprice", "c_nationkey", "c_acctbal", "o_orderpriority", "c_mktsegment",
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("done"), "o_orderdate",
    )


def order_preparation(**options):
    cleaning = Cleaning(rare_threshold=0.2, date_columns=["o_orderdate"])
    encoders = [OneHot(["o_orderpriority", "c_mktsegment"])]
    return Preparation(key="o_orderkey", target="done", cleaning=cleaning, encoders=encoders, **options)


def feature_means(df, features, by):
    """(by, feature, n, mean) of every feature."""
    typed = df.select(*by, *[F.col(c).cast("double").alias(c) for c in features])
    means = typed.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in features])
    return means.unpivot([*by, "n"], features, "feature", "mean")


def group_rare(column: str) -> str:
    return f"case when {column} in (select {column} from j group by 1 having count(*) / (select count(*) from j) >= 0.2) then {column} else 'OTHERS' end"


# The learned steps in long form: one row per order and feature.
LONG_SQL = f"""
j as (select * from orders join customer on o_custkey = c_custkey),
base as (select o_orderkey, o_totalprice, c_nationkey, c_acctbal, {group_rare('o_orderpriority')} as pri, {group_rare('c_mktsegment')} as seg, o_orderdate,
  substr({digest_sql('o_orderkey')}, 1, 8) < 'b3333333' as train from j),
cats as (select col, v, row_number() over (partition by col order by v) as r, count(*) over (partition by col) as k from
  (select distinct 'o_orderpriority' as col, pri as v from base union select distinct 'c_mktsegment', seg from base)),
f as (
  select o_orderkey, train, 1 as pos, 'o_totalprice' as feature, o_totalprice as x from base union all
  select o_orderkey, train, 2, 'c_nationkey', c_nationkey from base union all select o_orderkey, train, 3, 'c_acctbal', c_acctbal from base union all
  select o_orderkey, train, 4, 'o_orderdate_year', year(o_orderdate) from base union all
  select o_orderkey, train, 5, 'o_orderdate_quarter', quarter(o_orderdate) from base union all
  select o_orderkey, train, 6, 'o_orderdate_month', month(o_orderdate) from base union all
  select o_orderkey, train, 7, 'o_orderdate_day', day(o_orderdate) from base union all
  select o_orderkey, train, 10 + r, concat('o_orderpriority_', v), (pri = v)::int from base, cats where col = 'o_orderpriority' and (k <> 2 or r = 2) union all
  select o_orderkey, train, 100 + r, concat('c_mktsegment_', v), (seg = v)::int from base, cats where col = 'c_mktsegment' and (k <> 2 or r = 2)),
fit as (select feature, min(x) as lo, max(x) as hi, avg(x) as m, stddev_pop(x) as s, var_samp(x) as v from f where train group by 1)"""

DROPPED_SQL = """dropped as (select distinct feature from (select b.feature, a.feature as earlier, abs(corr(a.x, b.x)) as r
  from f a join f b using (o_orderkey) where a.train and a.pos < b.pos group by 1, 2) where r >= 0.9)"""

FLAGSHIP_SQL = f"""
with {LONG_SQL}, {DROPPED_SQL}
select case when train then 'train' else 'test' end as split, feature, count(*) as n,
  round(avg(case when hi > lo then (x - lo) / (hi - lo) else 0 end), 7) as mean
from f join fit using (feature) where feature not in (select feature from dropped) group by 1, 2
"""


@query("l02_flagship_preparation", FLAGSHIP_SQL)
def l02(t):
    model = order_preparation(scaling="minmax", feature_selection="redundant", min_threshold=0.9).fit(customer_orders(t))
    return rounded(feature_means(model.prepared, model.features, ["split"]), ["mean"], 7)


@query("l01_configured_preparation", f"""
with {LONG_SQL}
select case when train then 'train' else 'test' end as split, feature, count(*) as n, round(avg(x), 4) as mean
from f join fit using (feature) where v >= 0.18 group by 1, 2
""")
def l01(t):
    model = order_preparation(feature_selection="lowvar", max_threshold=0.18).fit(customer_orders(t))
    return rounded(feature_means(model.prepared, model.features, ["split"]), ["mean"])


@query("l02_outliers_and_balance", """
with t as (select done, count(*) as n from (select case when o_orderstatus = 'F' then 1 else 0 end as done,
  substr(md5(concat(cast(o_orderkey as varchar), ':42')), 1, 8) < 'b3333333' as train from orders join customer on o_custkey = c_custkey) where train group by 1)
select done, (select min(n) from t) as n from t
""")
def l02_balance(t):
    model = order_preparation(outliers="discard", scaling="zscore", balancing="under").fit(customer_orders(t))
    train = model.prepared.filter("split = 'train'")
    return train.groupBy("done").agg(F.count(F.lit(1)).alias("n"))


@query("l03_transform_saved", f"""
with {LONG_SQL}, {DROPPED_SQL}
select feature, count(*) as n, round(avg(case when hi > lo then (x - lo) / (hi - lo) else 0 end), 7) as mean
from f join fit using (feature) where feature not in (select feature from dropped) group by 1
""")
def l03(t):
    fitted = order_preparation(scaling="minmax", feature_selection="redundant", min_threshold=0.9).fit(customer_orders(t))
    path = scratch_path(t.spark, "preparation")
    fitted.save(t.spark, path)
    model = load_preparation(t.spark, path)
    return rounded(feature_means(model.transform(customer_orders(t)), model.features, []), ["mean"], 7)


@query("l04_kept_types", """
select * from (values ('o_orderkey', 'numeric'), ('o_totalprice', 'numeric'), ('c_nationkey', 'numeric'), ('c_acctbal', 'numeric'),
  ('o_orderpriority', 'symbolic'), ('c_mktsegment', 'symbolic'), ('done', 'binary'), ('o_orderdate', 'date')) as v(variable, var_type)
where (select count(distinct o_orderpriority) from orders) > 2 and (select count(distinct c_mktsegment) from customer) > 2
""")
def l04(t):
    model = order_preparation().fit(customer_orders(t))
    rows = [(c, k) for k, names in model.state["types"].items() for c in names]
    return t.spark.createDataFrame(rows, "variable string, var_type string")


def document_preparation(**options):
    return Preparation(key="doc_id", target="quality", cleaning=Cleaning(rare_threshold=0.02),
                       encoders=[OneHot(["lang"]), FrequencyEncoder(["source"])], **options)


@query("l05_experiment_dry_run", """
select * from (values ('outliers', 'None'), ('scaling', 'zscore'), ('balancing', 'under'), ('feature_selection', 'None'),
  ('metric', 'accuracy'), ('dry_run', 'True'), ('label', 'zscore_under')) as v(setting, value)
union all select 'rows', cast(count(quality) as varchar) from documents join labels using (doc_id)
""")
def l05_dry(t):
    return run_experiment(ExperimentConfig(scaling="zscore", balancing="under", dry_run=True), featured(t), key="doc_id", target="quality")


@query("l05_experiment")
def l05(t):
    return run_experiment(ExperimentConfig(outliers="truncate", scaling="minmax", balancing="smote"), featured(t), key="doc_id", target="quality")


def document_registry(t):
    """A preparation of the documents with two models, saved and loaded again."""
    fitted = document_preparation(scaling="minmax").fit(labelled_documents(t))
    prepared = materialize(fitted.prepared, "prepared")
    train = assemble(prepared.filter("split = 'train'"), fitted.features, "quality")
    registry = ModelRegistry(fitted)
    registry.add("tree", DecisionTreeClassifier(maxDepth=4, seed=42).fit(train), {"depth": 4}, default=True)
    registry.add("bayes", naive_bayes("gaussian").fit(train), {"kind": "gaussian"})
    path = scratch_path(t.spark, "registry")
    registry.save(t.spark, path)
    return ModelRegistry.load(t.spark, path)


@query("l06_registry_models", "select 'tree' as model, true as is_default from (select count(*) from labels) union all select 'bayes', false")
def l06(t):
    registry = document_registry(t)
    return t.spark.createDataFrame([(m, m == registry.default_model) for m in registry.list_models()], "model string, is_default boolean")


@query("q07_registry_evaluate")
def q07(t):
    return document_registry(t).evaluate(labelled_documents(t))


@query("st1_batch_scoring")
def st1(t):
    return document_registry(t).predict(labelled_documents(t), "bayes")


def documents_stream(t, docs):
    path = scratch_path(t.spark, "documents-stream")
    docs.write.parquet(path)
    return read_stream(t.spark, path, docs.schema)


@query("st2_stream_scoring")
def st2(t):
    registry = document_registry(t)
    stream = documents_stream(t, labelled_documents(t).drop("quality"))
    return run_available(score_stream(stream, registry), scratch_path(t.spark, "scored"))


@query("st2_stream_preparation", """
with d as (select d.doc_id, cast(n_chars as double) as n_chars, lang, source, substr(md5(concat(cast(d.doc_id as varchar), ':42')), 1, 8) < 'b3333333' as train
  from documents d join labels using (doc_id)),
j as (select * from d), s as (select source, count(*) / (select count(*) from d)::double as f from d group by 1),
g as (select d.*, case when f >= 0.02 then d.source else 'OTHERS' end as src from d join s using (source)),
freq as (select src, count(*) / (select count(*) from g)::double as freq from g group by 1),
lim as (select min(n_chars) as lo, max(n_chars) as hi, min(freq) as fl, max(freq) as fh from g join freq using (src) where train)
select doc_id, round((n_chars - lo) / (hi - lo), 6) as n_chars, round((freq - fl) / (fh - fl), 6) as source_freq from g join freq using (src), lim
""")
def st2_preparation(t):
    docs = labelled_documents(t)
    model = document_preparation(scaling="minmax").fit(docs)
    out = run_available(prepare_stream(documents_stream(t, docs.drop("quality")), model), scratch_path(t.spark, "prepared-stream"))
    return rounded(out.select("doc_id", "n_chars", "source_freq"), ["n_chars", "source_freq"], 6)


@query("st2_stream_forest")
def st2_forest(t):
    """A stream scored by the first 30 of 40 trees."""
    fitted = document_preparation(scaling="minmax").fit(labelled_documents(t))
    train = assemble(materialize(fitted.prepared, "prepared").filter("split = 'train'"), fitted.features, "quality")
    registry = ModelRegistry(fitted)
    forest = RandomForestClassifier(numTrees=40, maxDepth=4, seed=42).fit(train)
    registry.add("forest", ForestPrefix(forest, 30), {"trees": 30})
    stream = documents_stream(t, labelled_documents(t).drop("quality"))
    return run_available(score_stream(stream, registry), scratch_path(t.spark, "scored"))
