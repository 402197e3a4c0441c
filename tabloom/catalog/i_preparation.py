"""Missing values, outliers, scaling, balancing, selection and splits."""

from pyspark.sql import functions as F

from tabloom.catalog.a_aggregates import RELATED, RELATED_SQL, related, rounded
from tabloom.catalog.base import digest_sql, modulo_sql, query, uniform_sql
from tabloom.catalog.j_joins import DOCS_SQL, labelled_documents
from tabloom.operators.balancing import balance, over_balance, smote_balance, synthetic_rows, under_balance
from tabloom.operators.missing import Filling, drop_missing
from tabloom.operators.order import assign_row_index, head_share
from tabloom.operators.outliers import Outliers
from tabloom.operators.sampling import split_train_test, stratified_split, tag_split
from tabloom.operators.scaling import Scaling, scale_splits
from tabloom.operators.selection import FeatureSelection, select_features

TRAIN = f"substr({digest_sql('o_orderkey')}, 1, 8) < 'b3333333'"


def order_gaps(t):
    return t.orders.select(
        "o_orderkey", F.when(F.col("o_totalprice") <= 300000, F.col("o_totalprice")).alias("o_totalprice"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"), F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"),
        F.when(F.col("o_totalprice") > 495000, F.lit("seen")).alias("seldom"),
    )


ORDER_GAPS_SQL = """(select o_orderkey, case when o_totalprice <= 300000 then o_totalprice end as o_totalprice,
  nullif(o_orderpriority, '5-LOW') as o_orderpriority, nullif(o_orderstatus, 'P') as o_orderstatus,
  case when o_totalprice > 495000 then 'seen' end as seldom from orders)"""


@query("i01_drop_missing", f"""
select o_orderkey, o_totalprice, o_orderpriority, o_orderstatus from {ORDER_GAPS_SQL}
where (o_orderkey is not null)::int + (o_totalprice is not null)::int + (o_orderpriority is not null)::int + (o_orderstatus is not null)::int >= 4
""")
def i01(t):
    return drop_missing(order_gaps(t), 0.1, 0.8)


@query("i02_fill_frequent", f"""
with g as {ORDER_GAPS_SQL}, p as (select o_orderpriority as v from g where o_orderpriority is not null group by 1 order by count(*) desc, 1 limit 1),
s as (select o_orderstatus as v from g where o_orderstatus is not null group by 1 order by count(*) desc, 1 limit 1)
select o_orderkey::double as o_orderkey, round(coalesce(o_totalprice, (select avg(o_totalprice) from g)), 4) as o_totalprice,
  coalesce(o_orderpriority, (select v from p)) as o_orderpriority, coalesce(o_orderstatus, (select v from s)) as o_orderstatus from g
""")
def i02(t):
    df = order_gaps(t).drop("seldom")
    return rounded(Filling("frequent").fit(df).transform(df), ["o_totalprice"])


@query("i03_fill_constant", f"""
select o_orderkey, coalesce(o_totalprice, -1) as o_totalprice, coalesce(o_orderpriority, 'NA') as o_orderpriority,
  coalesce(o_orderstatus, 'False') as o_orderstatus from {ORDER_GAPS_SQL}
""")
def i03(t):
    df = order_gaps(t).drop("seldom")
    return Filling("constant").fit(df).transform(df)


# --- outliers ----------------------------------------------------------------

QUARTILES_SQL = "(select quantile_cont(value, 0.25) as a, quantile_cont(value, 0.5) as m, quantile_cont(value, 0.75) as b, avg(value) as mean, stddev_samp(value) as s from events)"


@query("o01_outliers_all_numeric", """
with q as (select quantile_cont(value, 0.25) as a, quantile_cont(value, 0.75) as b,
  quantile_cont(user_id, 0.25) as ua, quantile_cont(user_id, 0.75) as ub from events)
select event_type, value, user_id from events, q where value between a - 7 * (b - a) and b + 7 * (b - a) and user_id between ua - 7 * (ub - ua) and ub + 7 * (ub - ua)
""")
def o01(t):
    df = t.events.select("event_type", "value", "user_id")
    return Outliers("discard").fit(df).transform(df)


@query("o02_discard_by_quartiles", f"select event_id, value from events, {QUARTILES_SQL} where value between a - 3 * (b - a) and b + 3 * (b - a)")
def o02(t):
    return Outliers("discard", factor=3.0, columns=["value"]).fit(t.events).transform(t.events).select("event_id", "value")


@query("o02_discard_by_std", f"select event_id, value from events, {QUARTILES_SQL} where value between mean - 2 * s and mean + 2 * s")
def o02_std(t):
    return Outliers("discard", std_based=True, columns=["value"]).fit(t.events).transform(t.events).select("event_id", "value")


@query("o03_truncate", f"select event_id, round(least(greatest(value, a - 1.5 * (b - a)), b + 1.5 * (b - a)), 4) as value from events, {QUARTILES_SQL}")
def o03(t):
    out = Outliers("truncate", factor=1.5, columns=["value"]).fit(t.events).transform(t.events)
    return rounded(out.select("event_id", "value"), ["value"])


@query("o04_replace_by_median", f"""
select event_id, round(case when value > b + 1.5 * (b - a) or value < a - 1.5 * (b - a) then m else value end, 4) as value from events, {QUARTILES_SQL}
""")
def o04(t):
    out = Outliers("fixed", factor=1.5, columns=["value"]).fit(t.events).transform(t.events)
    return rounded(out.select("event_id", "value"), ["value"])


# --- scaling -----------------------------------------------------------------


@query("n01_minmax", f"""
with f as (select min(o_totalprice) as a, max(o_totalprice) as b, min(o_custkey) as c, max(o_custkey) as d from orders where {TRAIN})
select o_orderkey, round((o_totalprice - a) / (b - a), 6) as o_totalprice, round((o_custkey - c) / (d - c)::double, 6) as o_custkey, 0.0::double as same
from orders, f where not {TRAIN}
""")
def n01(t):
    df = t.orders.select("o_orderkey", "o_totalprice", "o_custkey", F.lit(3).alias("same"))
    train, test = split_train_test(df, "o_orderkey")
    out = Scaling("minmax", ["o_totalprice", "o_custkey", "same"]).fit(train).transform(test)
    return rounded(out, ["o_totalprice", "o_custkey"], 6)


@query("n02_zscore", f"""
with f as (select avg(o_totalprice) as a, stddev_pop(o_totalprice) as b from orders where {TRAIN})
select o_orderkey, round((o_totalprice - a) / b, 6) as o_totalprice from orders, f
""")
def n02(t):
    df = t.orders.select("o_orderkey", "o_totalprice")
    train, _ = split_train_test(df, "o_orderkey")
    return rounded(Scaling("zscore", ["o_totalprice"]).fit(train).transform(df), ["o_totalprice"], 6)


@query("n03_scale_per_split", f"""
select o_orderkey, round((o_totalprice - min(o_totalprice) over w) / (max(o_totalprice) over w - min(o_totalprice) over w), 6) as o_totalprice
from orders window w as (partition by {TRAIN})
""")
def n03(t):
    train, test = split_train_test(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey")
    a, b = scale_splits(train, test, "minmax", columns=["o_totalprice"], fit_per_split=True)
    return rounded(a.unionByName(b), ["o_totalprice"], 6)


@query("n04_scaled_features", """
select 'c_acctbal' as variable, round(avg(c_acctbal), 4) as shift from customer union all select 'c_custkey', round(avg(c_custkey), 4) from customer
""")
def n04(t):
    model = Scaling("zscore", target="c_nationkey").fit(t.customer)
    rows = [(c, v[0]) for c, v in model.state["columns"].items()]
    return rounded(t.spark.createDataFrame(rows, "variable string, shift double"), ["shift"])


# --- balancing ---------------------------------------------------------------

DONE_SQL = "(select o_orderkey, o_totalprice, case when o_orderstatus = 'F' then 1 else 0 end as done from orders)"


def done_orders(t):
    return t.orders.select("o_orderkey", "o_totalprice", F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("done"))


CLASSES_SQL = f"""d as {DONE_SQL}, c as (select done, count(*) as n from d group by 1),
rare as (select done from c order by n, done limit 1), common as (select done from c order by n desc, done limit 1)"""


@query("b01_under_balance", f"""
with {CLASSES_SQL}, r as (select *, row_number() over (partition by done order by {digest_sql('o_orderkey')}) as rk from d)
select o_orderkey, o_totalprice, done from r where done = (select done from rare)
  or (done = (select done from common) and rk <= (select min(n) from c))
""")
def b01(t):
    return under_balance(done_orders(t), "done", "o_orderkey")


@query("b02_over_balance", f"""
with {CLASSES_SQL}, pool as (select *, row_number() over (order by o_orderkey) - 1 as slot from d where done = (select done from rare)),
draws as (select range as draw_id from range((select max(n) from c)))
select o_orderkey, o_totalprice, done from draws join pool on slot = {modulo_sql(digest_sql('draw_id'), 'select min(n) from c')}
union all select o_orderkey, o_totalprice, done from d where done = (select done from common)
""")
def b02(t):
    return over_balance(done_orders(t), "done", "o_orderkey")


SMOTE_SQL = f"""
docs as {DOCS_SQL}, c as (select quality, count(*) as n from docs group by 1),
pool as (select doc_id, n_chars, words, row_number() over (order by doc_id) - 1 as slot from docs where quality = 0),
dist as (select a.doc_id, b.n_chars as n2, b.words as w2,
  row_number() over (partition by a.doc_id order by sqrt((a.n_chars - b.n_chars) ** 2 + (a.words - b.words) ** 2), b.doc_id) as rank
  from pool a join pool b on a.doc_id <> b.doc_id),
draws as (select range as synthetic_id from range((select max(n) - min(n) from c))),
picked as (select synthetic_id, {modulo_sql(digest_sql('synthetic_id', '42:base'), 'select min(n) from c')} as slot,
  {modulo_sql(digest_sql('synthetic_id', '42:pick'), '5')} + 1 as rank, {uniform_sql(digest_sql('synthetic_id', '42:gap'))} as u from draws),
synth as (select synthetic_id, round(n_chars + u * (n2 - n_chars), 4) as n_chars, round(words + u * (w2 - words), 4) as words, 0 as quality
  from picked join pool using (slot) join dist on dist.doc_id = pool.doc_id and dist.rank = picked.rank)
"""


@query("b03_synthetic_rows", f"with {SMOTE_SQL} select * from synth")
def b03(t):
    return rounded(synthetic_rows(labelled_documents(t), "quality", "doc_id", ["n_chars", "words"]), ["n_chars", "words"])


@query("b03_smote_balance", f"""
with {SMOTE_SQL}, whole as (select n_chars, words, quality from docs union all select n_chars, words, quality from synth)
select quality, count(*) as n, round(avg(n_chars), 3) as n_chars, round(avg(words), 3) as words from whole group by 1
""")
def b03_balance(t):
    out = smote_balance(labelled_documents(t), "quality", "doc_id", ["n_chars", "words"])
    return out.groupBy("quality").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("n_chars"), 3).alias("n_chars"), F.round(F.avg("words"), 3).alias("words"))


@query("b04_balance_by_strategy", f"""
with {CLASSES_SQL} select 'under' as strategy, done, (select min(n) from c) as n from c union all select 'over', done, (select max(n) from c) from c
""")
def b04(t):
    df = done_orders(t)
    parts = [balance(df, "done", "o_orderkey", s).groupBy("done").agg(F.count(F.lit(1)).alias("n")).withColumn("strategy", F.lit(s)) for s in ("under", "over")]
    return parts[0].unionByName(parts[1]).select("strategy", "done", "n")


# --- selection ---------------------------------------------------------------


def split_lineitem(t):
    key = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return split_train_test(t.lineitem.select(*key, "l_quantity", "l_extendedprice", "l_discount", "l_tax"), key)


LINE_TRAIN = "substr(md5(concat_ws(':', l_orderkey, l_partkey, l_suppkey, l_linenumber, '42')), 1, 8) < 'b3333333'"


@query("v01_same_columns_dropped", f"""
select case when {LINE_TRAIN} then 'train' else 'test' end as split, count(*) as n, round(sum(l_quantity), 2) as quantity, round(sum(l_extendedprice), 2) as price
from lineitem group by 1
""")
def v01(t):
    train, test = select_features(*split_lineitem(t), "lowvar", "l_quantity", max_threshold=0.45, min_threshold=0.4)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    if "l_tax" in both.columns or "l_discount" in both.columns:
        raise AssertionError("low-variance columns are still there")
    return both.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"),
                                     F.round(F.sum("l_extendedprice"), 2).alias("price"))


@query("v02_select_low_variance", " union all ".join(
    f"select '{c}' as variable from {RELATED_SQL} having var_samp({c}) < 0.45" for c in RELATED if c != "l_quantity"))
def v02_low(t):
    model = FeatureSelection("lowvar", "l_quantity", max_threshold=0.45).fit(related(t))
    return t.spark.createDataFrame([(c,) for c in model.state["dropped"]], "variable string")


FEATURES = [c for c in RELATED if c != "l_discount"]


@query("v02_select_redundant", "select distinct var2 as variable from (" + " union all ".join(
    f"select '{b}' as var2, abs(corr({a}, {b})) as r from {RELATED_SQL}" for i, a in enumerate(FEATURES) for b in FEATURES[i + 1:]) + ") where r >= 0.7")
def v02_redundant(t):
    model = FeatureSelection("redundant", "l_discount", min_threshold=0.7).fit(related(t))
    return t.spark.createDataFrame([(c,) for c in model.state["dropped"]], "variable string")


# --- splits ------------------------------------------------------------------


@query("k01_split", f"select o_orderkey, case when {TRAIN} then 'train' else 'test' end as split from orders")
def k01(t):
    return tag_split(t.orders.select("o_orderkey"), "o_orderkey")


@query("k02_stratified_split", f"""
select o_orderkey, o_orderstatus, case when row_number() over (partition by o_orderstatus order by {digest_sql('o_orderkey')})
  <= floor(count(*) over (partition by o_orderstatus) * 0.7::double + 1e-9) then 'train' else 'test' end as split from orders
""")
def k02(t):
    return stratified_split(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", "o_orderkey")


K_SQL = "select event_id, {c} case when row_number() over (order by ts, event_id) <= floor(count(*) over () * 0.9::double) then 'train' else 'test' end as split from events"


@query("k03_series_split", K_SQL.format(c=""))
def k03(t):
    train, test = head_share(assign_row_index(t.events.select("event_id", "ts"), ["ts", "event_id"]), 0.9)
    return train.select("event_id", F.lit("train").alias("split")).unionByName(test.select("event_id", F.lit("test").alias("split")))


@query("k04_table_split", K_SQL.format(c="event_type, user_id, value,"))
def k04(t):
    train, test = head_share(assign_row_index(t.events, ["ts", "event_id"]), 0.9)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return both.select("event_id", "event_type", "user_id", "value", "split")
