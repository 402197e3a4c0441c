"""Sources, sinks and samples."""

from pyspark.sql import functions as F

from tabloom.catalog.base import Tables, digest_sql, modulo_sql, query
from tabloom.operators.cleaning import RareCategoryGrouping
from tabloom.operators.columns import require_columns, strip_names
from tabloom.operators.sampling import sample_exact, sample_fraction, sample_with_replacement, shuffle_rows, tag_split
from tabloom.operators.scaling import Scaling
from tabloom.operators.stages import load_stage
from tabloom.session import scratch_path
from tabloom.sources.tables import load_series, load_splits, load_table, load_tables, save_table, table_shapes

ORDER_TYPES = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"


def orders_csv(t: Tables) -> str:
    gaps = t.orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
    )
    return save_table(gaps, scratch_path(t.spark, "orders-csv"), fmt="csv")


PRIORITY_SQL = """
select nullif(o_orderpriority, '5-LOW') as o_orderpriority, count(*) as n, round(sum(o_totalprice), 2) as total
from orders group by 1
"""


def priority_summary(df):
    return df.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("s01_load_csv", PRIORITY_SQL)
def s01(t):
    return priority_summary(load_table(t.spark, orders_csv(t), fmt="csv", schema=ORDER_TYPES))


@query("s01_load_csv_inferred", PRIORITY_SQL)
def s01_inferred(t):
    return priority_summary(load_table(t.spark, orders_csv(t), fmt="csv"))


@query("s01_load_sampled", f"""
select o_orderkey, o_totalprice from orders where substr({digest_sql('o_orderkey')}, 1, 8) < '4ccccccc'
""")
def s01_sampled(t):
    df = load_table(t.spark, f"{t.folder}/orders.parquet", sample=0.3, sample_keys="o_orderkey")
    return df.select("o_orderkey", "o_totalprice")


@query("s01_load_json", "select n_nationkey, n_name, n_regionkey from nation")
def s01_json(t):
    path = save_table(t.nation, scratch_path(t.spark, "nation-json"), fmt="json")
    return load_table(t.spark, path, fmt="json", schema="n_nationkey int, n_name string, n_regionkey int")


@query("s02_load_tables", """
select 'region' as dataset, count(*) as records, 2 as variables from region union all
select 'nation', count(*), 3 from nation union all
select 'customer', count(*), 5 from customer union all
select 'orders', count(*), 6 from orders
""")
def s02(t):
    return table_shapes(load_tables(t.spark, {n: f"{t.folder}/{n}.parquet" for n in ("region", "nation", "customer", "orders")}))


@query("s03_key_column", "select o_orderkey, o_custkey, o_orderstatus from orders")
def s03(t):
    df = load_table(t.spark, orders_csv(t), fmt="csv", schema=ORDER_TYPES)
    return require_columns(df, ["o_orderkey"]).select("o_orderkey", "o_custkey", "o_orderstatus")


@query("s04_load_series", """
select date_trunc('hour', ts) as ts, count(*) as n, round(sum(value), 2) as total from events group by 1
""")
def s04(t):
    text = t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "value")
    path = save_table(text, scratch_path(t.spark, "events-csv"), fmt="csv")
    series = load_series(t.spark, path, "ts", ts_format="yyyy-MM-dd HH:mm:ss", fmt="csv", schema="event_id long, ts string, value double")
    return series.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("s05_train_test_files", f"""
with tagged as (
  select quality, case when substr({digest_sql('doc_id')}, 1, 8) < 'b3333333' then 'train' else 'test' end as split from labels)
select quality, count(*) filter (split = 'train') as n_train, count(*) filter (split = 'test') as n_test,
  2 as nr_features from tagged group by 1
""")
def s05(t):
    tagged = tag_split(t.labels, "doc_id")
    paths = {s: save_table(tagged.filter(F.col("split") == s).drop("split"), scratch_path(t.spark, f"labels-{s}")) for s in ("train", "test")}
    splits = load_splits(t.spark, paths["train"], paths["test"], "quality")
    counts = splits.train.withColumn("split", F.lit("train")).unionByName(splits.test.withColumn("split", F.lit("test")))
    counted = counts.groupBy("quality").agg(
        F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "test").alias("n_test"))
    return splits.labels().join(counted, "quality").withColumn("nr_features", F.lit(len(splits.features)))


@query("s06_stage_handoff", "select o_orderstatus, count(*) as n, round(sum(o_totalprice), 2) as total from orders group by 1")
def s06(t):
    path = save_table(t.orders, scratch_path(t.spark, "stage"), partition_by=["o_orderstatus"])
    return t.spark.read.parquet(path).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("s07_sample_fraction", f"""
select event_id, event_type, value from events where substr({digest_sql('event_id')}, 1, 8) < '0ccccccc'
""")
def s07(t):
    return sample_fraction(t.events, 0.05, "event_id").select("event_id", "event_type", "value")


@query("s08_sample_exact", f"""
select o_orderkey, o_totalprice from orders order by {digest_sql('o_orderkey')}
limit (select count(*) // 3 from orders)
""")
def s08(t):
    return sample_exact(t.orders, t.orders.count() // 3, "o_orderkey").select("o_orderkey", "o_totalprice")


@query("s08_sample_with_replacement", f"""
with pool as (select c_custkey, c_acctbal, row_number() over (order by c_custkey) - 1 as slot from customer),
draws as (select range as draw_id from range((select 2 * count(*) from customer)))
select draw_id, c_custkey, c_acctbal from draws
join pool on slot = {modulo_sql(digest_sql('draw_id'), 'select count(*) from customer')}
""")
def s08_replacement(t):
    return sample_with_replacement(t.customer, 2 * t.customer.count(), "c_custkey").select("draw_id", "c_custkey", "c_acctbal")


@query("s09_shuffle", f"""
select event_id, row_number() over (order by {digest_sql('event_id')}) - 1 as shuffled_idx from events
""")
def s09(t):
    return shuffle_rows(t.events.select("event_id"), "event_id").df


@query("s10_strip_names", "select o_orderkey, o_orderstatus, o_totalprice from orders")
def s10(t):
    blank = t.orders.select(*[F.col(c).alias(f"  {c} ") for c in ("o_orderkey", "o_orderstatus", "o_totalprice")])
    return strip_names(blank)


@query("s11_require_target", "select quality, count(*) as n from labels group by 1")
def s11(t):
    return require_columns(t.labels, ["quality"]).groupBy("quality").agg(F.count(F.lit(1)).alias("n"))


@query("s12_saved_stages", """
with keep as (select o_orderpriority as p from orders group by 1 having count(*) / (select count(*) from orders) >= 0.2),
lim as (select min(o_totalprice) as lo, max(o_totalprice) as hi from orders)
select o_orderkey, round((o_totalprice - lo) / (hi - lo), 6) as o_totalprice,
  case when o_orderpriority in (select p from keep) then o_orderpriority else 'OTHERS' end as o_orderpriority
from orders, lim
""")
def s12(t):
    fitted = [RareCategoryGrouping(["o_orderpriority"], 0.2).fit(t.orders), Scaling("minmax", ["o_totalprice"]).fit(t.orders)]
    out = t.orders
    for i, stage in enumerate(fitted):
        path = scratch_path(t.spark, f"stage{i}")
        stage.save(t.spark, path)
        out = load_stage(t.spark, path).transform(out)
    return out.select("o_orderkey", F.round("o_totalprice", 6).alias("o_totalprice"), "o_orderpriority")
