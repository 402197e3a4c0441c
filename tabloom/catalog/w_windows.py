"""Positions, lags, rolling means, running totals, sorts and set operations."""

from pyspark.sql import functions as F

from tabloom.catalog.base import digest_sql, query
from tabloom.operators.neighbors import knn_join, knn_vote
from tabloom.operators.order import Ordered, assign_row_index, difference, lagged, prefix_sum, rolling_mean
from tabloom.operators.sampling import split_train_test
from tabloom.operators.series import std_band
from tabloom.catalog.j_joins import SPLIT


def timed(t):
    return assign_row_index(t.events.select("event_id", "ts", "event_type", "value"), ["ts", "event_id"])


@query("w01_row_position", "select event_id, row_number() over (order by ts, event_id) - 1 as row_idx from events")
def w01(t):
    return timed(t).df.select("event_id", "row_idx")


@query("w02_difference", "select event_id, round(value - lag(value) over (order by ts, event_id), 4) as value_diff from events")
def w02(t):
    return difference(timed(t), ["value"]).select("event_id", F.round("value_diff", 4).alias("value_diff"))


@query("w02_difference_by_series", """
select event_id, round(value - lag(value) over (partition by event_type order by ts, event_id), 4) as value_diff from events
""")
def w02_series(t):
    ordered = assign_row_index(t.events.select("event_id", "ts", "event_type", "value"), ["event_type", "ts", "event_id"])
    return difference(ordered, ["value"], series=["event_type"]).select("event_id", F.round("value_diff", 4).alias("value_diff"))


@query("w03_lags", """
select event_id, lag(value, 1) over w as lag_1, lag(value, 10) over w as lag_10, lag(value, 20) over w as lag_20
from events window w as (order by ts, event_id)
""")
def w03(t):
    return lagged(timed(t), "value", 20, 10).select("event_id", "lag_1", "lag_10", "lag_20")


ROLLING = (10, 25, 50, 100, 250)
ROLLING_SQL = "select event_id, " + ", ".join(
    f"case when count(value) over w{n} = {n} then round(avg(value) over w{n}, 4) end as mean_{n}" for n in ROLLING
) + " from events window " + ", ".join(f"w{n} as (order by ts, event_id rows between {n - 1} preceding and current row)" for n in ROLLING)


@query("w04_rolling_mean", ROLLING_SQL)
def w04(t):
    out = rolling_mean(timed(t), "value", ROLLING, block_rows=4096)
    return out.select("event_id", *[F.round(f"mean_{n}", 4).alias(f"mean_{n}") for n in ROLLING])


@query("w05_running_count", """
with d as (select event_id, ts, case when value < lag(value) over (order by ts, event_id) then 1 else 0 end as drop_flag from events)
select event_id, cast(sum(drop_flag) over (order by ts, event_id) as bigint) as nr_drops from d
""")
def w05(t):
    steps = difference(timed(t), ["value"])
    flag = F.coalesce((F.col("value_diff") < 0).cast("long"), F.lit(0).cast("long"))
    return prefix_sum(Ordered(steps, t.events.count()), flag, "nr_drops", block_rows=2000).select("event_id", "nr_drops")


@query("w06_std_band", """
with s as (select round(stddev_pop(value), 3) as b from events)
select event_id, round(value - b, 4) as band_low, round(value + b, 4) as band_high from events, s
""")
def w06(t):
    return std_band(t.events, "value").select("event_id", *[F.round(c, 4).alias(c) for c in ("band_low", "band_high")])


@query("x01_sorted_distinct", "select distinct c_mktsegment from customer")
def x01(t):
    return t.customer.select("c_mktsegment").distinct().orderBy("c_mktsegment")


@query("x02_sorted_values", "select value, event_id from events")
def x02(t):
    return t.events.select("value", "event_id").orderBy("value", "event_id")


@query("x04_vote_top_k", f"""
with v as (select vec_id, label, embedding::double[] as e, {SPLIT} as train from embeddings),
d as (select a.vec_id, b.vec_id as other, b.label, list_distance(a.e, b.e) as distance from v a join v b on not a.train and b.train),
r as (select *, row_number() over (partition by vec_id order by distance, other) as rank from d),
k as (select unnest([1, 5, 9]) as k),
votes as (select vec_id, k, label, count(*) as n from r join k on rank <= k group by 1, 2, 3)
select vec_id, k, arg_min(label, -n * 1000 + label) as prediction from votes group by 1, 2
""")
def x04(t):
    train, test = split_train_test(t.embeddings, "vec_id")
    near = knn_join(test, train, 9, query_id="vec_id", candidate_id="vec_id", features="embedding", keep=["label"])
    return knn_vote(near, "vec_id", "label", [1, 5, 9])


@query("x05_union_all", """
select n_name as name, 'nation' as kind from nation union all select r_name, 'region' from region union all select r_name, 'region' from region
""")
def x05(t):
    nations = t.nation.select(F.col("n_name").alias("name"), F.lit("nation").alias("kind"))
    regions = t.region.select(F.col("r_name").alias("name"), F.lit("region").alias("kind"))
    return nations.unionByName(regions).unionByName(regions)


@query("x06_union_distinct", "select l_orderkey as k from lineitem union select l_partkey from lineitem")
def x06(t):
    return t.lineitem.select(F.col("l_orderkey").alias("k")).union(t.lineitem.select("l_partkey")).distinct()


@query("x08_except_rows", f"select o_orderkey, o_totalprice from orders where substr({digest_sql('o_orderkey')}, 1, 8) >= 'b3333333'")
def x08(t):
    from tabloom.operators.joins import complement

    train, _ = split_train_test(t.orders, "o_orderkey")
    return complement(t.orders, train, ["o_orderkey"]).select("o_orderkey", "o_totalprice")
