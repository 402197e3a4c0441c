"""Cleaning steps and encodings with learned state."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabloom.catalog.a_aggregates import rounded
from tabloom.catalog.base import digest_sql, query
from tabloom.operators.cleaning import Cleaning, RareCategoryGrouping, derive_date_columns, road_alignment_features
from tabloom.operators.encoding import (
    LIGHTING_ORDER,
    CyclicByMax,
    CyclicByPeriod,
    CyclicTwoStep,
    FrequencyEncoder,
    OneHot,
    OneHotVector,
    Refit,
    PlaceEncoder,
    REGION_STATES,
    encode_binary,
    encode_calendar,
    hierarchy_codes,
    ordinal_encode,
)
from tabloom.operators.joins import lookup_join
from tabloom.operators.sampling import split_train_test

TRAIN = f"substr({digest_sql('o_orderkey')}, 1, 8) < 'b3333333'"


def messy_orders(t):
    """Orders with a null, a constant, a code-named, an ``hhmm`` and a text-date column."""
    return t.orders.select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
        F.nullif("o_custkey", F.lit(1)).alias("partly"), F.lit("x").alias("same"), F.lit(1).alias("ShipCode"),
        (F.pmod(F.col("o_custkey"), F.lit(24)) * 100 + F.pmod(F.col("o_orderkey"), F.lit(60))).cast("int").alias("CRSDepTime"),
        F.date_format("o_orderdate", "MM/dd/yyyy hh:mm:ss a").alias("ordered"),
    )


FREQUENT_PRIORITY = "(select o_orderpriority from orders group by 1 having count(*) / (select count(*) from orders) >= 0.2)"


@query("c01_clean_flights_style", f"""
select o_orderkey, o_orderstatus, o_totalprice, case when o_orderpriority in {FREQUENT_PRIORITY} then o_orderpriority else 'OTHERS' end as o_orderpriority,
  printf('%02d:%02d', o_custkey % 24, o_orderkey % 60) as "CRSDepTime"
from orders
""")
def c01(t):
    cleaning = Cleaning(rare_threshold=0.2, drop_patterns=["Code"], time_columns=["CRSDepTime"], keep=["o_orderkey"])
    df = messy_orders(t).drop("ordered")
    return cleaning.fit(df).transform(df)


@query("c02_clean_accidents_style", f"""
select o_orderkey, o_orderstatus, case when o_orderpriority in {FREQUENT_PRIORITY} then o_orderpriority else 'OTHERS' end as o_orderpriority,
  cast(year(o_orderdate) as integer) as ordered_year, cast(quarter(o_orderdate) as integer) as ordered_quarter,
  cast(month(o_orderdate) as integer) as ordered_month, cast(day(o_orderdate) as integer) as ordered_day from orders
""")
def c02(t):
    df = messy_orders(t).select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "ordered")
    cleaning = Cleaning(rare_threshold=0.2, drop_patterns=["price"], date_columns=["ordered"], drop_null_columns=False, drop_constant=False)
    return cleaning.fit(df).transform(df)


@query("c03_rare_categories", f"""
with train as (select nullif(o_orderpriority, '5-LOW') as p from orders where {TRAIN}),
keep as (select p from train where p is not null group by 1 having count(*) / (select count(p) from train) >= 0.25)
select o_orderkey, case when nullif(o_orderpriority, '5-LOW') in (select p from keep) then o_orderpriority else 'OTHERS' end as o_orderpriority
from orders where not {TRAIN}
""")
def c03(t):
    df = t.orders.select("o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"))
    train, test = split_train_test(df, "o_orderkey")
    return RareCategoryGrouping(["o_orderpriority"], 0.25).fit(train).transform(test)


@query("c03_rare_categories_keep_null", """
with v as (select o_orderkey, nullif(o_orderpriority, '5-LOW') as p from orders),
keep as (select p from v where p is not null group by 1 having count(*) / (select count(p) from v) >= 0.25)
select o_orderkey, case when p is null then null when p in (select p from keep) then p else 'OTHERS' end as o_orderpriority from v
""")
def c03_null(t):
    df = t.orders.select("o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"))
    return RareCategoryGrouping(["o_orderpriority"], 0.25, null_policy="keep").fit(df).transform(df)


@query("c04_date_columns", """
select o_orderkey, cast(year(o_orderdate) as integer) as o_orderdate_year, cast(quarter(o_orderdate) as integer) as o_orderdate_quarter,
  cast(month(o_orderdate) as integer) as o_orderdate_month, cast(day(o_orderdate) as integer) as o_orderdate_day from orders
""")
def c04(t):
    return derive_date_columns(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate"], drop_source=True)


ALIGNMENT_SQL = """(select p_partkey, case p_size % 5 when 0 then 'STRAIGHT AND LEVEL' when 1 then 'CURVE ON GRADE' when 2 then 'STRAIGHT ON HILLCREST'
  when 3 then 'CURVE, LEVEL' else p_type end as alignment from part)"""


@query("c05_alignment_features", f"""
select p_partkey, cast(contains(alignment, 'CURVE') as tinyint) as is_curve, cast(case when contains(alignment, 'LEVEL') then 0
  when contains(alignment, 'ON GRADE') then 1 when contains(alignment, 'HILLCREST') then 2 else 0 end as tinyint) as alignment_grade from {ALIGNMENT_SQL}
""")
def c05(t):
    texts = F.array(*[F.lit(x) for x in ("STRAIGHT AND LEVEL", "CURVE ON GRADE", "STRAIGHT ON HILLCREST", "CURVE, LEVEL")])
    df = t.part.withColumn("alignment", F.coalesce(F.get(texts, F.pmod("p_size", F.lit(5))), F.col("p_type")))
    return road_alignment_features(df).select("p_partkey", "is_curve", "alignment_grade")


LIGHT = list(LIGHTING_ORDER)


@query("e01_ordinal", "select o_orderkey, cast(o_custkey % 7 as integer) as lighting_condition from orders")
def e01(t):
    light = F.get(F.array(*[F.lit(x) for x in LIGHT]), F.pmod("o_custkey", F.lit(7)).cast("int"))
    df = t.orders.select("o_orderkey", light.alias("lighting_condition"))
    return ordinal_encode(df, {"lighting_condition": LIGHTING_ORDER, "absent": {}})


@query("e02_hierarchy_codes", """
with h as (select c_custkey, r_name, n_name, c_mktsegment from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)
select c_custkey, dense_rank() over (order by r_name) * 1000 + dense_rank() over (partition by r_name order by n_name) * 100
  + dense_rank() over (partition by r_name, n_name order by c_mktsegment) as code from h
""")
def e02(t):
    places = t.nation.join(t.region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey").withColumnRenamed("n_nationkey", "c_nationkey")
    levels = ["r_name", "n_name", "c_mktsegment"]
    df = lookup_join(t.customer, places, ["c_nationkey"])
    joined = lookup_join(df, hierarchy_codes(df, levels), levels)
    code = F.col("r_name_code") * 1000 + F.col("n_name_code") * 100 + F.col("c_mktsegment_code")
    return joined.select("c_custkey", code.alias("code"))


STATES = [s for states in REGION_STATES.values() for s in states]
STATE_LIST = "[" + ", ".join(f"'{s}'" for s in STATES) + "]"
REGION_ROWS = ", ".join(
    f"('{s}', {r + 1}, {i + 1})" for r, region in enumerate(sorted(REGION_STATES)) for i, s in enumerate(sorted(REGION_STATES[region])))


@query("e02_place_codes", f"""
with c as (select c_custkey, ({STATE_LIST})[cast(c_nationkey + 1 as integer)] as os, c_mktsegment as oc,
  ({STATE_LIST})[cast(50 - c_nationkey as integer)] as ds, concat(substr(c_mktsegment, 1, 4), ' City') as dc from customer),
cities as (select state, city, dense_rank() over (partition by state order by city) as code from
  (select os as state, oc as city from c union select ds, dc from c)),
states as (select * from (values {REGION_ROWS}) as v(state, r, s))
select c_custkey, coalesce(a.r, 0) * 1000 + coalesce(a.s, 0) * 100 + coalesce(ca.code, 0) as "OriginGeoNum",
  coalesce(b.r, 0) * 1000 + coalesce(b.s, 0) * 100 + coalesce(cb.code, 0) as "DestGeoNum" from c
left join states a on a.state = os left join states b on b.state = ds
left join cities ca on ca.state = os and ca.city = oc left join cities cb on cb.state = ds and cb.city = dc
""")
def e02_places(t):
    states = F.array(*[F.lit(s) for s in STATES])
    origin, dest = F.get(states, F.col("c_nationkey")), F.get(states, F.lit(49) - F.col("c_nationkey"))
    df = t.customer.select(
        "c_custkey", origin.alias("OriginState"), F.concat("c_mktsegment", F.lit(", "), origin).alias("OriginCityName"),
        dest.alias("DestState"), F.concat(F.substring("c_mktsegment", 1, 4), F.lit(" City, "), dest).alias("DestCityName"),
    )
    roles = [("OriginState", "OriginCityName", "OriginGeoNum"), ("DestState", "DestCityName", "DestGeoNum")]
    return PlaceEncoder(roles).fit(df).transform(df)


def one_hot_sql(column: str, values) -> str:
    return ", ".join(f"""cast({column} = '{v}' as double) as "{column}_{v}\"""" for v in values)


@query("e03_one_hot", f"""
select l_orderkey, l_partkey, {one_hot_sql('l_returnflag', 'ANR')}, {one_hot_sql('l_linestatus', 'O')} from lineitem
""")
def e03(t):
    df = t.lineitem.select("l_orderkey", "l_partkey", "l_returnflag", "l_linestatus")
    return OneHot(["l_returnflag", "l_linestatus"]).fit(df).transform(df)


@query("e03_one_hot_unseen", f"""
select o_orderkey, {one_hot_sql('o_orderpriority', ['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED'])} from orders
""")
def e03_unseen(t):
    df = t.orders.select("o_orderkey", "o_orderpriority")
    return OneHot(["o_orderpriority"]).fit(df.filter("o_orderpriority <> '5-LOW'")).transform(df)


@query("e03_one_hot_vector", """
with codes as (select p_brand, dense_rank() over (order by p_brand) - 1 as code from part group by 1)
select p_partkey, code, (select count(*) from codes) + 1 as width from part join codes using (p_brand)
""")
def e03_vector(t):
    out = OneHotVector(["p_brand"]).fit(t.part).transform(t.part)
    dense = vector_to_array("p_brand_vec")
    return out.select("p_partkey", (F.array_position(dense, 1.0) - 1).alias("code"), F.size(dense).cast("long").alias("width"))


@query("e04_cyclic_by_max", """
with m as (select max(p_size) as m from part)
select p_partkey, round(sin(2 * pi() * p_size / m), 3) as p_size_sin, round(cos(2 * pi() * p_size / m), 3) as p_size_cos from part, m
""")
def e04(t):
    df = t.part.select("p_partkey", "p_size")
    return CyclicByMax(["p_size"]).fit(df).transform(df).drop("p_size")


def calendar_orders(t):
    return derive_date_columns(t.orders.select("o_orderkey", F.col("o_orderdate").alias("crash_date")), ["crash_date"], drop_source=True)


YEARS_SQL = "(select y, dense_rank() over (order by y) - 1 as r, count(*) over () as n from (select distinct year(o_orderdate) as y from orders))"


@query("e05_cyclic_by_period", f"""
select o_orderkey, round(sin(2 * pi() * (r % n) / n), 6) as crash_date_year_sin, round(cos(2 * pi() * (r % n) / n), 6) as crash_date_year_cos,
  round(sin(2 * pi() * (month(o_orderdate) % 12) / 12), 6) as crash_date_month_sin, round(cos(2 * pi() * (month(o_orderdate) % 12) / 12), 6) as crash_date_month_cos,
  round(sin(2 * pi() * (day(o_orderdate) % 31) / 31), 6) as crash_date_day_sin, round(cos(2 * pi() * (day(o_orderdate) % 31) / 31), 6) as crash_date_day_cos,
  round(sin(2 * pi() * (quarter(o_orderdate) % 4) / 4), 6) as crash_date_quarter_sin, round(cos(2 * pi() * (quarter(o_orderdate) % 4) / 4), 6) as crash_date_quarter_cos
from orders join {YEARS_SQL} on y = year(o_orderdate)
""")
def e05(t):
    from tabloom.operators.encoding import ACCIDENT_PERIODS

    df = calendar_orders(t)
    out = CyclicByPeriod(ACCIDENT_PERIODS, ranked=["crash_date_year"]).fit(df).transform(df)
    return zeroed(out, "o_orderkey", 6)


def zeroed(df, key, digits):
    """Rounded values with negative zero written as zero."""
    return df.select(key, *[(F.round(c, digits) + F.lit(0.0)).alias(c) for c in df.columns if c != key])


@query("e06_calendar", """
select event_id, round(sin(2 * pi() * (isodow(ts) - 1) / 7), 6) as "DayOfWeek_sin", round(cos(2 * pi() * (isodow(ts) - 1) / 7), 6) as "DayOfWeek_cos",
  round(sin(2 * pi() * (day(ts) - 1) / 31), 6) as "DayofMonth_sin", round(cos(2 * pi() * (day(ts) - 1) / 31), 6) as "DayofMonth_cos",
  round(sin(2 * pi() * (hour(ts) * 60 + minute(ts)) / 1440), 6) as "CRSDepTime_sin", round(cos(2 * pi() * (hour(ts) * 60 + minute(ts)) / 1440), 6) as "CRSDepTime_cos",
  round(sin(2 * pi() * (hour(ts) * 60 + 29.5) / 1440), 6) as "DepTimeBlk_sin", round(cos(2 * pi() * (hour(ts) * 60 + 29.5) / 1440), 6) as "DepTimeBlk_cos"
from events
""")
def e06(t):
    hour = F.lpad(F.hour("ts").cast("string"), 2, "0")
    df = t.events.select(
        "event_id", (F.weekday("ts") + 1).alias("DayOfWeek"), F.dayofmonth("ts").alias("DayofMonth"),
        F.date_format("ts", "HH:mm").alias("CRSDepTime"), F.concat(hour, F.lit("00-"), hour, F.lit("59")).alias("DepTimeBlk"),
    )
    return zeroed(encode_calendar(df), "event_id", 6)


@query("e07_cyclic_two_step", f"""
with a as (select o_orderkey, 2 * pi() * r / n as y, 2 * pi() * (month(o_orderdate) - 1) / 12 as m
  from orders join {YEARS_SQL} on y = year(o_orderdate)),
x as (select max(y) as my, max(m) as mm from a)
select o_orderkey, round(sin(2 * pi() * y / my), 3) + 0.0 as crash_date_year_sin, round(cos(2 * pi() * y / my), 3) + 0.0 as crash_date_year_cos,
  round(sin(2 * pi() * m / mm), 3) + 0.0 as crash_date_month_sin, round(cos(2 * pi() * m / mm), 3) + 0.0 as crash_date_month_cos from a, x
""")
def e07(t):
    df = calendar_orders(t).select("o_orderkey", "crash_date_year", "crash_date_month")
    out = CyclicTwoStep({"crash_date_month": (1, 12)}, ranked=["crash_date_year"]).fit(df).transform(df)
    return zeroed(out, "o_orderkey", 3)


@query("e08_binary", """
select o_orderkey, cast(o_totalprice > 200000 as tinyint) as large, cast(case when o_orderstatus = 'F' then 1.0::double when o_orderstatus = 'O' then 0.0::double end as double) as done from orders
""")
def e08(t):
    df = t.orders.select("o_orderkey", (F.col("o_totalprice") > 200000).alias("large"),
                         F.when(F.col("o_orderstatus") == "F", "Y").when(F.col("o_orderstatus") == "O", "N").alias("done"))
    return encode_binary(df, {"done": {"N": 0, "Y": 1}}).withColumn("done", F.col("done").cast("double"))


@query("e09_frequency", f"""
with f as (select o_orderpriority, count(*) / (select count(*) from orders where {TRAIN})::double as freq from orders where {TRAIN} group by 1)
select o_orderkey, round(coalesce(freq, 0), 6) as o_orderpriority_freq from orders left join f using (o_orderpriority)
""")
def e09(t):
    train, _ = split_train_test(t.orders, "o_orderkey")
    out = FrequencyEncoder(["o_orderpriority"]).fit(train).transform(t.orders)
    return rounded(out.select("o_orderkey", "o_orderpriority_freq"), ["o_orderpriority_freq"], 6)


@query("e09_frequency_refit", f"""
with f as (select o_orderpriority, count(*) / (select count(*) from orders where not ({TRAIN}))::double as freq from orders where not ({TRAIN}) group by 1)
select o_orderkey, round(freq, 6) as o_orderpriority_freq from orders join f using (o_orderpriority) where not ({TRAIN})
""")
def e09_refit(t):
    train, test = split_train_test(t.orders, "o_orderkey")
    out = Refit(FrequencyEncoder(["o_orderpriority"])).fit(train).transform(test)
    return rounded(out.select("o_orderkey", "o_orderpriority_freq"), ["o_orderpriority_freq"], 6)


@query("e05_cyclic_many_ranks", """
with r as (select o_orderkey, dense_rank() over (order by o_orderkey) - 1 as rank, count(*) over () as n from orders)
select o_orderkey, round(sin(2 * pi() * rank / n), 6) + 0.0 as k_sin, round(cos(2 * pi() * rank / n), 6) + 0.0 as k_cos from r
""")
def e05_many(t):
    df = t.orders.select("o_orderkey", F.col("o_orderkey").alias("k"))
    out = CyclicByPeriod({}, ["k"], max_ranks=100).fit(df).transform(df)
    # No negative zero.
    return out.select("o_orderkey", *[(F.round(c, 6) + 0.0).alias(c) for c in ("k_sin", "k_cos")])


@query("e10_encoding_order", f"""
with f as (select o_orderpriority, count(*) / (select count(*) from orders)::double as freq from orders group by 1)
select o_orderkey, cast(o_custkey % 7 as integer) as lighting_condition, {one_hot_sql('o_orderstatus', 'FOP')},
  round(sin(2 * pi() * (month(o_orderdate) - 1) / 12), 6) as "Month_sin", round(cos(2 * pi() * (month(o_orderdate) - 1) / 12), 6) as "Month_cos",
  cast(o_totalprice > 200000 as tinyint) as large, round(freq, 6) as o_orderpriority_freq
from orders join f using (o_orderpriority)
""")
def e10(t):
    light = F.get(F.array(*[F.lit(x) for x in LIGHT]), F.pmod("o_custkey", F.lit(7)).cast("int"))
    df = t.orders.select("o_orderkey", light.alias("lighting_condition"), "o_orderstatus", F.month("o_orderdate").alias("Month"),
                         (F.col("o_totalprice") > 200000).alias("large"), "o_orderpriority")
    df = ordinal_encode(df, {"lighting_condition": LIGHTING_ORDER})
    df = OneHot(["o_orderstatus"]).fit(df).transform(df)
    df = encode_binary(encode_calendar(df), {})
    df = FrequencyEncoder(["o_orderpriority"]).fit(df).transform(df)
    return df.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in ("Month_sin", "Month_cos", "o_orderpriority_freq")})
