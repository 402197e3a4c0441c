"""Scalar functions."""

from pyspark.sql import functions as F

from tabloom.catalog.base import query
from tabloom.functions import dates as D
from tabloom.functions.densities import exponential_pdf, lognormal_pdf, normal_pdf
from tabloom.functions.text import place_parts
from tabloom.operators.encoding import category_codes, encode_booleans


@query("f01_number_probe", """
select o_orderkey, try_cast(case when o_orderstatus = 'F' then o_orderpriority else cast(o_custkey as varchar) end as double) as number from orders
""")
def f01(t):
    text = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).otherwise(F.col("o_custkey").cast("string"))
    return t.orders.select("o_orderkey", D.number_probe(text).alias("number"))


@query("f02_date_probe", """
select o_orderkey, case when o_orderstatus <> 'F' then o_orderdate end as parsed from orders
""")
def f02(t):
    text = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t.orders.select("o_orderkey", D.timestamp_probe(text, "yyyy-MM-dd").cast("timestamp_ntz").alias("parsed"))


@query("f03_us_timestamp", """
select event_id, case when event_type <> 'error' then date_trunc('second', ts) end as parsed from events
""")
def f03(t):
    text = F.when(F.col("event_type") == "error", F.lit("not a date")).otherwise(F.date_format("ts", "MM/dd/yyyy hh:mm:ss a"))
    return t.events.select("event_id", D.parse_us_timestamp(text).cast("timestamp_ntz").alias("parsed"))


@query("f04_date_parts", """
select o_orderkey, cast(year(o_orderdate) as integer) as year, cast(quarter(o_orderdate) as integer) as quarter,
  cast(month(o_orderdate) as integer) as month, cast(day(o_orderdate) as integer) as day from orders
""")
def f04(t):
    return t.orders.select("o_orderkey", *[c.alias(n) for n, c in D.date_parts(F.col("o_orderdate")).items()])


@query("f05_clock_parts", """
select event_id, cast(hour(ts) as integer) as hour, cast(minute(ts) as integer) as minute, cast(second(ts) as integer) as second from events
""")
def f05(t):
    parts = D.clock_parts(F.date_format("ts", "hh:mm:ss a"))
    return t.events.select("event_id", *[c.alias(n) for n, c in parts.items()])


@query("f06_timestamp_from_parts", "select event_id, date_trunc('second', ts) as rebuilt from events")
def f06(t):
    ts = F.col("ts")
    rebuilt = D.timestamp_from_parts(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts), F.second(ts))
    return t.events.select("event_id", rebuilt.cast("timestamp_ntz").alias("rebuilt"))


CLOCK_SQL = "hour(ts) * 100 + minute(ts)"


def clock_number():
    return F.hour("ts") * 100 + F.minute("ts")


@query("f07_clock_label", """
select event_id, case when event_type = 'error' then '' else strftime(ts, '%H:%M') end as label from events
""")
def f07(t):
    number = F.when(F.col("event_type") == "error", F.lit("bad")).otherwise(clock_number().cast("string"))
    return t.events.select("event_id", D.clock_label(number).alias("label"))


@query("f08_clock_angle", """
select event_id, round(2 * pi() * (hour(ts) * 60 + minute(ts)) / 1440, 8) as clock,
  round(2 * pi() * (hour(ts) * 60 + 29.5) / 1440, 8) as slot from events
""")
def f08(t):
    hour = F.lpad(F.hour("ts").cast("string"), 2, "0")
    slot = F.concat(hour, F.lit("00-"), hour, F.lit("59"))
    return t.events.select("event_id", F.round(D.clock_angle(D.clock_label(clock_number())), 8).alias("clock"),
                           F.round(D.slot_angle(slot), 8).alias("slot"))


@query("f08_long_slot", """
select event_id, round(2 * pi() * case when hour(ts) < 6 then 180.0 else hour(ts) * 60 + 29.5 end / 1440, 8) as slot from events
""")
def f08_long(t):
    hour = F.lpad(F.hour("ts").cast("string"), 2, "0")
    slot = F.when(F.hour("ts") < 6, F.lit("0001-0559")).otherwise(F.concat(hour, F.lit("00-"), hour, F.lit("59")))
    return t.events.select("event_id", F.round(D.slot_angle(slot), 8).alias("slot"))


@query("f09_place_parts", """
select c_custkey, case when c_acctbal >= 0 then c_mktsegment end as city, case when c_acctbal >= 0 then concat('S', c_nationkey) end as state from customer
""")
def f09(t):
    whole = F.concat(F.col("c_mktsegment"), F.lit(" , S"), F.col("c_nationkey").cast("string"))
    place = F.when(F.col("c_acctbal") >= 0, whole).otherwise(F.col("c_mktsegment"))
    city, state = place_parts(place)
    return t.customer.select("c_custkey", city.alias("city"), state.alias("state"))


@query("f10_contains", """
select p_partkey, contains(p_name, 'red') as red, substr(p_name, 1, 5) as start from part
""")
def f10(t):
    return t.part.select("p_partkey", F.col("p_name").contains("red").alias("red"), F.substring("p_name", 1, 5).alias("start"))


@query("f11_trigonometry", """
select l_orderkey, l_partkey, round(sin(2 * pi() * (l_quantity % 7) / 7), 6) as s, round(cos(2 * pi() * (l_quantity % 7) / 7), 6) as c from lineitem
""")
def f11(t):
    angle = D.modulo_angle(F.col("l_quantity"), 7)
    return t.lineitem.select("l_orderkey", "l_partkey", F.round(F.sin(angle), 6).alias("s"), F.round(F.cos(angle), 6).alias("c"))


@query("f12_bool_to_number", "select o_orderkey, cast(o_orderstatus = 'F' as tinyint) as done from orders")
def f12(t):
    return encode_booleans(t.orders.select("o_orderkey", (F.col("o_orderstatus") == "F").alias("done")))


@query("f13_abs_sqrt", "select c_custkey, abs(c_acctbal) as a, round(sqrt(abs(c_acctbal)), 6) as r from customer")
def f13(t):
    return t.customer.select("c_custkey", F.abs("c_acctbal").alias("a"), F.round(F.sqrt(F.abs("c_acctbal")), 6).alias("r"))


@query("f14_clamp", "select event_id, least(greatest(value, 5.0::double), 80.0::double) as value from events")
def f14(t):
    from tabloom.operators.outliers import OutlierModel

    limits = {"value": {"bottom": 5.0, "top": 80.0, "median": 0.0}}
    return OutlierModel({"strategy": "truncate", "limits": limits}).transform(t.events).select("event_id", "value")


@query("f15_densities", """
select event_id, round(exp(-0.5 * ((value - 50) / 20) ** 2) / (20 * sqrt(2 * pi())), 8) as normal,
  round(case when value < 1 then 0 else exp(-(value - 1) / 40) / 40 end, 8) as exponential,
  round(exp(-0.5 * ((ln(value + 2) - ln(30)) / 0.9) ** 2) / ((value + 2) * 0.9 * sqrt(2 * pi())), 8) as lognormal from events
""")
def f15(t):
    x = F.col("value")
    return t.events.select(
        "event_id", F.round(normal_pdf(x, 50.0, 20.0), 8).alias("normal"), F.round(exponential_pdf(x, 1.0, 40.0), 8).alias("exponential"),
        F.round(lognormal_pdf(x, -2.0, 30.0, 0.9), 8).alias("lognormal"),
    )


@query("f16_category_codes", "select p_partkey, dense_rank() over (order by p_brand) - 1 as p_brand_code from part")
def f16(t):
    return category_codes(t.part, "p_brand").select("p_partkey", "p_brand_code")
