"""Counts, summaries, frequencies, correlation, outliers and histograms."""

from pyspark.sql import functions as F

from tabloom.catalog.base import query
from tabloom.catalog.p_projections import GAPS_SQL, lineitem_gaps
from tabloom.operators import aggregates as A
from tabloom.operators.correlation import correlation_table, correlations, redundant_variables
from tabloom.operators.distributions import density_at_values, fit_table, histogram_with_fits
from tabloom.operators.joins import lookup_join
from tabloom.operators.order import assign_row_index
from tabloom.operators.series import aggregate_by_period, segment_means, summary_by_granularity

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def rounded(df, columns, digits=4):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def each(template: str, columns, joiner=" union all ") -> str:
    return joiner.join(template.format(c=c) for c in columns)


@query("a01_dimensions", "select count(*) as nr_records, 11 as nr_variables from lineitem")
def a01(t):
    return A.dimensions(t.lineitem)


@query("a02_missing_values", f"""
select 'l_quantity' as variable, count(*) - count(l_quantity) as nr_missing from {GAPS_SQL} union all
select 'l_discount', count(*) - count(l_discount) from {GAPS_SQL}
""")
def a02(t):
    return A.missing_values(lineitem_gaps(t))


DISTINCT_COLUMNS = ["l_quantity", "l_discount", "l_returnflag", "l_suppkey", "l_orderkey"]


@query("a03_distinct_counts", each("select '{c}' as variable, count(distinct {c}) as nr_distinct from " + GAPS_SQL, DISTINCT_COLUMNS))
def a03(t):
    return A.distinct_counts(lineitem_gaps(t), DISTINCT_COLUMNS)


SUMMARY_SQL = (
    "count({c}) as count, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std, min({c})::double as min, "
    "round(quantile_cont({c}, 0.25), 4) as q25, round(quantile_cont({c}, 0.5), 4) as q50, round(quantile_cont({c}, 0.75), 4) as q75, "
    "max({c})::double as max"
)
SUMMARY_ROUNDED = ["mean", "std", "q25", "q50", "q75"]


@query("a04_describe", each("select '{c}' as variable, " + SUMMARY_SQL + " from " + GAPS_SQL, NUMERIC))
def a04(t):
    return rounded(A.describe_table(lineitem_gaps(t), NUMERIC), SUMMARY_ROUNDED)


@query("a04_describe_bracketed", each("select '{c}' as variable, " + SUMMARY_SQL + " from " + GAPS_SQL, NUMERIC))
def a04_bracketed(t):
    return rounded(A.describe_table(lineitem_gaps(t), NUMERIC, small_cells=0, accuracy=200), SUMMARY_ROUNDED)


@query("a05_value_counts", "select o_orderpriority, count(*) as n from orders group by 1")
def a05(t):
    return A.value_counts(t.orders, "o_orderpriority")


@query("a06_relative_frequencies", f"""
select l_quantity, round(count(*) / (select count(l_quantity)::double from {GAPS_SQL}), 6) as freq from {GAPS_SQL}
where l_quantity is not null group by 1
""")
def a06(t):
    return rounded(A.relative_frequencies(lineitem_gaps(t), "l_quantity"), ["freq"], 6)


@query("a07_class_balance", """
with c as (select quality, count(*) as n from labels group by 1)
select (select quality from c order by n, quality limit 1) as minority, (select quality from c order by n desc, quality limit 1) as majority,
  round((select min(n) from c)::double / (select max(n) from c), 2) as proportion
""")
def a07(t):
    b = A.class_balance(t.labels, "quality")
    return t.spark.createDataFrame([(b.minority, b.majority, b.proportion)], "minority int, majority int, proportion double")


PAIRS = [(a, b) for i, a in enumerate(NUMERIC) for b in NUMERIC[i + 1:]]
CORRELATION_SQL = " union all ".join(
    f"select '{a}' as var1, '{b}' as var2, round(abs(corr({a}, {b})), 4) as abs_corr from {GAPS_SQL}" for a, b in PAIRS
)


@query("a08_correlation", CORRELATION_SQL)
def a08(t):
    return rounded(correlation_table(lineitem_gaps(t), NUMERIC), ["abs_corr"])


@query("a08_correlation_wide", CORRELATION_SQL)
def a08_wide(t):
    return rounded(correlation_table(lineitem_gaps(t), NUMERIC, wide=True), ["abs_corr"])


@query("a09_outlier_limits", """
with q as (select avg(value) as m, stddev_samp(value) as s, quantile_cont(value, 0.25) as a, quantile_cont(value, 0.75) as b from events)
select 'stdev' as rule, round(m - 2 * s, 4) as bottom, round(m + 2 * s, 4) as top from q union all
select 'iqr', round(a - 1.5 * (b - a), 4), round(b + 1.5 * (b - a), 4) from q
""")
def a09(t):
    s = A.describe(t.events, ["value"])["value"]
    rows = [("stdev", *A.outlier_limits(s, std_based=True, threshold=2.0)), ("iqr", *A.outlier_limits(s, std_based=False, threshold=1.5))]
    return rounded(t.spark.createDataFrame(rows, "rule string, bottom double, top double"), ["bottom", "top"])


@query("a10_count_outliers", """
with e as (select avg(value) as m, stddev_samp(value) as s, quantile_cont(value, 0.25) as a, quantile_cont(value, 0.75) as b from events),
o as (select avg(user_id) as m, stddev_samp(user_id) as s, quantile_cont(user_id, 0.25) as a, quantile_cont(user_id, 0.75) as b from events)
select 'value' as variable, count(*) filter (value > b + 1.5 * (b - a) or value < a - 1.5 * (b - a)) as iqr,
  count(*) filter (value > m + 2 * s or value < m - 2 * s) as stdev from events, e union all
select 'user_id', count(*) filter (user_id > b + 1.5 * (b - a) or user_id < a - 1.5 * (b - a)),
  count(*) filter (user_id > m + 2 * s or user_id < m - 2 * s) from events, o
""")
def a10(t):
    return A.count_outliers(t.events, ["value", "user_id"])


HISTOGRAM_SQL = """
with f as (select min({c}) as lo, max({c}) as hi, count({c}) as n from {t}),
h as (select least(cast(floor(({c} - lo) * {b}.0::double / (hi - lo)) as integer), {b} - 1) as bin, count(*) as n from {t}, f where {c} is not null group by 1)
select cast(range as integer) as bin, round(lo + range * (hi - lo) / {b}, 4) as low, round(lo + (range + 1) * (hi - lo) / {b}, 4) as high,
  coalesce(h.n, 0) as n from range({b}) cross join f left join h on h.bin = range
"""


@query("a11_histogram", HISTOGRAM_SQL.format(c="value", t="events", b=20))
def a11(t):
    return rounded(A.histogram(t.events, "value", 20), ["low", "high"])


@query("a11_histogram_auto", """
with f as (select min(value) as lo, max(value) as hi, count(value) as n, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) as iqr from events),
g as (select *, cast(ceil((hi - lo) / least((hi - lo) / (log2(n) + 1), 2 * iqr / n ** (1.0::double / 3))) as integer) as b from f)
select least(cast(floor((value - lo) * b::double / (hi - lo)) as integer), b - 1) as bin, count(*) as n from events, g group by 1
""")
def a11_auto(t):
    return A.histogram(t.events, "value", "auto").filter("n > 0").select("bin", "n")


@query("a11_histogram_density", """
with f as (select min(value) as lo, max(value) as hi, count(value) as n from events)
select least(cast(floor((value - lo) * 10.0::double / (hi - lo)) as integer), 9) as bin, round(count(*) / (any_value(n) * any_value(hi - lo) / 10), 6) as density
from events, f group by 1
""")
def a11_density(t):
    return rounded(A.histogram(t.events, "value", density=True).filter("n > 0").select("bin", "density"), ["density"], 6)


BOX_SQL = """
with q as (select quantile_cont({c}, 0.25) as a, quantile_cont({c}, 0.5) as m, quantile_cont({c}, 0.75) as b from {t})
select '{c}' as variable, round(any_value(a), 4) as q25, round(any_value(m), 4) as q50, round(any_value(b), 4) as q75,
  min({c}) filter ({c} >= a - {k} * (b - a))::double as whisker_low, max({c}) filter ({c} <= b + {k} * (b - a))::double as whisker_high,
  count(*) filter ({c} < a - {k} * (b - a) or {c} > b + {k} * (b - a)) as nr_fliers from {t}, q
"""
for name, factor in (("a12_box_statistics", 1.5), ("a12_box_statistics_wide", 3.2), ("a12_box_statistics_extreme", 19)):
    @query(name, BOX_SQL.format(c="value", t="events", k=factor))
    def a12(t, factor=factor):
        return rounded(A.box_statistics(t.events, ["value"], factor), ["q25", "q50", "q75"])


LEVELS = ["year", "quarter", "month", "day"]


@query("a13_date_granularity", each(
    "select 'o_orderdate_{c}' as variable, cast(extract({c} from o_orderdate) as varchar) as value, count(*) as n from orders group by 2", LEVELS))
def a13(t):
    return A.date_granularity(t.orders, "o_orderdate", LEVELS)


@query("a14_property_granularity", """
with h as (select r_name, n_name, c_mktsegment from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)
select 'r_name' as variable, r_name as value, count(*) as n from h group by 2 union all
select 'n_name', n_name, count(*) from h group by 2 union all select 'c_mktsegment', c_mktsegment, count(*) from h group by 2
""")
def a14(t):
    places = t.nation.join(t.region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey")
    joined = lookup_join(t.customer, places.withColumnRenamed("n_nationkey", "c_nationkey"), ["c_nationkey"])
    return A.granularity(joined, ["r_name", "n_name", "c_mktsegment"])


@query("a15_symbolic_histograms", each(
    "select '{c}' as variable, {c} as value, count(*) as n from lineitem group by 2", ["l_returnflag", "l_linestatus"]))
def a15(t):
    return A.value_frequencies(t.lineitem, ["l_returnflag", "l_linestatus"])


@query("a16_low_variance", " union all ".join(f"select '{c}' as variable from lineitem having var_samp({c}) < 1" for c in NUMERIC))
def a16(t):
    return t.spark.createDataFrame([(c,) for c in A.low_variance(t.lineitem, 1.0, columns=NUMERIC)], "variable string")


# Columns with known relations: price_net follows the price, quantity_2 the quantity.
RELATED_SQL = """(select l_quantity, l_extendedprice, l_extendedprice * (1 - l_discount) as price_net, l_quantity * 2 + l_tax as quantity_2,
  l_quantity + l_discount as quantity_3, l_discount from lineitem)"""
RELATED = ["l_quantity", "l_extendedprice", "price_net", "quantity_2", "quantity_3", "l_discount"]


def related(t):
    return t.lineitem.select(
        "l_quantity", "l_extendedprice", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("price_net"),
        (F.col("l_quantity") * 2 + F.col("l_tax")).alias("quantity_2"), (F.col("l_quantity") + F.col("l_discount")).alias("quantity_3"), "l_discount",
    )


STRONG_SQL = " union all ".join(
    f"select {i} as pos1, {j} as pos2, '{a}' as var1, '{b}' as var2, abs(corr({a}, {b})) as r from {RELATED_SQL}"
    for i, a in enumerate(RELATED) for j, b in enumerate(RELATED) if i < j
)


@query("a17_redundant_earlier", f"select distinct var2 as variable from ({STRONG_SQL}) where r >= 0.9")
def a17(t):
    df = related(t)
    return t.spark.createDataFrame([(c,) for c in redundant_variables(correlations(df, RELATED), RELATED, 0.9, "earlier")], "variable string")


@query("a18_redundant_mutual", f"""
with s as (select var1 as a, var2 as b from ({STRONG_SQL}) where r >= 0.9),
both_ways as (select a, b from s union all select b, a from s),
many as (select a from both_ways group by 1 having count(*) >= 2)
select distinct b as variable from both_ways where a in (select a from many)
""")
def a18(t):
    df = related(t)
    return t.spark.createDataFrame([(c,) for c in redundant_variables(correlations(df, RELATED), RELATED, 0.9, "mutual")], "variable string")


@query("a19_distribution_fits", """
with f as (select avg(value) as m, stddev_pop(value) as s, min(value) as lo from events)
select 'normal' as distribution, 'mean' as parameter, round(m, 4) as value from f union all select 'normal', 'sigma', round(s, 4) from f union all
select 'exponential', 'loc', round(lo, 4) from f union all select 'exponential', 'scale', round(m - lo, 4) from f
""")
def a19(t):
    return rounded(fit_table(t.events, "value", lognormal=False), ["value"])


@query("a19_densities", """
with f as (select avg(value) as m, stddev_pop(value) as s, min(value) as lo from events)
select event_id, round(exp(-0.5 * ((value - m) / s) ** 2) / (s * sqrt(2 * pi())), 8) as pdf_normal,
  round(exp(-(value - lo) / (m - lo)) / (m - lo), 8) as pdf_exponential from events, f
""")
def a19_densities(t):
    df = density_at_values(t.events.select("event_id", "value"), "value", lognormal=False).drop("value")
    return rounded(df, ["pdf_normal", "pdf_exponential"], 8)


@query("a19_lognormal_fit")
def a19_lognormal(t):
    return fit_table(t.events, "value")


@query("a20_histogram_fits", """
with f as (select min(value) as lo, max(value) as hi, count(value) as n, avg(value) as m, stddev_pop(value) as s from events),
h as (select least(cast(floor((value - lo) * 20.0::double / (hi - lo)) as integer), 19) as bin, count(*) as c from events, f group by 1),
g as (select cast(range as integer) as bin, lo + (range + 0.5) * (hi - lo) / 20 as x, coalesce(c, 0) / (n * (hi - lo) / 20) as d, f.*
  from range(20) cross join f left join h on h.bin = range)
select bin, round(x, 6) as centre, round(d, 6) as density, round(exp(-0.5 * ((x - m) / s) ** 2) / (s * sqrt(2 * pi())), 6) as pdf_normal,
  round(exp(-(x - lo) / (m - lo)) / (m - lo), 6) as pdf_exponential from g
""")
def a20(t):
    df = histogram_with_fits(t.events, "value", lognormal=False).select("bin", "centre", "density", "pdf_normal", "pdf_exponential")
    return rounded(df, ["centre", "density", "pdf_normal", "pdf_exponential"], 6)


def level_sql(level: str, name: str) -> str:
    return f"select '{name}' as level, sum(value) as value from events group by date_trunc('{level}', ts)"


@query("a21_summary_by_granularity", f"""
with v as (select 'raw' as level, value from events union all {level_sql('hour', 'H')} union all {level_sql('day', 'D')} union all {level_sql('week', 'W')})
select level, count(value) as count, round(avg(value), 3) as mean, round(stddev_samp(value), 3) as std, round(min(value), 3) as min,
  round(quantile_cont(value, 0.25), 3) as q25, round(quantile_cont(value, 0.5), 3) as q50, round(quantile_cont(value, 0.75), 3) as q75,
  round(max(value), 3) as max from v group by 1
""")
def a21(t):
    return rounded(summary_by_granularity(t.events, "ts", "value"), [*SUMMARY_ROUNDED, "min", "max"], 3)


@query("a21_summary_of_many_groups", """
select l_partkey, count(*) as count, round(avg(l_extendedprice), 8) as mean, round(stddev_samp(l_extendedprice), 3) as std, min(l_extendedprice) as min,
  round(quantile_cont(l_extendedprice, 0.25), 6) as q25, round(quantile_cont(l_extendedprice, 0.5), 6) as q50, round(quantile_cont(l_extendedprice, 0.75), 6) as q75,
  max(l_extendedprice) as max from lineitem group by 1
""")
def a21_many(t):
    summary = rounded(A.describe_groups(t.lineitem, "l_partkey", "l_extendedprice"), ["std"], 3)
    return rounded(rounded(summary, ["mean"], 8), ["q25", "q50", "q75"], 6)


HOURLY_SQL = "(select date_trunc('hour', ts) as ts, sum(value) as value, row_number() over (order by date_trunc('hour', ts)) - 1 as i from events group by 1)"


def hourly(t):
    return assign_row_index(aggregate_by_period(t.events, "ts", ["value"], "H", "sum"), ["ts"])


@query("a22_segment_means", f"""
with h as (select *, count(*) over () as n from {HOURLY_SQL}),
s as (select value, (select count(*) from range(1, 10) r where i >= r.range * n // 10) as segment from h)
select cast(segment as integer) as segment, round(avg(value), 4) as segment_mean from s group by 1
""")
def a22(t):
    return rounded(segment_means(hourly(t), "value"), ["segment_mean"])


@query("a23_distinct_listing", """
with v as (select distinct 'o_orderstatus' as variable, o_orderstatus as value from orders union all
  select distinct 'o_orderpriority', nullif(o_orderpriority, '5-LOW') from orders)
select variable, value, count(*) over (partition by variable) as nr_distinct from v
""")
def a23(t):
    df = t.orders.withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    return A.distinct_listing(df, ["o_orderstatus", "o_orderpriority"])
