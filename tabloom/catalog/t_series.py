"""Time series and streams."""

from pyspark.sql import functions as F

from tabloom.catalog.a_aggregates import HOURLY_SQL, hourly, rounded
from tabloom.catalog.base import query
from tabloom.operators.order import assign_row_index, difference, head_share, rolling_mean
from tabloom.operators.scaling import Scaling
from tabloom.operators.series import (
    aggregate_by_period,
    autocorrelation,
    decompose,
    dickey_fuller,
    encode_traffic,
    lag_pairs,
    rebuild_timestamps,
    regular_grid,
    series_long,
    stationarity_line,
)
from tabloom.session import scratch_path
from tabloom.streaming.streams import read_stream, run_available, stream_by_period


@query("t01_rebuild_timestamps", """
with s as (select event_id, date_trunc('second', ts + interval 20 day) as x from events)
select event_id, make_timestamp(2025, 6 + month(x), day(x), hour(x), minute(x), second(x)::double) as datetime from s
""")
def t01(t):
    shifted = t.events.withColumn("x", F.col("ts") + F.expr("INTERVAL 20 DAYS"))
    partial = shifted.select("event_id", "ts", F.dayofmonth("x").alias("Date"), F.date_format("x", "h:mm:ss a").alias("Time"))
    out = rebuild_timestamps(partial, ["ts", "event_id"], block_rows=4096)
    return out.select("event_id", F.col("datetime").cast("timestamp_ntz").alias("datetime"))


@query("t02_encode_traffic", """
select event_id, cast(isodow(ts) as integer) as "Day of the week",
  cast(case event_type when 'error' then 1 when 'purchase' then 2 when 'click' then 3 else 4 end as integer) as "Traffic Situation" from events
""")
def t02(t):
    names = F.when(F.col("event_type") == "error", "heavy").when(F.col("event_type") == "purchase", "high").when(F.col("event_type") == "click", "normal").otherwise("low")
    df = t.events.select("event_id", F.date_format("ts", "EEEE").alias("Day of the week"), names.alias("Traffic Situation"))
    return encode_traffic(df)


def hourly_two(t):
    counted = t.events.withColumn("n", F.lit(1.0))
    return aggregate_by_period(counted, "ts", ["value", "n"], "H", "sum")


TWO_SQL = "(select date_trunc('hour', ts) as ts, sum(value) as value, count(*)::double as n from events group by 1)"


@query("t03_scale_series", f"""
with f as (select avg(value) as a, stddev_pop(value) as b, avg(n) as c, stddev_pop(n) as d from {TWO_SQL})
select ts, round((value - a) / b, 5) as value, round((n - c) / d, 5) as n from {TWO_SQL}, f
""")
def t03(t):
    df = hourly_two(t)
    return rounded(Scaling("zscore", ["value", "n"]).fit(df).transform(df), ["value", "n"], 5)


SIZES = (10, 25, 50, 75, 100, 250)


@query("t04_smoothing_study", "select ts, " + ", ".join(
    f"case when i >= {n - 1} then round(avg(value) over (order by i rows between {n - 1} preceding and current row), 4) end as mean_{n}" for n in SIZES) + f" from {HOURLY_SQL}")
def t04(t):
    out = rolling_mean(hourly(t), "value", SIZES)
    return rounded(out.select("ts", *[f"mean_{n}" for n in SIZES]), [f"mean_{n}" for n in SIZES])


LEVEL_SQL = "select '{n}' as level, date_trunc('{l}', ts) as ts, round({f}(value), 4) as value from events group by 2"


@query("t05_aggregate_by_period", " union all ".join(
    LEVEL_SQL.format(n=n, l=l, f=f) for n, l, f in (("H", "hour", "sum"), ("D", "day", "avg"), ("W", "week", "max"), ("M", "month", "stddev_samp"))))
def t05(t):
    parts = [aggregate_by_period(t.events, "ts", ["value"], level, agg).select(F.lit(level).alias("level"), "ts", F.round("value", 4).alias("value"))
             for level, agg in (("H", "sum"), ("D", "mean"), ("W", "max"), ("M", "std"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("t05_aggregate_callable", "select date_trunc('day', ts) as ts, max(value) - min(value) as value from events group by 1")
def t05_callable(t):
    return aggregate_by_period(t.events, "ts", ["value"], "D", lambda c: F.max(c) - F.min(c))


@query("t06_difference", f"""
select ts, round(value - lag(value) over (order by ts), 4) as value_diff, n - lag(n) over (order by ts) as n_diff from {TWO_SQL}
""")
def t06(t):
    out = difference(assign_row_index(hourly_two(t), ["ts"]), ["value", "n"])
    return out.select("ts", F.round("value_diff", 4).alias("value_diff"), "n_diff")


@query("t07_autocorrelation", f"""
with h as {HOURLY_SQL}, k as (select unnest(generate_series(-10, 10)) as lag)
select cast(lag as integer) as lag, round(sum(a.value * b.value) / (select sum(value * value) from h), 6) as acorr
from k join h a on true join h b on b.i = a.i + abs(lag) group by 1
""")
def t07(t):
    return rounded(autocorrelation(hourly(t), "value", 10), ["acorr"], 6)


@query("t07_lag_pairs", f"""
with h as {HOURLY_SQL} select cast(lag as integer) as lag, round(b.value, 4) as lagged, round(a.value, 4) as value
from (select unnest([1, 2, 5]) as lag) join h a on true join h b on b.i = a.i - lag
""")
def t07_pairs(t):
    return rounded(lag_pairs(hourly(t), "value", [1, 2, 5]), ["lagged", "value"])


@query("t08_regular_grid", f"""
with h as {HOURLY_SQL} select g.ts, round(h.value, 4) as value from
(select unnest(generate_series((select min(ts) from h), (select max(ts) from h), interval 15 minute)) as ts) g left join h using (ts)
""")
def t08(t):
    grid = regular_grid(aggregate_by_period(t.events, "ts", ["value"], "H", "sum"), "ts", "15 minutes")
    return grid.select("ts", F.round("value", 4).alias("value"))


def decompose_sql(period: int) -> str:
    half = period // 2
    frame = f"over (order by i rows between {half} preceding and {half} following)"
    trim = f"- (lag(value, {half}) over (order by i) + lead(value, {half}) over (order by i)) / 2" if period % 2 == 0 else ""
    return f"""
with h as {HOURLY_SQL}, t as (select *, case when count(value) {frame} = {2 * half + 1} then (sum(value) {frame} {trim}) / {period} end as trend from h),
m as (select i % {period} as phase, avg(value - trend) as s from t group by 1), c as (select phase, s - (select avg(s) from m) as seasonal from m)
select ts, round(trend, 6) as trend, round(seasonal, 6) as seasonal, round(value - trend - seasonal, 6) as residual from t join c on phase = i % {period}
"""


for name, period in (("t09_decompose_even", 24), ("t09_decompose_odd", 7)):
    @query(name, decompose_sql(period))
    def t09(t, period=period):
        return rounded(decompose(hourly(t), "value", period).select("ts", "trend", "seasonal", "residual"), ["trend", "seasonal", "residual"], 6)


@query("t10_stationarity_line", f"""
with h as (select *, count(*) over () as n, round(stddev_pop(value) over (), 3) as band from {HOURLY_SQL}),
g as (select *, (select count(*) from range(1, 10) r where i >= r.range * n // 10) as seg, least(i // (n // 10), 9) as line from h),
m as (select seg, avg(value) as segment_mean from g group by 1)
select ts, cast(line as integer) as segment, round(segment_mean, 4) as segment_mean, round(value - band, 3) as band_low, round(value + band, 3) as band_high
from g join m on m.seg = line
""")
def t10(t):
    out = stationarity_line(hourly(t), "value").select("ts", "segment", "segment_mean", "band_low", "band_high")
    return rounded(rounded(out, ["segment_mean"]), ["band_low", "band_high"], 3)


@query("t11_dickey_fuller")
def t11(t):
    found = dickey_fuller(hourly(t), "value")
    rows = [("statistic", found["statistic"]), ("p_value", found["p_value"]), ("used_lag", float(found["used_lag"])), ("nobs", float(found["nobs"])),
            *[(f"critical {k}", v) for k, v in found["critical"].items()]]
    return t.spark.createDataFrame(rows, "item string, value double")


@query("t12_series_long", f"""
select ts, 'value' as variable, round(value, 4) as value from {TWO_SQL} union all select ts, 'n', n from {TWO_SQL}
""")
def t12(t):
    return rounded(series_long(hourly_two(t), "ts", ["value", "n"]), ["value"])


@query("t13_temporal_split", f"select ts, case when i < floor((select count(*) from {HOURLY_SQL}) * 0.9::double) then 'train' else 'test' end as split from {HOURLY_SQL}")
def t13(t):
    train, test = head_share(hourly(t), 0.9)
    return train.select("ts", F.lit("train").alias("split")).unionByName(test.select("ts", F.lit("test").alias("split")))


def event_stream(t):
    return read_stream(t.spark, t.folder, t.events.schema, pathGlobFilter="events.parquet")


for name, level, unit in (("st3_stream_by_hour", "H", "hour"), ("st3_stream_by_day", "D", "day")):
    @query(name, f"""
select date_trunc('{unit}', ts) as ts, round(sum(value), 4) as value from events group by 1
having date_trunc('{unit}', any_value(ts)) + interval 1 {unit} <= (select max(ts) - interval 1 hour from events)
""")
    def st3(t, level=level):
        """Periods that have closed: their end lies before the last time minus the allowed lateness."""
        out = run_available(stream_by_period(event_stream(t), "ts", ["value"], level, "sum"), scratch_path(t.spark, "stream-out"))
        return out.select(F.col("ts").cast("timestamp_ntz").alias("ts"), F.round("value", 4).alias("value"))



