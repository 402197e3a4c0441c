"""Variable types, dimensionality, sparsity and scatter data."""

from pyspark.sql import functions as F

from tabloom.catalog.a_aggregates import NUMERIC, rounded
from tabloom.catalog.base import digest_sql, query, uniform_sql
from tabloom.catalog.p_projections import GAPS_SQL, lineitem_gaps
from tabloom.operators.columns import drop_constant_columns, drop_id_columns
from tabloom.operators.correlation import correlation_table
from tabloom.operators.sparsity import category_points, pair_density, sparsity_pairs
from tabloom.operators.vartypes import dimensionality_report, type_counts, variable_type_table


def text_orders(t):
    """Orders as text, as a CSV scan without types would give them."""
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderstatus", F.col("o_totalprice").cast("string").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority",
        F.when(F.col("o_totalprice") > 200000, "yes").otherwise("no").alias("large"), F.lit(None).cast("string").alias("nothing"),
    )


TEXT_SQL = """(select cast(o_orderkey as varchar) as o_orderkey, o_orderstatus, cast(o_totalprice as varchar) as o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d') as o_orderdate, o_orderpriority, case when o_totalprice > 200000 then 'yes' else 'no' end as large,
  cast(null as varchar) as nothing from orders)"""
TEXT_COLUMNS = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "large", "nothing"]


def type_sql(table: str, columns, numeric_as: dict | None = None) -> str:
    numeric_as = numeric_as or {}
    return " union all ".join(
        f"""select '{c}' as variable, case when count(distinct {c}) = 2 then 'binary'
  when count(*) filter ({c} is not null and try_cast({c} as double) is null) = 0 then '{numeric_as.get(c, 'numeric')}'
  when count(*) filter ({c} is not null and try_cast({c} as timestamp) is null) = 0 then 'date' else 'symbolic' end as var_type from {table}"""
        for c in columns
    )


@query("g01_variable_types", type_sql(TEXT_SQL, TEXT_COLUMNS))
def g01(t):
    return variable_type_table(text_orders(t))


@query("g02_types_with_pattern", type_sql(TEXT_SQL, TEXT_COLUMNS, {"o_totalprice": "symbolic", "o_orderkey": "numeric"}))
def g02(t):
    return variable_type_table(text_orders(t), symbolic_patterns=["price"])


@query("g03_type_counts", f"""
with v as ({type_sql(TEXT_SQL, TEXT_COLUMNS)})
select k.var_type, count(v.var_type) as nr_variables from (values ('numeric'), ('binary'), ('date'), ('symbolic')) as k(var_type)
left join v on v.var_type = k.var_type group by 1
""")
def g03(t):
    return type_counts(text_orders(t))


LABEL_TYPES = type_sql("(select cast(doc_id as varchar) as doc_id, cast(quality as varchar) as quality, cast(toxic as varchar) as toxic from labels)",
                       ["doc_id", "quality", "toxic"])
KINDS_SQL = "(values ('numeric'), ('binary'), ('date'), ('symbolic')) as k(item)"


@query("g04_dimensionality_report", f"""
with a as ({type_sql(TEXT_SQL, TEXT_COLUMNS)}), b as ({LABEL_TYPES})
select 'orders' as dataset, 'size' as section, 'records' as item, count(*) as value from orders union all select 'orders', 'size', 'variables', 7 union all
select 'labels', 'size', 'records', count(*) from labels union all select 'labels', 'size', 'variables', 3 union all
select 'orders', 'type', k.item, count(var_type) from {KINDS_SQL} left join a on var_type = k.item group by 3 union all
select 'labels', 'type', k.item, count(var_type) from {KINDS_SQL} left join b on var_type = k.item group by 3 union all
select 'orders', 'missing', 'nothing', count(*) from orders
""")
def g04(t):
    return dimensionality_report({"orders": text_orders(t), "labels": t.labels})


@query("g05_correlation_report", " union all ".join(
    f"select '{a}' as var1, '{b}' as var2, round(abs(corr({a}, {b})), 4) as abs_corr from {GAPS_SQL}"
    for i, a in enumerate(NUMERIC) for b in NUMERIC[i + 1:]))
def g05(t):
    df = lineitem_gaps(t).withColumns({"OrderID": F.col("l_orderkey"), "seven": F.lit(7)})
    df = drop_constant_columns(drop_id_columns(df.select("OrderID", "seven", *NUMERIC)))
    return rounded(correlation_table(df, df.columns), ["abs_corr"])


PAIR_COLUMNS = {"l_quantity": "numeric", "l_tax": "numeric", "l_returnflag": "symbolic", "l_linestatus": "binary", "one": "numeric", "wide": "symbolic"}
PAIR_COUNTS = " union all ".join(
    f"select {i} as pos, '{c}' as v, '{k}' as kind, count(distinct {c}) as d from (select *, 1 as one, concat('s', l_suppkey) as wide from lineitem)"
    for i, (c, k) in enumerate(PAIR_COLUMNS.items()))


@query("g06_sparsity_pairs", f"""
with c as ({PAIR_COUNTS}), p as (select a.v as var1, b.v as var2, a.kind as k1, b.kind as k2, a.d as d1, b.d as d2
  from c a join c b on a.pos < b.pos where a.d > 1 and b.d > 1)
select var1, var2, case when k1 = 'numeric' and k2 = 'numeric' then 'numeric' else 'category' end as kind from p
where (k1 = 'numeric' and (k2 = 'numeric' or d2 <= 50)) or (k2 = 'numeric' and d1 <= 50)
""")
def g06(t):
    df = t.lineitem.withColumn("one", F.lit(1)).withColumn("wide", F.concat(F.lit("s"), F.col("l_suppkey").cast("string")))
    return sparsity_pairs(df, ["l_quantity", "l_tax", "l_returnflag", "l_linestatus", "one", "wide"])


GRID_SQL = """
with f as (select min(l_quantity) as xl, max(l_quantity) as xh, min(l_extendedprice) as yl, max(l_extendedprice) as yh from lineitem)
select {by} least(cast(floor((l_quantity - xl) * 20.0::double / (xh - xl)) as integer), 19) as xbin,
  least(cast(floor((l_extendedprice - yl) * 20.0::double / (yh - yl)) as integer), 19) as ybin, count(*) as n from lineitem, f group by all
"""


@query("g07_pair_density", GRID_SQL.format(by=""))
def g07(t):
    return pair_density(t.lineitem, "l_quantity", "l_extendedprice")


@query("g07_category_points", f"""
select event_id, dense_rank() over (order by event_type) - 1 as code, value,
  round(dense_rank() over (order by event_type) - 1 + ({uniform_sql(digest_sql('event_id'))} * 2 - 1) * 0.05, 6) as position from events
""")
def g07_points(t):
    return rounded(category_points(t.events, "event_type", "value", "event_id"), ["position"], 6)


@query("g08_pair_density_by_group", GRID_SQL.format(by="l_returnflag,"))
def g08(t):
    return pair_density(t.lineitem, "l_quantity", "l_extendedprice", by=["l_returnflag"])
