"""Projections, filters and recodes."""

from pyspark.sql import functions as F

from tabloom.catalog.base import query
from tabloom.functions.text import recode, shorten
from tabloom.operators import columns as C
from tabloom.operators.encoding import label_codes
from tabloom.operators.vartypes import variable_type_table, variable_types
from tabloom.plans.studies import assemble

GAPS_SQL = """(select * replace (nullif(l_quantity, 17) as l_quantity,
  case when l_linenumber <> 5 then l_discount end as l_discount) from lineitem)"""


def lineitem_gaps(t):
    return t.lineitem.withColumns({
        "l_quantity": F.nullif("l_quantity", F.lit(17.0)),
        "l_discount": F.when(F.col("l_linenumber") != 5, F.col("l_discount")),
    })


def orders_padded(t):
    """Orders with an all-null, a constant and a partly null column."""
    return t.orders.select(
        "o_orderkey", "o_orderstatus", "o_totalprice",
        F.lit(None).cast("string").alias("nothing"), F.lit(7).alias("seven"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
    )


PRIORITY = "nullif(o_orderpriority, '5-LOW') as o_orderpriority"


@query("p01_drop_columns", "select * exclude (o_custkey, o_orderdate) from orders")
def p01(t):
    return C.drop_columns(t.orders, ["o_custkey", "o_orderdate", "absent"])


@query("p02_drop_pattern", "select l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate, l_linenumber from lineitem")
def p02(t):
    return C.drop_matching(t.lineitem, ["KEY", "flag", "STATUS"])


@query("p03_drop_id_columns", "select event_type, value, ts as paid_at from events")
def p03(t):
    renamed = t.events.select(F.col("event_id").alias("EventID"), F.col("user_id").alias("ID_user"), "event_type", "value",
                              F.col("ts").alias("paid_at"))
    return C.drop_id_columns(renamed)


@query("p04_drop_null_columns", "select o_orderkey, o_orderstatus, o_totalprice, 7 as seven from orders")
def p04(t):
    return C.drop_columns_with_nulls(orders_padded(t))


@query("p05_drop_constant_columns", f"select o_orderkey, o_orderstatus, o_totalprice, {PRIORITY} from orders")
def p05(t):
    return C.drop_constant_columns(orders_padded(t))


@query("p05_constant_keep_empty", "select 'seven' as variable")
def p05_profile(t):
    names = C.constant_columns(orders_padded(t), include_empty=False)
    return t.spark.createDataFrame([(c,) for c in names], "variable string")


@query("p06_drop_empty_columns", f"select o_orderkey, o_orderstatus, o_totalprice, 7 as seven, {PRIORITY} from orders")
def p06(t):
    return C.drop_empty_columns(orders_padded(t))


@query("p07_drop_any_null_columns", "select * exclude (l_quantity, l_discount, l_shipdate) from lineitem")
def p07(t):
    return C.drop_columns_with_nulls(lineitem_gaps(t)).drop("l_shipdate")


@query("p08_drop_null_rows", f"select * exclude (l_shipdate) from {GAPS_SQL} where l_quantity is not null and l_discount is not null")
def p08(t):
    return C.drop_rows_with_nulls(lineitem_gaps(t)).drop("l_shipdate")


@query("p09_keep_numeric", "select o_orderkey, o_custkey, o_totalprice, o_orderstatus from orders")
def p09(t):
    return C.keep_types(t.orders, variable_types(t.orders), ["numeric"], also=["o_orderstatus"])


@query("p10_class_rows", "select doc_id, toxic from labels where quality = 0")
def p10(t):
    return t.labels.filter(F.col("quality") == 0).select("doc_id", "toxic")


@query("p11_range_predicate", f"""
select l_orderkey, l_partkey, l_quantity from {GAPS_SQL} where l_quantity is null or (l_quantity >= 5 and l_quantity <= 45)
""")
def p11(t):
    kept = C.keep_unless(lineitem_gaps(t), C.outside(F.col("l_quantity"), 5, 45))
    return kept.select("l_orderkey", "l_partkey", "l_quantity")


@query("p12_align_columns", "select o_totalprice, 0 as missing_feature, o_custkey from orders")
def p12(t):
    return C.align_columns(t.orders, ["o_totalprice", "missing_feature", "o_custkey"])


@query("p13_compatible_guard", """
select round(count(*) filter (all_zero) / 4.0, 4) as zero_share from (
  select max(l_tax) = 0 as all_zero from lineitem union all select max(l_discount) = 0 from lineitem union all
  select true union all select max(l_quantity) = 0 from lineitem)
""")
def p13(t):
    features = ["l_tax", "l_discount", "never_seen", "l_quantity"]
    aligned = C.guard_compatible(C.align_columns(t.lineitem, features), features)
    return t.spark.createDataFrame([(round(C.zero_share(aligned, features), 4),)], "zero_share double")


@query("p14_missing_category", "select o_orderkey, o_orderstatus, 'UNKNOWN' as weather from orders")
def p14(t):
    return C.default_missing_category(t.orders.select("o_orderkey", "o_orderstatus"), ["o_orderstatus", "weather"])


@query("p15_target_split_off", """
select l_orderkey, l_quantity + l_discount as feature_sum, case when l_returnflag = 'R' then 1.0 else 0.0 end as label from lineitem
""")
def p15(t):
    from pyspark.ml.functions import vector_to_array

    named = t.lineitem.withColumn("returned", (F.col("l_returnflag") == "R").cast("int"))
    out = assemble(named, ["l_quantity", "l_discount"], "returned", key="l_orderkey").withColumn("x", vector_to_array("features"))
    return out.select("l_orderkey", (F.col("x")[0] + F.col("x")[1]).alias("feature_sum"), "label")


PRIORITY_NAMES = {"1-URGENT": "urgent", "5-LOW": "low"}


@query("p16_recode", """
select o_orderkey, case o_orderpriority when '1-URGENT' then 'urgent' when '5-LOW' then 'low' else o_orderpriority end as o_orderpriority
from orders
""")
def p16(t):
    return t.orders.select("o_orderkey", recode(F.col("o_orderpriority"), PRIORITY_NAMES).alias("o_orderpriority"))


@query("p17_strict_map", """
select o_orderkey, case o_orderstatus when 'F' then 0.0::double when 'O' then 1.0::double end as status_code from orders
""")
def p17(t):
    return t.orders.select("o_orderkey", recode(F.col("o_orderstatus"), {"F": 0.0, "O": 1.0}, strict=True).alias("status_code"))


@query("p18_label_codes", """
with firsts as (select event_type, min(event_id) as f from events group by 1),
codes as (select event_type, row_number() over (order by f) - 1 as label from firsts)
select event_id, label from events join codes using (event_type)
""")
def p18(t):
    return label_codes(t.events, "event_type", ["event_id"]).select("event_id", "label")


@query("p19_force_symbolic", """
select * from (values ('l_linenumber', 'symbolic'), ('l_quantity', 'numeric'), ('l_tax', 'symbolic'), ('l_linestatus', 'binary'))
  as v(variable, var_type)
""")
def p19(t):
    slim = t.lineitem.select("l_linenumber", "l_quantity", "l_tax", "l_linestatus")
    return variable_type_table(slim, force_symbolic=["l_linenumber", "l_tax"])


@query("p20_shorten", """
select p_partkey, case when length(p_name) > 9 then concat(substr(p_name, 1, 6), '...') else p_name end as p_name,
  case when length(p_type) > 6 then concat(substr(p_type, 1, 3), '...') else p_type end as p_type from part
""")
def p20(t):
    return t.part.select("p_partkey", shorten(F.col("p_name"), 9).alias("p_name"), shorten(F.col("p_type"), 6).alias("p_type"))


@query("p21_fill_null", f"select l_orderkey, l_partkey, coalesce(l_quantity, 0) as l_quantity, coalesce(l_discount, 0) as l_discount from {GAPS_SQL}")
def p21(t):
    return C.fill_null(lineitem_gaps(t), {"l_quantity": 0.0, "l_discount": 0.0}).select("l_orderkey", "l_partkey", "l_quantity", "l_discount")


@query("p22_select_by_type", "select o_orderkey, o_custkey, o_totalprice from orders")
def p22(t):
    return C.select_by_type(t.orders, "number")


@query("p22_select_strings", "select o_orderstatus, o_orderpriority from orders")
def p22_strings(t):
    return C.select_by_type(t.orders, "string")


@query("x07_dropped_names", """
select 'o_custkey' as variable, count(o_custkey) as n from orders union all select 'o_orderdate', count(o_orderdate) from orders
""")
def x07(t):
    """The columns a step has dropped, with the values that went with them."""
    after = C.drop_columns(t.orders, ["o_custkey", "o_orderdate"])
    gone = C.dropped_names(t.orders.columns, after.columns)
    counted = t.orders.agg(*[F.count(c).alias(c) for c in gone])
    return counted.select(F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("n")) for c in gone])).alias("e")).select("e.*")
