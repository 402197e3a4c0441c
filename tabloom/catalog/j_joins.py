"""Lookups, membership and nearest-neighbour joins."""

from pyspark.sql import functions as F

from tabloom.catalog.base import digest_sql, query
from tabloom.operators.aggregates import relative_frequencies
from tabloom.operators.joins import coded_lookup, complement, lookup_join, members
from tabloom.operators.missing import impute_by_neighbors
from tabloom.operators.neighbors import knn_join, missing_value_donors
from tabloom.operators.sampling import split_train_test


@query("j01_lookup", """
select c_custkey, n_name, r_name from customer left join nation on c_nationkey = n_nationkey
left join region on n_regionkey = r_regionkey
""")
def j01(t):
    nation = t.nation.withColumnRenamed("n_nationkey", "c_nationkey")
    region = t.region.withColumnRenamed("r_regionkey", "n_regionkey")
    named = lookup_join(t.customer, nation, ["c_nationkey"])
    return lookup_join(named, region, ["n_regionkey"]).select("c_custkey", "n_name", "r_name")


@query("j01_lookup_salted", """
select l_returnflag, p_brand, count(*) as n from lineitem join part on l_partkey = p_partkey group by 1, 2
""")
def j01_salted(t):
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    joined = lookup_join(t.lineitem.select("l_orderkey", "l_partkey", "l_returnflag"), part, ["l_partkey"], how="inner", limit=10, salts=8)
    return joined.groupBy("l_returnflag", "p_brand").agg(F.count(F.lit(1)).alias("n"))


@query("j02_two_key_default", """
with dim as (select c_nationkey, c_mktsegment, count(*) as code from customer where c_acctbal > 5000 group by 1, 2)
select c_custkey, coalesce(code, 0) as code from customer left join dim using (c_nationkey, c_mktsegment)
""")
def j02(t):
    dim = t.customer.filter("c_acctbal > 5000").groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("code"))
    return coded_lookup(t.customer, dim, ["c_nationkey", "c_mktsegment"], "code", default=0).select("c_custkey", "code")


FREQUENT_SQL = """(select l_suppkey from lineitem group by 1
  having count(*) / (select count(*) from lineitem) >= 1.0 / (select count(distinct l_suppkey) from lineitem))"""


def frequent_suppliers(t):
    freq = relative_frequencies(t.lineitem, "l_suppkey")
    n = t.lineitem.select("l_suppkey").distinct().count()
    return freq.filter(F.col("freq") >= 1.0 / n)


@query("j03_members", f"select l_orderkey, l_suppkey, l_quantity from lineitem where l_suppkey in {FREQUENT_SQL}")
def j03(t):
    return members(t.lineitem, frequent_suppliers(t), ["l_suppkey"]).select("l_orderkey", "l_suppkey", "l_quantity")


@query("j04_complement", f"select l_orderkey, l_suppkey, l_quantity from lineitem where l_suppkey not in {FREQUENT_SQL}")
def j04(t):
    return complement(t.lineitem, frequent_suppliers(t), ["l_suppkey"], limit=10).select("l_orderkey", "l_suppkey", "l_quantity")


@query("j05_columns_side_by_side", """
select o_orderkey, o_orderstatus, case when o_orderstatus = 'F' then 1.0 else 0.0 end as status_f, o_totalprice / 1000 as price_k
from orders
""")
def j05(t):
    return t.orders.select("o_orderkey", "o_orderstatus", (F.col("o_orderstatus") == "F").cast("double").alias("status_f"),
                           (F.col("o_totalprice") / 1000).alias("price_k"))


SPLIT = f"substr({digest_sql('vec_id')}, 1, 8) < 'b3333333'"
DISTANCE_SQL = {
    "euclidean": "list_distance(a.e, b.e)",
    "manhattan": "list_sum(list_transform(range(1, len(a.e) + 1), lambda i: abs(a.e[i] - b.e[i])))",
    "chebyshev": "list_max(list_transform(range(1, len(a.e) + 1), lambda i: abs(a.e[i] - b.e[i])))",
}


def neighbor_sql(metric: str, k: int) -> str:
    return f"""
with v as (select vec_id, label, embedding::double[] as e, {SPLIT} as train from embeddings),
d as (select a.vec_id, b.vec_id as neighbor_vec_id, b.label, {DISTANCE_SQL[metric]} as distance
  from v a join v b on not a.train and b.train),
r as (select *, row_number() over (partition by vec_id order by distance, neighbor_vec_id) as rank from d)
select vec_id, neighbor_vec_id, cast(rank as integer) as rank, round(distance, 4) as distance, label from r where rank <= {k}
"""


def embedding_neighbors(t, metric: str, k: int):
    train, test = split_train_test(t.embeddings, "vec_id")
    near = knn_join(test, train, k, query_id="vec_id", candidate_id="vec_id", features="embedding", metric=metric, keep=["label"])
    return near.withColumn("distance", F.round("distance", 4))


@query("j06_nearest_neighbors", neighbor_sql("euclidean", 10))
def j06(t):
    return embedding_neighbors(t, "euclidean", 10)


@query("j06_nearest_manhattan", neighbor_sql("manhattan", 5))
def j06_manhattan(t):
    return embedding_neighbors(t, "manhattan", 5)


@query("j06_nearest_chebyshev", neighbor_sql("chebyshev", 5))
def j06_chebyshev(t):
    return embedding_neighbors(t, "chebyshev", 5)


DOCS_SQL = """(select d.doc_id, cast(n_chars as double) as n_chars, cast(len(string_split(text, ' ')) as double) as words,
  lang, source, quality, toxic from documents d join labels using (doc_id))"""


def labelled_documents(t):
    words = F.size(F.split("text", " ")).cast("double")
    docs = t.documents.select("doc_id", F.col("n_chars").cast("double").alias("n_chars"), words.alias("words"), "lang", "source")
    return docs.join(t.labels, "doc_id")


@query("j07_minority_neighbors", f"""
with rare as (select doc_id, n_chars, words from {DOCS_SQL} where quality = 0),
d as (select a.doc_id, b.doc_id as neighbor_doc_id, sqrt((a.n_chars - b.n_chars) ** 2 + (a.words - b.words) ** 2) as distance
  from rare a join rare b on a.doc_id <> b.doc_id),
r as (select *, row_number() over (partition by doc_id order by distance, neighbor_doc_id) as rank from d)
select doc_id, neighbor_doc_id, round(distance, 4) as distance, cast(rank as integer) as rank from r where rank <= 5
""")
def j07(t):
    rare = labelled_documents(t).filter("quality = 0")
    near = knn_join(rare, rare, 5, query_id="doc_id", candidate_id="doc_id", features=["n_chars", "words"], exclude_self=True)
    return near.withColumn("distance", F.round("distance", 4))


PART_GAPS_SQL = """(select p_partkey, case when p_brand <> 'Brand#1' then cast(p_size as double) end as p_size,
  case when p_type <> 'ECONOMY' or p_brand = 'Brand#1' then p_retailprice end as p_retailprice, cast(length(p_name) as double) as name_length
  from part)"""
GAP_COLUMNS = ["p_size", "p_retailprice", "name_length"]

DONORS_SQL = f"""
g as (select * from {PART_GAPS_SQL}),
need as (select *, 'p_size' as variable from g where p_size is null union all
  select *, 'p_retailprice' from g where p_retailprice is null),
pairs as (select n.p_partkey, n.variable, b.p_partkey as donor,
  coalesce((n.p_size - b.p_size) ** 2, 0) + coalesce((n.p_retailprice - b.p_retailprice) ** 2, 0) + (n.name_length - b.name_length) ** 2 as total,
  case when n.p_size is not null and b.p_size is not null then 1 else 0 end
  + case when n.p_retailprice is not null and b.p_retailprice is not null then 1 else 0 end + 1 as shared,
  case when n.variable = 'p_size' then b.p_size else b.p_retailprice end as value
  from need n join g b on case when n.variable = 'p_size' then b.p_size else b.p_retailprice end is not null),
ranked as (select *, sqrt(total * 3 / shared) as distance from pairs),
nearest as (select *, row_number() over (partition by p_partkey, variable order by distance, donor) as r from ranked)
"""


def part_gaps(t):
    special = F.col("p_brand") == "Brand#1"
    return t.part.select(
        "p_partkey", F.when(~special, F.col("p_size").cast("double")).alias("p_size"),
        F.when((F.col("p_type") != "ECONOMY") | special, F.col("p_retailprice")).alias("p_retailprice"),
        F.length("p_name").cast("double").alias("name_length"),
    )


@query("j08_missing_value_donors", f"""
with {DONORS_SQL} select p_partkey, variable, donor, round(distance, 4) as distance, value from nearest where r <= 5
""")
def j08(t):
    donors = missing_value_donors(part_gaps(t), "p_partkey", GAP_COLUMNS, 5)
    return donors.withColumn("distance", F.round("distance", 4))


@query("i04_impute_by_neighbors", f"""
with {DONORS_SQL}, fills as (
  select p_partkey, avg(value) filter (variable = 'p_size') as fs, avg(value) filter (variable = 'p_retailprice') as fp
  from nearest where r <= 5 group by 1)
select p_partkey, round(coalesce(p_size, fs), 4) as p_size, round(coalesce(p_retailprice, fp), 4) as p_retailprice, name_length
from g left join fills using (p_partkey)
""")
def i04(t):
    filled = impute_by_neighbors(part_gaps(t), "p_partkey", GAP_COLUMNS, 5)
    return filled.withColumns({c: F.round(c, 4) for c in ("p_size", "p_retailprice")})
