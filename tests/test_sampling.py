import pytest
from conftest import plan_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabloom.functions.hashing import key_digest
from tabloom.operators.balancing import over_balance, under_balance
from tabloom.operators.joins import complement, lookup_join, members
from tabloom.operators.sampling import (
    digest_cutoff, sample_exact, sample_fraction, sample_with_replacement, split_train_test, stratified_split,
)


@pytest.mark.parametrize("n", [0, 1, 250, 999, 1000, 5000])
@pytest.mark.parametrize("boundary_rows", [1, 100_000])
def test_exact_sample_size(spark, n, boundary_rows):
    df = spark.range(1000)
    got = sample_exact(df, n, "id", boundary_rows=boundary_rows)
    assert got.count() == min(n, 1000)
    best = {r["id"] for r in df.orderBy(key_digest("id", 42)).limit(n).collect()}
    assert {r["id"] for r in got.collect()} == best


def test_cutoff_is_a_filter(spark):
    assert "TakeOrdered" not in plan_of(sample_exact(spark.range(1000), 300, "id"))
    assert digest_cutoff(spark.range(3), key_digest("id", 1), 10) is None


def test_split_is_a_partition(spark):
    df = spark.range(2000)
    train, test = split_train_test(df, "id")
    assert train.count() + test.count() == 2000 and train.join(test, "id").count() == 0
    assert abs(train.count() - 1400) < 80
    assert sample_fraction(df, 1.0, "id").count() == 2000 and sample_fraction(df, 0.0, "id").count() == 0
    with pytest.raises(ValueError):
        sample_fraction(df, 1.5, "id")


def test_stratified_split_keeps_shares(spark):
    df = spark.range(1000).withColumn("y", F.when(F.col("id") % 10 == 0, "rare").otherwise("common"))
    got = {(r["y"], r["split"]): r["count"] for r in stratified_split(df, "y", "id").groupBy("y", "split").count().collect()}
    assert got == {("rare", "train"): 70, ("rare", "test"): 30, ("common", "train"): 630, ("common", "test"): 270}


def test_draws_with_replacement(spark):
    drawn = sample_with_replacement(spark.range(10).withColumn("v", F.col("id") * 2), 500, "id")
    assert drawn.count() == 500 and drawn.select("id").distinct().count() == 10


def test_balanced_classes(spark):
    df = spark.range(300).withColumn("y", (F.col("id") % 6 == 0).cast("int"))
    for out, size in ((under_balance(df, "y", "id"), 50), (over_balance(df, "y", "id"), 250)):
        assert {r["count"] for r in out.groupBy("y").count().collect()} == {size}


@pytest.mark.parametrize("limit", [1, 1000])
def test_lookup_join_with_a_hot_key(spark, limit):
    fact = spark.range(3000).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50))
    lookup = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    joined = lookup_join(fact, lookup, ["k"], limit=limit, salts=4)
    want = fact.join(lookup, "k", "left")
    assert joined.count() == 3000
    assert joined.agg(F.sum("v")).first() == want.agg(F.sum("v")).first()
    gaps = fact.withColumn("k", F.when(F.col("id") % 2 == 0, F.col("k")))
    assert lookup_join(gaps, lookup, ["k"], limit=limit, salts=4).count() == 3000
    assert members(fact, lookup, ["k"], limit=limit).count() + complement(fact, lookup, ["k"], limit=limit).count() == 3000
    assert complement(fact, lookup, ["k"], limit=limit).filter("k < 40").count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=30, unique=True), st.integers(0, 31))
def test_exact_sample_property(spark, ids, n):
    df = spark.createDataFrame([(i,) for i in ids], "id int")
    assert sample_exact(df, n, "id", boundary_rows=2).count() == min(n, len(ids))
