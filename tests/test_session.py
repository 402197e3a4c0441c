import pytest

from tabloom.session import materialize, temporary_tables


def exists(spark, df):
    path = df.inputFiles()[0].rsplit("/", 1)[0]
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def test_tables_of_a_scope_go_and_kept_ones_stay(spark):
    with temporary_tables(spark) as outer:
        first = materialize(spark.range(5), "first")
        with temporary_tables(spark) as inner:
            second = materialize(spark.range(6), "second")
            third = inner.keep(second, "third")
            assert exists(spark, second)
        assert not exists(spark, second) and exists(spark, third) and third.count() == 6
        kept = outer.keep(third.unionByName(first), "kept")
    assert not exists(spark, first) and not exists(spark, third) and kept.count() == 11
    assert exists(spark, materialize(spark.range(2), "later"))


def test_a_failing_scope_leaves_no_tables(spark):
    with pytest.raises(ZeroDivisionError):
        with temporary_tables(spark):
            table = materialize(spark.range(5), "first")
            1 / 0
    assert not exists(spark, table)
