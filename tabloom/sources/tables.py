"""Readers and writers of tables, splits and series."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabloom.operators.columns import require_columns
from tabloom.operators.sampling import sample_fraction

FORMATS = ("csv", "json", "parquet", "orc")


def _format_of(path: str, fmt: str | None) -> str:
    if fmt:
        return fmt
    tail = path.rstrip("/").rsplit(".", 1)[-1].lower()
    return tail if tail in FORMATS else "parquet"


def load_table(
    spark: SparkSession,
    path: str,
    *,
    schema: StructType | str | None = None,
    fmt: str | None = None,
    sample: float | None = None,
    sample_keys: str | Sequence[str] | None = None,
    seed: int = 42,
) -> DataFrame:
    """Read a table; an empty CSV field is null.

    Without a schema the CSV types are inferred, which costs one more scan.
    ``sample`` keeps that share of the rows by the digest of ``sample_keys``
    (all columns when none are named).
    """
    kind = _format_of(path, fmt)
    if kind not in FORMATS:
        raise ValueError(f"format {kind} not recognized")
    reader = spark.read.format(kind)
    if schema is not None:
        reader = reader.schema(schema)
    if kind == "csv":
        reader = reader.option("header", True).option("nullValue", "").option("inferSchema", schema is None)
    df = reader.load(path)
    if sample is not None:
        df = sample_fraction(df, sample, sample_keys or df.columns, seed)
    return df


def load_tables(spark: SparkSession, paths: dict[str, str], **options) -> dict[str, DataFrame]:
    return {name: load_table(spark, path, **options) for name, path in paths.items()}


def table_shapes(tables: dict[str, DataFrame]) -> DataFrame:
    """(dataset, records, variables), one count per table in one job."""
    from functools import reduce

    parts = [
        df.agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("records"), F.lit(len(df.columns)).alias("variables"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def load_series(spark: SparkSession, path: str, ts: str, *, ts_format: str | None = None, **options) -> DataFrame:
    """A table with a parsed time key."""
    df = require_columns(load_table(spark, path, **options), [ts])
    if df.schema[ts].dataType.simpleString() == "string":
        parsed = F.try_to_timestamp(F.col(ts), F.lit(ts_format)) if ts_format else F.try_to_timestamp(F.col(ts))
        df = df.withColumn(ts, parsed)
    return df


@dataclass
class Splits:
    train: DataFrame
    test: DataFrame
    target: str
    features: list[str]

    def labels(self) -> DataFrame:
        """The distinct labels of both splits, sorted."""
        both = self.train.select(self.target).union(self.test.select(self.target))
        return both.distinct().orderBy(self.target)


def load_splits(spark: SparkSession, train_path: str, test_path: str, target: str, **options) -> Splits:
    train, test = load_table(spark, train_path, **options), load_table(spark, test_path, **options)
    require_columns(train, [target])
    require_columns(test, [target])
    return Splits(train, test, target, [c for c in train.columns if c != target])


def save_table(df: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "overwrite",
               partition_by: Sequence[str] = ()) -> str:
    """Write a stage result; one file per task, never gathered."""
    writer = df.write.format(fmt).mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True).option("emptyValue", "")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path
