"""Registration of the queries over the test tables and of their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of one folder as attributes, read lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Tables` under ``name``."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def digest_sql(key: str, seed: int | str = 42) -> str:
    """SQL of the key digest."""
    return f"md5(concat(cast({key} as varchar), ':', '{seed}'))"


def uniform_sql(digest: str) -> str:
    return f"(cast(concat('0x', substr({digest}, 1, 8)) as bigint) / 4294967296.0)"


def modulo_sql(digest: str, n: str) -> str:
    return f"(cast(concat('0x', substr({digest}, 1, 15)) as bigint) % ({n}))"
