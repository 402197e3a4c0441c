"""Joins that decide their strategy from a checked size.

A lookup side is broadcast only when its rows and bytes were found to be below
limits.  Beyond it the lookup is shuffled, and keys that hold a large share of
the fact rows are spread over salted copies of their one lookup row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.session import materialize

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 128 << 20
HOT_SHARE = 0.001


def _width(df: DataFrame) -> Column:
    """About how many bytes a row's values take."""
    fixed = sum(isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, (T.StringType, T.BinaryType)) for f in df.schema)
    wide = [f.name for f in df.schema if not isinstance(f.dataType, T.AtomicType) or isinstance(f.dataType, (T.StringType, T.BinaryType))]
    return sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in wide), F.lit(8 * fixed)).cast("long")


def is_small(df: DataFrame, limit: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``limit`` rows and its values about ``max_bytes``; counted per task, no rows move."""
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(_width(df)), F.lit(0))).first()
    return rows <= limit and size <= max_bytes


#: Operators that make it worth to write a lookup before it is measured and joined.
_WORK = ("Join", "Aggregate", "Window", "Generate", "Distinct", "Deduplicate", "Sort", "MapIn")


def measured_lookup(lookup: DataFrame, limit: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """(the lookup, whether it is small); one that has to be worked out is written and measured on the way, so that is done once."""
    plan = lookup._jdf.queryExecution().analyzed().toString()
    if not any(name in plan for name in _WORK):
        return lookup, is_small(lookup, limit, max_bytes)
    seen = Observation()
    written = materialize(lookup.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(_width(lookup)), F.lit(0)).alias("size")), "lookup")
    return written, seen.get["rows"] <= limit and seen.get["size"] <= max_bytes


def hot_keys(fact: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """(keys, parts): combinations that hold more than ``share`` of the rows, at most ``1/share``, and how many shares each holds."""
    limit = fact.count() * share
    hot = fact.groupBy(*keys).count().filter(F.col("count") > limit)
    return hot.select(*keys, F.ceil(F.col("count") / F.lit(limit)).cast("int").alias("parts"))


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    *,
    how: str = "left",
    limit: int = BROADCAST_ROWS,
    salts: int = 1,
) -> DataFrame:
    """Join ``fact`` with a lookup that has one row per key; a hot key is spread in proportion to its rows, ``salts`` ways at least."""
    keys = list(keys)
    lookup, small = measured_lookup(lookup, limit)
    if small:
        return fact.join(F.broadcast(lookup), keys, how)
    if fact.isStreaming:
        return fact.join(lookup, keys, how)
    hot = F.broadcast(hot_keys(fact, keys).withColumn("_hot", F.greatest("parts", F.lit(salts))).drop("parts"))
    # Rows with a null key match nothing, so they may go anywhere.
    loose = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    parts = F.when(loose, F.lit(ceil(1 / HOT_SHARE))).otherwise(F.coalesce("_hot", F.lit(1)))
    spread = F.pmod(F.xxhash64(*fact.columns), parts)
    salted_fact = fact.join(hot, keys, "left").withColumn("_salt", spread.cast("int")).drop("_hot")
    copies = F.sequence(F.lit(0), F.coalesce("_hot", F.lit(1)) - 1)
    salted_lookup = lookup.join(hot, keys, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    joined = salted_fact.join(salted_lookup, [*keys, "_salt"], how).drop("_salt")
    if how in ("left_semi", "left_anti"):
        return joined.select(*fact.columns)
    extra = [c for c in lookup.columns if c not in keys]
    return joined.select(*keys, *[c for c in fact.columns if c not in keys], *extra)


def members(fact: DataFrame, keys_table: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """Rows of ``fact`` whose key is in ``keys_table``."""
    return lookup_join(fact, keys_table.select(*keys).distinct(), keys, how="left_semi", **options)


def complement(fact: DataFrame, keys_table: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """Rows of ``fact`` whose key is not in ``keys_table``."""
    return lookup_join(fact, keys_table.select(*keys).distinct(), keys, how="left_anti", **options)


def coded_lookup(
    fact: DataFrame, lookup: DataFrame, keys: Sequence[str], code: str, *, default=None, **options
) -> DataFrame:
    """Add ``code`` from the lookup, or ``default`` where the key is unknown."""
    joined = lookup_join(fact, lookup.select(*keys, code), keys, **options)
    if default is None:
        return joined
    return joined.withColumn(code, F.coalesce(F.col(code), F.lit(default)))
