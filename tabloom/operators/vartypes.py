"""Semantic variable types, inferred from the values."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.dates import DATE_FORMATS, number_probe, timestamp_probe
from tabloom.session import local_table

KINDS = ("numeric", "binary", "date", "symbolic")


def _probes(columns: Sequence[str]) -> dict[tuple[str, str], Column]:
    """True where a present text value fails a probe: one number probe and one per date layout."""
    out = {}
    for c in columns:
        present = F.col(c).isNotNull()
        out[(c, "number")] = present & number_probe(F.col(c)).isNull()
        for fmt in DATE_FORMATS:
            out[(c, fmt)] = present & timestamp_probe(F.col(c), fmt).isNull()
    return out


def variable_types(df: DataFrame, *, symbolic_patterns: Sequence[str] = (), force_symbolic: Sequence[str] = ()) -> dict[str, list[str]]:
    """Two distinct values make a column binary; otherwise numbers, then dates, then symbolic.

    Two aggregates over the table cover all columns.  The first finds the
    extremes.  A probe that already rejects a column's extremes is settled; the
    second aggregate counts the rejections of the remaining ones, and tells
    whether any value lies strictly between the extremes.
    ``symbolic_patterns`` turns numeric columns whose name matches symbolic;
    ``force_symbolic`` names columns outright.  Arrays, maps and structs are symbolic.
    """
    result: dict[str, list[str]] = {k: [] for k in KINDS}
    nested = {f.name for f in df.schema.fields if not isinstance(f.dataType, (T.AtomicType, T.NullType))}
    at = {c: i for i, c in enumerate(df.columns) if c not in nested}
    if not at:
        return result | {"symbolic": df.columns}
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.VarcharType))]
    facts = df.agg(*[fn(c).alias(f"{n}{i}") for c, i in at.items() for n, fn in (("lo", F.min), ("hi", F.max))]).first()
    low, high = ({c: facts[f"{n}{i}"] for c, i in at.items()} for n in ("lo", "hi"))

    failed: set[tuple[str, str]] = set()
    probes = _probes(text)
    if text:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in text])
        extremes = df.sparkSession.createDataFrame([tuple(v[c] for c in text) for v in (low, high)], schema)
        row = extremes.agg(*[F.bool_or(p).alias(f"p{k}") for k, p in enumerate(probes.values())]).first()
        failed = {key for k, key in enumerate(probes) if row[f"p{k}"]}
    two = [c for c in at if low[c] != high[c]]
    exprs = []
    for c in two:
        kind = df.schema[c].dataType
        lo, hi = F.lit(low[c]).cast(kind), F.lit(high[c]).cast(kind)
        exprs.append(F.bool_or((F.col(c) != lo) & (F.col(c) != hi)).alias(f"other{at[c]}"))
    open_probes = [key for key in probes if key not in failed and low[key[0]] != high[key[0]]]
    exprs += [F.bool_or(probes[key]).alias(f"p{k}") for k, key in enumerate(open_probes)]
    between = df.agg(*exprs).first() if exprs else None
    failed |= {key for k, key in enumerate(open_probes) if between[f"p{k}"]}
    binary = {c for c in two if not between[f"other{at[c]}"]}

    for c in df.columns:
        if c in nested:
            result["symbolic"].append(c)
        elif c in binary:
            result["binary"].append(c)
        elif isinstance(df.schema[c].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            result["date"].append(c)
        elif c not in text or (c, "number") not in failed:
            forced = c in force_symbolic or any(re.search(p, c) for p in symbolic_patterns)
            result["symbolic" if forced else "numeric"].append(c)
        elif any((c, fmt) not in failed for fmt in DATE_FORMATS):
            result["date"].append(c)
        else:
            result["symbolic"].append(c)
    return result


def variable_type_table(df: DataFrame, **options) -> DataFrame:
    types = variable_types(df, **options)
    kind_of = {c: k for k, names in types.items() for c in names}
    return local_table(df.sparkSession, [(c, kind_of[c]) for c in df.columns], "variable string, var_type string")


def type_counts(df: DataFrame, **options) -> DataFrame:
    types = variable_types(df, **options)
    return local_table(df.sparkSession, [(k, len(v)) for k, v in types.items()], "var_type string, nr_variables long")


def dimensionality_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Records, variables, type counts and missing values of several tables, in long form."""
    from functools import reduce

    from tabloom.operators.aggregates import missing_values

    parts = []
    for name, df in tables.items():
        spark = df.sparkSession
        n = df.count()
        facts = [("size", "records", n), ("size", "variables", len(df.columns))]
        facts += [("type", k, len(v)) for k, v in variable_types(df).items()]
        parts.append(local_table(spark, [(name, *f) for f in facts], "dataset string, section string, item string, value long"))
        parts.append(missing_values(df).select(
            F.lit(name).alias("dataset"), F.lit("missing").alias("section"),
            F.col("variable").alias("item"), F.col("nr_missing").alias("value"),
        ))
    return reduce(DataFrame.unionByName, parts)
