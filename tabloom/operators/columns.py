"""Projections, column drops and row filters."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KINDS = {
    "number": T.NumericType,
    "bool": T.BooleanType,
    "string": T.StringType,
    "timestamp": (T.TimestampType, T.TimestampNTZType, T.DateType),
}


def strip_names(df: DataFrame) -> DataFrame:
    """Remove blanks around the column names."""
    return df.toDF(*[c.strip() for c in df.columns])


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop by name; absent names are ignored."""
    return df.drop(*columns)


def matching_columns(columns: Sequence[str], patterns: Sequence[str], *, ignore_case: bool = True) -> list[str]:
    flags = re.IGNORECASE if ignore_case else 0
    return [c for c in columns if any(re.search(p, c, flags) for p in patterns)]


def drop_matching(df: DataFrame, patterns: Sequence[str], *, ignore_case: bool = True) -> DataFrame:
    return df.drop(*matching_columns(df.columns, patterns, ignore_case=ignore_case))


def drop_id_columns(df: DataFrame) -> DataFrame:
    """Drop columns whose name contains ``ID``, case-sensitive."""
    return drop_matching(df, ["ID"], ignore_case=False)


def column_facts(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, dict]:
    """Rows, non-null count, and whether all non-null values are equal, per column.

    One aggregate over the table: equality is decided from min and max, so no
    distinct is needed.
    """
    names = list(columns or df.columns)
    exprs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(names):
        exprs += [F.count(F.col(c)).alias(f"n{i}"), (F.min(c) == F.max(c)).alias(f"s{i}")]
    row = df.agg(*exprs).first()
    return {
        c: {"rows": row["rows"], "non_null": row[f"n{i}"], "single": row[f"s{i}"]}
        for i, c in enumerate(names)
    }


def columns_with_nulls(df: DataFrame) -> list[str]:
    return [c for c, f in column_facts(df).items() if f["non_null"] < f["rows"]]


def constant_columns(df: DataFrame, *, include_empty: bool = True) -> list[str]:
    """Columns with one distinct value, and all-null ones when ``include_empty``."""
    found = []
    for c, f in column_facts(df).items():
        if f["single"] or (include_empty and f["non_null"] == 0):
            found.append(c)
    return found


def empty_columns(df: DataFrame) -> list[str]:
    return [c for c, f in column_facts(df).items() if f["non_null"] == 0]


def drop_columns_with_nulls(df: DataFrame) -> DataFrame:
    return df.drop(*columns_with_nulls(df))


def drop_constant_columns(df: DataFrame, *, include_empty: bool = True) -> DataFrame:
    return df.drop(*constant_columns(df, include_empty=include_empty))


def drop_empty_columns(df: DataFrame) -> DataFrame:
    return df.drop(*empty_columns(df))


def drop_rows_with_nulls(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def keep_types(df: DataFrame, types: dict[str, list[str]], kinds: Sequence[str], also: Sequence[str] = ()) -> DataFrame:
    """Keep the columns of the given variable types and the ones named in ``also``."""
    wanted = {c for k in kinds for c in types[k]} | set(also)
    return df.select(*[c for c in df.columns if c in wanted])


def columns_of_type(df: DataFrame, kind: str) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _KINDS[kind])]


def select_by_type(df: DataFrame, kind: str) -> DataFrame:
    return df.select(*columns_of_type(df, kind))


def keep_unless(df: DataFrame, predicate: Column) -> DataFrame:
    """Drop rows where ``predicate`` is true; unknown counts as false."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def outside(column: Column, bottom: float, top: float) -> Column:
    return (column > top) | (column < bottom)


def align_columns(df: DataFrame, features: Sequence[str], fill: float = 0) -> DataFrame:
    """Exactly ``features`` in that order; absent ones are filled, extra ones dropped."""
    present = set(df.columns)
    return df.select(*[F.col(c) if c in present else F.lit(fill).alias(c) for c in features])


def zero_share(df: DataFrame, features: Sequence[str]) -> float:
    """Share of the feature columns that hold only zeros (null counts as non-zero)."""
    if not features:
        return 0.0
    flags = [F.max((F.coalesce(F.col(c).cast("double"), F.lit(1.0)) != 0).cast("int")).alias(f"z{i}")
             for i, c in enumerate(features)]
    row = df.agg(*flags).first()
    return sum(1 for v in row if not v) / len(features)


#: Rows that are looked at before the whole table is.
FIRST_ROWS = 1_000


def guard_compatible(df: DataFrame, features: Sequence[str], limit: float = 0.99) -> DataFrame:
    """``df``, unless more than ``limit`` of its feature columns are all zero.

    More rows can only make fewer columns all zero, so a few rows are enough
    to accept a table; only one that seems not to fit is read as a whole.
    """
    if zero_share(df.limit(FIRST_ROWS), features) <= limit:
        return df
    share = zero_share(df, features)
    if share > limit:
        raise ValueError(f"{share:.1%} of the feature columns are all zero; the table does not fit the learned features")
    return df


def default_missing_category(df: DataFrame, columns: Sequence[str], value: str = "UNKNOWN") -> DataFrame:
    return df.withColumns({c: F.lit(value) for c in columns if c not in df.columns})


def fill_null(df: DataFrame, values: dict) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def dropped_names(before: Sequence[str], after: Sequence[str], keep: Sequence[str] = ()) -> list[str]:
    """Names in ``before`` that are not in ``after``, in their original order."""
    gone = set(before) - set(after) - set(keep)
    return [c for c in before if c in gone]


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN orders above every number in Spark; as null it is unknown instead."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c) for c in df.columns])
