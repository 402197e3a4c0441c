"""Rare categories, learned column drops and derived date columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.dates import clock_label, date_parts, parse_us_timestamp
from tabloom.operators.aggregates import value_frequencies
from tabloom.operators.columns import column_facts, matching_columns
from tabloom.operators.stages import FittedStage
from tabloom.operators.vartypes import variable_types

OTHERS = "OTHERS"


class RareCategoryModel(FittedStage):
    """Replace values outside the learned frequent sets."""

    def _transform(self, df: DataFrame) -> DataFrame:
        keep_null = self.state["null_policy"] == "keep"
        out = {}
        for c, kept in self.state["frequent"].items():
            if c not in df.columns:
                continue
            text = F.col(c).cast("string")
            known = text.isin(kept) if kept else F.lit(False)
            grouped = F.when(known, text).otherwise(F.lit(OTHERS))
            out[c] = F.when(text.isNull(), F.lit(None)).otherwise(grouped) if keep_null else grouped
        return df.withColumns(out) if out else df


class RareCategoryGrouping(Estimator):
    """Learn the values whose share of the non-null rows reaches ``threshold``.

    At most ``1/threshold`` values per column qualify, so the learned sets are
    bounded whatever the table.  ``null_policy`` is ``others`` or ``keep``.
    """

    def __init__(self, columns: Sequence[str], threshold: float = 0.005, null_policy: str = "others"):
        super().__init__()
        if threshold <= 0:
            raise ValueError("the rare threshold must be positive")
        if null_policy not in ("others", "keep"):
            raise ValueError(f"null policy {null_policy} not recognized")
        self.columns, self.threshold, self.null_policy = list(columns), threshold, null_policy

    def _fit(self, df: DataFrame) -> RareCategoryModel:
        frequent: dict[str, list[str]] = {c: [] for c in self.columns}
        if self.columns:
            totals = df.agg(*[F.count(c).alias(c) for c in self.columns]).first().asDict()
            limits = F.create_map(*[F.lit(x) for c in self.columns for x in (c, float(totals[c]))])
            rows = (
                value_frequencies(df, self.columns)
                .filter(F.col("n") / limits[F.col("variable")] >= F.lit(self.threshold))
                .collect()
            )
            for r in rows:
                frequent[r["variable"]].append(r["value"])
        return RareCategoryModel({
            "frequent": {c: sorted(v) for c, v in frequent.items()}, "null_policy": self.null_policy,
        })


class CleaningModel(FittedStage):
    """Apply the learned drops, category sets and derived columns."""

    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.state
        out = RareCategoryModel(s["rare"]).transform(df)
        out = out.drop(*s["dropped"])
        times = [c for c in s["time_columns"] if c in out.columns]
        if times:
            out = out.withColumns({c: clock_label(F.col(c)) for c in times})
        return derive_date_columns(out, [c for c in s["date_columns"] if c in out.columns], drop_source=True)


class Cleaning(Estimator):
    """Group rare categories, drop columns by name and by content, format times, derive dates.

    Everything learned (category sets, columns with nulls, constant columns) is
    fixed at fit, so later tables get the same columns.
    """

    def __init__(
        self,
        *,
        rare_threshold: float = 0.005,
        drop_patterns: Sequence[str] = (),
        drop_names: Sequence[str] = (),
        drop_null_columns: bool = True,
        drop_constant: bool = True,
        time_columns: Sequence[str] = (),
        date_columns: Sequence[str] = (),
        keep: Sequence[str] = (),
        types: dict[str, list[str]] | None = None,
        force_symbolic: Sequence[str] = (),
    ):
        super().__init__()
        self.rare_threshold = rare_threshold
        self.drop_patterns, self.drop_names = list(drop_patterns), list(drop_names)
        self.drop_null_columns, self.drop_constant = drop_null_columns, drop_constant
        self.time_columns, self.date_columns = list(time_columns), list(date_columns)
        self.keep, self.types, self.force_symbolic = set(keep), types, list(force_symbolic)

    def _fit(self, df: DataFrame) -> CleaningModel:
        types = self.types or variable_types(df, force_symbolic=self.force_symbolic)
        symbolic = [c for c in types["symbolic"] if c not in self.keep and c not in self.date_columns]
        rare = RareCategoryGrouping(symbolic, self.rare_threshold).fit(df).state
        dropped = set(matching_columns(df.columns, self.drop_patterns)) | set(self.drop_names)
        checked = [c for c in df.columns if c not in dropped and c not in symbolic]
        if checked and (self.drop_null_columns or self.drop_constant):
            for c, f in column_facts(df, checked).items():
                has_null = self.drop_null_columns and f["non_null"] < f["rows"]
                constant = self.drop_constant and (f["single"] or f["non_null"] == 0)
                if has_null or constant:
                    dropped.add(c)
        if self.drop_constant:
            # A grouped column is constant when one value covers every row.
            grouped = RareCategoryModel(rare).transform(df.select(*[c for c in symbolic if c not in dropped]))
            if grouped.columns:
                dropped |= {c for c, f in column_facts(grouped).items() if f["single"]}
        dropped -= self.keep
        return CleaningModel({
            "rare": rare,
            "dropped": [c for c in df.columns if c in dropped],
            "time_columns": self.time_columns,
            "date_columns": self.date_columns,
        })


def derive_date_columns(df: DataFrame, columns: Sequence[str], *, drop_source: bool = False) -> DataFrame:
    """Add year, quarter, month and day; text dates are parsed leniently."""
    out = {}
    for c in columns:
        value = parse_us_timestamp(F.col(c)) if df.schema[c].dataType.simpleString() == "string" else F.col(c)
        out.update({f"{c}_{part}": expr for part, expr in date_parts(value).items()})
    derived = df.withColumns(out) if out else df
    return derived.drop(*columns) if drop_source else derived


def road_alignment_features(df: DataFrame, column: str = "alignment") -> DataFrame:
    """Curve flag and grade level (0 level, 1 on grade, 2 on hillcrest) from the alignment text."""
    text = F.col(column)
    grade = (
        F.when(text.contains("LEVEL"), 0).when(text.contains("ON GRADE"), 1).when(text.contains("HILLCREST"), 2).otherwise(0)
    )
    return df.withColumns({
        "is_curve": text.contains("CURVE").cast("byte"),
        "alignment_grade": grade.cast("byte"),
    })
