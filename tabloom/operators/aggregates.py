"""Counts, summaries, frequency tables, outlier counts and histograms."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.operators.quantiles import column_facts, group_facts, known_number
from tabloom.session import local_table


def dimensions(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("nr_records")).withColumn("nr_variables", F.lit(len(df.columns)))


def missing_values(df: DataFrame) -> DataFrame:
    """Null count of the columns that have any."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counted.unpivot([], df.columns, "variable", "nr_missing").filter("nr_missing > 0")


def value_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long form (variable, value) with every value as text; -0.0 is 0.0."""
    kinds = dict(df.dtypes)
    plain = {c: F.col(c) + F.lit(0.0).cast(kinds[c]) if kinds.get(c) in ("float", "double") else F.col(c) for c in columns}
    return df.select(*[plain[c].cast("string").alias(c) for c in columns]).unpivot([], list(columns), "variable", "value")


def value_frequencies(df: DataFrame, columns: Sequence[str], *, keep_null: bool = False) -> DataFrame:
    """Frequency table of several columns from one grouping."""
    pairs = value_pairs(df, columns)
    if not keep_null:
        pairs = pairs.filter("value is not null")
    return pairs.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))


def distinct_counts(df: DataFrame, columns: Sequence[str], *, keep_null: bool = False) -> DataFrame:
    """Distinct values per column: group first, then count groups, never one big set."""
    grouped = value_frequencies(df, columns, keep_null=keep_null)
    found = grouped.groupBy("variable").agg(F.count(F.lit(1)).alias("nr_distinct"))
    empty = df.sparkSession.createDataFrame([(c, 0) for c in columns], "variable string, nr_distinct long")
    return found.union(empty).groupBy("variable").agg(F.max("nr_distinct").alias("nr_distinct"))


def distinct_listing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every (variable, value), null included, with the number of distinct values of its variable."""
    values = value_frequencies(df, columns, keep_null=True)
    counts = distinct_counts(df, columns, keep_null=True)
    return values.select("variable", "value").join(F.broadcast(counts), "variable")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Descending frequency table without nulls."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), column)


def relative_frequencies(df: DataFrame, column: str, name: str = "freq") -> DataFrame:
    """Share of each value among the non-null rows."""
    total = df.agg(F.count(column)).first()[0]
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(column, (F.col("n") / F.lit(float(total))).alias(name))


def most_frequent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value per column as text; of equally frequent ones the smallest, numbers compared as numbers."""
    numeric = [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]
    counted = value_frequencies(df, columns)
    order = F.struct(F.when(F.col("variable").isin(numeric), F.expr("try_cast(value as double)")), F.col("value"))
    top = F.broadcast(counted.groupBy("variable").agg(F.max("n").alias("n")))
    return counted.join(top, ["variable", "n"]).groupBy("variable", "n").agg(F.min_by("value", order).alias("value"))


@dataclass
class ClassBalance:
    """The rarest and the most frequent class with their rows; ``counts`` (class, n) stays a table, however many classes there are."""

    minority: object
    majority: object
    n_minority: int
    n_majority: int
    counts: DataFrame

    @property
    def proportion(self) -> float:
        return round(self.n_minority / self.n_majority, 2)


def class_balance(df: DataFrame, target: str) -> ClassBalance:
    """Class counts with the rarest and most frequent class (smallest label on ties)."""
    counted = df.filter(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    row = counted.agg(
        F.min_by(target, F.struct(F.col("n"), F.col(target))).alias("minority"), F.min_by(target, F.struct(-F.col("n"), F.col(target))).alias("majority"),
        F.min("n").alias("least"), F.max("n").alias("most")).first()
    if row["least"] is None:
        raise ValueError(f"{target} has no values")
    return ClassBalance(row["minority"], row["majority"], row["least"], row["most"], counted)


SUMMARY_FIELDS = ("count", "mean", "std", "min", "q25", "q50", "q75", "max")


def _summary(facts: dict) -> dict:
    q = facts["quantiles"]
    return {**{f: facts[f] for f in ("count", "mean", "std", "min", "max")}, "q25": q[0], "q50": q[1], "q75": q[2]}


def describe(df: DataFrame, columns: Sequence[str], **options) -> dict[str, dict]:
    """count, mean, sample std, min, quartiles and max of each column, on the driver; null and NaN are missing."""
    return {c: _summary(f) for c, f in column_facts(df, columns, **options).items()}


def describe_table(df: DataFrame, columns: Sequence[str], **options) -> DataFrame:
    summary = describe(df, columns, **options)
    rows = [(c, *[s[f] for f in SUMMARY_FIELDS]) for c, s in summary.items()]
    schema = "variable string, count long, " + ", ".join(f"{f} double" for f in SUMMARY_FIELDS[1:])
    return local_table(df.sparkSession, rows, schema)


def describe_groups(df: DataFrame, group: str, value: str, **options) -> DataFrame:
    """The summary of ``value`` for each group, however many there are."""
    facts = group_facts(df, [group], value, **options)
    q = {f: F.get("quantiles", F.lit(j)).alias(f) for j, f in enumerate(("q25", "q50", "q75"))}
    return facts.select(group, *[q.get(f, F.col(f)) for f in SUMMARY_FIELDS])


def outlier_limits(summary: dict, *, std_based: bool = True, threshold: float = 2.0) -> tuple[float | None, float | None]:
    """(bottom, top) from mean and std, or from the quartiles and their range."""
    if std_based:
        if summary["std"] is None:
            return None, None
        spread = threshold * summary["std"]
        return summary["mean"] - spread, summary["mean"] + spread
    if summary["q25"] is None:
        return None, None
    spread = threshold * (summary["q75"] - summary["q25"])
    return summary["q25"] - spread, summary["q75"] + spread


def count_outliers(df: DataFrame, columns: Sequence[str], *, nr_std: float = 2.0, iqr_factor: float = 1.5,
                   **options) -> DataFrame:
    """Values outside the limits per variable, by the std rule and by the quartile rule."""
    summary = describe(df, columns, **options)
    exprs = []
    for i, c in enumerate(columns):
        for rule, std_based, threshold in (("stdev", True, nr_std), ("iqr", False, iqr_factor)):
            bottom, top = outlier_limits(summary[c], std_based=std_based, threshold=threshold)
            x = F.col(c).cast("double")
            hit = F.lit(False) if top is None else (x > top) | (x < bottom)
            exprs.append(F.count_if(hit).alias(f"{rule}{i}"))
    row = df.agg(*exprs).first()
    rows = [(c, row[f"iqr{i}"], row[f"stdev{i}"]) for i, c in enumerate(columns)]
    return local_table(df.sparkSession, rows, "variable string, iqr long, stdev long")


def box_statistics(df: DataFrame, columns: Sequence[str], factor: float = 1.5, **options) -> DataFrame:
    """Quartiles, whiskers at the last value inside ``factor`` ranges, and fliers."""
    summary = describe(df, columns, **options)
    exprs = []
    for i, c in enumerate(columns):
        bottom, top = outlier_limits(summary[c], std_based=False, threshold=factor)
        x = F.col(c).cast("double")
        inside = F.lit(False) if top is None else (x >= bottom) & (x <= top)
        exprs += [
            F.min(F.when(inside, x)).alias(f"lo{i}"), F.max(F.when(inside, x)).alias(f"hi{i}"),
            F.count_if(x.isNotNull() & ~inside).alias(f"out{i}"),
        ]
    row = df.agg(*exprs).first()
    rows = []
    for i, c in enumerate(columns):
        s = summary[c]
        rows.append((c, s["q25"], s["q50"], s["q75"], row[f"lo{i}"], row[f"hi{i}"], row[f"out{i}"]))
    return local_table(
        df.sparkSession, rows,
        "variable string, q25 double, q50 double, q75 double, whisker_low double, whisker_high double, nr_fliers long",
    )


def bin_count_auto(summary: dict) -> int:
    """The larger of the Sturges and Freedman-Diaconis bin counts."""
    n, span = summary["count"], (summary["max"] or 0) - (summary["min"] or 0)
    if not n or span == 0:
        return 1
    widths = [span / (log2(n) + 1)]
    iqr = summary["q75"] - summary["q25"]
    if iqr > 0:
        widths.append(2 * iqr / n ** (1 / 3))
    return max(1, ceil(span / min(widths)))


def bin_index(x: Column, low: float, high: float, bins: int) -> Column:
    """Equal-width bin number from 0; the last bin includes its upper edge."""
    if high == low:
        low, high = low - 0.5, high + 0.5
    raw = F.floor((x - F.lit(low)) * F.lit(float(bins)) / F.lit(high - low)).cast("int")
    return F.least(raw, F.lit(bins - 1))


def histogram(df: DataFrame, column: str, bins: int | str = 10, *, density: bool = False, **options) -> DataFrame:
    """Equal-width histogram, empty bins included; null and NaN are missing."""
    x = known_number(F.col(column))
    if bins == "auto":
        facts = describe(df, [column], **options)[column]
        bins = bin_count_auto(facts)
    else:
        facts = df.agg(F.count(x).alias("count"), F.min(x).alias("min"), F.max(x).alias("max")).first().asDict()
    if not facts["count"]:
        return local_table(df.sparkSession, [], "bin int, low double, high double, n long")
    if bins >= 2**31:
        raise ValueError(f"{column} would need {bins} bins of equal width; give their number")
    low, high = facts["min"], facts["max"]
    counted = (
        df.filter(x.isNotNull()).groupBy(bin_index(x, low, high, bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    )
    if high == low:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    at = F.col("id").cast("double")
    # A heavy tail gives any number of bins, so they are made by tasks.
    edges = df.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin"), (F.lit(low) + at * F.lit(width)).alias("low"), (F.lit(low) + (at + 1) * F.lit(width)).alias("high"))
    out = edges.join(counted, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    if density:
        out = out.withColumn("density", F.col("n") / F.lit(float(facts["count"]) * width))
    return out


def granularity(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Frequency tables of the levels of a hierarchy, from one grouping."""
    return value_frequencies(df, columns)


def date_granularity(df: DataFrame, column: str, levels: Sequence[str]) -> DataFrame:
    from tabloom.functions.dates import date_parts

    parts = date_parts(F.col(column))
    return granularity(df.select(*[parts[level].alias(f"{column}_{level}") for level in levels]),
                       [f"{column}_{level}" for level in levels])


def low_variance(df: DataFrame, max_threshold: float, target: str | None = None,
                 columns: Sequence[str] | None = None) -> list[str]:
    """Numeric columns whose sample variance is below the threshold."""
    from tabloom.operators.columns import columns_of_type

    names = [c for c in (columns or columns_of_type(df, "number")) if c != target]
    if not names:
        return []
    row = df.agg(*[F.var_samp(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(names)]).first()
    return [c for i, c in enumerate(names) if row[f"v{i}"] is not None and row[f"v{i}"] < max_threshold]
