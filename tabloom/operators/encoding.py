"""Ordinal, hierarchical, one-hot, cyclic, binary and frequency encoding."""

from __future__ import annotations

from collections.abc import Sequence
from inspect import signature
from math import pi

from pyspark.ml import Estimator
from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.dates import clock_angle, modulo_angle, ordinal_angle, slot_angle
from tabloom.functions.text import place_parts, recode
from tabloom.operators.aggregates import relative_frequencies, value_frequencies
from tabloom.operators.columns import default_missing_category
from tabloom.operators.joins import coded_lookup
from tabloom.operators.order import assign_row_index, group_positions, windowed
from tabloom.operators.stages import FittedStage
from tabloom.session import local_table, materialize

# Lighting from darkest to brightest, unknown last.
LIGHTING_ORDER = {
    "DARKNESS": 0,
    "DARKNESS, LIGHTED ROAD": 1,
    "DAWN": 2,
    "DAYLIGHT": 3,
    "DUSK": 4,
    "UNKNOWN": 5,
    "OTHERS": 6,
}
# Weekdays and traffic levels of the traffic counts.
WEEKDAY_ORDER = {
    "Monday": 1, "Tuesday": 2, "Wednesday": 3, "Thursday": 4, "Friday": 5, "Saturday": 6, "Sunday": 7,
}
TRAFFIC_ORDER = {"heavy": 1, "high": 2, "normal": 3, "low": 4}
# States of each region.
REGION_STATES = {
    "Midwest": ["IA", "IL", "IN", "KS", "MI", "MN", "MO", "ND", "NE", "OH", "SD", "WI"],
    "Northeast": ["CT", "MA", "ME", "NH", "NJ", "NY", "PA", "RI", "VT"],
    "Outside": ["AS", "MP", "PR", "TT", "VI"],
    "South": ["AL", "AR", "DC", "DE", "FL", "GA", "KY", "LA", "MD", "MS", "NC", "OK", "SC", "TN", "TX", "VA", "WV"],
    "West": ["AK", "AZ", "CA", "CO", "HI", "ID", "MT", "NM", "NV", "OR", "UT", "WA", "WY"],
}
# Weights of the three hierarchy levels in the code.
REGION_WEIGHT, STATE_WEIGHT = 1000, 100
# Circle sizes of the calendar columns.
CALENDAR_SIZES = {"DayOfWeek": 7, "Quarter": 4, "Month": 12, "DayofMonth": 31}
CLOCK_COLUMNS = ("CRSDepTime", "CRSArrTime")
SLOT_COLUMNS = ("DepTimeBlk", "ArrTimeBlk")
ACCIDENT_PERIODS = {
    "crash_date_quarter": 4,
    "crash_date_month": 12,
    "crash_date_day": 31,
    "crash_day_of_week": 7,
    "crash_hour": 24,
}

MAX_DENSE_CATEGORIES = 5_000


def ordinal_encode(df: DataFrame, mappings: dict[str, dict]) -> DataFrame:
    """Replace values by their fixed rank; unmapped values become null."""
    return df.withColumns({c: recode(F.col(c), m, strict=True) for c, m in mappings.items() if c in df.columns})


def category_codes(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Rank of the value among the sorted distinct values, from 0; null stays null."""
    distinct = df.filter(F.col(column).isNotNull()).select(column).distinct()
    lookup = assign_row_index(distinct, [column], index=name or f"{column}_code").df
    return coded_lookup(df, lookup, [column], name or f"{column}_code")


def label_codes(df: DataFrame, column: str, order_by: Sequence[str], name: str = "label") -> DataFrame:
    """Codes 0..k-1 by first appearance in the order of the key columns ``order_by``."""
    first = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.min(F.struct(*order_by)).alias("_first"))
    lookup = assign_row_index(first, ["_first"], index=name).df.drop("_first")
    return coded_lookup(df, lookup, [column], name)


# --- one-hot ---------------------------------------------------------------


class OneHotModel(FittedStage):
    """0/1 columns per learned category, all added in one projection."""

    def _transform(self, df: DataFrame) -> DataFrame:
        learned = self.state["categories"]
        df = default_missing_category(df, list(learned))
        added = []
        for c, values in learned.items():
            shown = values[1:] if len(values) == 2 else values
            for v in shown:
                hit = F.col(c).isNull() if v is None else F.col(c).cast("string") == F.lit(v)
                added.append(F.coalesce(hit, F.lit(False)).cast("double").alias(f"{c}_{'nan' if v is None else v}"))
        return df.select(*[c for c in df.columns if c not in learned], *added)

    @property
    def feature_names(self) -> list[str]:
        return [
            f"{c}_{'nan' if v is None else v}"
            for c, values in self.state["categories"].items()
            for v in (values[1:] if len(values) == 2 else values)
        ]


class OneHot(Estimator):
    """Learn the sorted categories of each column; a binary column keeps its second one only.

    The dense form needs one column per category, so their number is checked;
    wider inputs take :class:`OneHotVector`.
    """

    def __init__(self, columns: Sequence[str], max_categories: int = MAX_DENSE_CATEGORIES):
        super().__init__()
        self.columns, self.max_categories = list(columns), max_categories

    def _fit(self, df: DataFrame) -> OneHotModel:
        df = default_missing_category(df, self.columns)
        rows = value_frequencies(df, self.columns, keep_null=True).limit(self.max_categories + 1).collect()
        if len(rows) > self.max_categories:
            raise ValueError(f"more than {self.max_categories} categories; use OneHotVector")
        learned: dict[str, list] = {}
        for c in self.columns:
            numeric = isinstance(df.schema[c].dataType, T.NumericType)
            present = [r["value"] for r in rows if r["variable"] == c]
            known = sorted((v for v in present if v is not None), key=(lambda v: float(v)) if numeric else (lambda v: v))
            learned[c] = known + ([None] if None in present else [])
        return OneHotModel({"categories": learned})


class OneHotVectorModel(FittedStage):
    """Sparse vector per column; the category index comes from a lookup join."""

    def _transform(self, df: DataFrame) -> DataFrame:
        for c, size in self.state["sizes"].items():
            spark = df.sparkSession
            indexed = coded_lookup(df, self.tables[c], [c], "_code", default=size)
            indexed = indexed.withColumn("_code", F.col("_code").cast("double"))
            shape = local_table(spark, [(float(max(size - 1, 0)),)], "_code double")
            encoder = OneHotEncoder(inputCol="_code", outputCol=f"{c}_vec", dropLast=False, handleInvalid="keep").fit(shape)
            df = encoder.transform(indexed).drop("_code")
        return df


class OneHotVector(Estimator):
    """One-hot for columns with very many categories."""

    def __init__(self, columns: Sequence[str]):
        super().__init__()
        self.columns = list(columns)

    def _fit(self, df: DataFrame) -> OneHotVectorModel:
        sizes, tables = {}, {}
        for c in self.columns:
            ordered = assign_row_index(df.filter(F.col(c).isNotNull()).select(c).distinct(), [c], index="_code")
            sizes[c], tables[c] = ordered.n, ordered.df
        return OneHotVectorModel({"sizes": sizes}, tables)


# --- hierarchy -------------------------------------------------------------


def hierarchy_codes(df: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Sorted rank of each value within its parent, for each level of a hierarchy.

    Returns the distinct paths with ``<level>_code`` columns from 1.  The paths
    are sorted once.  A row starts a new value of a level where its path down
    to that level differs from the row before; a code is the number of starts
    since the parent last started, within a block of rows and, by one row a
    block, across blocks.
    """
    levels = list(levels)
    ordered = assign_row_index(df.select(*levels).distinct().na.drop("any"), levels, index="_at")
    seen = windowed(ordered, lambda w: {f"_p{i}": F.lag(c, 1).over(w) for i, c in enumerate(levels)}, before=1)
    starts, new = {}, F.lit(False)
    for i, c in enumerate(levels):
        new = new | ~F.col(f"_p{i}").eqNullSafe(F.col(c))
        starts[f"_s{i}"] = new.cast("long")
    size = ordered.block_rows(None)
    flagged = seen.withColumns({**starts, "_block": F.floor(F.col("_at") / F.lit(size)).cast("long")})
    run = Window.partitionBy("_block").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    depth = range(len(levels))
    summed = flagged.withColumns({f"_n{i}": F.sum(f"_s{i}").over(run) for i in depth})
    # Of the rows that start a parent the last one has the largest count.
    opened = summed.withColumns({f"_o{i}": F.max(F.when(F.col(f"_s{i - 1}") == 1, F.col(f"_n{i}"))).over(run) for i in depth if i})
    opened = opened.withColumn("_o0", F.lit(None).cast("long"))
    ends = opened.groupBy("_block").agg(*[F.max(f"_n{i}").alias(f"n{i}") for i in depth], *[F.max(f"_o{i}").alias(f"o{i}") for i in depth])
    before, carried = [0] * len(levels), []
    for r in sorted(ends.collect(), key=lambda r: r["_block"]):
        carried.append((r["_block"], *before))
        before = [before[i] + r[f"n{i}"] if r[f"o{i}"] is None else r[f"n{i}"] - r[f"o{i}"] + 1 for i in depth]
    base = F.broadcast(local_table(df.sparkSession, carried, "_block long, " + ", ".join(f"_c{i} long" for i in depth)))
    coded = opened.join(base, "_block")
    code = lambda i: F.coalesce(F.col(f"_n{i}") - F.col(f"_o{i}") + 1, F.col(f"_c{i}") + F.col(f"_n{i}"))
    return coded.select(*levels, *[code(i).alias(f"{c}_code") for i, c in enumerate(levels)])


class PlaceModel(FittedStage):
    """region * 1000 + state * 100 + city, with 0 for an unknown city."""

    def _transform(self, df: DataFrame) -> DataFrame:
        spark = df.sparkSession
        states = local_table(spark, [tuple(r) for r in self.state["states"]], "_state string, _region_code int, _state_code int")
        for role in self.state["roles"]:
            state, city, out = role["state"], role["city"], role["out"]
            place = F.trim(F.split(F.col(city).cast("string"), ",", 2)[0])
            df = df.withColumns({"_state": F.col(state), "_city": place})
            df = df.join(F.broadcast(states), "_state", "left")
            df = coded_lookup(df, self.tables["cities"], ["_state", "_city"], "_city_code", default=0)
            code = (
                F.coalesce("_region_code", F.lit(0)) * REGION_WEIGHT
                + F.coalesce("_state_code", F.lit(0)) * STATE_WEIGHT
                + F.col("_city_code")
            )
            df = df.withColumn(out, code.cast("long")).drop(
                "_state", "_city", "_region_code", "_state_code", "_city_code", state, city
            )
        return df


class PlaceEncoder(Estimator):
    """Learn the city ranks per state from every ``"City, ST"`` column.

    ``roles`` lists (state column, city column, output column).
    """

    def __init__(self, roles: Sequence[tuple[str, str, str]], region_states: dict[str, list[str]] | None = None):
        super().__init__()
        self.roles, self.region_states = list(roles), region_states or REGION_STATES

    def _fit(self, df: DataFrame) -> PlaceModel:
        places = None
        for _, city, _ in self.roles:
            name, state = place_parts(F.col(city))
            part = df.select(state.alias("_state"), name.alias("_city"))
            places = part if places is None else places.union(part)
        ranked = group_positions(places.na.drop("any").distinct(), ["_state"], ["_city"], name="_city_code")
        cities = materialize(ranked.drop("_city_code_size"), "cities")
        states = [
            [state, r + 1, s + 1]
            for r, region in enumerate(sorted(self.region_states))
            for s, state in enumerate(sorted(self.region_states[region]))
        ]
        roles = [{"state": s, "city": c, "out": o} for s, c, o in self.roles]
        return PlaceModel({"states": states, "roles": roles}, {"cities": cities})


# --- cyclic ----------------------------------------------------------------


def circle_columns(angles: dict[str, Column], digits: int | None = None) -> dict[str, Column]:
    """``<name>_sin`` and ``<name>_cos`` of each angle."""
    out = {}
    for name, angle in angles.items():
        for part, fn in (("sin", F.sin), ("cos", F.cos)):
            value = fn(angle)
            out[f"{name}_{part}"] = F.round(value, digits) if digits is not None else value
    return out


class CyclicMaxModel(FittedStage):
    def _transform(self, df: DataFrame) -> DataFrame:
        angles = {c: F.lit(2 * pi) * F.col(c) / F.lit(float(m)) for c, m in self.state["max"].items()}
        return df.withColumns(circle_columns(angles, 3))


class CyclicByMax(Estimator):
    """sin and cos of ``2 pi x / max`` to three digits; a maximum of 0 counts as 1."""

    def __init__(self, columns: Sequence[str]):
        super().__init__()
        self.columns = list(columns)

    def _fit(self, df: DataFrame) -> CyclicMaxModel:
        row = df.agg(*[F.max(c).alias(c) for c in self.columns]).first()
        return CyclicMaxModel({"max": {c: float(row[c] or 1) for c in self.columns}})


class CyclicPeriodModel(FittedStage):
    def _transform(self, df: DataFrame) -> DataFrame:
        angles: dict[str, Column] = {}
        helpers = []
        for c, ranked in self.state["ranked"].items():
            if c in df.columns:
                ranks = {v: i for i, v in enumerate(ranked)}
                angles[c] = modulo_angle(recode(F.col(c), ranks, strict=True), max(len(ranked), 1))
        for c, size in self.state.get("sizes", {}).items():
            if c in df.columns:
                helpers.append(f"_rank_{c}")
                df = coded_lookup(df, self.tables[c], [c], helpers[-1])
                angles[c] = modulo_angle(F.col(helpers[-1]), size)
        for c, period in self.state["periods"].items():
            if c in df.columns:
                angles[c] = modulo_angle(F.col(c), period)
        return df.withColumns(circle_columns(angles)).drop(*angles, *helpers) if angles else df


class CyclicByPeriod(Estimator):
    """Known periods by modulo; ``ranked`` columns (years) by their learned sorted rank.

    Up to ``max_ranks`` ranks are part of the plan; more stay a table that is joined.
    """

    def __init__(self, periods: dict[str, int], ranked: Sequence[str] = (), max_ranks: int = 10_000):
        super().__init__()
        self.periods, self.ranked, self.max_ranks = dict(periods), list(ranked), max_ranks

    def _fit(self, df: DataFrame) -> CyclicPeriodModel:
        ranked, sizes, tables = {}, {}, {}
        for c in self.ranked:
            if c not in df.columns:
                continue
            values = df.filter(F.col(c).isNotNull()).select(c).distinct()
            rows = values.orderBy(c).limit(self.max_ranks + 1).collect()
            if len(rows) <= self.max_ranks:
                ranked[c] = [r[0] for r in rows]
            else:
                ordered = assign_row_index(values, [c], index=f"_rank_{c}")
                sizes[c], tables[c] = ordered.n, ordered.df
        return CyclicPeriodModel({"periods": self.periods, "ranked": ranked, "sizes": sizes}, tables)


def encode_calendar(df: DataFrame) -> DataFrame:
    """Replace weekday, quarter, month, day, clock and slot columns by sin and cos."""
    angles: dict[str, Column] = {}
    for c in df.columns:
        if c in CALENDAR_SIZES:
            angles[c] = ordinal_angle(F.col(c), CALENDAR_SIZES[c])
        elif c in CLOCK_COLUMNS:
            angles[c] = clock_angle(F.col(c))
        elif c in SLOT_COLUMNS:
            angles[c] = slot_angle(F.col(c))
    return df.withColumns(circle_columns(angles)).drop(*angles) if angles else df


class CyclicTwoStep(Estimator):
    """The laboratory variant: positions become angles, then sin and cos of ``2 pi angle / max angle``.

    ``sizes`` maps a column to (first position, circle size); ``ranked``
    columns use their learned sorted rank.
    """

    def __init__(self, sizes: dict[str, tuple[int, int]], ranked: Sequence[str] = ()):
        super().__init__()
        self.sizes, self.ranked = dict(sizes), list(ranked)

    def _fit(self, df: DataFrame) -> CyclicTwoStepModel:
        learned = CyclicByPeriod({}, self.ranked).fit(df).state
        if learned["sizes"]:
            raise ValueError(f"{sorted(learned['sizes'])} have too many values for angles of their own; use CyclicByPeriod")
        ranks = learned["ranked"]
        sizes = {c: list(v) for c, v in self.sizes.items()}
        first = CyclicTwoStepModel({"sizes": sizes, "ranked": ranks, "max": {}})
        highest = CyclicByMax([*sizes, *ranks]).fit(first.angles(df)).state["max"]
        return CyclicTwoStepModel({"sizes": sizes, "ranked": ranks, "max": highest})


class CyclicTwoStepModel(FittedStage):
    def angles(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, (start, size) in self.state["sizes"].items():
            out[c] = F.lit(2 * pi) * (F.col(c) - start) / F.lit(float(size))
        for c, values in self.state["ranked"].items():
            ranks = {v: 2 * pi * i / len(values) for i, v in enumerate(values)}
            out[c] = recode(F.col(c), ranks, strict=True)
        return df.withColumns(out)

    def _transform(self, df: DataFrame) -> DataFrame:
        return CyclicMaxModel({"max": self.state["max"]}).transform(self.angles(df)).drop(*self.state["max"])


# --- binary and frequency --------------------------------------------------


def encode_booleans(df: DataFrame) -> DataFrame:
    flags = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    return df.withColumns({c: F.col(c).cast("byte") for c in flags}) if flags else df


def encode_binary(df: DataFrame, mappings: dict[str, dict]) -> DataFrame:
    """Booleans to 0/1 and two-valued texts by a strict mapping; absent columns are skipped."""
    df = encode_booleans(df)
    out = {c: recode(F.col(c), m, strict=True).cast("byte") for c, m in mappings.items() if c in df.columns}
    return df.withColumns(out) if out else df


class FrequencyModel(FittedStage):
    """Replace each value by its learned share; unseen values get 0."""

    def _transform(self, df: DataFrame) -> DataFrame:
        for c in self.state["columns"]:
            if c in df.columns:
                df = coded_lookup(df, self.tables[c], [c], f"{c}_freq", default=0.0).drop(c)
        return df


class FrequencyEncoder(Estimator):
    def __init__(self, columns: Sequence[str]):
        super().__init__()
        self.columns = list(columns)

    def _fit(self, df: DataFrame) -> FrequencyModel:
        present = [c for c in self.columns if c in df.columns]
        return FrequencyModel({"columns": present}, {
            c: materialize(relative_frequencies(df, c, f"{c}_freq"), "frequencies") for c in present
        })


class RefitModel(FittedStage):
    """Learns its encoder anew on every table it transforms."""

    def _transform(self, df: DataFrame) -> DataFrame:
        if df.isStreaming:
            raise ValueError("nothing can be learned from a stream; fit the encoder on a table")
        return _encoders()[self.state["encoder"]](**self.state["arguments"]).fit(df).transform(df)


class Refit(Estimator):
    """An encoder whose shares, city codes or year ranks follow the table at hand, not the training table.

    A single row then has a share of 1 and the first rank.  This is how the
    encoders behave that keep no state; elsewhere they learn once.
    """

    def __init__(self, encoder: Estimator):
        super().__init__()
        self.encoder = encoder

    def _fit(self, df: DataFrame) -> RefitModel:
        name = type(self.encoder).__name__
        if name not in _encoders():
            raise ValueError(f"encoder {name} cannot be learned anew")
        names = signature(type(self.encoder).__init__).parameters
        return RefitModel({"encoder": name, "arguments": {n: getattr(self.encoder, n) for n in names if n != "self"}})


def _encoders() -> dict[str, type[Estimator]]:
    return {c.__name__: c for c in (FrequencyEncoder, PlaceEncoder, CyclicByPeriod, CyclicByMax, CyclicTwoStep, OneHot, OneHotVector)}
