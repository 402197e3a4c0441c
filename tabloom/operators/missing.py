"""Missing-value treatment: dropping, filling, and nearest-neighbour imputation."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.operators.aggregates import most_frequent
from tabloom.operators.columns import column_facts
from tabloom.operators.neighbors import missing_value_donors
from tabloom.operators.stages import FittedStage
from tabloom.operators.vartypes import variable_types

# The fill-ins of the constant strategy.
CONSTANT_NUMBER, CONSTANT_TEXT, CONSTANT_FLAG = -1, "NA", False


def drop_missing(df: DataFrame, min_pct_per_variable: float = 0.1, min_pct_per_record: float = 0.0) -> DataFrame:
    """Keep columns with enough known values, then rows with enough of the original column count."""
    facts = column_facts(df)
    kept = [c for c, f in facts.items() if f["non_null"] >= f["rows"] * min_pct_per_variable]
    need = ceil(len(df.columns) * min_pct_per_record)
    slim = df.select(*kept)
    return slim.na.drop(thresh=need) if need > 0 else slim


class FillModel(FittedStage):
    def _transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, v in self.state["values"].items():
            if c in df.columns and v is not None:
                kind = df.schema[c].dataType
                if isinstance(v, float) and isinstance(kind, T.IntegralType) and not v.is_integer():
                    kind = T.DoubleType()
                out[c] = F.coalesce(F.col(c).cast(kind), F.lit(v).cast(kind))
        return df.withColumns(out) if out else df


class Filling(Estimator):
    """``frequent``: mean for numbers, most frequent value otherwise; ``constant``: fixed fill-ins.

    All columns stay, in order.
    """

    def __init__(self, strategy: str = "frequent", types: dict[str, list[str]] | None = None):
        super().__init__()
        if strategy not in ("frequent", "constant"):
            raise ValueError(f"filling strategy {strategy} not recognized")
        self.strategy, self.types = strategy, types

    def _fit(self, df: DataFrame) -> FillModel:
        types = self.types or variable_types(df)
        values: dict[str, object] = {}
        if self.strategy == "constant":
            values.update({c: CONSTANT_NUMBER for c in types["numeric"]})
            values.update({c: CONSTANT_TEXT for c in types["symbolic"]})
            for c in types["binary"]:
                kind = df.schema[c].dataType
                flag = isinstance(kind, T.BooleanType)
                values[c] = CONSTANT_FLAG if flag else (0 if isinstance(kind, T.NumericType) else str(CONSTANT_FLAG))
            return FillModel({"values": values})
        if types["numeric"]:
            row = df.agg(*[F.avg(F.col(c).try_cast("double")).alias(f"m{i}") for i, c in enumerate(types["numeric"])]).first()
            values.update({c: row[f"m{i}"] for i, c in enumerate(types["numeric"])})
        named = [*types["symbolic"], *types["binary"]]
        if named:
            values.update({r["variable"]: r["value"] for r in most_frequent(df, named).collect()})
        return FillModel({"values": values})


def impute_by_neighbors(df: DataFrame, key: str, columns: Sequence[str], k: int = 5, **options) -> DataFrame:
    """Mean of the k nearest rows that have the value; the column mean where no row shares a column.  NaN is a gap too."""
    columns = list(columns)
    donors = missing_value_donors(df, key, columns, k, **options)
    known = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    means = df.agg(*[F.avg(known[c]).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    wide = donors.groupBy(key).agg(*[
        F.avg(F.when(F.col("variable") == c, F.col("value"))).alias(f"_fill{i}") for i, c in enumerate(columns)
    ])
    joined = df.join(wide, key, "left")
    filled = {
        c: F.coalesce(known[c], F.col(f"_fill{i}"), F.lit(means[f"m{i}"]).cast("double"))
        for i, c in enumerate(columns)
    }
    return joined.withColumns(filled).select(*df.columns)
