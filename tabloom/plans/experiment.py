"""Preparation experiments with stage switches, and threshold studies for feature selection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.hashing import key_digest
from tabloom.operators.columns import columns_of_type
from tabloom.operators.correlation import correlations, redundant_variables
from tabloom.plans.prep import Preparation
from tabloom.plans.studies import evaluate_approach
from tabloom.session import local_table, materialize

ROW_KEY = "__row_key"
STAGES = ("outliers", "scaling", "balancing", "feature_selection")


@dataclass
class ExperimentConfig:
    outliers: str | None = None
    scaling: str | None = None
    balancing: str | None = None
    feature_selection: str | None = None
    metric: str = "accuracy"
    dry_run: bool = False

    @property
    def label(self) -> str:
        """The active strategies joined by underscores."""
        return "_".join(v for s in STAGES if (v := getattr(self, s))) or "baseline"


def run_experiment(config: ExperimentConfig, df: DataFrame, *, key: str, target: str, **preparation) -> DataFrame:
    """Prepare with the switched-on stages and score the two reference learners.

    A dry run returns the resolved configuration instead, with the number of
    rows that have a target.
    """
    spark = df.sparkSession
    if config.dry_run:
        rows = df.filter(F.col(target).isNotNull()).count()
        return local_table(spark, [(k, str(v)) for k, v in {**asdict(config), "label": config.label, "rows": rows}.items()],
                           "setting string, value string")
    stages = {s: getattr(config, s) for s in STAGES}
    model = Preparation(key=key, target=target, **stages, **preparation).fit(df)
    prepared = materialize(model.prepared, "experiment")
    train, test = (prepared.filter(F.col("split") == s).drop("split") for s in ("train", "test"))
    # Synthetic rows have no key; the neighbour join gets one for every row, made from what the row holds.
    row_key = F.coalesce(F.concat(F.lit("row:"), F.col(key).cast("string")), F.concat(F.lit("new:"), key_digest(model.features, 0)))
    train, test = (materialize(d.withColumn(ROW_KEY, row_key), "experiment-split") for d in (train, test))
    scored = evaluate_approach(train, test, ROW_KEY, model.features, target, config.metric)
    return scored.select(F.lit(config.label).alias("experiment"), "metric", "nb", "knn")


def steps(start: float, stop: float, step: float) -> list[float]:
    """start, start + step, ... up to ``stop``, which is included when a step meets it; exact in decimals."""
    at, last, by = (Decimal(str(x)) for x in (start, stop, step))
    if by <= 0:
        raise ValueError("the step must be positive")
    found = []
    while at <= last:
        found.append(float(at))
        at += by
    return found


def _study(train: DataFrame, test: DataFrame, key: str, target: str, features: Sequence[str],
           options: Sequence[float], dropped_at, metric: str) -> DataFrame:
    """Score each threshold; equal column sets are scored once."""
    known: dict[tuple[str, ...], tuple[float | None, float | None]] = {}
    rows = []
    for threshold in options:
        kept = tuple(c for c in features if c not in set(dropped_at(threshold)))
        if not kept:
            continue
        if kept not in known:
            scored = evaluate_approach(train, test, key, kept, target, metric).filter(F.col("metric") == metric).first()
            known[kept] = (scored["nb"], scored["knn"]) if scored else (None, None)
        rows.append((float(threshold), len(kept), *known[kept]))
    return local_table(train.sparkSession, rows, "threshold double, nr_features int, nb double, knn double")


def variance_study(train: DataFrame, test: DataFrame, key: str, target: str, *, max_threshold: float = 1.0,
                   lag: float = 0.05, metric: str = "accuracy", features: Sequence[str] | None = None) -> DataFrame:
    """Both learners at each variance threshold; the variances are computed once."""
    names = list(features or [c for c in columns_of_type(train, "number") if c not in (key, target)])
    row = train.agg(*[F.var_samp(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(names)]).first()
    variance = {c: row[f"v{i}"] for i, c in enumerate(names)}
    options = steps(lag, max_threshold, lag)
    return _study(train, test, key, target, names, options,
                  lambda t: [c for c in names if variance[c] is not None and variance[c] < t], metric)


def redundancy_study(train: DataFrame, test: DataFrame, key: str, target: str, *, min_threshold: float = 0.9,
                     lag: float = 0.05, metric: str = "accuracy", rule: str = "mutual",
                     features: Sequence[str] | None = None) -> DataFrame:
    """Both learners at each correlation threshold from ``min_threshold`` to 1; correlations are computed once."""
    names = list(features or [c for c in columns_of_type(train, "number") if c not in (key, target)])
    found = correlations(train, names)
    options = steps(min_threshold, 1.0, lag)
    return _study(train, test, key, target, names, options, lambda t: redundant_variables(found, names, t, rule), metric)
