"""Classification and forecast metrics as aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.operators.order import assign_row_index, prefix_sums
from tabloom.session import materialize

CLASS_METRICS = ("accuracy", "recall", "precision", "auc_hard", "f1")


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = (),
                   positive=1) -> DataFrame:
    """The five metrics of hard labels per group; undefined ratios are 0.

    ``auc_hard`` is the area under the single-point curve of the labels.
    """
    yes, said = F.col(label) == F.lit(positive), F.col(prediction) == F.lit(positive)
    counts = df.groupBy(*by).agg(
        F.count_if(yes & said).cast("double").alias("tp"), F.count_if(~yes & said).cast("double").alias("fp"),
        F.count_if(yes & ~said).cast("double").alias("fn"), F.count_if(~yes & ~said).cast("double").alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    recall, precision = _ratio(tp, tp + fn), _ratio(tp, tp + fp)
    return counts.select(
        *by,
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        recall.alias("recall"),
        precision.alias("precision"),
        ((recall + _ratio(tn, tn + fp)) / 2).alias("auc_hard"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def metrics_long(wide: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return wide.unpivot(list(by), list(CLASS_METRICS), "metric", "value")


def confusion_counts(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, label: str, prediction: str, labels: Sequence, by: Sequence[str] = ()) -> DataFrame:
    """Counts for every (label, prediction) of the given label order, zeros included.

    One conditional count per cell in a single aggregate, then the cells are
    unfolded from that one row per group.
    """
    cells = [(a, b) for a in labels for b in labels]
    counted = df.groupBy(*by).agg(*[
        F.count_if((F.col(label) == F.lit(a)) & (F.col(prediction) == F.lit(b))).alias(f"c{i}") for i, (a, b) in enumerate(cells)
    ])
    grid = F.array(*[
        F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"), F.col(f"c{i}").alias("n")) for i, (a, b) in enumerate(cells)
    ])
    return counted.select(*by, F.explode(grid).alias("e")).select(*by, "e.label", "e.prediction", "e.n")


def weighted_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, and precision and recall weighted by the class sizes; undefined ones count 0."""
    pairs = confusion_counts(df, label, prediction, by)
    truth = pairs.select(*by, F.col("label").alias("cls"), F.col("n").alias("support"),
                         F.lit(0).cast("long").alias("said"), F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit"))
    said = pairs.select(*by, F.col("prediction").alias("cls"), F.lit(0).cast("long").alias("support"),
                        F.col("n").alias("said"), F.lit(0).cast("long").alias("hit"))
    classes = truth.unionByName(said).groupBy(*by, "cls").agg(*[F.sum(c).cast("double").alias(c) for c in ("support", "said", "hit")])
    weight = F.col("support")
    return classes.groupBy(*by).agg(
        (F.sum("hit") / F.sum(weight)).alias("accuracy"),
        (F.sum(weight * _ratio(F.col("hit"), F.col("said"))) / F.sum(weight)).alias("precision"),
        (F.sum(weight * _ratio(F.col("hit"), F.col("support"))) / F.sum(weight)).alias("recall"),
    )


def roc_points(df: DataFrame, label: str, score: str, positive=1, by: Sequence[str] = ()) -> DataFrame:
    """(by, threshold, fpr, tpr) at every distinct score, from the highest on; one curve for each group of ``by``.

    All groups are sorted together and counted in one running pass; a group's
    own counts start where it starts, so a large group still spreads over many tasks.
    """
    by = list(by)
    yes = F.col(label) == F.lit(positive)
    keys = [F.col(c).alias(f"_k{i}") for i, c in enumerate(by)]
    names = [f"_k{i}" for i in range(len(by))]
    counts = df.groupBy(*keys, F.col(score).alias("threshold")).agg(F.count_if(yes).alias("_p"), F.count_if(~yes).alias("_n"))
    ordered = assign_row_index(counts, [*names, F.desc("threshold")], index="_at")
    running = prefix_sums(ordered, {"_tp": F.col("_p"), "_fp": F.col("_n")})
    totals = ordered.df.groupBy(*names).agg(F.sum("_p").alias("_all_p"), F.sum("_n").alias("_all_n"), F.min("_at").alias("_at"))
    if not by:
        all_rows = totals.first()
        constants = {"_all_p": all_rows["_all_p"] or 0, "_all_n": all_rows["_all_n"] or 0, "_tp0": 0, "_fp0": 0}
        return _curve(running.withColumns({c: F.lit(v).cast("long") for c, v in constants.items()}), [], [])
    firsts = running.select("_at", (F.col("_tp") - F.col("_p")).alias("_tp0"), (F.col("_fp") - F.col("_n")).alias("_fp0"))
    groups = materialize(totals.join(firsts, "_at").drop("_at").toDF(*[f"_g{i}" for i in range(len(by))], "_all_p", "_all_n", "_tp0", "_fp0"), "curves")
    same = reduce(lambda a, b: a & b, [F.col(f"_k{i}").eqNullSafe(F.col(f"_g{i}")) for i in range(len(by))])
    return _curve(running.join(groups, same), names, by)


def _curve(counted: DataFrame, names: Sequence[str], by: Sequence[str]) -> DataFrame:
    rate = lambda hits, start, total: _ratio((F.col(hits) - F.col(start)).cast("double"), F.col(total).cast("double"))
    return counted.select(*[F.col(n).alias(c) for n, c in zip(names, by)], "threshold", rate("_fp", "_fp0", "_all_n").alias("fpr"), rate("_tp", "_tp0", "_all_p").alias("tpr"))


def wide_metrics(df: DataFrame, label: str, predictions: dict[str, str], by: Sequence[str] = ()) -> DataFrame:
    """``binary_metrics`` of several models whose predictions stand side by side: (model, by, metrics), in one pass.

    ``predictions`` maps a model's name to its column.
    """
    entries = F.array(*[F.struct(F.lit(name).alias("model"), F.col(column).cast("double").alias("prediction")) for name, column in predictions.items()])
    each = df.select(*by, F.col(label).cast("double").alias("label"), F.explode(entries).alias("e")).select("e.model", *by, "label", "e.prediction")
    return binary_metrics(each, by=["model", *by])


def forecast_errors(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """MSE, RMSE, MAE, R2 and MAPE per group."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    gap = y - p
    tiny = 2.0 ** -52
    sse, sst = F.sum(gap * gap), F.var_pop(y) * F.count(y)
    return df.groupBy(*by).agg(
        F.avg(gap * gap).alias("mse"),
        F.sqrt(F.avg(gap * gap)).alias("rmse"),
        F.avg(F.abs(gap)).alias("mae"),
        F.when(sst > 0, 1 - F.try_divide(sse, sst)).otherwise(F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0))).alias("r2"),
        F.avg(F.abs(gap) / F.greatest(F.abs(y), F.lit(tiny))).alias("mape"),
    )


def align_forecast(train: DataFrame, test: DataFrame, predicted: DataFrame, ts: str, value: str) -> DataFrame:
    """Train, test and prediction on one time axis with a role column."""
    parts = [d.select(ts, F.lit(role).alias("role"), F.col(value).cast("double").alias("value"))
             for role, d in (("train", train), ("test", test), ("prediction", predicted))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
