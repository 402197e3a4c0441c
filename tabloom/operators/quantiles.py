"""Exact quantiles with bounded memory, of whole columns and of any number of groups.

A first scan takes the counts, limits and moments together with a mergeable
sketch whose bracket around each wanted rank is wider than the sketch's error.
A second scan counts what lies below each bracket and, while it does so,
gathers the different values inside.  What was gathered is a small share of
the data; if it is still too much for the driver, it is narrowed on its own
table, without going back to the data.

With few values the built-in exact ``percentile`` is used in place of the
second scan; it keeps every different value of a column in one buffer.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil, floor

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tabloom.session import local_table, materialize

SMALL_CELLS = 1_000_000
ACCURACY = 10_000
COLLECT_ROWS = 200_000
QUARTILES = (0.25, 0.5, 0.75)
#: Half the width of a bracket, in units of the sketch's error.
SLACK = 3
#: Values of one group that a single task may rank; larger groups are columns of their own.
GROUP_ROWS = 10_000_000
WIDE_GROUPS = 100


def known_number(x: Column) -> Column:
    """The value as a double; NaN is missing."""
    x = x.cast("double")
    return F.when(~F.isnan(x), x)


def _bracket_points(probs: Sequence[float], accuracy: int, slack: int) -> list[float]:
    margin = slack / accuracy
    return [at for p in probs for at in (max(0.0, p - margin), min(1.0, p + margin))]


def column_facts(df: DataFrame, columns: Sequence[str], probs: Sequence[float] = QUARTILES, *, small_cells: int = SMALL_CELLS,
                 accuracy: int = ACCURACY, collect_rows: int = COLLECT_ROWS) -> dict[str, dict]:
    """count, mean, sample std, min, max and the ``quantiles`` of each column; null and NaN are missing.

    Two scans, whatever the number of columns.
    """
    columns, probs = list(columns), list(probs)
    if not columns:
        return {}
    # NaN compares with nothing, so no bracket could ever be narrowed around it.
    slim = df.select(*[known_number(F.col(c)).alias(f"c{i}") for i, c in enumerate(columns)])
    names = slim.columns
    points = _bracket_points(probs, accuracy, SLACK)
    exprs = [f(c).alias(f"{name}_{c}") for c in names for name, f in
             (("count", F.count), ("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))]
    sketches = [F.percentile_approx(c, points, accuracy).alias(f"at_{c}") for c in names]
    row = slim.agg(*exprs, *sketches).first()
    facts = {c: {f: row[f"{f}_{c}"] for f in ("count", "mean", "std", "min", "max")} for c in names}
    if sum(f["count"] for f in facts.values()) <= small_cells:
        exact = slim.agg(*[F.percentile(c, F.array(*[F.lit(p) for p in probs])).alias(c) for c in names]).first()
        for c in names:
            facts[c]["quantiles"] = list(exact[c]) if exact[c] is not None else [None] * len(probs)
    else:
        brackets = {}
        for c in names:
            n = facts[c]["count"]
            for j in range(len(probs) if n else 0):
                # With few values a bracket could be narrower than two neighbouring ranks.
                whole = n <= accuracy
                brackets[c, j] = (facts[c]["min"], facts[c]["max"]) if whole else tuple(row[f"at_{c}"][2 * j:2 * j + 2])
        ranks = {(c, j): (floor(p * (facts[c]["count"] - 1)), ceil(p * (facts[c]["count"] - 1))) for (c, j) in brackets for p in [probs[j]]}
        found = _ranked(slim, brackets, ranks, {c: facts[c] for c in names}, collect_rows)
        for c in names:
            n = facts[c]["count"]
            facts[c]["quantiles"] = [_between(found[c, j], probs[j], n) if n else None for j in range(len(probs))]
    return {columns[i]: facts[c] for i, c in enumerate(names)}


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float] = QUARTILES, **options) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of the values of each column; null and NaN are missing."""
    return {c: f["quantiles"] for c, f in column_facts(df, columns, probs, **options).items()}


def _between(values: tuple[float, float], p: float, n: int) -> float:
    share = p * (n - 1) - floor(p * (n - 1))
    return values[0] + (values[1] - values[0]) * share


def _gathered(slim: DataFrame, brackets: dict) -> tuple[DataFrame, dict]:
    """((c, v, n) of the different values inside the open brackets of each column, rows below each bracket), from one scan."""
    seen = Observation()
    below = {key: F.count_if(F.col(key[0]) < a).alias(f"u{i}") for i, (key, (a, _)) in enumerate(brackets.items())}
    hits: dict[str, Column] = {}
    for (c, _), (a, b) in brackets.items():
        hit = (F.col(c) >= a) & (F.col(c) <= b)
        hits[c] = hits[c] | hit if c in hits else hit
    watched = slim.observe(seen, *below.values())
    near = watched.filter(reduce(lambda x, y: x | y, hits.values()))
    entries = F.array_compact(F.array(*[F.when(hit, F.struct(F.lit(c).alias("c"), F.col(c).alias("v"))) for c, hit in hits.items()]))
    values = materialize(near.select(F.explode(entries).alias("e")).groupBy("e.c", "e.v").agg(F.count("*").alias("n")), "inside")
    counts = seen.get
    return values, {key: counts[f"u{i}"] for i, key in enumerate(brackets)}


def _ranked(slim: DataFrame, brackets: dict, ranks: dict, facts: dict, collect_rows: int) -> dict:
    """The values at both ranks of each target."""
    if not brackets:
        return {}
    values, below = _gathered(slim, brackets)
    spread = False
    while True:
        inside = _weights(values, brackets)
        missed = [key for key, (low, high) in ranks.items() if not (below[key] <= low and high < below[key] + inside[key][1])]
        if missed and not spread:
            # Beyond the sketch's promise: look at the whole column, once.
            spread = True
            wide = {key: (facts[key[0]]["min"], facts[key[0]]["max"]) if key in missed else b for key, b in brackets.items()}
            brackets = wide
            values, below = _gathered(slim, brackets)
            continue
        if sum(n for n, _ in inside.values()) <= collect_rows:
            break
        tighter, below = _narrowed(values, brackets, below, ranks)
        if tighter == brackets:
            # A rank's own value and its neighbour are all that is left.
            break
        brackets = tighter
    kept = reduce(lambda x, y: x | y, [(F.col("c") == c) & (F.col("v") >= a) & (F.col("v") <= b) for (c, _), (a, b) in brackets.items()])
    by_column: dict[str, list] = {}
    for r in values.filter(kept).collect():
        by_column.setdefault(r["c"], []).append((r["v"], r["n"]))
    out = {}
    for key, (low, high) in ranks.items():
        a, b = brackets[key]
        at, got = below[key], {}
        for v, n in sorted(by_column[key[0]]):
            if a <= v <= b:
                got |= {r: v for r in (low, high) if at <= r < at + n}
                at += n
        out[key] = (got[low], got[high])
    return out


def _weights(values: DataFrame, brackets: dict) -> dict:
    """(different values, rows) inside each bracket."""
    exprs = []
    for i, ((c, _), (a, b)) in enumerate(brackets.items()):
        hit = (F.col("c") == c) & (F.col("v") >= a) & (F.col("v") <= b)
        exprs += [F.count_if(hit).alias(f"d{i}"), F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias(f"w{i}")]
    row = values.agg(*exprs).first()
    return {key: (row[f"d{i}"], row[f"w{i}"]) for i, key in enumerate(brackets)}


def _narrowed(values: DataFrame, brackets: dict, below: dict, ranks: dict, cuts: int = 64) -> tuple[dict, dict]:
    """Brackets with a share of their different values that still hold their ranks, and the rows below them."""
    steps = [k / cuts for k in range(1, cuts)]
    hits = {key: (F.col("c") == key[0]) & (F.col("v") >= a) & (F.col("v") <= b) for key, (a, b) in brackets.items()}
    row = values.agg(*[F.percentile_approx(F.when(h, F.col("v")), steps, 10 * cuts).alias(f"s{i}") for i, h in enumerate(hits.values())]).first()
    edges = {key: sorted({brackets[key][0], *row[f"s{i}"], brackets[key][1]}) for i, key in enumerate(brackets)}
    sums = []
    for i, (key, points) in enumerate(edges.items()):
        sums += [F.coalesce(F.sum(F.when(hits[key] & (F.col("v") < p), F.col("n"))), F.lit(0)).alias(f"w{i}_{j}") for j, p in enumerate(points)]
    totals = values.agg(*sums).first()
    new, under = {}, {}
    for i, (key, points) in enumerate(edges.items()):
        low, high = (r - below[key] for r in ranks[key])
        before = [totals[f"w{i}_{j}"] for j in range(len(points))]
        first = max(j for j in range(len(points)) if before[j] <= low)
        last = min((j for j in range(len(points)) if before[j] > high), default=len(points) - 1)
        new[key], under[key] = (points[first], points[last]), below[key] + before[first]
    return new, under


def group_facts(df: DataFrame, groups: Sequence[str], value: str, probs: Sequence[float] = QUARTILES, *, accuracy: int = ACCURACY,
                group_rows: int = GROUP_ROWS) -> DataFrame:
    """(groups, count, mean, std, min, max, quantiles) for every group, however many there are; null and NaN values are missing.

    Each group gets its own sketch, and the second scan meets the brackets by
    a join, so one group's values inside a bracket are ranked by one task.
    Groups of more than ``group_rows`` values are treated as columns.
    """
    probs = list(probs)
    names = list(groups)
    slim = df.select(*[F.col(g).alias(f"g{i}") for i, g in enumerate(names)], known_number(F.col(value)).alias("x"))
    keys = [f"g{i}" for i in range(len(names))]
    points = _bracket_points(probs, accuracy, SLACK)
    facts = slim.groupBy(*keys).agg(
        F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), F.min("x").alias("min"), F.max("x").alias("max"),
        F.percentile_approx("x", points, accuracy).alias("at"))
    facts = materialize(facts.withColumn("group", F.monotonically_increasing_id()), "group-facts")
    low = [F.when(F.col("count") <= accuracy, F.col("min")).otherwise(F.get("at", F.lit(2 * j))) for j in range(len(probs))]
    high = [F.when(F.col("count") <= accuracy, F.col("max")).otherwise(F.get("at", F.lit(2 * j + 1))) for j in range(len(probs))]
    brackets = facts.where((F.col("count") > 0) & (F.col("count") <= group_rows)).select(*keys, "group", *[c.alias(f"a{j}") for j, c in enumerate(low)], *[c.alias(f"b{j}") for j, c in enumerate(high)])
    met = slim.where("x is not null").alias("s").join(brackets.alias("b"), reduce(lambda a, b: a & b, [F.col(f"s.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]))
    # A value below a bracket only counts, so a task sends one row for all of them.
    entry = lambda j: F.when(F.col("x") <= F.col(f"b{j}"), F.struct(F.lit(j).alias("j"), F.when(F.col("x") >= F.col(f"a{j}"), F.col("x")).alias("v")))
    counted = met.select("group", F.explode(F.array_compact(F.array(*[entry(j) for j in range(len(probs))]))).alias("e")).groupBy("group", "e.j", "e.v").agg(F.count("*").alias("n"))
    running = Window.partitionBy("group", "j").orderBy(F.asc_nulls_first("v")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    share = F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("j") + 1) * (F.col("count") - 1)
    placed = counted.withColumn("upto", F.sum("n").over(running)).join(facts.select("group", "count"), "group").withColumn("at", share)
    holds = lambda rank: (F.col("upto") - F.col("n") <= rank) & (rank < F.col("upto"))
    ends = placed.groupBy("group", "j", "at").agg(F.max(F.when(holds(F.floor("at")), F.col("v"))).alias("low"), F.max(F.when(holds(F.ceil("at")), F.col("v"))).alias("high"))
    each = ends.select("group", "j", (F.col("low") + (F.col("high") - F.col("low")) * (F.col("at") - F.floor("at"))).alias("q"))
    found = materialize(each.groupBy("group").agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "q"))), lambda s: s["q"]).alias("quantiles")), "group-quantiles")
    whole = facts.join(found, "group", "left")
    done = (F.col("count") == 0) | (F.coalesce(F.size("quantiles"), F.lit(0)) == len(probs)) & ~F.coalesce(F.exists("quantiles", lambda q: q.isNull()), F.lit(True))
    left = whole.where(~done).select(*keys, "group").collect()  # at most rows / group_rows, and groups a sketch has failed
    more = []
    for k in range(0, len(left), WIDE_GROUPS):
        some = left[k:k + WIDE_GROUPS]
        wide = slim.select(*[F.when(reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.lit(r[g])) for g in keys]), F.col("x")).alias(f"v{i}") for i, r in enumerate(some)])
        found_here = exact_quantiles(wide, wide.columns, probs, accuracy=accuracy)
        more += [(r["group"], *found_here[f"v{i}"]) for i, r in enumerate(some)]
    quantiles = F.coalesce("quantiles", F.array(*[F.lit(None).cast("double") for _ in probs]))
    if more:
        kind = "group long, " + ", ".join(f"q{j} double" for j in range(len(probs)))
        own = local_table(df.sparkSession, more, kind).select("group", F.array(*[f"q{j}" for j in range(len(probs))]).alias("own"))
        whole = whole.join(own, "group", "left")
        quantiles = F.coalesce("own", quantiles)
    return whole.select(*[F.col(k).alias(g) for k, g in zip(keys, names)], "count", "mean", "std", "min", "max", quantiles.alias("quantiles"))
