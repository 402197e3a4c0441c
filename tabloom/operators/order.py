"""Positions, prefix sums and neighbouring rows without one global task.

A window without partition columns would move the whole table into one task.
Here a table is sorted by range once, written with its position, and windows
then run per block of consecutive rows.  Each block also gets copies of the
few rows just before or after it, so no value is lost at a block border.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tabloom.session import local_table, materialize

BLOCK_ROWS = 1 << 17
MAX_BLOCKS = 1 << 18
ROW = "row_idx"


@dataclass
class Ordered:
    """A table with its 0-based position in a total order, and its row count."""

    df: DataFrame
    n: int
    index: str = ROW

    def block_rows(self, wanted: int | None, halo: int = 0) -> int:
        """Rows per block: at least twice the halo, and a bounded number of blocks."""
        base = wanted or BLOCK_ROWS
        return max(base, 2 * halo + 1, -(-self.n // MAX_BLOCKS))


def sort_expressions(order_by: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def assign_row_index(df: DataFrame, order_by: Sequence[str | Column], *, index: str = ROW) -> Ordered:
    """Number the rows 0..n-1 in the order of ``order_by``, which must be total.

    The range sort is evaluated once and written; per-run row counts (one row
    per partition) then give each run its offset.
    """
    spark = df.sparkSession
    tagged = df.orderBy(*sort_expressions(order_by)).withColumn("_mid", F.monotonically_increasing_id())
    stored = materialize(
        tagged.select(
            *df.columns,
            F.shiftright("_mid", 33).cast("int").alias("_run"),
            F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos"),
        ),
        "ordered",
    )
    runs = sorted((r["_run"], r["count"]) for r in stored.groupBy("_run").count().collect())
    offsets, total = [], 0
    for run, count in runs:
        offsets.append((run, total))
        total += count
    base = F.broadcast(local_table(spark, offsets, "_run int, _base long"))
    indexed = stored.join(base, "_run").withColumn(index, F.col("_base") + F.col("_pos"))
    return Ordered(indexed.select(*df.columns, index), total, index)


def with_halo(ordered: Ordered, before: int = 0, after: int = 0, *, block_rows: int | None = None) -> DataFrame:
    """Rows tagged with ``_block``; border rows are copied into the neighbouring block.

    ``_own`` marks the one copy that belongs to its block.
    """
    size = F.lit(ordered.block_rows(block_rows, max(before, after)))
    idx = F.col(ordered.index)
    own = F.floor(idx / size).cast("long")
    inside = F.pmod(idx, size)
    targets = F.array_compact(F.array(
        own,
        F.when(inside >= size - F.lit(before), own + 1) if before else F.lit(None).cast("long"),
        F.when((inside < F.lit(after)) & (own > 0), own - 1) if after else F.lit(None).cast("long"),
    ))
    spread = ordered.df.withColumn("_home", own).withColumn("_block", F.explode(targets))
    return spread.withColumn("_own", F.col("_home") == F.col("_block")).drop("_home")


def windowed(
    ordered: Ordered,
    columns: Callable[[WindowSpec], dict[str, Column]],
    *,
    before: int = 0,
    after: int = 0,
    series: Sequence[str] = (),
    block_rows: int | None = None,
) -> DataFrame:
    """Add window columns that look at most ``before``/``after`` rows away.

    With ``series`` the order must start with those columns; the window then
    never crosses from one series into another.
    """
    spec = Window.partitionBy("_block", *series).orderBy(ordered.index)
    spread = with_halo(ordered, before, after, block_rows=block_rows)
    added = columns(spec)
    return spread.select("*", *[c.alias(n) for n, c in added.items()]).filter("_own").drop("_own", "_block")


def prefix_sums(ordered: Ordered, values: dict[str, Column], *, block_rows: int | None = None) -> DataFrame:
    """Running totals of several columns up to and including each row, from one pass over the blocks."""
    spark = ordered.df.sparkSession
    size = ordered.block_rows(block_rows)
    names = {f"_v{i}": v for i, v in enumerate(values.values())}
    blocked = ordered.df.withColumn("_block", F.floor(F.col(ordered.index) / F.lit(size)).cast("long"))
    blocked = blocked.withColumns({n: F.coalesce(v, F.lit(0)) for n, v in names.items()})
    sums = blocked.groupBy("_block").agg(*[F.sum(n).alias(n) for n in names])
    kinds = {n: sums.schema[n].dataType.simpleString() for n in names}
    totals, offsets = dict.fromkeys(names), []
    for r in sorted(sums.collect(), key=lambda r: r["_block"]):
        offsets.append((r["_block"], *[t if t is not None else r[n] - r[n] for n, t in totals.items()]))
        totals = {n: r[n] if t is None else t + r[n] for n, t in totals.items()}
    base = F.broadcast(local_table(spark, offsets, "_block long, " + ", ".join(f"_b{n} {k}" for n, k in kinds.items())))
    spec = Window.partitionBy("_block").orderBy(ordered.index).rowsBetween(Window.unboundedPreceding, 0)
    local = blocked.withColumns({f"_l{n}": F.sum(n).over(spec) for n in names})
    added = {name: F.col(f"_b{n}") + F.col(f"_l{n}") for name, n in zip(values, names)}
    return local.join(base, "_block").withColumns(added).drop("_block", *names, *[f"_l{n}" for n in names], *[f"_b{n}" for n in names])


def prefix_sum(ordered: Ordered, value: Column, name: str, *, block_rows: int | None = None) -> DataFrame:
    """Running total of ``value`` up to and including each row."""
    return prefix_sums(ordered, {name: value}, block_rows=block_rows)


def difference(ordered: Ordered, columns: Sequence[str], *, series: Sequence[str] = (), suffix: str = "_diff",
               block_rows: int | None = None) -> DataFrame:
    """First difference of each column."""
    return windowed(
        ordered,
        lambda w: {f"{c}{suffix}": F.col(c) - F.lag(c, 1).over(w) for c in columns},
        before=1, series=series, block_rows=block_rows,
    )


def lagged(ordered: Ordered, column: str, max_lag: int, delta: int = 1, *, series: Sequence[str] = (),
           block_rows: int | None = None) -> DataFrame:
    """``lag_1`` and every ``delta``-th lag up to ``max_lag``."""
    steps = sorted({1, *range(delta, max_lag + 1, delta)})
    return windowed(
        ordered,
        lambda w: {f"lag_{k}": F.lag(column, k).over(w) for k in steps},
        before=max(steps), series=series, block_rows=block_rows,
    )


#: Windows of more rows are put together from two running sums.
DIRECT_WINDOW = 32


def rolling_mean(ordered: Ordered, column: str, sizes: Sequence[int], *, series: Sequence[str] = (),
                 block_rows: int | None = None) -> DataFrame:
    """Trailing means; null until a full window of non-null values is available.

    Rows are cut into chunks as long as the window.  A window is the end of one
    chunk and the start of the next, so its sum is a running sum from the back
    plus one from the front: three additions a row for any window length, and
    nothing is ever subtracted, so nothing cancels.
    """
    wide = [n for n in sizes if n > DIRECT_WINDOW]
    spread = with_halo(ordered, max(sizes) - 1, 0, block_rows=block_rows)
    own = Window.partitionBy("_block", *series).orderBy(ordered.index)
    idx = F.col(ordered.index)
    known = F.col(column).isNotNull().cast("long")
    steps = {}
    for n in wide:
        chunk = F.floor(idx / F.lit(n))
        for way, order in (("front", F.asc(ordered.index)), ("back", F.desc(ordered.index))):
            run = Window.partitionBy("_block", *series, chunk).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
            steps[f"_{way}_sum_{n}"] = F.sum(F.col(column).cast("double")).over(run)
            steps[f"_{way}_n_{n}"] = F.sum(known).over(run)
    summed = spread.select("*", *[c.alias(name) for name, c in steps.items()])
    means = {}
    for n in sizes:
        if n not in wide:
            frame = own.rowsBetween(-(n - 1), 0)
            means[f"mean_{n}"] = F.when(F.count(column).over(frame) == n, F.avg(column).over(frame))
            continue
        whole = F.pmod(idx, F.lit(n)) == n - 1
        back = {part: F.when(whole, F.lit(0)).otherwise(F.lag(f"_back_{part}_{n}", n - 1).over(own)) for part in ("sum", "n")}
        full = F.col(f"_front_n_{n}") + back["n"] == n
        means[f"mean_{n}"] = F.when(full, (F.col(f"_front_sum_{n}") + back["sum"]) / n)
    out = summed.select("*", *[c.alias(name) for name, c in means.items()])
    return out.filter("_own").drop("_own", "_block", *steps)


def head_share(ordered: Ordered, share: float) -> tuple[DataFrame, DataFrame]:
    """The first ``int(n * share)`` rows and the rest."""
    cut = int(ordered.n * share)
    return ordered.df.filter(F.col(ordered.index) < cut), ordered.df.filter(F.col(ordered.index) >= cut)


def group_positions(df: DataFrame, group: Sequence[str], order_by: Sequence[str], *, name: str = "position") -> DataFrame:
    """1-based position of each row inside its group, plus the group size.

    The table is numbered once in (group, order) order; a row's position is its
    number minus the smallest number of its group, so a group that holds a
    large share of the rows still spreads over many tasks.
    """
    from tabloom.operators.joins import lookup_join

    group = list(group)
    ordered = assign_row_index(df, [*group, *order_by], index="_at")
    keyed = ordered.df.withColumns({f"_g{i}": F.to_json(F.struct(F.col(g).alias("v"))) for i, g in enumerate(group)})
    keys = [f"_g{i}" for i in range(len(group))]
    starts = keyed.groupBy(*keys).agg(F.min("_at").alias("_start"), F.count(F.lit(1)).alias(f"{name}_size"))
    # The group table is written once: its size is checked and it is joined.
    joined = lookup_join(keyed, materialize(starts, "groups"), keys)
    return joined.select(*df.columns, (F.col("_at") - F.col("_start") + 1).alias(name), f"{name}_size")
