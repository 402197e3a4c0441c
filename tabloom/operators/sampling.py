"""Samples and splits decided by a key digest.

No sampling operator sorts the whole table: an exact-n sample finds the n-th
smallest digest by counting digests per prefix and then filters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.hashing import below_fraction, digest_integer, key_digest
from tabloom.operators.order import Ordered, assign_row_index, group_positions

PREFIX_STEP = 3
BOUNDARY_ROWS = 100_000


def sample_fraction(df: DataFrame, fraction: float, keys: str | Sequence[str], seed: int = 42) -> DataFrame:
    return df.filter(below_fraction(key_digest(keys, seed), fraction))


def digest_cutoff(df: DataFrame, digest: Column, n: int, *, boundary_rows: int = BOUNDARY_ROWS) -> str | None:
    """The n-th smallest digest, or None when the table has fewer rows.

    Each round counts digests by a three-digit longer prefix (at most 4096
    groups, combined before the shuffle) and keeps the prefix that holds the
    n-th one, until few enough rows share it.
    """
    if n <= 0:
        return ""
    tagged = df.select(digest.alias("_h"))
    prefix, left = "", n
    while True:
        width = len(prefix) + PREFIX_STEP
        inside = tagged.filter(F.col("_h").startswith(prefix)) if prefix else tagged
        counts = sorted(
            (r["p"], r["count"]) for r in inside.groupBy(F.substring("_h", 1, width).alias("p")).count().collect()
        )
        for step, (piece, count) in enumerate(counts):
            if left <= count:
                break
            left -= count
        else:
            return None
        prefix = piece
        if count <= boundary_rows or width >= 32:
            rows = tagged.filter(F.col("_h").startswith(prefix)).orderBy("_h").limit(left).collect()
            return rows[-1]["_h"]


def sample_exact(df: DataFrame, n: int, keys: str | Sequence[str], seed: int = 42, **options) -> DataFrame:
    """The n rows with the smallest digests; ``keys`` must identify a row."""
    digest = key_digest(keys, seed)
    cutoff = digest_cutoff(df, digest, n, **options)
    return df if cutoff is None else df.filter(digest <= F.lit(cutoff))


def shuffle_rows(df: DataFrame, keys: str | Sequence[str], seed: int = 42, *, index: str = "shuffled_idx") -> Ordered:
    """A random permutation, as an explicit position column."""
    ordered = assign_row_index(df.withColumn("_digest", key_digest(keys, seed)), ["_digest"], index=index)
    return Ordered(ordered.df.drop("_digest"), ordered.n, index)


def sample_with_replacement(df: DataFrame, n: int, keys: str | Sequence[str], seed: int = 42, *,
                            draw: str = "draw_id") -> DataFrame:
    """``n`` draws; draw i takes the row at digest(i, seed) modulo the row count."""
    names = [keys] if isinstance(keys, str) else list(keys)
    pool = assign_row_index(df, names, index="_slot")
    draws = df.sparkSession.range(n).withColumnRenamed("id", draw)
    if pool.n == 0:
        return df.limit(0).withColumn(draw, F.lit(None).cast("long"))
    draws = draws.withColumn("_slot", digest_integer(key_digest(draw, seed), pool.n))
    return draws.join(pool.df, "_slot").drop("_slot")


def split_flag(keys: str | Sequence[str], train_fraction: float, seed: int = 42) -> Column:
    """True for training rows; the complement is the test set."""
    return below_fraction(key_digest(keys, seed), train_fraction)


def split_train_test(df: DataFrame, keys: str | Sequence[str], test_size: float = 0.3, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    flag = split_flag(keys, 1 - test_size, seed)
    return df.filter(flag), df.filter(~flag)


def tag_split(df: DataFrame, keys: str | Sequence[str], test_size: float = 0.3, seed: int = 42) -> DataFrame:
    flag = split_flag(keys, 1 - test_size, seed)
    return df.withColumn("split", F.when(flag, F.lit("train")).otherwise(F.lit("test")))


def stratified_split(df: DataFrame, target: str, keys: str | Sequence[str], train_share: float = 0.7,
                     seed: int = 42) -> DataFrame:
    """Tag rows so that each class gives ``train_share`` of its rows to training.

    The rank inside a class is the global position in (class, digest) order
    minus the class start, so one huge class still spreads over many tasks.
    """
    ranked = group_positions(df.withColumn("_digest", key_digest(keys, seed)), [target], ["_digest"], name="_rank")
    in_train = F.col("_rank") <= F.floor(F.col("_rank_size") * F.lit(train_share) + F.lit(1e-9))
    tagged = ranked.withColumn("split", F.when(in_train, F.lit("train")).otherwise(F.lit("test")))
    return tagged.select(*df.columns, "split")
