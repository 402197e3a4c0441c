"""Class balancing: under-sampling, over-sampling and synthetic minority rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.hashing import digest_integer, digest_uniform, key_digest
from tabloom.operators.aggregates import class_balance
from tabloom.operators.neighbors import knn_join
from tabloom.operators.order import assign_row_index
from tabloom.operators.sampling import sample_exact, sample_with_replacement

STRATEGIES = ("under", "over", "smote")


def under_balance(df: DataFrame, target: str, key: str, seed: int = 42) -> DataFrame:
    """All minority rows and as many majority rows."""
    classes = class_balance(df, target)
    rare = df.filter(F.col(target) == F.lit(classes.minority))
    common = df.filter(F.col(target) == F.lit(classes.majority))
    return rare.unionByName(sample_exact(common, classes.n_minority, key, seed))


def over_balance(df: DataFrame, target: str, key: str, seed: int = 42) -> DataFrame:
    """All majority rows and as many minority draws with replacement."""
    classes = class_balance(df, target)
    rare = df.filter(F.col(target) == F.lit(classes.minority))
    common = df.filter(F.col(target) == F.lit(classes.majority))
    drawn = sample_with_replacement(rare, classes.n_majority, key, seed)
    return drawn.select(*df.columns).unionByName(common)


def synthetic_rows(df: DataFrame, target: str, key: str, features: Sequence[str], *, k: int = 5, seed: int = 42,
                   **options) -> DataFrame:
    """New minority rows on the line from a minority row to one of its k nearest minority neighbours.

    Row j draws its base row, neighbour and position from the digests of
    (j, seed, purpose), so the result does not depend on the partitioning.
    """
    classes = class_balance(df, target)
    spark = df.sparkSession
    rare = df.filter(F.col(target) == F.lit(classes.minority)).select(key, *[F.col(c).cast("double").alias(c) for c in features])
    schema = [F.lit(classes.minority).cast(df.schema[target].dataType).alias(target)]
    wanted = classes.n_majority - classes.n_minority
    n_near = min(k, classes.n_minority - 1)
    if n_near < 1:
        raise ValueError("the minority class needs at least two rows")
    near = knn_join(rare, rare, n_near, query_id=key, candidate_id=key, features=list(features), exclude_self=True, **options)
    near = near.select(F.col(key).alias("_base"), F.col("rank").alias("_pick"), F.col(f"neighbor_{key}").alias("_other"))
    pool = assign_row_index(rare, [key], index="_slot").df
    new = spark.range(wanted).withColumnRenamed("id", "synthetic_id").withColumns({
        "_slot": digest_integer(key_digest("synthetic_id", f"{seed}:base"), classes.n_minority),
        "_pick": (digest_integer(key_digest("synthetic_id", f"{seed}:pick"), n_near) + 1).cast("int"),
        "_u": digest_uniform(key_digest("synthetic_id", f"{seed}:gap")),
    })
    based = new.join(pool.withColumnRenamed(key, "_base"), "_slot").join(near, ["_base", "_pick"])
    other = rare.select(F.col(key).alias("_other"), *[F.col(c).alias(f"_n_{c}") for c in features])
    mixed = based.join(other, "_other")
    return mixed.select(
        "synthetic_id",
        *[(F.col(c) + F.col("_u") * (F.col(f"_n_{c}") - F.col(c))).alias(c) for c in features],
        *schema,
    )


def smote_balance(df: DataFrame, target: str, key: str, features: Sequence[str], *, k: int = 5, seed: int = 42,
                  **options) -> DataFrame:
    """The original rows and the synthetic ones (whose key is null)."""
    new = synthetic_rows(df, target, key, features, k=k, seed=seed, **options)
    original = df.select(key, *[F.col(c).cast("double").alias(c) for c in features], target)
    added = new.select(F.lit(None).cast(df.schema[key].dataType).alias(key), *features, target)
    return original.unionByName(added)


def balance(df: DataFrame, target: str, key: str, strategy: str = "under", *, features: Sequence[str] = (), seed: int = 42) -> DataFrame:
    if strategy == "under":
        return under_balance(df, target, key, seed)
    if strategy == "over":
        return over_balance(df, target, key, seed)
    if strategy == "smote":
        names = list(features) or [c for c in df.columns if c not in (target, key)]
        return smote_balance(df, target, key, names, seed=seed)
    raise ValueError(f"balancing strategy {strategy} not recognized")
