"""k nearest neighbours as a model: a saved metric index that scores batches and streams."""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.operators.metric_index import MetricIndex, index_neighbors
from tabloom.operators.neighbors import index_points
from tabloom.session import materialize

#: Scored rows of one merging task; a stream has a fixed number of tasks.
SLOT_ROWS = 20_000
STREAM_SLOTS = 64


def _vector(df: DataFrame, features: str) -> Column:
    """The features as an array, whether they are a vector or an array."""
    column = F.col(features)
    return column.cast("array<double>") if isinstance(df.schema[features].dataType, T.ArrayType) else vector_to_array(column)


class NeighborModel(Transformer):
    """The majority label of the ``k`` nearest training rows; the smallest label wins a tie.

    Equally distant rows rank by their key.  Any ``k`` up to ``largest`` can be
    set, as the index serves them all.
    """

    def __init__(self, index: MetricIndex, k: int, largest: int | None = None, features: str = "features"):
        super().__init__()
        self.index, self.k, self.largest, self.features = index, k, largest or k, features
        if k > self.largest:
            raise ValueError(f"the index serves up to {self.largest} neighbours")

    @classmethod
    def fit_rows(cls, train: DataFrame, k: int, *, label: str = "label", features: str = "features", key: str | None = None,
                 metric: str = "euclidean", missing: str = "error") -> NeighborModel:
        """Index ``train``; without ``key`` its rows are numbered."""
        number = F.col(key) if key else F.monotonically_increasing_id()
        points = train.select(number.alias("_cid"), _vector(train, features).alias("_vec"), F.col(label).cast("double").alias("_keep_label"))
        return cls(index_points(points, k, metric, missing), k, k, features)

    def with_k(self, k: int) -> NeighborModel:
        return NeighborModel(self.index, k, self.largest, self.features)

    def save(self, spark: SparkSession, path: str) -> dict:
        self.index.save(f"{path}/index")
        return {"k": self.k, "largest": self.largest, "features": self.features, "index": self.index.spec()}

    @classmethod
    def load(cls, spark: SparkSession, path: str, spec: dict) -> NeighborModel:
        return cls(MetricIndex.load(spark, f"{path}/index", spec["index"]), spec["k"], spec["largest"], spec["features"])

    def _transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction``; also for a stream.

        Rows travel with their neighbours, so nothing has to be joined back.
        """
        return self.votes(df, [self.k]).withColumn("prediction", F.get("_votes", F.lit(0))).drop("_votes")

    def votes(self, df: DataFrame, ks: list[int]) -> DataFrame:
        """``df`` with an array of predictions, one for each of ``ks``."""
        if not set(ks) <= set(range(1, self.largest + 1)):
            raise ValueError(f"the index serves up to {self.largest} neighbours")
        vector = not isinstance(df.schema[self.features].dataType, T.ArrayType)
        named = df.withColumn("_vec", _vector(df, self.features)).withColumn("_id", F.uuid())
        rest = [c for c in df.columns if not (vector and c == self.features)]
        pay = F.struct(*rest, F.col("_vec").alias("_features"))
        q = named.select("_id", "_vec", pay.alias("_pay"))
        slots, n = STREAM_SLOTS, None
        if not df.isStreaming:
            seen = Observation()
            q = materialize(q.observe(seen, F.count("*").alias("n")), "scored")
            n = seen.get["n"]
            slots = max(1, ceil(n / SLOT_ROWS))
        near = index_neighbors(self.index, q, max(ks), n_queries=n)
        kind = T.StructType([T.StructField("_pay", q.schema["_pay"].dataType), T.StructField("_votes", T.ArrayType(T.DoubleType()))])
        near = near.select("_id", "_cid", "_d", "_keep_label", "_pay").withColumn("_slot", F.pmod(F.xxhash64("_id"), F.lit(slots)).cast("int"))
        scored = near.groupBy("_slot").applyInArrow(lambda table: _elect(table, ks), kind)
        out = scored.select("_pay.*", "_votes")
        if vector:
            out = out.withColumn(self.features, array_to_vector("_features"))
        return out.select(*df.columns, "_votes")


def _elect(table: pa.Table, ks: list[int]) -> pa.Table:
    """One row per scored row of a slot, with its payload and the winners among its first k neighbours."""
    _, row = np.unique(table.column("_id").to_numpy(), return_inverse=True)
    row = row.ravel()
    order = np.lexsort((table.column("_cid").to_numpy(), table.column("_d").to_numpy(), row))
    row = row[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row, side="left")
    classes, label = np.unique(table.column("_keep_label").to_numpy()[order], return_inverse=True)
    n = int(row[-1]) + 1 if len(row) else 0
    winners = np.empty((n, len(ks)))
    for i, k in enumerate(ks):
        first = rank < k
        tally = np.bincount(row[first] * len(classes) + label.ravel()[first], minlength=n * len(classes)).reshape(n, len(classes))
        winners[:, i] = classes[tally.argmax(axis=1)]
    pay = table.column("_pay").combine_chunks()
    has = np.flatnonzero(pay.is_valid().to_numpy(zero_copy_only=False)[order])
    at = np.empty(n, dtype=np.int64)
    at[row[has]] = order[has]
    votes = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * len(ks), pa.int32()), pa.array(winners.ravel()))
    return pa.table({"_pay": pay.take(pa.array(at)), "_votes": votes})
