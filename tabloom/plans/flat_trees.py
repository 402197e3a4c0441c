"""Trained trees as flat arrays, scored together by numpy."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tabloom.session import scratch_path

#: Rows that descend a tree at once.
ROWS = 1 << 14


@dataclass
class FlatTree:
    """Nodes by number: the feature and threshold asked, the nodes on both sides, and the output; a leaf leads to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    output: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        at, rows = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
        for _ in range(self.depth):
            below = x[rows, self.feature[at]] <= self.threshold[at]
            at = np.where(below, self.left[at], self.right[at])
        return self.output[at]


def flat_trees(spark: SparkSession, model, size: int) -> list[FlatTree]:
    """The first ``size`` trees of an ensemble over continuous features, outputs weighted, read from its saved form.

    A forest's tree gives the share of class 1 in a leaf, a boosted one its prediction.
    """
    forest, weights = "RandomForest" in type(model).__name__, list(model.treeWeights)
    path = scratch_path(spark, "trees")
    model.write().save(path)
    node, split = "nodeData.", "nodeData.split."
    stats = F.col(node + "impurityStats")
    output = F.get(stats, F.lit(1)) / F.aggregate(stats, F.lit(0.0), lambda a, v: a + v) if forest else F.col(node + "prediction")
    rows = spark.read.parquet(f"{path}/data").filter(F.col("treeID") < size).select(
        "treeID", F.col(node + "id").alias("id"), F.col(node + "leftChild").alias("left"), F.col(node + "rightChild").alias("right"), output.alias("output"),
        F.col(split + "featureIndex").alias("feature"), F.get(F.col(split + "leftCategoriesOrThreshold"), F.lit(0)).alias("threshold"), F.col(split + "numCategories").alias("categories"))
    nodes = rows.toPandas().sort_values(["treeID", "id"])  # as large as the model
    if (nodes["categories"] > 0).any():
        raise ValueError("trees that split categories are not supported")
    out = []
    for number, tree in nodes.groupby("treeID"):
        leaf, own = tree["left"].to_numpy() < 0, tree["id"].to_numpy()
        weight = 1.0 if forest else weights[number]
        out.append(FlatTree(np.where(leaf, 0, tree["feature"]), np.where(leaf, np.inf, tree["threshold"]), np.where(leaf, own, tree["left"]),
                            np.where(leaf, own, tree["right"]), tree["output"].to_numpy() * weight, model.trees[number].depth))
    return out


def running_totals(x: np.ndarray, trees: Sequence[FlatTree], sizes: Sequence[int]) -> np.ndarray:
    """(rows x sizes): the sum of the first trees' outputs at each of the ascending ``sizes``."""
    out = np.empty((len(x), len(sizes)))
    for start in range(0, len(x), ROWS):
        part = x[start:start + ROWS]
        total, place = np.zeros(len(part)), 0
        for n, tree in enumerate(trees[:sizes[-1]], 1):
            total = total + tree.score(part)
            while place < len(sizes) and sizes[place] == n:
                out[start:start + ROWS, place] = total
                place += 1
    return out
