"""Connected components of a distributed edge list, by hooking, pointer jumping and contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b), the component being its smallest node.

    Each round points every node at its smallest neighbour below it, follows
    the pointers to their roots by doubling, and replaces edges by edges
    between roots.  Nothing is collected; each step is a written table, so a
    lost executor repeats one step.  Loops and repeated edges are allowed.
    """
    ordered = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    alone = edges.where("a = b").select(F.col("a").alias("node")).distinct().withColumn("component", F.col("node"))
    rest = materialize(ordered.where("u <> v").distinct(), "edges")
    labels = None
    while not rest.isEmpty():
        roots = _roots(rest)
        if labels is None:
            lowest = rest.select(F.col("v").alias("node")).distinct().join(roots, "node", "left_anti")
            labels = roots.unionByName(lowest.withColumn("component", F.col("node")))
        else:
            moved = roots.select(F.col("node").alias("component"), F.col("component").alias("lower"))
            labels = labels.join(moved, "component", "left").select("node", F.coalesce("lower", "component").alias("component"))
        labels = materialize(labels, "components")
        ends = _relabel(_relabel(rest, "u", roots), "v", roots)
        contracted = ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
        rest = materialize(contracted, "edges")
    if labels is None:
        return alone
    return labels.unionByName(alone.join(labels, "node", "left_anti"))


def _relabel(edges: DataFrame, side: str, roots: DataFrame) -> DataFrame:
    """``edges`` with one end replaced by its root; ends are looked up once each, so a hot one costs one row unless it moves."""
    moves = materialize(
        edges.select(side).distinct().join(roots.withColumnsRenamed({"node": side, "component": "root"}), side), "moves")
    if moves.isEmpty():
        return edges
    return edges.join(moves, side, "left").withColumn(side, F.coalesce("root", side)).select("u", "v")


def _roots(edges: DataFrame) -> DataFrame:
    """(node, component): where the smallest-neighbour pointers of ``edges`` (u > v) end."""
    links = materialize(edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")), "links")
    while True:
        above = links.select(F.col("node").alias("component"), F.col("component").alias("lower"))
        moves = materialize(links.select("component").distinct().join(above, "component"), "moves")
        if moves.isEmpty():
            return links
        links = materialize(links.join(moves, "component", "left").select("node", F.coalesce("lower", "component").alias("component")), "links")


def smallest_reachable(nodes: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """For each of ``nodes`` the smallest node its component holds; ``pairs`` are index pairs, all in one task."""
    low = nodes.copy()
    while len(pairs):
        before = low.copy()
        least = np.minimum(low[pairs[:, 0]], low[pairs[:, 1]])
        np.minimum.at(low, pairs[:, 0], least)
        np.minimum.at(low, pairs[:, 1], least)
        if np.array_equal(before, low):
            break
    return low
