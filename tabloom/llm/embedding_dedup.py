"""Embedding near-duplicates by tiles of PCA-ordered coordinates.

Unit vectors are rotated onto the principal axes of all vectors, which leaves
cosines unchanged and puts most of a product into the first coordinates.  Two
vectors within the threshold are close on the first axis, so vectors meet only
inside a strip of that axis and between neighbouring strips, in pairs of
blocks of bounded size.  In such a tile products are accumulated over leading
coordinates first; a pair is given up as soon as the rest, bounded by the
product of its suffix norms, cannot lift it to the threshold.  What is left is
decided by the exact cosine.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.components import connected_components, smallest_reachable
from tabloom.session import materialize

THRESHOLD = 0.98
BLOCK = 1024
_STEPS = (4, 12, 32)
_SLACK = 1e-9


def _usable() -> Column:
    """Whether a row can link with anything."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("embedding", lambda x: x != 0)
    return F.coalesce(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & fine, F.lit(False))


def usable_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, size, key, key2, embedding): rows that can link, as doubles without a negative zero, and two digests."""
    rows = vectors.where(_usable()).select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0)).alias("embedding"))
    return rows.select("vec_id", "label", F.size("embedding").alias("size"), F.xxhash64("embedding").alias("key"), F.xxhash64("embedding", F.lit(1)).alias("key2"), "embedding")


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size).astype(np.float64)


def _units(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by their largest component first, so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal_axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """For each vector size the axes, strongest first, of the second moments of all unit vectors.

    The moments are summed per task and then over tasks; what reaches the
    driver is one size x size matrix.
    """

    def partial(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                x = _units(_matrix(batch.filter(pa.array(sizes == size)).column("embedding"), int(size)))
                sums[int(size)] = sums.get(int(size), 0) + x.T @ x
        for size, m in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([size], pa.int32()), pa.array([m.tobytes()], pa.binary())], names=["size", "moments"])

    def add(key, table):
        size = key[0].as_py()
        total = sum((np.frombuffer(m.as_py(), dtype=np.float64) for m in table.column("moments")), np.zeros(size * size))
        return pa.table({"size": pa.array([size], pa.int32()), "moments": pa.array([total.tobytes()], pa.binary())})

    parts = classes.select("size", "embedding").mapInArrow(partial, "size int, moments binary")
    axes = {}
    for row in parts.groupBy("size").applyInArrow(add, "size int, moments binary").toLocalIterator():
        moments = np.frombuffer(row["moments"], dtype=np.float64).reshape(row["size"], row["size"])
        axes[row["size"]] = np.linalg.eigh((moments + moments.T) / 2)[1][:, ::-1]
    return axes


def _with_strip(classes: DataFrame, axes, width: float) -> DataFrame:
    """Adds the strip of the first axis that each vector falls into."""

    def run(batches):
        for batch in batches:
            sizes, strips = batch.column("size").to_numpy(), np.zeros(batch.num_rows, dtype=np.int32)
            for size in np.unique(sizes):
                at = sizes == size
                first = _units(_matrix(batch.filter(pa.array(at)).column("embedding"), int(size))) @ axes.value[int(size)][:, 0]
                strips[at] = np.floor((first + 1.0) / width).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(strips)], names=[*batch.schema.names, "strip"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in classes.schema.fields)
    return classes.mapInArrow(run, f"{fields}, strip int")


def _tile_links(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float, same: bool) -> np.ndarray:
    """Index pairs of rows of a and b whose cosine reaches the threshold."""
    ua, ub = _units(a), _units(b)
    ya, yb = ua @ axes, ub @ axes
    size, at = ya.shape[1], 0
    done = np.zeros((len(a), len(b)))
    alive = np.triu(np.ones(done.shape, dtype=bool), 1) if same else np.ones(done.shape, dtype=bool)
    for step in _STEPS:
        if at >= size:
            break
        stop = min(size, at + step)
        done += ya[:, at:stop] @ yb[:, at:stop].T
        rest_a, rest_b = np.sqrt((ya[:, stop:] ** 2).sum(axis=1)), np.sqrt((yb[:, stop:] ** 2).sum(axis=1))
        alive &= done + rest_a[:, None] * rest_b[None, :] >= threshold - _SLACK
        at = stop
        if not alive.any():
            return np.zeros((0, 2), dtype=np.int64)
    pairs = np.argwhere(alive)
    linked = []
    for k in range(0, len(pairs), 1 << 16):
        part = pairs[k:k + (1 << 16)]
        cosine = np.einsum("ij,ij->i", ua[part[:, 0]], ub[part[:, 1]])
        linked.append(part[cosine >= threshold])
    return np.concatenate(linked) if linked else np.zeros((0, 2), dtype=np.int64)


def _links(tiles: DataFrame, axes, threshold: float) -> DataFrame:
    """(node, weight, root) per vector class and tile."""

    def run(key, table):
        size = key[1].as_py()
        left, right = ((key[k].as_py() << 32) + key[k + 1].as_py() for k in (2, 4))
        same = left == right
        at = table.column("strip").to_numpy().astype(np.int64) * (1 << 32) + table.column("block").to_numpy()
        node, copies = table.column("rep").to_numpy(), table.column("copies").to_numpy()
        x = _matrix(table.column("embedding"), size)
        rows_a, rows_b = np.flatnonzero(at == left), np.flatnonzero(at == right)
        out = pa.table({"rep": pa.array([], pa.int64()), "weight": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        if not len(rows_a) or not len(rows_b):
            return out
        pairs = _tile_links(x[rows_a], x[rows_b], axes.value[size], threshold, same)
        if not len(pairs):
            return out
        i, j = rows_a[pairs[:, 0]], rows_b[pairs[:, 1]]
        weight = np.bincount(i, weights=copies[j], minlength=len(node)) + np.bincount(j, weights=copies[i], minlength=len(node))
        met = np.flatnonzero(weight)
        return pa.table({"rep": node[met], "weight": weight[met].astype(np.int64), "root": smallest_reachable(node, np.stack([i, j], axis=1))[met]})

    return tiles.groupBy("label", "size", "left_strip", "left_block", "right_strip", "right_block").applyInArrow(run, "rep long, weight long, root long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding, label).

    Rows of one label (not null) and one vector size are linked when their
    cosine in double precision is at least ``threshold``.  Vectors that are
    null, zero or empty, or hold null or non-finite components, link with
    nothing, nor does a row without vec_id; they are kept.  Equal vectors of a
    label are compared once and counted each.  Rows that repeat a vec_id are
    rows of their own and one node of the components.  Other columns are not read.
    """
    spark = vectors.sparkSession
    usable = materialize(usable_vectors(vectors), "vectors")
    same = ["label", "size", "key", "key2"]
    classes = materialize(usable.groupBy(*same).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("embedding").alias("embedding")), "classes")
    axes = spark.sparkContext.broadcast(principal_axes(classes))
    # Unit vectors of cosine c are sqrt(2 - 2c) apart, and no further on any axis.
    width = max(math.sqrt(max(0.0, 2.0 - 2.0 * threshold)) + 1e-6, 1e-3)
    placed = materialize(_with_strip(classes, axes, width), "strips")
    blocks = placed.groupBy("label", "size", "strip").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    blocks = materialize(blocks, "blocks")
    here = placed.join(blocks, ["label", "size", "strip"]).withColumn("block", F.pmod(F.xxhash64("rep", "key2"), F.col("blocks")).cast("int"))
    beside = lambda d, name: blocks.select("label", "size", (F.col("strip") - d).alias("strip"), F.col("blocks").alias(name))
    here = here.join(beside(1, "above"), ["label", "size", "strip"], "left").join(beside(-1, "below"), ["label", "size", "strip"], "left")

    def tiles(strips: str, n: str):
        """Tiles of the row's block with the n blocks of a strip, the lower strip and block on the left."""
        return (f"if({n} is null, array(), transform(sequence(0, {n} - 1), o -> if({strips} > strip or ({strips} = strip and o >= block), "
                f"struct(strip as left_strip, block as left_block, {strips} as right_strip, o as right_block), "
                f"struct({strips} as left_strip, o as left_block, strip as right_strip, block as right_block))))")

    spread = here.withColumn("tile", F.explode(F.expr(f"concat({tiles('strip', 'blocks')}, {tiles('strip + 1', 'above')}, {tiles('strip - 1', 'below')})")))
    tiled = spread.select("label", "size", "tile.*", "strip", "block", "rep", "copies", "embedding")
    links = materialize(_links(tiled, axes, threshold), "links")
    components = connected_components(links.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    weights = links.groupBy("rep").agg(F.sum("weight").alias("weight"))
    found = materialize(classes.join(components.withColumnRenamed("node", "rep"), "rep", "left").join(weights, "rep", "left").select(
        *same, F.coalesce("component", "rep").alias("component_id"), (F.col("copies") - 1 + F.coalesce("weight", F.lit(0))).alias("n_links")), "classes")
    linked = usable.select("vec_id", *same).join(found, same).select("vec_id", "n_links", "component_id")
    rest = vectors.where(~_usable()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.unionByName(rest)
    return out.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("n_links").cast("long").alias("n_links"), F.col("component_id").cast("long").alias("component_id"),
                      F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))
