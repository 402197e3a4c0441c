"""Exact nearest neighbours where an index rules out little: blocks of queries sweep over all blocks of points.

In many dimensions an index copies a query to almost every leaf, so its
tables grow with the product of both sides.  Here both sides are packed into
blocks of bounded size and shuffled once; a task takes a block of queries,
reads the blocks of points one after another and keeps each query's k best.
Every pair is compared, as the exact answer needs, but only the best become
rows: disk follows the queries and the points, memory the blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.hashing import key_digest
from tabloom.operators.metric_index import FANOUT, chunks, pair_distances, ring_bounds
from tabloom.session import materialize

#: Rows of a block of queries and of one of points, and cells (rows times features) of either.
QUERY_BLOCK, POINT_BLOCK, BLOCK_CELLS = 4096, 2048, 1 << 18
#: Tasks that are wanted for each core, and the fewest rows of a block of queries for the sake of that.
TASKS_PER_CORE, LEAST_BLOCK = 4, 256
#: Cells of the points that a task reads from one partition before it goes on to the next.
PART_CELLS = 1 << 21
#: Pairs whose screened distances are held at once.
SCREEN_PAIRS = 1 << 17
#: Features after which the pairs that are still within their limits are counted, and the share of them that is compared at once.
SCREEN_STEP, SCREEN_LEFT = 8, 1 / 32
#: Points and queries that tell whether an index helps, and the share of nodes it may visit.
SAMPLE_POINTS, SAMPLE_QUERIES, SAMPLE_CELLS, VISITED = 8192, 128, 1 << 20, 0.5
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def index_helps(points: DataFrame, queries: DataFrame, metric: str, width: int) -> bool:
    """Whether a tree of pivots rules out half of its nodes or more, judged by a sample; results do not depend on it."""
    def some(rows: DataFrame, key: str, n: int) -> np.ndarray:
        taken = rows.orderBy(key_digest(key, "sweep")).limit(max(1, min(n, SAMPLE_CELLS // max(1, width)))).select("_vec").collect()
        return np.array([r["_vec"] for r in taken], dtype=float).reshape(len(taken), width)

    x, q = some(points, "_cid", SAMPLE_POINTS), some(queries, "_id", SAMPLE_QUERIES)
    n_pivots = max(1, min(FANOUT // 4, len(x) // 8))
    pivots, rest = x[:n_pivots], x[n_pivots:]
    if not len(q) or not len(rest):
        return True
    at, dist = (np.concatenate(found) for found in zip(*((d.argmin(axis=1), d.min(axis=1)) for d in (
        pair_distances(rest[part], pivots, metric) for part in chunks(len(rest), *pivots.shape)))))
    near, far = np.full(n_pivots, np.inf), np.zeros(n_pivots)
    np.minimum.at(near, at, dist)
    np.maximum.at(far, at, dist)
    bound = np.concatenate([pair_distances(q[part], rest, metric).min(axis=1) for part in chunks(len(q), *rest.shape)])
    visited = ring_bounds(pair_distances(q, pivots, metric), near, far) <= bound[:, None]
    return bool(visited.mean() <= VISITED)


def _packed(rows: DataFrame, width: int, size: int) -> DataFrame:
    """(_key, _vecs, an array for each other column): ``rows`` in blocks of ``size`` and fewer; vectors take 4 bytes a value where those hold them exactly."""
    others = [f for f in rows.schema.fields if f.name != "_vec"]

    def block(table: pa.Table, serial: int) -> pa.RecordBatch:
        whole = table.column("_vec").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        short = whole.astype(np.float32)
        vecs = (short if (short == whole).all() else whole).tobytes()
        ends = pa.array([0, table.num_rows], pa.int32())
        arrays = [pa.ListArray.from_arrays(ends, table.column(f.name).combine_chunks()) for f in others]
        key = (TaskContext.get().partitionId() << 32) + serial
        return pa.RecordBatch.from_arrays([pa.array([key]), pa.array([vecs], pa.binary()), *arrays], names=["_key", "_vecs", *(f.name for f in others)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, serial = [], 0, 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= size:
                whole = pa.Table.from_batches(held)
                for start in range(0, n - n % size, size):
                    yield block(whole.slice(start, size), serial)
                    serial += 1
                held, n = whole.slice(n - n % size).to_batches(), n % size
        if n:
            yield block(pa.Table.from_batches(held), serial)

    kind = T.StructType([T.StructField("_key", T.LongType()), T.StructField("_vecs", T.BinaryType()), *(T.StructField(f.name, T.ArrayType(f.dataType)) for f in others)])
    return rows.mapInArrow(run, kind)


def _unpacked(vecs: pa.Scalar, n: int, width: int) -> np.ndarray:
    data = vecs.as_buffer()
    return np.frombuffer(data, np.float32 if data.size == 4 * n * width else np.float64).reshape(n, width).astype(float)


def _screened(x: np.ndarray, c: np.ndarray, metric: str, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distances of all pairs, squared if euclidean, and how far those of a row may be off).

    Sums and maxima only grow with the features, so they end where few pairs are within their limits.
    """
    if metric == "euclidean":
        x_norms, c_norms = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", c, c)
        d = (-2 * x) @ c.T
        d += x_norms[:, None]
        d += c_norms
        return d, 2e-9 * (x_norms + c_norms.max(initial=0.0) + 1.0)
    width = x.shape[1]
    scale = np.abs(x).max(initial=0.0) + np.abs(c).max(initial=0.0)
    # Bounds the rounding of values, and of sums, in single precision.
    off = ((width + 2) ** 2 if metric == "manhattan" else 1) * 2.0 ** -21 * scale
    single = 1e-30 < scale < 1e30 and off <= 1e-3 * np.median(limit) < np.inf
    kind = np.float32 if single else np.float64
    a, b = np.ascontiguousarray(x.T, dtype=kind), np.ascontiguousarray(c.T, dtype=kind)
    off = np.full(len(x), off if single else off * 2.0 ** -29)
    d, step = np.zeros((len(x), len(c)), kind), np.empty((len(x), len(c)), kind)
    most = (limit + off).astype(kind)[:, None]
    # Rounding to single precision may not lower a limit.
    most = np.nextafter(most, kind(np.inf))
    ends = bool(np.isfinite(limit).all())
    fold = np.add if metric == "manhattan" else np.maximum
    for j in range(width):
        np.subtract(a[j][:, None], b[j], out=step)
        np.abs(step, out=step)
        fold(d, step, out=d)
        if ends and j % SCREEN_STEP == SCREEN_STEP - 1 and np.count_nonzero(d <= most) <= SCREEN_LEFT * d.size:
            break
    return d, off


class _Nearest:
    """The best points so far of each query of a block."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, k: int, metric: str, exclude_self: bool):
        self.x, self.ids, self.k, self.metric, self.exclude_self = x, ids, k, metric, exclude_self
        self.limit = np.full(len(x), np.inf)
        self.found: list[tuple[np.ndarray, np.ndarray, pa.Table]] = []
        self.loose = 0

    def meet(self, c: np.ndarray, near: pa.Table) -> None:
        ids = near.column("_cid").to_numpy() if self.exclude_self else None
        wanted = self.k + 1 if self.exclude_self else self.k
        step = max(1, SCREEN_PAIRS // max(1, len(c)))
        for start in range(0, len(self.x), step):
            x, limit = self.x[start:start + step], self.limit[start:start + step]
            d, off = _screened(x, c, self.metric, limit)
            most = (limit * limit if self.metric == "euclidean" else limit) + off
            if np.isinf(limit).any() and wanted <= len(c):
                most = np.minimum(most, np.partition(d, wanted - 1, axis=1)[:, wanted - 1] + 2 * off)
            rows, cols = np.nonzero((d <= most[:, None]) & np.isfinite(d))
            exact = np.empty(len(rows))
            for piece in chunks(len(rows), 1, x.shape[1]):
                gap = np.abs(x[rows[piece]] - c[cols[piece]])
                if self.metric == "euclidean":
                    exact[piece] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
                else:
                    exact[piece] = gap.sum(axis=1) if self.metric == "manhattan" else gap.max(axis=1)
            stay = exact <= limit[rows]
            if ids is not None:
                stay &= self.ids[rows + start] != ids[cols]
            self.found.append((rows[stay] + start, exact[stay], near.take(pa.array(cols[stay]))))
            self.loose += int(stay.sum())
            if self.loose >= len(self.x):
                self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray, pa.Table]:
        """(query row, distance, point) of the k best found, by distance and id."""
        rows, d = (np.concatenate([f[i] for f in self.found]) for i in (0, 1))
        near = pa.concat_tables([f[2] for f in self.found])
        rank = np.empty(len(rows), np.int64)
        rank[np.argsort(near.column("_cid").to_numpy(), kind="stable")] = np.arange(len(rows))
        order = np.lexsort((rank, d, rows))
        place = np.arange(len(rows)) - np.searchsorted(rows[order], rows[order], side="left")
        last, order = order[place == self.k - 1], order[place < self.k]
        self.limit[rows[last]] = d[last]
        best = rows[order], d[order], near.take(pa.array(order)).combine_chunks()
        self.found, self.loose = [best], 0
        return best


@contextmanager
def _one_row_batches(spark: SparkSession):
    """Rows of packed blocks are sent to Python one at a time."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, "1")
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def sweep_neighbors(points: DataFrame, queries: DataFrame, k: int, metric: str, width: int, n: int, n_queries: int, *, exclude_self: bool = False) -> DataFrame:
    """(_id, _cid, _d, kept columns): the k nearest of ``points`` (_cid, _vec, kept columns) for each of ``queries`` (_id, _vec), and perhaps some more, not ranked.

    Both are written tables of ``n`` and ``n_queries`` rows without null or non-finite components.
    """
    spark = points.sparkSession
    kept = [f for f in points.schema.fields if f.name not in ("_cid", "_vec")]
    names = ["_cid", *(f.name for f in kept)]
    cells = max(1, BLOCK_CELLS // max(1, width))
    q_size, c_size = min(QUERY_BLOCK, cells), min(POINT_BLOCK, cells)
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    q_size = max(min(q_size, LEAST_BLOCK), min(q_size, ceil(n_queries / tasks)))
    q_parts, c_parts = max(1, ceil(n_queries / q_size)), max(1, ceil(n * width / PART_CELLS))
    # Few blocks of queries would be few tasks, so each then sweeps over a share of the points.
    shares = min(c_parts, max(1, ceil(tasks / q_parts)))
    asking = _packed(queries.select("_id", "_vec"), width, q_size).withColumnsRenamed({"_key": "_block", "_vecs": "_asked"})
    asking = asking.repartitionByRange(q_parts, "_block")
    packed = _packed(points, width, c_size).repartitionByRange(c_parts, "_key")
    schema = T.StructType([queries.schema["_id"], points.schema["_cid"], T.StructField("_d", T.DoubleType()), *kept])
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, tuple[pa.Array, _Nearest]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                key = batch.column("_block")[i].as_py()
                if key not in blocks:
                    ids = batch.column("_id")[i].values
                    blocks[key] = ids, _Nearest(_unpacked(batch.column("_asked")[i], len(ids), width), ids.to_numpy(zero_copy_only=False), k, metric, exclude_self)
                near = pa.table({name: batch.column(name)[i].values for name in names})
                blocks[key][1].meet(_unpacked(batch.column("_vecs")[i], near.num_rows, width), near)
        for ids, best in blocks.values():
            rows, d, near = best.settle()
            out = pa.table({"_id": ids.take(pa.array(rows)), "_cid": near.column("_cid"), "_d": pa.array(d), **{name: near.column(name) for name in names[1:]}})
            yield from out.to_batches(max_chunksize=1 << 16)

    with _one_row_batches(spark):
        pairs = asking.hint("shuffle_replicate_nl").crossJoin(packed)
        return materialize(pairs.coalesce(q_parts * shares).mapInArrow(run, schema), "swept")
