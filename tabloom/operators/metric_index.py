"""A metric index for exact nearest neighbours: a tree of pivots over written tables.

Points start in one node.  A node of more than ``leaf_rows`` points is split:
some of its points become pivots, every point moves to the nearest one, and
the new nodes are split in turn, so the tree grows with the data and its
leaves do not.  Of each node its pivot, its number of points, and the distances of
its nearest and farthest point are kept.

A query walks down to the leaf of its nearest pivots.  The k-th distance found
there bounds the answer, and by the triangle inequality only those other nodes
can hold a nearer point whose ring of distances around the pivot comes within
that bound.  Only for them the query is copied, so a query's work follows what
the bound cannot rule out, not the number of points.  In every step queries
meet nodes or leaves by an equality join; a node with many queries is dealt
to several tasks.

The same plan serves batches and streams.  A stream cannot count its queries
first, so there every node's queries are dealt to a fixed number of tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.hashing import key_digest
from tabloom.session import local_table, materialize

METRICS = ("euclidean", "manhattan", "chebyshev")
LEAF_ROWS = 2048
FANOUT = 128
MAX_DEPTH = 12
QUERY_ROWS = 8192
STREAM_PARTS = 4
CHUNK_CELLS = 4_000_000
#: Pairs of queries and points of one task where all points are one leaf.
TASK_CELLS = 8_000_000
_LOOSE = 1e-9


def pair_distances(q: np.ndarray, c: np.ndarray, metric: str) -> np.ndarray:
    """Distances of every row of ``q`` to every row of ``c``, computed coordinate-wise."""
    diff = np.abs(q[:, None, :] - c[None, :, :])
    if metric == "euclidean":
        return np.sqrt(np.einsum("ijk,ijk->ij", diff, diff))
    return diff.sum(axis=2) if metric == "manhattan" else diff.max(axis=2)


def chunks(n_query: int, n_other: int, width: int) -> Iterator[slice]:
    step = max(1, CHUNK_CELLS // max(1, n_other * width))
    for start in range(0, n_query, step):
        yield slice(start, start + step)


def nearest_in_block(q: np.ndarray, c: np.ndarray, ids: np.ndarray, k: int, metric: str,
                     q_ids: np.ndarray | None, bound: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate row, distance) of the k nearest, ties by candidate id.

    Euclidean blocks are first screened by the product form; every pair whose
    screened distance could be among the k best is recomputed directly.
    ``bound`` gives each query a distance beyond which nothing is wanted.
    """
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    by_id = np.argsort(ids, kind="stable")
    c_sorted, ids_sorted = c[by_id], ids[by_id]
    keep = min(k, len(ids))
    if metric == "euclidean":
        norms = np.einsum("ij,ij->i", c_sorted, c_sorted)
    for part in chunks(len(q), len(ids), 1 if metric == "euclidean" else q.shape[1]):
        block = q[part]
        if metric == "euclidean":
            q_norms = np.einsum("ij,ij->i", block, block)
            d = q_norms[:, None] + norms[None, :] - 2 * block @ c_sorted.T
            tolerance = 1e-9 * (q_norms[:, None] + norms.max(initial=0.0) + 1.0)
        else:
            d = pair_distances(block, c_sorted, metric)
            tolerance = np.zeros((len(block), 1))
        if q_ids is not None:
            d[q_ids[part][:, None] == ids_sorted[None, :]] = np.inf
        limit = np.partition(d, keep - 1, axis=1)[:, keep - 1:keep]
        if bound is not None:
            most = bound[part][:, None]
            limit = np.minimum(limit, most * most if metric == "euclidean" else most)
        rows, cols = np.nonzero((d <= limit + tolerance) & np.isfinite(d))
        if metric == "euclidean":
            exact = np.empty(len(rows))
            for piece in chunks(len(rows), 1, q.shape[1]):
                gap = block[rows[piece]] - c_sorted[cols[piece]]
                exact[piece] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
        else:
            exact = d[rows, cols]
        order = np.lexsort((cols, exact, rows))
        rows, cols, exact = rows[order], cols[order], exact[order]
        starts = np.searchsorted(rows, rows, side="left")
        best = np.arange(len(rows)) - starts < k
        found.append((rows[best] + part.start, by_id[cols[best]], exact[best]))
    if not found:
        empty = np.empty(0, dtype=int)
        return empty, empty, np.empty(0)
    return tuple(np.concatenate(x) for x in zip(*found))


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _nearest_pivot(x: np.ndarray, pivots: np.ndarray, metric: str) -> tuple[np.ndarray, np.ndarray]:
    at, dist = np.empty(len(x), dtype=np.int64), np.empty(len(x))
    for part in chunks(len(x), *pivots.shape):
        d = pair_distances(x[part], pivots, metric)
        at[part], dist[part] = d.argmin(axis=1), d.min(axis=1)
    return at, dist


def _plain(table: pa.Table) -> pa.Table:
    """The table with every field nullable, so that all tables a task returns have one schema."""
    return pa.Table.from_arrays(table.columns, schema=pa.schema([pa.field(f.name, f.type) for f in table.schema]))


def _with(table: pa.Table, **columns: np.ndarray | pa.Array) -> pa.Table:
    for name, values in columns.items():
        table = table.set_column(table.schema.get_field_index(name), name, pa.chunked_array([pa.array(values)]).cast(table.schema.field(name).type))
    return table


def ring_bounds(d: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
    """How near to a query a point of a node can be, a little less to be safe against rounding."""
    least = np.maximum(d - far, near - d)
    return least - _LOOSE * (1.0 + np.abs(d) + np.abs(far))


@dataclass
class MetricIndex:
    """``points`` (_leaf, _cid, _vec, kept columns) and ``nodes`` (level, parent, node, pivot, near, far, n)."""

    points: DataFrame
    nodes: DataFrame
    metric: str
    width: int
    depth: int
    n: int

    def spec(self) -> dict:
        return {"metric": self.metric, "width": self.width, "depth": self.depth, "n": self.n}

    def save(self, path: str) -> None:
        self.points.write.mode("overwrite").parquet(f"{path}/points")
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")

    @classmethod
    def load(cls, spark: SparkSession, path: str, spec: dict) -> MetricIndex:
        return cls(spark.read.parquet(f"{path}/points"), spark.read.parquet(f"{path}/nodes"), **spec)

    def level(self, level: int) -> DataFrame:
        return self.nodes.filter(F.col("level") == level).select(F.col("parent").alias("_node"), "node", "pivot", "near", "far", "n")

    def top(self) -> tuple[np.ndarray, ...]:
        """(node, pivots, near, far, n) of the first level, at most ``FANOUT`` nodes."""
        rows = self.level(1).orderBy("node").collect()
        return (np.array([r["node"] for r in rows], dtype=np.int64), np.array([r["pivot"] for r in rows], dtype=float).reshape(-1, self.width),
                *(np.array([r[c] for r in rows], dtype=float) for c in ("near", "far", "n")))


def _kinds(df: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])


def _meet(left: DataFrame, right: DataFrame, fn: Callable, schema: T.StructType, key: str = "_node", rows: int = QUERY_ROWS) -> DataFrame:
    """Cogroup both sides by ``key``; keys with more than ``rows`` rows on the left are dealt to several tasks.

    ``right`` is copied only for keys that are on the left, once per task.
    """
    slot = F.xxhash64("_id")
    if left.isStreaming:
        parts = F.lit(STREAM_PARTS)
        right = right.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
        left = left.withColumn("_part", F.pmod(slot, parts).cast("int"))
    else:
        counted = materialize(left.groupBy(key).agg(F.ceil(F.count("*") / rows).cast("int").alias("_parts")), "visits")
        right = right.join(counted, key).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
        left = left.join(counted, key).withColumn("_part", F.pmod(slot, F.col("_parts")).cast("int")).drop("_parts")
    names = left.drop("_part").columns

    def run(keys: tuple[pa.Scalar, ...], a: pa.Table, b: pa.Table) -> pa.Table:
        return _plain(fn(a.select(names), b))

    return left.groupBy(key, "_part").cogroup(right.groupBy(key, "_part")).applyInArrow(run, schema)


def build_index(points: DataFrame, metric: str, width: int, n: int, *, leaf_rows: int = LEAF_ROWS, fanout: int = FANOUT) -> MetricIndex:
    """The index of ``points`` (_cid, _vec, kept columns), a written table of ``n`` rows without null or non-finite components."""
    spark = points.sparkSession
    if metric not in METRICS:
        raise ValueError(f"metric {metric} not recognized")
    rows = points.withColumns({"_node": F.lit(0).cast("long"), "_path": F.array().cast("array<long>"), "_dists": F.array().cast("array<double>"), "_id": F.col("_cid")})
    chosen, big = [], local_table(spark, [(0, n)] if n > leaf_rows else [], "_node long, _n long")
    for level in range(1, MAX_DEPTH + 1):
        if big.isEmpty():
            break
        order = Window.partitionBy("_node").orderBy(key_digest("_cid", f"pivot{level}"))
        wanted = F.least(F.lit(fanout), F.ceil(F.col("_n") / leaf_rows)).cast("int")
        inside = rows.join(big, "_node")
        # Two conditions, so that each task keeps at most ``fanout`` rows a node before they are gathered.
        pivots = inside.withColumn("_slot", F.row_number().over(order)).filter(F.col("_slot") <= fanout).filter(F.col("_slot") <= wanted)
        pivots = pivots.groupBy("_node", F.col("_vec").alias("pivot")).agg(F.min("_slot").alias("_slot"))
        pivots = materialize(pivots.select("_node", (F.col("_node") * fanout + F.col("_slot")).alias("node"), "pivot"), "pivots")
        chosen.append(pivots.withColumn("level", F.lit(level)))
        rows = materialize(_moved(rows, pivots, metric, width, level), "index")
        big = materialize(rows.filter(F.size("_path") == level).groupBy("_node").agg(F.count("*").alias("_n")).filter(F.col("_n") > leaf_rows), "crowded")
    depth = len(chosen)
    kinds = "level int, parent long, node long, pivot array<double>, near double, far double, n long"
    if depth:
        steps = rows.select(F.explode(F.arrays_zip("_path", "_dists")).alias("s")).groupBy(F.col("s._path").alias("node"))
        facts = steps.agg(F.min("s._dists").alias("near"), F.max("s._dists").alias("far"), F.count("*").alias("n"))
        named = chosen[0]
        for more in chosen[1:]:
            named = named.unionByName(more)
        nodes = materialize(named.join(facts, "node").select("level", F.col("_node").alias("parent"), "node", "pivot", "near", "far", "n"), "nodes")
    else:
        nodes = spark.createDataFrame([], kinds)
    kept = [c for c in points.columns if c not in ("_cid", "_vec")]
    return MetricIndex(rows.select(F.col("_node").alias("_leaf"), "_cid", "_vec", *kept), nodes, metric, width, depth, n)


def _moved(rows: DataFrame, pivots: DataFrame, metric: str, width: int, level: int) -> DataFrame:
    """Points of split nodes move to their nearest pivot and note the distance; others stay."""

    def move(table: pa.Table, nodes: np.ndarray, at: np.ndarray) -> pa.Table:
        to, dist = _nearest_pivot(_matrix(table.column("_vec"), width), at, metric)
        add = lambda name, values: [[*(old or []), v] for old, v in zip(table.column(name).to_pylist(), values)]
        return _with(table, _node=nodes[to], _path=pa.array(add("_path", nodes[to].tolist()), pa.list_(pa.int64())), _dists=pa.array(add("_dists", dist.tolist()), pa.list_(pa.float64())))

    if level == 1:
        found = pivots.orderBy("node").collect()
        nodes, at = np.array([r["node"] for r in found]), np.array([r["pivot"] for r in found], dtype=float)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    yield from _plain(move(pa.Table.from_batches([batch]), nodes, at)).to_batches()

        return rows.mapInArrow(run, _kinds(rows))

    def meet(table: pa.Table, own: pa.Table) -> pa.Table:
        if not own.num_rows or not table.num_rows:
            return table
        return move(table, own.column("node").to_numpy(), _matrix(own.column("pivot"), width))

    return _meet(rows, pivots, meet, _kinds(rows), rows=4 * QUERY_ROWS)


def index_neighbors(index: MetricIndex, queries: DataFrame, k: int, *, exclude_self: bool = False, n_queries: int | None = None) -> DataFrame:
    """(_id, _cid, _d, kept columns, _pay): each query's k nearest points and perhaps some more, not ranked.

    ``queries`` has (_id, _vec, _pay); ``_pay`` stands in one row of each query.
    A batch is a written table.  Ties at the k-th distance are all kept that a
    leaf ranks among its k, so that ranking by distance and id is exact.
    """
    width, metric = index.width, index.metric
    kept = [f for f in index.points.schema.fields if f.name not in ("_leaf", "_cid", "_vec")]
    streaming = queries.isStreaming
    write = (lambda df, label: df) if streaming else materialize
    cid = index.points.schema["_cid"].dataType
    near_kind = T.StructType([T.StructField("_cid", cid), T.StructField("_d", T.DoubleType()), *kept])
    names = ["_cid", "_d", *(f.name for f in kept)]
    q = queries.withColumn("_node", F.lit(0).cast("long"))
    top = index.top() if index.depth else None
    if index.depth:
        nodes, pivots = top[:2]

        def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    at, _ = _nearest_pivot(_matrix(batch.column("_vec"), width), pivots, metric)
                    yield from _plain(_with(pa.Table.from_batches([batch]), _node=nodes[at])).to_batches()

        q = q.mapInArrow(first, _kinds(q))
        for level in range(2, index.depth + 1):

            def down(table: pa.Table, own: pa.Table) -> pa.Table:
                if not own.num_rows or not table.num_rows:
                    return table
                at, _ = _nearest_pivot(_matrix(table.column("_vec"), width), _matrix(own.column("pivot"), width), metric)
                return _with(table, _node=own.column("node").to_numpy()[at])

            q = _meet(write(q, "descent"), index.level(level), down, _kinds(q))
        q = write(q, "own-leaf")
    leaves = index.points.withColumnRenamed("_leaf", "_node")
    bounded = T.StructType([*q.schema.fields, T.StructField("_bound", T.DoubleType()), T.StructField("_best", T.ArrayType(near_kind))])

    def search(table: pa.Table, own: pa.Table, bound: np.ndarray | None = None) -> tuple[np.ndarray, pa.Table]:
        """(query row, near points) in order of the query row."""
        ids = own.column("_cid").to_numpy()
        q_ids = table.column("_id").to_numpy() if exclude_self else None
        rows, cols, dist = nearest_in_block(_matrix(table.column("_vec"), width), _matrix(own.column("_vec"), width), ids, k, metric, q_ids, bound)
        picked = own.take(pa.array(cols))
        return rows, pa.table({"_cid": picked.column("_cid"), "_d": pa.array(dist), **{f.name: picked.column(f.name) for f in kept}})

    def within(table: pa.Table, own: pa.Table) -> pa.Table:
        n = table.num_rows
        if own.num_rows and n:
            rows, near = search(table, own)
            counts = np.bincount(rows, minlength=n)
            last = np.full(n, np.inf)
            full = counts >= k
            last[full] = near.column("_d").to_numpy()[np.cumsum(counts)[full] - 1]
            structs = pa.StructArray.from_arrays([near.column(c).combine_chunks() for c in names], names=names)
            best = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), structs)
            return table.append_column("_bound", pa.array(last)).append_column("_best", best)
        kind = pa.list_(pa.struct([("_cid", own.schema.field("_cid").type), ("_d", pa.float64()), *((f.name, own.schema.field(f.name).type) for f in kept)]))
        return table.append_column("_bound", pa.array(np.full(n, np.inf))).append_column("_best", pa.array([[]] * n, kind))

    if not index.depth and n_queries is not None:
        # One leaf holds all points: the number of tasks follows from the number of queries.
        parts = max(1, ceil(n_queries * index.n / TASK_CELLS))
        q = q.withColumn("_node", F.pmod(F.xxhash64("_id"), F.lit(parts)))
        copies = leaves.withColumn("_node", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
        order = q.columns
        q = q.groupBy("_node").cogroup(copies.groupBy("_node")).applyInArrow(lambda a, b: _plain(within(a.select(order), b)), bounded)
    else:
        q = _meet(q, leaves, within, bounded)
    if not index.depth:
        return q.select("_id", F.explode("_best").alias("b"), "_pay").select("_id", "b.*", "_pay")
    q = write(q, "bounded").withColumns({"_own": F.col("_node"), "_done": F.lit(True)})
    wide = _kinds(q)
    top_nodes, top_pivots, top_near, top_far, top_n = top
    wanted = k + 1 if exclude_self else k

    def survivors(table: pa.Table, nodes: np.ndarray, pivots: np.ndarray, near: np.ndarray, far: np.ndarray, n: np.ndarray | None) -> pa.Table:
        """A row for each node that can hold a point within a query's bound, without the query's own leaf."""
        x, bound, own = _matrix(table.column("_vec"), width), table.column("_bound").to_numpy().copy(), table.column("_own").to_numpy()
        parts = []
        for part in chunks(len(x), *pivots.shape):
            d = pair_distances(x[part], pivots, metric)
            if n is not None:
                # Whole nodes that together hold enough points bound the answer too.
                reach = d + far
                order = np.argsort(reach, axis=1)
                enough = (np.cumsum(n[order], axis=1) >= wanted)
                sure = np.where(enough.any(axis=1), np.take_along_axis(reach, np.take_along_axis(order, enough.argmax(axis=1)[:, None], 1), 1)[:, 0], np.inf)
                bound[part] = np.minimum(bound[part], sure * (1 + _LOOSE) + _LOOSE)
            rows, cols = np.nonzero((ring_bounds(d, near, far) <= bound[part][:, None]) & (nodes[None, :] != own[part][:, None]))
            parts.append((rows + part.start, cols))
        rows, cols = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in (0, 1))
        out = table.select(["_id", "_vec", "_own"]).take(pa.array(rows))
        fields = {"_id": out.column("_id"), "_vec": out.column("_vec"), "_own": out.column("_own"), "_node": pa.array(nodes[cols]), "_bound": pa.array(bound[rows]), "_done": pa.array(np.zeros(len(rows), bool))}
        return pa.table({f.name: fields[f.name].cast(f.type) if f.name in fields and not pa.types.is_list(f.type) else fields.get(f.name, pa.nulls(len(rows), f.type)) for f in table.schema})

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch])
                yield from _plain(table).to_batches()
                yield from _plain(survivors(table, top_nodes, top_pivots, top_near, top_far, top_n)).to_batches()

    tiles = q.mapInArrow(spread, wide)
    for level in range(2, index.depth + 1):

        def deeper(table: pa.Table, own: pa.Table) -> pa.Table:
            done = table.column("_done").to_numpy()
            if not own.num_rows or done.all():
                return table
            kids = (own.column("node").to_numpy(), _matrix(own.column("pivot"), width), own.column("near").to_numpy(), own.column("far").to_numpy(), None)
            return pa.concat_tables([table.filter(pa.array(done)), survivors(table.filter(pa.array(~done)), *kids)])

        tiles = _meet(write(tiles, "tiles"), index.level(level), deeper, wide)
    flat = T.StructType([wide["_id"], *near_kind.fields, wide["_pay"]])

    def far_off(table: pa.Table, own: pa.Table) -> pa.Table:
        done = table.column("_done").to_numpy()
        first = table.filter(pa.array(done))
        best = first.column("_best").combine_chunks() if first.num_rows else None
        parts = []
        if first.num_rows:
            counts = np.diff(best.offsets.to_numpy())
            rows = np.repeat(np.arange(first.num_rows), counts)
            inner = best.flatten()
            head = np.zeros(len(rows), bool)
            head[(np.cumsum(counts) - counts)[counts > 0]] = True
            pay = first.column("_pay").combine_chunks().take(pa.array(rows, mask=~head))
            parts.append([first.column("_id").combine_chunks().take(pa.array(rows)), *(inner.field(c) for c in range(len(names))), pay])
        rest = table.filter(pa.array(~done))
        if rest.num_rows and own.num_rows:
            rows, near = search(rest, own, rest.column("_bound").to_numpy() * (1 + _LOOSE) + _LOOSE)
            parts.append([rest.column("_id").combine_chunks().take(pa.array(rows)), *(near.column(c).combine_chunks() for c in names), pa.nulls(len(rows), table.schema.field("_pay").type)])
        columns = ["_id", *names, "_pay"]
        if not parts:
            kinds = [table.schema.field("_id").type, own.schema.field("_cid").type, pa.float64(), *(own.schema.field(f.name).type for f in kept), table.schema.field("_pay").type]
            return pa.table({c: pa.array([], kind) for c, kind in zip(columns, kinds)})
        return pa.concat_tables([pa.table(dict(zip(columns, p))) for p in parts])

    return _meet(write(tiles, "tiles"), leaves, far_off, flat)


def visited_leaves(index: MetricIndex, queries: DataFrame, bound: str) -> DataFrame:
    """(_id, n): how many leaves can hold a point within a query's ``bound``, from the index alone; for judging an index of one level."""
    nodes, pivots, near, far, _ = index.top()
    width, metric = index.width, index.metric

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = pair_distances(_matrix(batch.column("_vec"), width), pivots, metric)
            n = (ring_bounds(d, near, far) <= batch.column(bound).to_numpy()[:, None]).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(n, pa.int64())], names=["_id", "n"])

    kind = T.StructType([queries.schema["_id"], T.StructField("n", T.LongType())])
    return queries.select("_id", "_vec", bound).mapInArrow(run, kind)
