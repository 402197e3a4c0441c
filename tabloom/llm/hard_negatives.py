"""Hard-negative mining by exact integer products of anchor and candidate tiles.

Anchors and candidates are dealt into blocks by digest, whatever their labels,
so no label is a hot key.  Every pair of blocks is one tile: a task multiplies
its two int64 matrices by Strassen's recursion (odd sides are padded with a
zero row or column) and keeps the few best candidates of each anchor.  These
heaps are merged by rank, first where they were made and then per anchor.  The
first pass finds each anchor's positives; their scores bound the windows that
the second pass fills with candidates of other labels.

Sums and products are those of the ring of integers modulo 2**64, so they are
exact wherever the true score fits a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.joins import short_list
from tabloom.session import materialize

POSITIVES = 5
NEGATIVES = 5
LOW, HIGH, OF = 80, 100, 100
ANCHOR_ROWS, CANDIDATE_ROWS = 512, 4096
TILE_BYTES = 16 << 20
_LEAF = 32
_LEAST = np.iinfo(np.int64).min
_LEFT, _RIGHT = 0, 1


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = _LEAF) -> np.ndarray:
    """The product of two int64 matrices by seven half-size products a level, down to a side of ``leaf``."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        a = np.pad(a, ((0, m % 2), (0, k % 2)))
        b = np.pad(b, ((0, k % 2), (0, n % 2)))
        return strassen(a, b, leaf)[:m, :n]
    i, j, h = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :h], b[:j, h:], b[j:, :h], b[j:, h:]
    out = np.empty((m, n), dtype=np.int64)
    p = strassen(a11 + a22, b11 + b22, leaf)
    out[:i, :h] = p
    out[i:, h:] = p
    p = strassen(a21 + a22, b11, leaf)
    out[i:, :h] = p
    out[i:, h:] -= p
    p = strassen(a11, b12 - b22, leaf)
    out[:i, h:] = p
    out[i:, h:] += p
    p = strassen(a22, b21 - b11, leaf)
    out[:i, :h] += p
    out[i:, :h] += p
    p = strassen(a11 + a12, b22, leaf)
    out[:i, :h] -= p
    out[:i, h:] += p
    out[i:, h:] += strassen(a21 - a11, b11 + b12, leaf)
    out[:i, :h] += strassen(a12 - a22, b21 + b22, leaf)
    return out


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, columns) of each row's best, second best ... allowed score, the first column of equal ones; ``allowed`` is used up."""
    work = np.where(allowed, scores, _LEAST)
    rows = np.arange(len(scores))
    for _ in range(k):
        at = work.argmax(axis=1)
        found = allowed[rows, at]
        if not found.any():
            return
        yield rows[found], at[found]
        work[rows, at] = _LEAST
        allowed[rows, at] = False


def integer_vectors(vectors: DataFrame, scale: float) -> DataFrame:
    """(vec_id, label, anchor, size, x): rows with an id, a label and only finite components, each scaled and rounded down to a long."""
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = vectors.where(F.coalesce(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & fine, F.lit(False)))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.coalesce("anchor", F.lit(False)).alias("anchor"),
                       F.size("embedding").alias("size"), F.transform("embedding", lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("x"))


def _blocks(rows: DataFrame, n: str) -> Column:
    return F.pmod(F.xxhash64("row"), F.col(n)).cast("int")


def _tiles(anchors: DataFrame, candidates: DataFrame, sizes: DataFrame) -> DataFrame:
    """Every anchor once per block of candidates and every candidate once per block of anchors, by vector size."""
    left = anchors.join(sizes, "size").withColumn("left", _blocks(anchors, "anchor_blocks")).withColumn("right", F.explode(F.sequence(F.lit(0), F.col("candidate_blocks") - 1)))
    right = candidates.join(sizes, "size").withColumn("right", _blocks(candidates, "candidate_blocks")).withColumn("left", F.explode(F.sequence(F.lit(0), F.col("anchor_blocks") - 1)))
    empty = F.array().cast("array<long>")
    names = ["size", "left", "right", "side", "row", "vec_id", "label", "x", "wanted"]
    return left.withColumn("side", F.lit(_LEFT)).select(names).unionByName(right.withColumns({"side": F.lit(_RIGHT), "wanted": empty}).select(names))


def _sides(table: pa.Table, size: int) -> tuple[pa.Table, pa.Table, np.ndarray]:
    """(anchors, candidates, scores) of a tile, both sides in order of vec_id."""
    side = table.column("side").to_numpy()
    parts = [table.filter(pa.array(side == s)).sort_by([("vec_id", "ascending"), ("row", "ascending")]) for s in (_LEFT, _RIGHT)]
    matrices = [p.column("x").combine_chunks().flatten().to_numpy().reshape(p.num_rows, size) for p in parts]
    return parts[0], parts[1], strassen(matrices[0], np.ascontiguousarray(matrices[1].T)) if all(p.num_rows for p in parts) else np.zeros((0, 0), np.int64)


_HEAP = "anchor_row long, anchor_id long, place int, row long, vec_id long, score long"


def _heap(anchors: pa.Table, candidates: pa.Table, scores: np.ndarray, found: list[tuple[np.ndarray, np.ndarray, int]]) -> pa.Table:
    i, j = (np.concatenate([f[n] for f in found]) if found else np.zeros(0, np.int64) for n in (0, 1))
    place = np.concatenate([np.full(len(f[0]), f[2]) for f in found]) if found else np.zeros(0, np.int64)
    take = lambda table, name, at: table.column(name).to_numpy()[at]
    return pa.table({"anchor_row": take(anchors, "row", i), "anchor_id": take(anchors, "vec_id", i), "place": pa.array(place, pa.int32()), "row": take(candidates, "row", j),
                     "vec_id": take(candidates, "vec_id", j), "score": scores[i, j] if len(i) else np.zeros(0, np.int64)})


def _merged(heaps: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of all heaps of an anchor and place, by score and then vec_id, numbered from 1."""
    order = Window.partitionBy("anchor_row", "place").orderBy(F.desc("score"), "vec_id", "row")
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column | None = None, scale: float = 256.0, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   window: tuple[int, int, int] = (LOW, HIGH, OF), anchor_rows: int = ANCHOR_ROWS, candidate_rows: int = CANDIDATE_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows of ``vectors`` (vec_id, embedding, label).

    A score is the integer product of two vectors whose components are scaled
    and rounded down; higher ones come first, ties by smaller vec_id.  An
    anchor's positives are its best ``positives`` other rows of its label.  For
    each, the negatives are the best rows of another label whose score is
    between ``window[0] / window[2]`` and ``window[1] / window[2]`` of the
    positive's.  ``is_anchor`` and ``label`` are columns over ``vectors``.

    Rows without vec_id, label or vector, or with a null or non-finite
    component, take no part.  Vectors of different sizes never meet; those of
    size 0 all score 0.  Rows that repeat a vec_id are rows of their own, as
    anchors and as others.  A component beyond a long is cut to its range.
    Other columns are not read.
    """
    chosen = vectors.select("vec_id", "embedding", (F.col("label") if label is None else label).alias("label"), is_anchor.alias("anchor"))
    # Written, so that the number of a row stays.
    rows = materialize(integer_vectors(chosen, scale).withColumn("row", F.monotonically_increasing_id()), "vectors")
    per_block = lambda most: F.greatest(F.lit(32), F.least(F.lit(most), (F.lit(TILE_BYTES) / (8 * F.greatest(F.col("size"), F.lit(1)))).cast("int")))
    counted = rows.groupBy("size").agg(F.count("*").alias("n"), F.count_if("anchor").alias("n_anchors")).where("n_anchors > 0")
    sizes = short_list(materialize(counted.select("size", F.ceil(F.col("n_anchors") / per_block(anchor_rows)).cast("int").alias("anchor_blocks"),
                                                  F.ceil(F.col("n") / per_block(candidate_rows)).cast("int").alias("candidate_blocks")), "sizes"))
    no_window = F.array().cast("array<long>")
    anchors, candidates = rows.where("anchor").withColumn("wanted", no_window), rows
    low, high, of = window

    def same_label(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        a, c, scores = _sides(table, key[0].as_py())
        found = []
        if scores.size:
            allowed = (a.column("label").to_numpy()[:, None] == c.column("label").to_numpy()) & (a.column("row").to_numpy()[:, None] != c.column("row").to_numpy())
            found = [(i, j, 0) for i, j in best(scores, allowed, positives)]
        return _heap(a, c, scores, found)

    def other_label(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        a, c, scores = _sides(table, key[0].as_py())
        found = []
        if scores.size:
            others = a.column("label").to_numpy()[:, None] != c.column("label").to_numpy()
            wanted = a.column("wanted").to_pylist()
            for place in range(max(map(len, wanted))):
                at = np.array([k for k, w in enumerate(wanted) if len(w) > place])
                # of * score >= low * positive, without leaving the range of a long.
                bounds = [(-(-low * wanted[k][place] // of), high * wanted[k][place] // of) for k in at]
                least, most = (np.array([max(_LEAST, min(b[n], 2**63 - 1)) for b in bounds])[:, None] for n in (0, 1))
                some = scores[at]
                allowed = others[at] & (some >= least) & (some <= most)
                found += [(at[i], j, place) for i, j in best(some, allowed, negatives)]
        return _heap(a, c, scores, found)

    tile = ["size", "left", "right"]
    near = materialize(_merged(_tiles(anchors, candidates, sizes).groupBy(*tile).applyInArrow(same_label, _HEAP), positives), "positives")
    # At most ``positives`` numbers an anchor.
    wanted = near.groupBy(F.col("anchor_row").alias("row")).agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("w")).select("row", F.transform("w", lambda v: v["score"]).alias("wanted"))
    asking = rows.where("anchor").join(wanted, "row")
    heaps = _tiles(asking, candidates, sizes).groupBy(*tile).applyInArrow(other_label, _HEAP)
    far = _merged(heaps, negatives).select("anchor_row", (F.col("place") + 1).alias("place"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    known = near.select("anchor_row", F.col("rank").alias("place"), "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return far.join(known, ["anchor_row", "place"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


#: The same rows straight from the table, for anchors divisible by 100.
NEGATIVES_SQL = """
with usable as (
    select row_number() over () as r, vec_id, cast(case when vec_id % 7 = 0 then (label + 1) % 10 else label end as bigint) as label,
        [floor(256 * cast(x as double)) for x in embedding] as v
    from embeddings
    where label is not null and vec_id is not null and embedding is not null
        and coalesce(list_bool_and([x is not null and isfinite(x) for x in embedding]), true)
),
pairs as (
    select a.r as a, a.vec_id as anchor_id, b.r as b, b.vec_id, a.label = b.label as alike, cast(list_inner_product(a.v, b.v) as bigint) as score
    from usable a join usable b on a.r <> b.r and len(a.v) = len(b.v) where a.vec_id % 100 = 0
),
positives as (select *, row_number() over (partition by a order by score desc, vec_id) as place from pairs where alike),
met as (
    select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id, p.score as positive_score, n.score as negative_score,
        row_number() over (partition by p.a, p.place order by n.score desc, n.vec_id) as rank
    from positives p join pairs n on p.a = n.a and not n.alike and 80 * p.score <= 100 * n.score and 100 * n.score <= 100 * p.score
    where p.place <= 5
)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from met where rank <= 5
"""
