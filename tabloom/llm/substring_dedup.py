"""Substring dedup: words covered by a window that also starts in an earlier document are removed.

Three passes over the texts, none of which collects windows:

1. *Sketch.*  Every window of ``window`` words is represented by its anchor,
   the smallest hash among the shorter ``anchor``-word runs inside it.  Equal
   windows have equal anchors, so an anchor's count is never below the count
   of its windows, and there is about one anchor per twenty words.  Each
   partition counts its anchors in a count-min sketch (two rows of cells, cut
   into shards); the partition sketches are merged by shard.
2. *Exact grouping.*  Only windows whose anchor is estimated to occur more
   than once are hashed, shuffled and grouped, by two independent digests of
   96 bits together; a window used once may get this far, a repeated one
   always does.
3. *Removal.*  Starts of repeated windows go back to their documents, which
   lose the covered words.

The merged sketch has one bit per cell (the count is above one) and at most
``max_cells`` cells a row.  Past that size more windows pass the filter, which
costs time and never a result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.joins import short_list
from tabloom.llm.words import bound_batches, mix, split_words, text_slices, window_hashes, word_hashes
from tabloom.session import materialize

WINDOW = 50
ANCHOR = 8
SHARD_CELLS = 1 << 18
MAX_CELLS = 1 << 30
SKETCH_ROWS = 2
_FLUSH = 1 << 22


def anchors_of(hashes: np.ndarray, bounds: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window hash, index of its first word, its anchor) of every window in every text."""
    windows, first = window_hashes(hashes, bounds, window)
    if not len(windows):
        return windows, first, windows
    runs, at = window_hashes(hashes, bounds, anchor)
    spread = np.full(len(hashes), np.iinfo(np.uint64).max, dtype=np.uint64)
    spread[at] = mix(runs)
    # The minimum over window - anchor + 1 consecutive runs, by doubling.
    span, reach = window - anchor + 1, 1
    low = spread
    while reach * 2 <= span:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if reach < span:
        low = np.minimum(low[:len(low) - (span - reach)], low[span - reach:])
    return windows, first, low[first]


def cell_of(anchors: np.ndarray, row: int, cells: int) -> np.ndarray:
    return mix(anchors + np.uint64(0xA24BAED4963EE407 * (row + 1) % 2**64)) & np.uint64(cells - 1)


def sketch_cells(n_words: int, window: int, anchor: int, max_cells: int) -> int:
    """A power of two, about four cells for each anchor expected, one shard at least."""
    wanted = 4 * max(1, 2 * n_words // (window - anchor + 2))
    return min(max_cells, max(SHARD_CELLS, 1 << (wanted - 1).bit_length()))


def partition_sketches(docs: DataFrame, cells: int, window: int, anchor: int) -> DataFrame:
    """(sketch_row, shard, cells): per partition the cells of its anchors; a cell used twice is listed twice.

    An anchor shared by overlapping windows of one place counts once, so a
    window that occurs once does not pass on its own account.
    """

    def emit(values):
        anchors = np.concatenate(values)
        for row in range(SKETCH_ROWS):
            cell = np.sort(cell_of(anchors, row, cells))
            twice = np.concatenate([[False], cell[1:] == cell[:-1]])
            third = np.concatenate([[False, False], cell[2:] == cell[:-2]]) if len(cell) > 1 else twice
            cell = cell[~(twice & third)]
            shard = (cell // np.uint64(SHARD_CELLS)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(shard)) + 1
            parts = np.split((cell % np.uint64(SHARD_CELLS)).astype(np.uint32), cuts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row] * len(parts), pa.int32()), pa.array(shard[np.concatenate([[0], cuts]).astype(int)], pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())],
                names=["sketch_row", "shard", "cells"])

    def run(batches):
        held, size = [], 0
        for batch in text_slices(batches):
            words = split_words(batch.column("text"))
            _, first, anchor_of = anchors_of(word_hashes(words), words.bounds, window, anchor)
            if len(anchor_of):
                # Neighbouring windows with one anchor are one place; a new text starts a new place.
                text = np.searchsorted(words.bounds, first, side="right")
                new = np.concatenate([[True], (anchor_of[1:] != anchor_of[:-1]) | (text[1:] != text[:-1])])
                held.append(anchor_of[new])
                size += int(new.sum())
            if size >= _FLUSH:
                yield from emit(held)
                held, size = [], 0
        if held:
            yield from emit(held)

    return docs.select("text").mapInArrow(run, "sketch_row int, shard long, cells binary")


def merged_sketch(parts: DataFrame) -> DataFrame:
    """(sketch_row, shard, bits): which cells of a shard were used more than once in all partitions together."""

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SHARD_CELLS, dtype=np.uint8)
        for batch in batches:
            for packed in batch.column("cells"):
                cell = np.frombuffer(packed.as_buffer(), dtype=np.uint32)
                counts[:] = np.minimum(counts + np.bincount(cell, minlength=SHARD_CELLS).clip(0, 2).astype(np.uint8), 2)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int64()), pa.array([np.packbits(counts > 1).tobytes()], pa.binary())], names=["sketch_row", "shard", "bits"])

    return parts.groupBy("sketch_row", "shard").applyInArrow(merge, "sketch_row int, shard long, bits binary")


def _sketch_bits(sketch: DataFrame, cells: int) -> np.ndarray:
    """The merged sketch as one bit array per row: cells / 8 bytes each, bounded by ``max_cells``."""
    bits = np.zeros((SKETCH_ROWS, cells // 8), dtype=np.uint8)
    step = SHARD_CELLS // 8
    for r in sketch.toLocalIterator():
        bits[r["sketch_row"], r["shard"] * step:(r["shard"] + 1) * step] = np.frombuffer(r["bits"], dtype=np.uint8)
    return bits


def suspected_windows(docs: DataFrame, bits, cells: int, window: int, anchor: int) -> DataFrame:
    """(hash, hash2, doc_id, start) of the windows whose anchor the sketch counts more than once."""

    def run(batches):
        seen = bits.value
        for batch in text_slices(batches):
            words = split_words(batch.column("text"))
            windows, first, anchor_of = anchors_of(word_hashes(words), words.bounds, window, anchor)
            again, _ = window_hashes(word_hashes(words, 1), words.bounds, window)
            keep = np.ones(len(windows), dtype=bool)
            for row in range(SKETCH_ROWS):
                cell = cell_of(anchor_of, row, cells)
                keep &= (seen[row][cell >> np.uint64(3)] >> (np.uint8(7) - (cell & np.uint64(7)).astype(np.uint8))) & 1 == 1
            first = first[keep]
            text = np.searchsorted(words.bounds, first, side="right") - 1
            ids = batch.column("doc_id").cast(pa.int64()).take(pa.array(text))
            columns = [pa.array(windows[keep].view(np.int64)), pa.array((again[keep] >> np.uint64(32)).astype(np.uint32).view(np.int32)), ids, pa.array((first - words.bounds[text]).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["hash", "hash2", "doc_id", "start"])

    return docs.select("doc_id", "text").mapInArrow(run, "hash long, hash2 int, doc_id long, start int")


def repeated_starts(windows: DataFrame) -> DataFrame:
    """(doc_id, first, last): first words of the windows that also start in a document of smaller doc_id, as runs of consecutive ones."""
    # Written, so that the join below deals both sides anew and a hot window's rows can be split over tasks.
    origin = materialize(windows.groupBy("hash", "hash2").agg(F.min("doc_id").alias("origin"), F.max("doc_id").alias("last"))
                         .where("last > origin").drop("last"), "origins")
    later = windows.join(origin, ["hash", "hash2"]).where("doc_id > origin").select("doc_id", "start")
    starts = later.groupBy("doc_id").agg(F.array_sort(F.collect_set("start")).alias("s"))
    first = F.filter("s", lambda x, i: (i == 0) | (F.get(F.col("s"), i - 1) != x - 1))
    last = F.filter("s", lambda x, i: (i == F.size("s") - 1) | (F.get(F.col("s"), i + 1) != x + 1))
    return starts.select("doc_id", first.alias("first"), last.alias("last"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, max_cells: int = MAX_CELLS, with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept_text]) for every row of ``docs`` (doc_id, text).

    Words are maximal runs of characters other than space and 0x09-0x0D.  A
    null or empty text has no words and the digest of the empty string.  A
    window never spans two rows.  Rows that repeat a doc_id see only windows
    of smaller doc_ids, not each other.  Null doc_ids sort before all others:
    their rows keep every word and remove nothing elsewhere.  Other columns
    are not read.  Rows that repeat a doc_id are expected to repeat its text.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    named = docs.where("doc_id is not null")
    n_words = _estimated_words(named)
    cells = sketch_cells(n_words, window, anchor, max_cells)
    sketch = materialize(merged_sketch(partition_sketches(named, cells, window, anchor)), "sketch")
    bits = spark.sparkContext.broadcast(_sketch_bits(sketch, cells))
    # Made for the grouping and again for the join: that costs less than a table of all of them.
    windows = suspected_windows(named, bits, cells, window, anchor)
    starts = materialize(repeated_starts(windows), "starts")
    joined = docs.select("doc_id", "text").join(short_list(starts), "doc_id", "left")
    kind = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if with_text else "")

    def run(batches):
        for batch in text_slices(batches):
            words = split_words(batch.column("text"))
            counts, removed, digests, texts = [], [], [], []
            for k, (first, last) in enumerate(zip(batch.column("first"), batch.column("last"))):
                lo, hi = int(words.bounds[k]), int(words.bounds[k + 1])
                left = np.ones(hi - lo, dtype=bool)
                if first.is_valid:
                    edges = np.zeros(hi - lo + 1, dtype=np.int64)
                    starts, ends = first.values.to_numpy(), last.values.to_numpy() + window
                    fits = ends <= hi - lo
                    np.add.at(edges, starts[fits], 1)
                    np.add.at(edges, ends[fits], -1)
                    left = np.cumsum(edges[:-1]) == 0
                whole = words.data[words.starts[lo]:words.ends[hi - 1]].tobytes().split() if hi > lo else []
                text = b" ".join(compress(whole, left))
                counts.append(hi - lo)
                removed.append(int((~left).sum()))
                digests.append(hashlib.sha256(text).hexdigest())
                if with_text:
                    texts.append(text.decode())
            columns = [batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            yield pa.RecordBatch.from_arrays(columns + ([pa.array(texts, pa.string())] if with_text else []), names=names + (["kept_text"] if with_text else []))

    return joined.mapInArrow(run, kind)


def _estimated_words(docs: DataFrame) -> int:
    """About how many words there are, at six bytes each; it sets the sketch's size only."""
    return docs.agg((F.sum(F.octet_length("text")) / 6).cast("long").alias("n")).first()["n"] or 0
