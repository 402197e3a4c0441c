"""Words of whole Arrow text columns and hashes of word windows, without a Python object per word.

A word is a maximal run of bytes other than space and 0x09-0x0D.  Texts are
cut into slices of bounded size first, so memory does not follow the batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

SLICE_BYTES = 4 << 20
_LONG_WORD = 256
_KEYS = (0x9E3779B97F4A7C15, 0xA24BAED4963EE407)
_WORD_BASE = 0xD1342543DE82EF95
_powers: dict[int, np.ndarray] = {}


def bound_batches(spark: SparkSession, rows: int = 2000, size: int = 16 << 20) -> None:
    """Keep Arrow batches of whole texts small; a value the user has set stays."""
    for key, value in (("spark.sql.execution.arrow.maxBytesPerBatch", str(size)), ("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))):
        if spark.conf.get(key, None) in (None, "10000", str(2**31 - 1)):
            spark.conf.set(key, value)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept between calls."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = 1 << max(12, (n - 1).bit_length())
        known = np.full(size, base, dtype=np.uint64)
        known[0] = 1
        _powers[base] = known = np.cumprod(known, dtype=np.uint64)
    return known[:n]


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


#: Masks that keep the first n bytes of a block.
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


def text_slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``limit`` text bytes, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, n + 1 offsets); a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of several texts: byte ranges, and each text's range of words."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def split_words(column: pa.Array) -> Words:
    data, offsets = text_bytes(column)
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~SEPARATOR[data]
    border = np.zeros(len(data) + 1, dtype=bool)
    border[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | border[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | border[1:])) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def word_hashes(words: Words, key: int = 0) -> np.ndarray:
    """A 64-bit hash of every word; ``key`` 0 and 1 give two independent ones.

    Blocks of eight bytes are mixed one after another, for all words at once;
    a word of more than ``_LONG_WORD`` bytes is digested by itself.
    """
    sizes = words.ends - words.starts
    out = mix(sizes.astype(np.uint64) + np.uint64(_KEYS[key]))
    padded = np.concatenate([words.data, np.zeros(8, np.uint8)])
    blocks = np.ndarray(len(padded) - 7, dtype="<u8", buffer=padded, strides=(1,))
    rest = np.flatnonzero(sizes <= _LONG_WORD)
    at = 0
    while len(rest):
        left = sizes[rest] - at
        out[rest] = mix((out[rest] ^ (blocks[words.starts[rest] + at] & _FIRST_BYTES[np.minimum(left, 8)])) * np.uint64(_KEYS[1 - key]))
        rest, at = rest[left > 8], at + 8
    for k in np.flatnonzero(sizes > _LONG_WORD):
        digest = hashlib.blake2b(words.data[words.starts[k]:words.ends[k]], digest_size=8, salt=bytes([key]))
        out[k] = np.frombuffer(digest.digest(), dtype="<u8")[0]
    return out


def window_hashes(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every window of ``size`` words inside one text, index of its first word)."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes * powers(_WORD_BASE, n), out=sums[1:])
    first = np.arange(n - size + 1)
    text_end = np.repeat(bounds[1:], np.diff(bounds))[:n - size + 1]
    first = first[first + size <= text_end]
    return mix((sums[first + size] - sums[first]) * powers(_inverse(_WORD_BASE), n)[first] + np.uint64(size)), first


def shingle_sets(words: Words, size: int) -> Iterator[np.ndarray]:
    """For each text its different shingle hashes, sorted; a shorter text is one shingle, an empty one none."""
    hashes = word_hashes(words)
    windows, first = window_hashes(hashes, words.bounds, size)
    at = np.searchsorted(first, words.bounds)
    for k, n in enumerate(words.counts):
        if n >= size:
            yield np.unique(windows[at[k]:at[k + 1]])
        elif n:
            lo, hi = words.bounds[k], words.bounds[k + 1]
            yield window_hashes(hashes[lo:hi], np.array([0, n]), int(n))[0]
        else:
            yield np.zeros(0, np.uint64)
