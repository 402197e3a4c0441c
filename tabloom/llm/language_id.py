"""Language identification by rank-order n-gram profiles.

A profile lists a language's most frequent character n-grams (one to three
characters, a space for every run of other characters than letters) by rank.
A text is ranked in the same way, and its out-of-place distance to a profile is
the sum over its n-grams of the difference in rank, or ``profile_size`` for an
n-gram that the profile lacks.  The nearest profile names the language.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.words import bound_batches, text_slices

PROFILE_SIZE = 400
ORDERS = (1, 2, 3)
UNKNOWN = "und"
#: Below this score a text is as far from every profile as a text of another script.
MIN_SCORE = 0.1

_BITS = 21
_SPACE = 32
_fold: list[np.ndarray] = []
#: N-grams of texts that a task holds before it counts them, and different ones before it hands them on.
_FLUSH_KEYS = 1 << 20
_HELD_GRAMS = 1 << 20


def _folding() -> np.ndarray:
    """Code point -> its lower-case letter, or a space for anything but a letter."""
    if not _fold:
        table = np.full(sys.maxunicode + 1, _SPACE, dtype=np.uint32)
        for c in range(sys.maxunicode + 1):
            if unicodedata.category(chr(c))[0] == "L":
                low = chr(c).lower()
                table[c] = ord(low) if len(low) == 1 else c
        _fold.append(table)
    return _fold[0]


def _letters(text: str) -> np.ndarray:
    """Folded letters with single spaces between and around them; empty without a letter."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    folded = _folding()[raw]
    keep = folded != _SPACE
    if not keep.any():
        return np.zeros(0, np.uint64)
    keep[1:] |= keep[:-1]  # one space after each run of letters
    line = folded[keep]
    return np.concatenate([[_SPACE], line, [_SPACE] if line[-1] != _SPACE else []]).astype(np.uint64)


def gram_keys(letters: np.ndarray) -> np.ndarray:
    """Every n-gram of the orders as one integer of up to three code points; a lone space is none."""
    shift = np.uint64(_BITS)
    one = letters
    two = (one[:-1] << shift) | one[1:]
    three = (two[:-1] << shift) | one[2:]
    return np.concatenate([one[one != _SPACE], two, three])


def ranked_grams(text: str, size: int) -> np.ndarray:
    """The ``size`` most frequent n-grams, most frequent first, ties by their code points."""
    keys = gram_keys(_letters(text))
    if not len(keys):
        return keys
    keys.sort()
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    grams, counts = keys[first], np.diff(np.append(first, len(keys)))
    if len(grams) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        grams, counts = grams[counts >= least], counts[counts >= least]
    return grams[np.argsort(-counts, kind="stable")][:size]


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, and the sum of the counts of each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order], first)


class GramTally:
    """N-gram counts of one task by language.  At most about ``flush`` n-grams of texts wait to be counted."""

    def __init__(self, flush: int = _FLUSH_KEYS):
        self.flush, self.size = flush, 0
        self.waiting: dict[str, list[np.ndarray]] = {}
        self.known: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def add(self, lang: str, keys: np.ndarray) -> None:
        if len(keys):
            self.waiting.setdefault(lang, []).append(keys)
            self.size += len(keys)
        if self.size >= self.flush:
            self.count()

    def count(self) -> None:
        for lang, keys in self.waiting.items():
            found = np.unique(np.concatenate(keys), return_counts=True)
            if lang in self.known:
                found = _summed(*(np.concatenate(p) for p in zip(self.known[lang], found)))
            self.known[lang] = found
        self.waiting, self.size = {}, 0

    @property
    def different(self) -> int:
        return sum(len(grams) for grams, _ in self.known.values())

    def rows(self) -> Iterator[pa.RecordBatch]:
        """(lang, gram, n) so far; counting then starts anew."""
        self.count()
        for lang, (grams, n) in self.known.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])
        self.known = {}


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n): n-gram counts of all texts, summed per task before the shuffle."""

    def run(batches):
        tally = GramTally()
        for batch in text_slices(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                tally.add(lang, gram_keys(_letters(text.as_py())))
            if tally.different >= _HELD_GRAMS:
                yield from tally.rows()
        yield from tally.rows()

    counted = docs.where("lang is not null and text is not null").select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn_profiles(docs: DataFrame, size: int = PROFILE_SIZE) -> dict[str, np.ndarray]:
    """Each language's n-grams by rank, from all rows with a language and a text.

    The result holds ``size`` integers for each value of lang, whatever the
    number of rows; values of lang are taken to be a short list.
    """
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = gram_counts(docs).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    profiles: dict[str, list] = {}
    for row in ranked.orderBy("lang", "rank").collect():
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return {lang: np.array(grams, dtype=np.int64).view(np.uint64) for lang, grams in profiles.items()}


class Ranks:
    """Profiles laid out for lookup: the sorted n-grams of all of them, and each profile's rank of every one."""

    def __init__(self, profiles: dict[str, np.ndarray], size: int):
        self.size, self.langs = size, sorted(profiles)
        self.grams = np.unique(np.concatenate([profiles[k] for k in self.langs])) if profiles else np.zeros(0, np.uint64)
        self.rank = np.full((len(self.langs), len(self.grams)), -1, dtype=np.int64)
        for k, lang in enumerate(self.langs):
            self.rank[k, np.searchsorted(self.grams, profiles[lang])] = np.arange(len(profiles[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        grams = ranked_grams(text, self.size) if text else np.zeros(0, np.uint64)
        if not len(grams) or not self.langs:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        rank = np.where(self.grams[at] == grams, self.rank[:, at], -1)
        apart = np.where(rank < 0, self.size, np.abs(rank - np.arange(len(grams))))
        distance = apart.sum(axis=1)
        best = int(np.argmin(distance))
        return self.langs[best], 1.0 - float(distance[best]) / (self.size * len(grams))


def predict_language(docs: DataFrame, profiles: dict[str, np.ndarray], size: int = PROFILE_SIZE, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of ``docs`` with lang_pred and score for every row, in whole-text batches.

    ``und`` with score 0 if the text is null, has no letter, or nothing was
    learned.  Of equally near profiles the first by name wins.  The score is
    one minus the distance over the largest distance possible.
    """
    bound_batches(docs.sparkSession)
    ranks = docs.sparkSession.sparkContext.broadcast(Ranks(profiles, size))
    wanted = docs.select(*keep, F.col("text").alias("__text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields)

    def run(batches):
        for batch in text_slices(batches, "__text"):
            found = [ranks.value.predict(t) for t in batch.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                batch.columns[:-1] + [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*keep, "lang_pred", "score"])

    return wanted.mapInArrow(run, f"{kinds}, lang_pred string, score double")


def held_out(doc_id: Column | str) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 2 when divided by 4; a null id is not."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")) if isinstance(doc_id, str) else F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame, size: int = PROFILE_SIZE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs`` (doc_id, text, lang, ...).

    Profiles are learned from all rows that are not held out; lang, source and
    doc_id are no inputs of a prediction.  Repeated rows count as often as they occur.
    """
    bound_batches(docs.sparkSession)
    profiles = learn_profiles(docs.where(~held_out("doc_id")), size)
    found = predict_language(docs.select("doc_id", "text"), profiles, size)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def recognised(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is recognised; ``und`` and scores below ``min_score`` go."""
    bound_batches(docs.sparkSession)
    profiles = learn_profiles(docs.where(~held_out("doc_id")))
    ranks = docs.sparkSession.sparkContext.broadcast(Ranks(profiles, PROFILE_SIZE))
    # A row's text is sent to its task once, inside the row.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    at = docs.columns.index("text") if "text" in docs.columns else [c.lower() for c in docs.columns].index("text")

    def run(batches):
        for batch in batches:
            row = batch.column("row")
            both = pa.RecordBatch.from_arrays([row, row.field(at)], names=["row", "text"])
            for part in text_slices([both]):
                found = (ranks.value.predict(t.as_py()) for t in part.column("text"))
                kept = pa.array([lang != UNKNOWN and score >= min_score for lang, score in found], pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column("row").filter(kept)], names=["row"])

    return rows.mapInArrow(run, rows.schema).select("row.*")
