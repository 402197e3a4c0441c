"""Language-model scoring: a gated recurrent model trained by Spark tasks on all training documents.

1. *Counts.*  Every word of every training document is counted exactly, by
   its string; the counts stay a distributed table.
2. *Encoding.*  The most frequent words (at most ``known_words``, by whole
   levels of frequency) and their counts go to all tasks, which replace each
   text by small ids: the ``model_words`` most frequent words and the end have
   one each, other known words share one per power of two of their count, and
   all rarer words share one.
3. *Training.*  Documents are dealt into ``rounds``.  In a round every task
   trains the model on its documents by truncated backpropagation, and the
   tasks' parameters, weighted by tokens, are averaged in two levels into the
   model that the next round starts from.  Every training token is learned
   from once.
4. *Scoring.*  The state is carried over all windows of a document.  A word
   that shares an id has the id's chance times its share of the group; rarer
   words get theirs from the table of counts by a join, with an absolute
   discount that leaves a share to words never seen.

What reaches the driver and is broadcast is bounded by ``known_words`` and the
size of the model.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm.recurrent import GatedModel, class_starts
from tabloom.llm.words import bound_batches, text_bytes, text_slices
from tabloom.session import local_table, materialize, scratch_path

KNOWN_WORDS = 1 << 18
MODEL_WORDS = 1024
CLASSES = 24
HIDDEN = 16
RATE = 0.2
ROUNDS = 4
#: Words with smaller counts are never sent to tasks; they stand for words that are not seen in training.
MIN_KNOWN = 4
#: Levels of a doubling of the count, for the cut between known and rarer words.
_LEVELS = 64
_SLOTS = 32
_BLOCK = 1 << 16
_SCORED_TOKENS = 1 << 20
#: The end of a text, which no word equals.
END = ""


def held_out(doc_id: str) -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(10)) == 0


@dataclass
class Tokens:
    """Words of some texts: the different words, and for each text the positions of its own among them, without ends."""

    words: pa.Array
    ids: np.ndarray
    bounds: np.ndarray


def tokens_of(texts: pa.Array) -> Tokens:
    """Words between spaces and 0x09-0x0D, A-Z lower-cased; a null text has none."""
    # Arrow's ascii_lower mixes up large strings whose bytes do not begin at the first text, as those of a slice.
    data, offsets = text_bytes(texts)
    whole = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data))
    split = pc.ascii_split_whitespace(pc.ascii_lower(whole))
    flat, offsets = split.flatten(), split.offsets.to_numpy()
    coded = pc.dictionary_encode(flat)
    full = (pc.binary_length(coded.dictionary).to_numpy() > 0)
    ids = coded.indices.to_numpy().astype(np.int64)
    kept = full[ids] if len(ids) else np.zeros(0, bool)
    bounds = np.concatenate([[0], np.cumsum(kept)])[offsets - offsets[0]]
    return Tokens(coded.dictionary, ids[kept], bounds)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, count) over all texts of ``docs``, without ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            tokens = tokens_of(batch.column("text"))
            counts = np.bincount(tokens.ids, minlength=len(tokens.words))
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([tokens.words.take(pa.array(used)).cast(pa.string()), pa.array(counts[used], pa.int64())], names=["word", "count"])

    return docs.select("text").mapInArrow(run, "word string, count long").groupBy("word").agg(F.sum("count").alias("count"))


@dataclass
class Vocabulary:
    """The known words with their counts, most frequent first, and what is known of the others."""

    words: pa.Array
    counts: np.ndarray
    n_words: int
    tokens: int
    types: int
    rare_tokens: int
    rare_types: int
    discount: float

    @property
    def n_groups(self) -> int:
        """Groups behind the words with an id of their own: the rarer words first, then one per power of two of the count."""
        shared = self.counts[self.n_words:]
        return 2 + int(math.log2(shared.max())) if len(shared) else 1

    def ids(self) -> np.ndarray:
        """The id of every known word."""
        shared = np.floor(np.log2(np.maximum(self.counts[self.n_words:], 1))).astype(np.int64)
        return np.concatenate([np.arange(self.n_words), self.n_words + 1 + shared])

    def id_counts(self) -> np.ndarray:
        out = np.bincount(self.ids(), weights=self.counts, minlength=self.n_words + self.n_groups)
        out[self.n_words] = self.rare_tokens
        return out

    def base(self, count: np.ndarray) -> np.ndarray:
        """log10 of the smoothed share of words of these counts."""
        return np.log10((count + 0.1) / (self.tokens + 0.1 * (self.types + 1)))


def vocabulary(counts: DataFrame, n_docs: int, known_words: int, model_words: int) -> Vocabulary:
    """Cut ``counts`` (word, count) into known and rarer words; ``n_docs`` training documents have one end each."""
    level = F.floor(F.log2("count") * _LEVELS)
    levels = counts.groupBy(level.alias("level")).agg(F.sum("count").alias("tokens"), F.count("*").alias("types"), F.min("count").alias("least"),
                                                     F.count_if(F.col("count") == 1).alias("once"), F.count_if(F.col("count") == 2).alias("twice"))
    rows = sorted(levels.collect(), key=lambda r: -r["level"])  # at most _LEVELS a doubling
    cut, left = None, known_words
    for r in rows:
        if r["least"] < MIN_KNOWN or r["types"] > left:
            break
        cut, left = r["level"], left - r["types"]
    rare = [r for r in rows if cut is None or r["level"] < cut]
    schema = pa.schema([("word", pa.string()), ("count", pa.int64())])
    known = pa.table({"word": [], "count": []}, schema=schema) if cut is None else counts.where(level >= cut).select("word", "count").toArrow().cast(schema)
    if n_docs:
        known = pa.concat_tables([known, pa.table({"word": [END], "count": [n_docs]}, schema=schema)])
    known = known.sort_by([("count", "descending"), ("word", "ascending")])
    # The end has an id of its own, however rare it is.
    words, n = known.column("word").combine_chunks(), known.num_rows
    place = int(pc.index(words, END).as_py()) if n else -1
    if place >= model_words:
        order = np.concatenate([np.arange(model_words - 1), [place], np.arange(model_words - 1, place), np.arange(place + 1, n)])
        known = known.take(pa.array(order))
        words = known.column("word").combine_chunks()
    once, twice = sum(r["once"] for r in rare), sum(r["twice"] for r in rare)
    return Vocabulary(words, known.column("count").to_numpy(), min(model_words, n), sum(r["tokens"] for r in rows) + n_docs, sum(r["types"] for r in rows) + (n_docs > 0),
                      sum(r["tokens"] for r in rare), sum(r["types"] for r in rare), once / (once + 2 * twice) if once and twice else 0.5)


def encoded(docs: DataFrame, vocab, path: str, rounds: int) -> None:
    """Write (row, doc_id, held_out, n_tokens, n_known, base, inner, ids, rare, rare_n) under ``path``, in folders by ``round``.

    ``base`` sums the smoothed shares of known words, ``inner`` the natural
    logarithm of the shares that known words have of their id; ``rare`` are
    the document's rarer words and ``rare_n`` how often it has them.
    """
    kind = ("row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, inner double, ids binary, rare array<string>, rare_n array<int>, round int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = vocab.value
        id_of, id_counts = v.ids(), v.id_counts()
        inner_of = np.log(np.maximum(v.counts, 1) / np.maximum(id_counts[id_of], 1))
        base_of = v.base(v.counts)
        end = int(pc.index(v.words, END).as_py())
        for batch in text_slices(batches):
            tokens = tokens_of(batch.column("text"))
            at = pc.fill_null(pc.index_in(tokens.words.cast(pa.string()), v.words), -1).to_numpy()
            known = at >= 0
            ids = np.where(known, id_of[at], v.n_words).astype(np.int16)[tokens.ids] if len(tokens.ids) else np.zeros(0, np.int16)
            sums = {name: np.concatenate([[0.0], np.cumsum(np.where(known, values[at], 0.0)[tokens.ids])])[tokens.bounds]
                    for name, values in (("base", base_of), ("inner", inner_of), ("known", np.ones(len(v.counts))))} if len(tokens.ids) else {n: np.zeros(len(tokens.bounds)) for n in ("base", "inner", "known")}
            packed, rare, rare_n, ends = [], [], [], np.int16(end)
            for k in range(batch.num_rows):
                lo, hi = tokens.bounds[k], tokens.bounds[k + 1]
                own = ids[lo:hi]
                packed.append(np.append(own, ends).tobytes())
                places, n = np.unique(tokens.ids[lo:hi][own == v.n_words], return_counts=True)
                rare.append(places)
                rare_n.append(n)
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in rare])]), pa.int32())
            rare_words = tokens.words.cast(pa.string()).take(pa.array(np.concatenate(rare).astype(np.int64)))
            columns = [
                batch.column("row"), batch.column("doc_id").cast(pa.int64()), batch.column("held_out"), pa.array(np.diff(tokens.bounds) + 1, pa.int64()), pa.array(np.diff(sums["known"]) + (v.counts[end] > 0), pa.int64()),
                pa.array(np.diff(sums["base"]) + base_of[end]), pa.array(np.diff(sums["inner"])), pa.array(packed, pa.binary()),
                pa.ListArray.from_arrays(offsets, rare_words), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(rare_n), pa.int32())), pa.array(batch.column("row").to_numpy() % rounds, pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in kind.split(", ")])

    docs.select("row", "doc_id", "held_out", "text").mapInArrow(run, kind).write.partitionBy("round").parquet(path)


def trained_parts(tokens: DataFrame, model, fresh: GatedModel) -> DataFrame:
    """(block, slot, weight, numbers): what each task has learned from its documents, in blocks of parameters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = GatedModel(fresh.starts, fresh.n_groups, fresh.end, fresh.hidden, fresh.rate).unpack(model.value)
        seen = own.train(np.frombuffer(x.as_buffer(), dtype=np.int16) for batch in batches for x in batch.column("ids"))
        if not seen:
            return
        numbers = own.packed()
        blocks = [numbers[k:k + _BLOCK].tobytes() for k in range(0, len(numbers), _BLOCK)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int32()), pa.array([float(seen)] * len(blocks)), pa.array(blocks, pa.binary())], names=["block", "weight", "numbers"])

    parts = tokens.select("ids").mapInArrow(run, "block int, weight double, numbers binary")
    return parts.withColumn("slot", F.pmod(F.spark_partition_id(), F.lit(_SLOTS)))


def averaged(parts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, weight, numbers): weighted means of the blocks of a group, which are read one by one."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight = 0.0, 0.0
        for batch in batches:
            for w, numbers in zip(batch.column("weight").to_pylist(), batch.column("numbers")):
                total = total + w * np.frombuffer(numbers.as_buffer(), dtype=np.float32).astype(np.float64)
                weight += w
        mean = (total / weight).astype(np.float32)
        yield pa.RecordBatch.from_arrays([*(pa.array([k.as_py()], pa.int32()) for k in key), pa.array([weight]), pa.array([mean.tobytes()], pa.binary())], names=[*keys, "weight", "numbers"])

    kind = "".join(f"{k} int, " for k in keys) + "weight double, numbers binary"
    return parts.groupBy(*keys).applyInArrow(run, kind)


def train_model(spark: SparkSession, path: str, vocab: Vocabulary, hidden: int, n_classes: int, rate: float, rounds: int) -> GatedModel:
    """The model after all rounds over the encoded training documents under ``path``."""
    counts = vocab.id_counts()
    end = int(pc.index(vocab.words, END).as_py())
    model = GatedModel(class_starts(counts[:vocab.n_words], n_classes), vocab.n_groups, end, hidden, rate).start(counts)
    blank = GatedModel(model.starts, model.n_groups, model.end, hidden, rate)
    size = len(model.packed())
    tokens = spark.read.parquet(path).where("not held_out")
    for k in range(rounds):
        sent = spark.sparkContext.broadcast(model.packed())
        parts = averaged(trained_parts(tokens.where(F.col("round") == k), sent, blank), ["block", "slot"])
        means = averaged(parts, ["block"])
        blocks = {r["block"]: np.frombuffer(r["numbers"], dtype=np.float32) for r in means.toLocalIterator()}
        sent.unpersist()
        if blocks:
            flat = np.concatenate([blocks[b] for b in sorted(blocks)])
            assert len(flat) == size
            model.unpack(flat)
    return model


def model_scores(tokens: DataFrame, model, blank: GatedModel) -> DataFrame:
    """(row, doc_id, held_out, n_tokens, n_known, base, chance): ``chance`` is the natural logarithm up to the shares of rarer words."""
    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = GatedModel(blank.starts, blank.n_groups, blank.end, blank.hidden, blank.rate).unpack(model.value)
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            docs = [np.frombuffer(x.as_buffer(), dtype=np.int16) for batch in held for x in batch.column("ids")]
            inner = np.concatenate([batch.column("inner").to_numpy() for batch in held])
            rest = [pa.concat_arrays([batch.column(c) for batch in held]) for c in names]
            return pa.RecordBatch.from_arrays([*rest, pa.array(own.score(docs) + inner)], names=[*names, "chance"])

        for batch in text_slices(batches, "ids"):
            held.append(batch)
            size += batch.column("ids").nbytes // 2
            if size >= _SCORED_TOKENS:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    kind = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, chance double"
    return tokens.select(*names, "inner", "ids").mapInArrow(run, kind)


def score_documents(docs: DataFrame, held: Column | None = None, known_words: int = KNOWN_WORDS, model_words: int = MODEL_WORDS, n_classes: int = CLASSES,
                    hidden: int = HIDDEN, rate: float = RATE, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs`` (doc_id, text).

    Tokens are the words of a text, A-Z lower-cased, and one end; a null or
    empty text is an end only.  Rows for which ``held`` is true are not learned
    from; by default those whose crc32 of doc_id is divisible by ten.  A row
    with a null doc_id is held out.  ``base_score`` is the sum of log10 of
    smoothed word shares, ``score`` that of the recurrent model, whose words
    never seen in training share what the discount of rarer words leaves.
    Without training documents every share is that of the one unseen word, and
    both scores are 0.  Rows that repeat a doc_id are rows of their own.  Other
    columns are not read.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    out = F.coalesce(held_out("doc_id") if held is None else held, F.lit(True))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", out.alias("held_out"))
    training = rows.where("not held_out")
    counts = materialize(word_counts(training), "word-counts")
    vocab = vocabulary(counts, training.count(), known_words, model_words)
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    if not vocab.tokens:
        only_end = rows.select("doc_id", "held_out", "text").mapInArrow(_token_numbers, "doc_id long, held_out boolean, n_tokens long")
        zero = F.lit(0).cast("long")
        return only_end.select("doc_id", "held_out", "n_tokens", zero.alias("n_known"), zero.alias("train_tokens"), F.lit(0.0).alias("base_score"), F.lit(0.0).alias("score"))
    path = scratch_path(spark, "tokens")
    sent = spark.sparkContext.broadcast(vocab)
    encoded(rows.withColumn("row", F.monotonically_increasing_id()), sent, path, rounds)
    model = train_model(spark, path, vocab, hidden, n_classes, rate, rounds)
    blank = GatedModel(model.starts, model.n_groups, model.end, hidden, rate)
    tokens = spark.read.parquet(path)
    scored = model_scores(tokens, spark.sparkContext.broadcast(model.packed()), blank)
    # Rarer words find their counts by a join; each counts once a document.
    rarer = tokens.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("w")).select("row", F.col("w.rare").alias("word"), F.col("w.rare_n").alias("n"))
    seen = rarer.join(counts, "word", "left")
    scale = vocab.tokens + 0.1 * (vocab.types + 1)
    mass = max(vocab.rare_tokens, 1)
    unseen = math.log(max(vocab.discount * vocab.rare_types, 0.5) / mass) if vocab.rare_tokens else 0.0
    share = F.when(F.col("count").isNull(), F.lit(unseen)).otherwise(F.log((F.col("count") - vocab.discount) / mass))
    rare_sums = seen.groupBy("row").agg(F.sum(F.col("n") * F.log10((F.coalesce("count", F.lit(0)) + 0.1) / scale)).alias("rare_base"), F.sum(F.col("n") * share).alias("rare_chance"),
                                        F.sum(F.when(F.col("count").isNotNull(), F.col("n"))).alias("rare_known"))
    both = scored.join(rare_sums, "row", "left")
    nothing = F.lit(0.0)
    return both.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", nothing)).alias("base_score"), ((F.col("chance") + F.coalesce("rare_chance", nothing)) / math.log(10)).alias("score")).select(names)


def _token_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        n = np.diff(tokens_of(batch.column("text")).bounds) + 1
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(n, pa.int64())], names=["doc_id", "held_out", "n_tokens"])
