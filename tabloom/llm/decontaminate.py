"""Benchmark decontamination by SimHash of item-sized windows.

Texts become lower-case words of letters and digits, and five-word shingles.
A window of a document has as many words as a benchmark item.  Every start is a
window; one at the threshold shares so many shingles with its item, wherever
they stand, that windows with fewer places whose shingle is in an item of that
length are left out without loss.  The others are fingerprinted: 128 bits, each
the majority of that bit over the window's shingles.  Fingerprints are cut into blocks; two fingerprints
within the radius differ in few bits in at least one block, so items are
listed under every block value that close, and an equality join finds all of
them.  Candidates are verified by their exact weighted shingle similarity
(each shingle weighs as often as it occurs).

The radius fits windows of many shingles of little weight each.  Where one
shingle has more than ``HEAVY`` of an item or a window, as in repetitive or
short texts, the majority bits follow that shingle.  Such pairs are candidates
without the radius, if they share one of the item's rarest shingles: of those
that together are more than a similar window can lack, it has one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.joins import short_list
from tabloom.session import materialize, temporary_tables

SHINGLE_WORDS = 5
THRESHOLD = 0.8
#: At similarity 0.8 two fingerprints of 128 bits differ in 19 bits on average, in more than this about twice in a thousand.
RADIUS = 31
#: Share of a text's shingles above which one of them could turn the fingerprint.
HEAVY = 0.04
_BLOCKS, _BLOCK_BITS = 8, 16


def words_of(text: Column | str) -> Column:
    """Lower-case words of letters and digits; an empty array without any."""
    spaced = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def _shingle(words: str, at: Column, width: int) -> Column:
    return F.xxhash64(*[F.get(F.col(words), at + k) for k in range(width)])


def _shingles(rows: DataFrame, width: int) -> DataFrame:
    """One row per shingle of ``words``: its place and hash."""
    spots = F.sequence(F.lit(0), F.size("words") - width)
    return (rows.where(F.size("words") >= width).withColumn("place", F.explode(spots))
            .withColumn("shingle", _shingle("words", F.col("place"), width)).drop("words"))


def fingerprints(shingles: DataFrame, key: list[str]) -> DataFrame:
    """(key, low, high, weight): 128 majority bits over the shingles of each key, and how many there are.

    Sums of bits are kept two to a 64-bit column, 32 bits apart.
    """
    both = shingles.withColumn("h0", F.col("shingle")).withColumn("h1", F.xxhash64(F.col("shingle"), F.lit(7)))
    pair = F.lit(0x0000000100000001)
    sums = [F.sum(F.shiftrightunsigned(f"h{w}", j).bitwiseAND(pair)).alias(f"s{w}_{j}") for w in range(2) for j in range(32)]
    counted = both.groupBy(*key).agg(F.count("*").alias("weight"), *sums)

    def bits(w: int) -> Column:
        out = F.lit(0).cast("long")
        for j in range(32):
            total = F.col(f"s{w}_{j}")
            for value, bit in ((total.bitwiseAND(F.lit(0xFFFFFFFF)), j), (F.shiftrightunsigned(total, 32), j + 32)):
                out = out.bitwiseOR(F.shiftleft((value * 2 > F.col("weight")).cast("long"), bit))
        return out

    return counted.select(*key, bits(0).alias("low"), bits(1).alias("high"), "weight")


def window_starts(met: DataFrame, width: int, threshold: float) -> DataFrame:
    """(doc_id, n, start) of all windows of n words that can reach the threshold, each once.

    ``met`` (doc_id, length, n, place) are the places in documents whose shingle
    some item of n words has.  Similarity s / (a + b - s) >= t needs s >= t / (1 + t) * (a + b)
    shared shingles, so as many places in the window.
    """
    size = F.least("length", "n") - (width - 1)
    least = F.ceil(F.lit(threshold / (1 + threshold)) * (F.col("n") - (width - 1) + size) - F.lit(1e-6)).cast("int")
    spots = (met.groupBy("doc_id", "n").agg(F.max("length").alias("length"), F.array_sort(F.collect_set("place")).alias("places"))
             .withColumn("size", size).withColumn("least", F.greatest(F.lit(1), least)).withColumn("many", F.size("places") - F.col("least") + 1).where("many > 0"))
    part = lambda values, at: F.slice(values, at, F.col("many"))
    before = F.concat(F.array(F.lit(-1)), F.col("places"))
    runs = spots.select("doc_id", "n", "length", "size", F.explode(F.arrays_zip(
        part(before, F.lit(1)).alias("before"), part(F.col("places"), F.lit(1)).alias("first"), part(F.col("places"), F.col("least")).alias("last"))).alias("run"))
    # A window belongs to the first place it holds, so it is listed once.
    runs = runs.select("doc_id", "n", F.greatest(F.col("run.before") + 1, F.col("run.last") - F.col("size") + 1).alias("low"),
                       F.least(F.col("run.first"), F.greatest(F.lit(0), F.col("length") - F.col("n"))).alias("high"))
    return runs.where("low <= high").select("doc_id", "n", F.explode(F.sequence("low", "high")).alias("start"))


def _block_values() -> Column:
    """The fingerprint's blocks, in order."""
    per_word = 64 // _BLOCK_BITS
    return F.array(*[F.shiftrightunsigned(("low", "high")[b // per_word], (b % per_word) * _BLOCK_BITS).bitwiseAND(F.lit((1 << _BLOCK_BITS) - 1)) for b in range(_BLOCKS)])


def within_radius(windows: DataFrame, items: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All (window, item) rows of equal ``n`` whose fingerprints differ in at most ``radius`` bits."""
    near = [m for m in range(1 << _BLOCK_BITS) if m.bit_count() <= radius // _BLOCKS]
    probes = (items.select("item_id", "n", F.col("low").alias("item_low"), F.col("high").alias("item_high"), F.posexplode(_block_values()).alias("block", "value"))
              .withColumn("value", F.explode(F.transform(F.lit(near), lambda m: F.col("value").bitwiseXOR(m.cast("long"))))))
    keys = windows.select("doc_id", "start", "n", "low", "high", F.posexplode(_block_values()).alias("block", "value"))
    # Sizes are estimated before explode, so without the hint the many probes would be broadcast.
    met = keys.join(probes.hint("merge"), ["n", "block", "value"])
    apart = F.bit_count(F.col("low").bitwiseXOR(F.col("item_low"))) + F.bit_count(F.col("high").bitwiseXOR(F.col("item_high")))
    return met.where(apart <= radius).select("doc_id", "start", "n", "item_id").distinct()


def heavy_pairs(counted: DataFrame, windows: DataFrame, item_counts: DataFrame, items: DataFrame, threshold: float, heavy: float) -> DataFrame:
    """(doc_id, start, n, item_id) of all pairs that can reach the threshold and have a heavy shingle on either side.

    ``counted`` and ``item_counts`` have one row per different shingle of a
    window or item, with its number ``c`` or ``item_c``.
    """
    window, item = ["doc_id", "start", "n"], ["item_id", "n"]
    turned = counted.join(windows.select(*window, "weight"), window).where(F.col("c") > heavy * F.col("weight")).select(window).distinct()
    weighed = item_counts.join(items.select(*item, F.col("weight").alias("item_weight")), item)
    heavy_items = weighed.where(F.col("item_c") > heavy * F.col("item_weight")).select(item).distinct()
    # A window at the threshold lacks at most this share of the item, so it has one of the rarest shingles beyond it.
    common = item_counts.groupBy("n", "shingle").agg(F.count("*").alias("spread"))
    order = Window.partitionBy(*item).orderBy("spread", "shingle").rowsBetween(Window.unboundedPreceding, -1)
    ranked = weighed.join(common, ["n", "shingle"]).withColumn("rarer", F.coalesce(F.sum("item_c").over(order), F.lit(0)))
    rare = materialize(ranked.where(F.col("rarer") <= F.lit(1 - threshold) * F.col("item_weight") + 1e-6).select(*item, "shingle"), "rare")
    met = counted.join(turned, window, "left_semi").join(rare, ["n", "shingle"])
    more = counted.join(rare.join(heavy_items, item, "left_semi"), ["n", "shingle"])
    return met.select(*window, "item_id").unionByName(more.select(*window, "item_id")).distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = SHINGLE_WORDS, threshold: float = THRESHOLD, radius: int = RADIUS, heavy: float = HEAVY) -> DataFrame:
    """(doc_id, item_id, start, n_words, similarity): each item found in each document, at its most similar window.

    ``start`` counts the document's normalised words; of equally similar
    windows the first counts.  Items and documents shorter than ``width``
    words, null or empty texts match nothing.  A document shorter than an item
    is compared as one window.  Items of equal text are reported each; rows
    that repeat a doc_id or item_id count once.  Other columns are not read.
    """
    listed = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") >= width).dropDuplicates()
    item_shingles = materialize(_shingles(listed.withColumn("n", F.size("words")), width), "items")
    texts = docs.select("doc_id", words_of(F.col("text")).alias("words")).where("doc_id is not null")
    wanted = short_list(materialize(item_shingles.select("shingle", "n").distinct(), "wanted"))
    met = _shingles(texts.withColumn("length", F.size("words")), width).join(wanted, "shingle")
    spots = materialize(window_starts(met, width, threshold), "spots")
    by_doc = materialize(spots.groupBy("doc_id").agg(F.collect_set(F.struct("start", "n")).alias("spots")), "documents")
    by_doc = short_list(by_doc)
    cut = docs.select("doc_id", "text").join(by_doc, "doc_id").select("doc_id", words_of(F.col("text")).alias("words"), "spots").dropDuplicates(["doc_id"])
    # The shingles of a document are hashed once, whatever number of windows they are in.
    hashes = F.transform(F.sequence(F.lit(0), F.size("words") - width), lambda at: _shingle("words", at, width))
    cut = materialize(cut.select("doc_id", "spots", hashes.alias("hashes")), "hashes").select("doc_id", "hashes", F.explode("spots").alias("spot"))
    window_shingles = materialize(cut.select("doc_id", "spot.start", "spot.n", F.explode(
        F.slice("hashes", F.col("spot.start") + 1, F.col("spot.n") - (width - 1))).alias("shingle")), "windows")
    windows = fingerprints(window_shingles, ["doc_id", "start", "n"])
    items = materialize(fingerprints(item_shingles, ["item_id", "n"]), "item_prints")
    windows = materialize(windows, "window_prints")
    counted = materialize(window_shingles.groupBy("doc_id", "start", "n", "shingle").agg(F.count("*").alias("c")), "window_counts")
    item_counts = materialize(item_shingles.groupBy("item_id", "n", "shingle").agg(F.count("*").alias("item_c")), "item_counts")
    pairs = within_radius(windows, items, radius).unionByName(heavy_pairs(counted, windows, item_counts, items, threshold, heavy)).distinct()
    shared = (pairs.join(counted, ["doc_id", "start", "n"]).join(item_counts, ["item_id", "n", "shingle"])
              .groupBy("doc_id", "start", "n", "item_id").agg(F.sum(F.least("c", "item_c")).alias("shared")))
    sized = shared.join(windows.select("doc_id", "start", "n", "weight"), ["doc_id", "start", "n"]).join(items.select("item_id", "n", F.col("weight").alias("item_weight")), ["item_id", "n"])
    similarity = F.col("shared") / (F.col("weight") + F.col("item_weight") - F.col("shared"))
    found = sized.withColumn("similarity", similarity).where(F.col("similarity") >= threshold)
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n")).alias("best"))
    return best.select("doc_id", "item_id", (-F.col("best.back")).alias("start"), F.col("best.n").alias("n_words"), "best.similarity")


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, in whose text no benchmark item was found."""
    with temporary_tables(docs.sparkSession) as scope:
        found = scope.keep(contaminated(docs, benchmark).select("doc_id").distinct(), "contaminated")
    return docs.join(short_list(found), "doc_id", "left_anti")
