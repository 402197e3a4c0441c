"""N-gram Jaccard join by a MinHash LSH forest.

Every text becomes the set of its five-word shingles.  Each of ``trees`` trees
orders the texts by ``max_depth`` MinHash values, so texts that agree on a
prefix of them are neighbours.  The join starts at the longest prefix and
shortens it until a pair at the threshold is found with ``target_recall``;
after verification the recall is estimated again from the links found
(each weighted by one over its chance of being found), and the prefix is
shortened further if that estimate is below the target.

Texts of equal sets are one class with a weight.  Classes that share a prefix
are brought together by connected components, cut into blocks of bounded size,
and each pair of blocks is verified exactly in one task: a pair of classes is
counted once, whatever number of trees it shares, and a task returns a row per
class, never one per pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.components import connected_components, smallest_reachable
from tabloom.llm.joins import short_list
from tabloom.llm.words import bound_batches, mix, shingle_sets, split_words, text_slices
from tabloom.session import materialize, temporary_tables

SHINGLE_WORDS = 5
THRESHOLD = 0.8
TREES = 16
MAX_DEPTH = 6
TARGET_RECALL = 0.999
BLOCK = 256
_ROWS_AT_ONCE = 2048


def found_chance(similarity, depth: int, trees: int = TREES):
    """The chance that some tree puts a pair under one prefix of ``depth`` values."""
    return 1.0 - (1.0 - similarity ** depth) ** trees


def prefix_depth(threshold: float, trees: int, max_depth: int, target: float) -> int:
    """The longest prefix that still finds a pair at the threshold often enough; 1 at least."""
    depth = max_depth
    while depth > 1 and found_chance(threshold, depth, trees) < target:
        depth -= 1
    return depth


def _hash_family(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
    return seeds[:n] | np.uint64(1), seeds[n:]


def min_hashes(shingles: np.ndarray, n: int) -> np.ndarray:
    """n 32-bit MinHash values of a non-empty set, in bounded memory."""
    factor, shift = _hash_family(n)
    low = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
    for k in range(0, len(shingles), _ROWS_AT_ONCE):
        part = shingles[k:k + _ROWS_AT_ONCE, None] * factor + shift
        np.minimum(low, part.min(axis=0), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def set_key(shingles: np.ndarray, seed: int) -> int:
    """A 64-bit key of a set: the sum of its mixed members."""
    return int(np.add.reduce(mix(shingles ^ np.uint64(seed))).view(np.int64))


def signatures(docs: DataFrame, size: int = SHINGLE_WORDS, trees: int = TREES, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(doc_id, set_a, set_b, n_shingles, signature); the set keys are null where a text has no word."""

    def run(batches):
        for batch in text_slices(batches):
            words = split_words(batch.column("text"))
            a, b, counts, packed = [], [], [], []
            for s in shingle_sets(words, size):
                counts.append(len(s))
                if not len(s):
                    a.append(None)
                    b.append(None)
                    packed.append(None)
                    continue
                a.append(set_key(s, 0x51ED))
                b.append(set_key(s, 0x7C15))
                packed.append(min_hashes(s, trees * max_depth).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(counts, pa.int32()), pa.array(packed, pa.binary())],
                names=["doc_id", "set_a", "set_b", "n_shingles", "signature"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, set_a long, set_b long, n_shingles int, signature binary")


def shingle_table(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, set_a, shingles): the sorted 64-bit shingle hashes of every text, packed."""

    def run(batches):
        for batch in text_slices(batches):
            sets = list(shingle_sets(split_words(batch.column("text")), size))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array([set_key(s, 0x51ED) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["doc_id", "set_a", "shingles"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, set_a long, shingles binary")


def tree_labels(packed: list[bytes], trees: int, max_depth: int, depth: int) -> np.ndarray:
    """One 64-bit value per text and tree for the first ``depth`` values of the tree's order."""
    values = np.frombuffer(b"".join(packed), dtype=np.uint32).reshape(len(packed), trees, max_depth)[:, :, :depth].astype(np.uint64)
    out = np.broadcast_to(np.arange(1, trees + 1, dtype=np.uint64), values.shape[:2]).copy()
    for k in range(depth):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + values[:, :, k])
    return out


def _labels_of(classes: DataFrame, trees: int, max_depth: int, depth: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                labels = tree_labels(batch.column("signature").to_pylist(), trees, max_depth, depth)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(batch.column("rep").to_numpy(), trees)), pa.array(labels.reshape(-1).view(np.int64))], names=["rep", "label"])

    return classes.select("rep", "signature").mapInArrow(run, "rep long, label long")


def shared_counts(left: list[np.ndarray], right: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """How many shingles each set on the left shares with each on the right, exactly.

    Only shingles on both sides count; they are numbered and multiplied as
    0/1 matrices, ``width`` columns at a time.
    """
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    a, b = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(a, b)
    if not len(both):
        return out
    row_a, row_b = np.repeat(np.arange(len(left)), [len(x) for x in left]), np.repeat(np.arange(len(right)), [len(x) for x in right])

    def numbered(values, rows):
        at = np.searchsorted(both, values)
        at[at == len(both)] = 0
        hit = both[at] == values
        at, rows = at[hit], rows[hit]
        order = np.argsort(at, kind="stable")
        return at[order], rows[order]

    (col_a, row_a), (col_b, row_b) = numbered(a, row_a), numbered(b, row_b)
    for k in range(0, len(both), width):
        x, y = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
        lo, hi = np.searchsorted(col_a, [k, k + width])
        x[row_a[lo:hi], col_a[lo:hi] - k] = 1
        lo, hi = np.searchsorted(col_b, [k, k + width])
        y[row_b[lo:hi], col_b[lo:hi] - k] = 1
        out += x @ y.T
    return out


def _verify(left: dict, right: dict, same: bool, threshold: float, depth: int, trees: int):
    """(matrix of links between two blocks, number of links, their number weighted by the chance of being found)."""
    together = np.zeros((len(left["rep"]), len(right["rep"])), dtype=bool)
    for t in range(trees):
        together |= left["labels"][:, t][:, None] == right["labels"][:, t][None, :]
    if same:
        together = np.triu(together, 1)
    if not together.any():
        return None
    shared = shared_counts(left["sets"], right["sets"])
    size_a, size_b = np.array([len(s) for s in left["sets"]]), np.array([len(s) for s in right["sets"]])
    similarity = shared / (size_a[:, None] + size_b[None, :] - shared)
    linked = together & (similarity >= threshold - 1e-9)
    chance = found_chance(similarity[linked].astype(np.float64), depth, trees)
    return linked, float(linked.sum()), float((1.0 / chance).sum())


def _links_in_blocks(rows: DataFrame, threshold: float, trees: int, max_depth: int, depth: int) -> DataFrame:
    """Verify the rows of each unit; (rep, weight, root, found, expected) per class and unit."""
    schema = pa.schema([("rep", pa.int64()), ("weight", pa.int64()), ("root", pa.int64()), ("found", pa.float64()), ("expected", pa.float64())])

    def run(key, table):
        same = key[2].as_py() == key[3].as_py()
        group, block = table.column("grp").to_numpy(), table.column("block").to_numpy()
        order = np.lexsort((block, group))
        cuts = np.flatnonzero(np.diff(group[order])) + 1
        rep, copies = table.column("rep").to_numpy(), table.column("copies").to_numpy()
        signature, sets = table.column("signature"), table.column("shingles")
        out = []
        for members in np.split(order, cuts):
            kinds = np.unique(block[members])
            if len(members) < 2 or len(kinds) != (1 if same else 2):
                continue
            take = lambda idx: {
                "rep": rep[idx], "labels": tree_labels([signature[int(i)].as_py() for i in idx], trees, max_depth, depth),
                "sets": [np.frombuffer(sets[int(i)].as_py(), dtype=np.uint64) for i in idx]}
            # A diagonal unit holds one block; a unit of two blocks compares across only.
            first = members[block[members] == kinds[0]]
            second = first if same else members[block[members] == kinds[1]]
            left = take(first)
            right = left if same else take(second)
            done = _verify(left, right, same, threshold, depth, trees)
            if done is None:
                continue
            linked, found, expected = done
            both = first if same else np.concatenate([first, second])
            weight = np.zeros(len(both), dtype=np.int64)
            shift = 0 if same else len(first)
            weight[:len(first)] += linked @ copies[second]
            weight[shift:shift + len(second)] += linked.T @ copies[first]
            root = smallest_reachable(rep[both], np.argwhere(linked) + [0, shift])
            share = np.zeros(len(both))
            share[0] = 1
            out.append(pa.table([rep[both], weight, root, share * found, share * expected], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return rows.groupBy("unit_kind", "unit_a", "unit_b", "unit_c").applyInArrow(run, "rep long, weight long, root long, found double, expected double")


def jaccard_join(docs: DataFrame, size: int = SHINGLE_WORDS, threshold: float = THRESHOLD, trees: int = TREES,
                 max_depth: int = MAX_DEPTH, target_recall: float = TARGET_RECALL, block: int = BLOCK) -> DataFrame:
    """(doc_id, class_id, n_links, kept) for every row of ``docs`` (doc_id, text).

    Two texts are linked when the Jaccard similarity of their sets of
    ``size``-word shingles is at least ``threshold``.  n_links counts the other
    rows a row is linked to, copies included; class_id is the smallest doc_id
    reachable by links; kept marks the row whose doc_id is class_id.  A text
    shorter than ``size`` words is one shingle.  A null text or one without
    words links with nothing and is kept, as does a row without a doc_id.  A
    row that repeats a doc_id counts as one more row; with another text, its
    links add to that doc_id's.
    Other columns are not read.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    named = docs.where("doc_id is not null").select("doc_id", "text")
    signed = materialize(signatures(named, size, trees, max_depth), "signatures")
    classes = materialize(
        signed.where("set_a is not null").groupBy("set_a", "set_b")
        .agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.min("signature").alias("signature")), "classes")
    depth = prefix_depth(threshold, trees, max_depth, target_recall)
    while True:
        links, recall = _links_at(named, classes, size, threshold, trees, max_depth, depth, block)
        if recall >= target_recall or depth == 1:
            break
        depth -= 1
    components = connected_components(links.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    weights = links.groupBy("rep").agg(F.sum("weight").alias("weight"))
    found = materialize(
        classes.join(components.withColumnRenamed("node", "rep"), "rep", "left").join(weights, "rep", "left")
        .select("set_a", "set_b", F.coalesce("component", "rep").alias("class_id"),
                (F.col("copies") - 1 + F.coalesce("weight", F.lit(0))).alias("n_links")), "classes")
    out = signed.select("doc_id", "set_a", "set_b").join(found, ["set_a", "set_b"], "left")
    out = out.unionByName(docs.where("doc_id is null").select(F.col("doc_id").cast("long")), allowMissingColumns=True)
    return out.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce(F.col("class_id") == F.col("doc_id"), F.lit(True)).alias("kept"))


def _links_at(docs, classes, size, threshold, trees, max_depth, depth, block):
    """Verified links of all classes that share a prefix of ``depth`` values, and the recall estimated from them."""
    labels = materialize(_labels_of(classes, trees, max_depth, depth), "labels")
    nodes = labels.groupBy("label").agg(F.min("rep").alias("low"), F.count("*").alias("n")).where("n > 1").drop("n")
    meet = labels.join(nodes, "label").select(F.col("rep").alias("a"), F.col("low").alias("b")).distinct()
    groups = connected_components(materialize(meet, "meet")).select(F.col("node").alias("rep"), F.col("component").alias("grp"))
    sizes = groups.groupBy("grp").agg(F.count("*").alias("members"))
    members = materialize(
        groups.join(sizes, "grp").join(classes, "rep").select("rep", "set_a", "grp", "members", "copies", "signature"), "members")
    bins = max(1, members.count() // 500)
    blocks = F.ceil(F.col("members") / block).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    sets = shingle_table(docs.select("doc_id", "text").join(members.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi"), size)
    sets = sets.withColumnRenamed("doc_id", "rep").dropDuplicates(["rep", "set_a"])
    rows = (
        members.join(sets, ["rep", "set_a"])
        .withColumn("blocks", blocks).withColumn("block", own)
        .withColumn("other", F.explode(F.when(F.col("blocks") > 1, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(F.lit(0)))))
        .withColumn("unit_kind", (F.col("blocks") > 1).cast("int"))
        .withColumn("unit_a", F.when(F.col("blocks") > 1, F.col("grp")).otherwise(F.pmod(F.xxhash64("grp"), F.lit(bins))))
        .withColumn("unit_b", F.least("block", "other")).withColumn("unit_c", F.greatest("block", "other"))
        .select("unit_kind", "unit_a", "unit_b", "unit_c", "grp", "block", "rep", "copies", "signature", "shingles")
    )
    links = materialize(_links_in_blocks(rows, threshold, trees, max_depth, depth), "links")
    got = links.agg(F.sum("found").alias("found"), F.sum("expected").alias("expected")).first()
    return links, (got["found"] / got["expected"] if got["expected"] else 1.0)


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that stay when each class of near-copies keeps its smallest doc_id, once.

    Rows without a doc_id stay.
    """
    with temporary_tables(docs.sparkSession) as scope:
        judged = scope.keep(jaccard_join(docs), "judged")
    gone = materialize(judged.where("not kept").select("doc_id").distinct(), "gone")
    kept = docs.join(short_list(gone), "doc_id", "left_anti").select(docs.columns)
    repeated = judged.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    if repeated.isEmpty():
        return kept
    return kept.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(kept.where("doc_id is null"))
