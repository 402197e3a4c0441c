"""How filters interact: what each removes in every order, and its fair share of all that is removed.

A document is judged once, by one bit per filter it fails.  All questions then
are about coalitions of filters: a coalition removes the documents that fail
any of its members, so a step of an order removes the difference between two
coalitions.  The potential of the removal game is computed recursively over
the 32 coalitions,

    P(S) = (removed(S) + sum of P(S without i) over i in S) / |S|,

and a filter's Shapley value is P(all) - P(all without it).  Potentials are
multiples of 1/60, so they are kept as whole numbers of sixtieths.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.joins import short_list
from tabloom.session import materialize

FILTERS = "ABCDE"
MIN_WORDS = 200
_ALL = 2 ** len(FILTERS) - 1
_SIXTIETHS = 60
_SPACE = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Maximal runs of characters other than space and 0x09-0x0D; none for a null text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t-\\r]+"))


def failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails by itself; a null text is empty."""
    known = F.coalesce(text, F.lit(""))
    # Arguments of a function are evaluated once, so the words are split once.
    sizes = F.transform(F.array(words(text)), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("different")))[0]
    few_or_same = F.transform(F.array(sizes), lambda s: (s["n"] < MIN_WORDS).cast("int") + (100 * s["different"].cast("long") < 50 * s["n"].cast("long")).cast("int") * 2)[0]
    capitals = F.regexp_count(known, F.lit("[A-Z]")).cast("long") * 100 > F.char_length(known).cast("long") * 3
    return few_or_same + capitals.cast("int") * 4 + known.rlike("[#$%&*|]").cast("int") * 8


def judged(docs: DataFrame, labels: DataFrame, part: Column) -> DataFrame:
    """(part, failed, n, good, toxic): how many documents of a part fail exactly these filters, and how many of them are labelled so."""
    text = F.coalesce("text", F.lit(""))
    rows = materialize(docs.select("doc_id", part.alias("part"), failures(F.col("text")).alias("own"), F.unhex(F.sha2(text, 256)).alias("digest")), "judged")
    # A digest of many rows is reduced before it is shuffled; written, so that a hot one's rows can be split over tasks.
    firsts = materialize(rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").drop("last"), "firsts")
    repeated = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int") * 16
    failed = rows.join(short_list(firsts), "digest", "left").select("doc_id", "part", (F.col("own") + repeated).alias("failed"))
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    never = F.lit(False)
    named = failed.where("doc_id is not null").join(known, "doc_id", "left").withColumns({c: F.coalesce(c, never) for c in ("good", "toxic")}).drop("doc_id")
    nameless = failed.where("doc_id is null").select("part", "failed", never.alias("good"), never.alias("toxic"))
    return named.unionByName(nameless).groupBy("part", "failed").agg(F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))


def coalitions(judged_rows: DataFrame) -> DataFrame:
    """(part, total, removed, good, toxic): per part what each of the coalitions removes, by its bits as the position in the arrays."""
    each = judged_rows.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit(_ALL))))
    gone = lambda c: F.sum(F.when(F.col("failed").bitwiseAND(F.col("coalition")) != 0, F.col(c)).otherwise(F.lit(0)))
    sums = each.groupBy("part", "coalition").agg(gone("n").alias("removed"), gone("good").alias("good"), gone("toxic").alias("toxic"), F.sum("n").alias("total"))
    rows = sums.groupBy("part").agg(F.max("total").alias("total"), F.array_sort(F.collect_list(F.struct("coalition", "removed", "good", "toxic"))).alias("c"))
    return rows.select("part", "total", *[F.col("c").getField(name).alias(name) for name in ("removed", "good", "toxic")])


def potentials(removed: Column) -> Column:
    """Sixtieths of the potential of every coalition."""

    def potential(known: Column, s: Column) -> Column:
        without = sum((F.when(s.bitwiseAND(F.lit(1 << k)) != 0, F.get(known, s - (1 << k))).otherwise(F.lit(0)) for k in range(len(FILTERS))), F.lit(0))
        # Exact: sixtieths of dividends over at most five members are whole.
        return F.call_function("div", _SIXTIETHS * F.get(removed, s) + without, F.bit_count(s))

    return F.aggregate(F.sequence(F.lit(1), F.lit(_ALL)), F.array(F.lit(0).cast("long")), lambda known, s: F.concat(known, F.array(potential(known, s).cast("long"))))


def filter_audit(docs: DataFrame, labels: DataFrame, part: Column | None = None) -> DataFrame:
    """One row per part, order of the five filters, and step, with the counts of that step.

    (part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley).  ``part`` is the language unless given; a
    null one is the empty string.  Filters: A under 200 words, B less than half
    of the words different, C more than 3 capitals in 100 characters, D holds
    one of ``#$%&*|``, E has the text of a row with a smaller doc_id, in
    whatever part.  A null text is empty, and equal to empty ones.  A row
    without doc_id never fails E, makes none fail it, and has no label.  Rows
    that repeat a doc_id are documents of their own and fail E together.  Of
    several labels of a document, any counts.  ``shapley`` is the sum over all
    120 orders of what the step's filter removes.  Empty ``docs`` give no rows.
    """
    parts = F.coalesce(F.col("lang") if part is None else part, F.lit(""))
    game = coalitions(judged(docs, labels, parts)).withColumn("potential", potentials(F.col("removed")))
    game = game.withColumn("filter_order", F.explode(F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)]))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    members = lambda letters: sum(((F.instr(letters, f) > 0).cast("int") * (1 << k) for k, f in enumerate(FILTERS)), F.lit(0))
    steps = game.withColumns({"after": members(F.substring("filter_order", F.lit(1), F.col("step"))), "own": members(F.substring("filter_order", F.col("step"), F.lit(1)))})
    before, others = F.col("after") - F.col("own"), F.lit(_ALL) - F.col("own")
    at = lambda name, c: F.get(F.col(name), c)
    removed = at("removed", F.col("after")) - at("removed", before)
    return steps.select(
        "part", "filter_order", "step", (F.col("total") - at("removed", F.col("after"))).alias("kept"), removed.alias("removed"), (at("removed", F.col("own")) - removed).alias("redundant"),
        (at("removed", F.lit(_ALL)) - at("removed", others)).alias("unique_fails"), (at("good", F.col("after")) - at("good", before)).alias("good_lost"),
        (at("toxic", F.col("after")) - at("toxic", before)).alias("toxic_lost"),
        (F.lit(120 // _SIXTIETHS) * (at("potential", F.lit(_ALL)) - at("potential", others))).cast("long").alias("shapley"))


def audit_sql() -> str:
    """The same rows by applying every order to every document."""
    fails = {
        "A": "n < 200", "B": "100 * different < 50 * n", "C": "100 * capitals > 3 * size", "D": r"regexp_matches(known, '[#$%&*|]')", "E": "coalesce(doc_id > first, false)",
    }
    orders = ", ".join(f"'{''.join(p)}'" for p in permutations(FILTERS))
    return rf"""
with texts as (
    select doc_id, coalesce(lang, '') as part, coalesce(text, '') as known, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
),
sized as (
    select doc_id, part, known, len(words) as n, len(list_distinct(words)) as different, length(regexp_replace(known, '[^A-Z]', '', 'g')) as capitals, length(known) as size,
        min(doc_id) over (partition by known) as first
    from texts
),
marks as (
    select doc_id, part, {", ".join(f"case when {rule} then '{f}' else '' end" for f, rule in fails.items()).replace(", case", " || case")} as fails from sized
),
docs as (
    select m.part, m.fails, count(*) as n, count(*) filter (where l.good) as good, count(*) filter (where l.toxic) as toxic from marks m
    left join (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id) l using (doc_id) group by all
),
steps as (
    select filter_order, step, substr(filter_order, cast(step as integer), 1) as own, substr(filter_order, 1, cast(step as integer) - 1) as earlier
    from (select unnest([{orders}]) as filter_order), (select unnest(range(1, 6)) as step)
),
met as (
    select part, filter_order, step, own, n, good, toxic, contains(fails, own) as failing, fails = own as only_own,
        len(list_intersect(string_split(fails, ''), string_split(earlier, ''))) > 0 and earlier <> '' as gone
    from docs, steps
),
counted as (
    select part, filter_order, cast(step as integer) as step, own, cast(sum(n) filter (where not gone and not failing) as bigint) as kept, cast(sum(n) filter (where not gone and failing) as bigint) as removed,
        cast(sum(n) filter (where gone and failing) as bigint) as redundant, cast(sum(n) filter (where only_own) as bigint) as unique_fails,
        cast(sum(good) filter (where not gone and failing) as bigint) as good_lost, cast(sum(toxic) filter (where not gone and failing) as bigint) as toxic_lost
    from met group by part, filter_order, step, own
)
select part, filter_order, step, coalesce(kept, 0) as kept, coalesce(removed, 0) as removed, coalesce(redundant, 0) as redundant, coalesce(unique_fails, 0) as unique_fails,
    coalesce(good_lost, 0) as good_lost, coalesce(toxic_lost, 0) as toxic_lost, cast(sum(coalesce(removed, 0)) over (partition by part, own) as bigint) as shapley
from counted
"""
