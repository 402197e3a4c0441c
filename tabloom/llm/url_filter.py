"""URL filter: host and path rules first, then the ratio of two character language models.

URLs that a rule accepts or rejects are the labelled texts.  For each class a
Markov model of variable order gives the chance of the next character: the
longest context of up to ``order`` characters seen at least ``min_context``
times in that class, smoothed with the shorter ones (Witten-Bell).  A URL's
score is the difference of its log-likelihoods per character; the threshold is
calibrated on labelled URLs that were not learned from.

Counts and model are tables: n-grams are summed before each shuffle, lower
orders are sums of the highest one, and URLs meet their n-grams in a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.session import materialize

#: (verdict, host and path prefix); a rule covers its host and all subdomains, the longest rule wins.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
ORDER = 4
MIN_CONTEXT = 2
_CALIBRATE = 3  # the fourth of labelled texts that sets the threshold
_WIDTH = 4  # bytes of a character in UTF-32


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty for a null url or one without ://."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the end of the host up to ?, # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def text_of(url: Column) -> Column:
    """The whole URL, its host lower-cased; empty for a null one."""
    known = F.coalesce(url, F.lit(""))
    before, after = F.regexp_extract(known, r"(?s)^(.*?://)", 1), F.regexp_extract(known, r"(?s)^.*?://[^/?#]*(.*)$", 1)
    return F.when(before == "", known).otherwise(F.concat(before, host_of(url), after))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """A struct (rule, verdict) of the longest rule that fits; null without one."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _grams(texts: DataFrame, order: int) -> DataFrame:
    """One row per character and the end of each text: the character with ``order`` before it, in UTF-32."""
    padded = F.encode(F.concat(F.lit("\u0002" * order), "text", F.lit("\u0003")), "UTF-32")
    spots = F.sequence(F.lit(0), F.char_length("text"))
    return (texts.withColumn("bytes", padded).withColumn("spot", F.explode(spots))
            .withColumn("gram", F.substring(F.col("bytes"), F.col("spot") * _WIDTH + 1, F.lit((order + 1) * _WIDTH))).drop("bytes", "spot", "text"))


def learn_model(labelled: DataFrame, order: int = ORDER, min_context: int = MIN_CONTEXT) -> DataFrame:
    """(gram, ratio): log P(allow) - log P(block) of the last character given those before it.

    ``labelled`` has text, n_allow and n_block, how often each text was learned
    in either class; texts with neither get their n-grams scored too.
    """
    counts = materialize(_grams(labelled, order).groupBy("gram").agg(F.sum("n_allow").alias("allow"), F.sum("n_block").alias("block")), "grams")
    size = counts.select(F.substring("gram", order * _WIDTH + 1, _WIDTH)).distinct().count()
    chances = None
    for k in range(order + 1):
        own = (counts.withColumn("gram", F.substring("gram", (order - k) * _WIDTH + 1, (k + 1) * _WIDTH))
               .groupBy("gram").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
               .withColumn("context", F.substring("gram", 1, k * _WIDTH)))
        totals = own.groupBy("context").agg(*[f(c).alias(c + n) for c in ("allow", "block") for f, n in (
            (F.sum, "_total"), (lambda x: F.sum((F.col(x) > 0).cast("long")), "_kinds"))])
        level = own.join(totals, "context")
        if chances is None:
            level = level.withColumns({"allow_lower": F.lit(1.0 / max(size, 1)), "block_lower": F.lit(1.0 / max(size, 1))})
        else:
            lower = chances.select(F.col("gram").alias("shorter"), F.col("allow_p").alias("allow_lower"), F.col("block_p").alias("block_lower"))
            level = level.withColumn("shorter", F.substring("gram", _WIDTH + 1, k * _WIDTH)).join(lower, "shorter")
        enough = 1 if k == 0 else min_context
        chance = {f"{c}_p": F.when(F.col(f"{c}_total") >= enough, (F.col(c) + F.col(f"{c}_kinds") * F.col(f"{c}_lower")) / (F.col(f"{c}_total") + F.col(f"{c}_kinds")))
                  .otherwise(F.col(f"{c}_lower")) for c in ("allow", "block")}
        chances = materialize(level.withColumns(chance).select("gram", "allow_p", "block_p"), "chances")
    return chances.select("gram", (F.ln("allow_p") - F.ln("block_p")).alias("ratio"))


def score_texts(texts: DataFrame, model: DataFrame, order: int = ORDER) -> DataFrame:
    """(key, score): the mean ratio over the characters and the end of each text (key, text)."""
    return _grams(texts.select("key", "text"), order).join(model, "gram").groupBy("key").agg(F.avg("ratio").alias("score"))


def filter_urls(pages: DataFrame, rules=RULES, order: int = ORDER, min_context: int = MIN_CONTEXT) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for every row of ``pages`` (page_id, url).

    A rule's verdict stands; other URLs are allowed when their score reaches
    the threshold.  Models learn from and score the whole URL, rules see host and
    path.  A null URL or one without :// has an empty host and path; a null one
    is scored as the empty text.  If one class has nothing to learn from
    every other URL scores towards the other; without labelled URLs at all
    scores are 0 and all are allowed.  Equal URLs are scored once and repeated
    rows stay.  Other columns are not read.
    """
    url = F.col("url")
    judged = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), text_of(url).alias("text"))
    judged = judged.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    judged = judged.withColumn("key", F.unhex(F.md5("text")))
    part = F.pmod(F.xxhash64("key"), F.lit(4))
    texts = materialize(
        judged.groupBy("key", "text").agg(*[F.sum((F.col("found.verdict") == v).cast("long")).alias(f"all_{v}") for v in ("allow", "block")])
        .withColumns({f"all_{v}": F.coalesce(f"all_{v}", F.lit(0)) for v in ("allow", "block")})
        .withColumns({f"n_{v}": F.when(part != _CALIBRATE, F.col(f"all_{v}")).otherwise(F.lit(0)) for v in ("allow", "block")}), "texts")
    model = learn_model(texts.select("text", "n_allow", "n_block"), order, min_context)
    scores = materialize(score_texts(texts, model, order), "scores")
    threshold = _threshold(texts.where(part == _CALIBRATE).join(scores, "key"))
    out = judged.join(scores, "key", "left")
    learned = F.when(F.coalesce("score", F.lit(0.0)) >= threshold, "allow").otherwise("block")
    return out.select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", learned).alias("verdict"), "score")


def _threshold(held: DataFrame) -> float:
    """Where both classes of ``held`` (all_allow, all_block, score) stand equally many deviations apart; 0 if one is absent."""
    sums = {}
    for c in ("allow", "block"):
        n, x = F.col(f"all_{c}"), F.col("score")
        sums |= {f"{c}_n": F.sum(n), f"{c}_x": F.sum(n * x), f"{c}_xx": F.sum(n * x * x)}
    s = held.agg(*[v.alias(k) for k, v in sums.items()]).first()
    if not (s["allow_n"] and s["block_n"]):
        return 0.0
    mean = {c: s[f"{c}_x"] / s[f"{c}_n"] for c in ("allow", "block")}
    spread = {c: max(s[f"{c}_xx"] / s[f"{c}_n"] - mean[c] ** 2, 1e-12) ** 0.5 for c in ("allow", "block")}
    return (mean["allow"] * spread["block"] + mean["block"] * spread["allow"]) / (spread["allow"] + spread["block"])
