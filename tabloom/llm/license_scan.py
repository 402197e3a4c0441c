"""Licence scan by canonical digests.

A text is brought to canonical form: lower case, copyright lines dropped,
everything but letters and digits a space, and equivalent spellings made one.
The units of a document (the whole text, its blocks between blank lines, its
lines) are looked up whole, by digest, among the digests of known licences.
Only units of the exact length of a known text are digested; no other can be equal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm.license_texts import LICENSE_TEXTS

#: Spellings that mean the same in a licence; fixed values, applied in this order to canonical words.
SPELLINGS = (
    ("licence", "license"), ("licenced", "licensed"), ("organisation", "organization"), ("acknowledgement", "acknowledgment"), ("authorisation", "authorization"),
    ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("copyright owner", "copyright holder"), ("per cent", "percent"), ("favour", "favor"),
    ("https", "http"), ("and or", "or"),
)
#: A line that only states a copyright, after any marks of a comment.
_COPYRIGHT = r"\n[^\na-z0-9]*(copyright[ \t]*(\(c\)|©|[0-9{<\[])|\(c\)[ \t]|©)[^\n]*"
_RESERVED = r"\n[^\na-z0-9]*all rights reserved\.?"
_OTHER = r"[^\p{L}\p{N}\n]+"
#: No spelling shortens a text by more than a third, so longer ones cannot become equal to a known text.
_SLACK = 1.5

KNOWN_ROWS = 10_000


def canonical_sql(column: str, all_matches: str = "") -> str:
    """SQL for the canonical lines of a text; ``all_matches`` is DuckDB's flag, as Spark replaces all anyway."""
    def replaced(x, pattern, by):
        return f"regexp_replace({x}, r'{pattern}', '{by}'{all_matches})" if not all_matches else f"regexp_replace({x}, '{pattern}', '{by}'{all_matches})"

    lines = f"concat(chr(10), lower(coalesce({column}, '')))"
    for pattern in (_COPYRIGHT, _RESERVED):
        lines = replaced(lines, pattern, "")
    return replaced(lines, _OTHER, " ")


def joined_sql(column: str, all_matches: str = "") -> str:
    """SQL for canonical lines joined to one text, single spaces between words."""
    raw = "" if all_matches else "r"
    return f"trim(regexp_replace({column}, {raw}'[ \\n]+', ' '{all_matches}))"


def spelled_sql(column: str) -> str:
    """SQL for a canonical text with equivalent spellings made one, whole words at the front of a match."""
    out = f"concat(' ', {column})"
    for other, usual in SPELLINGS:
        out = f"replace({out}, ' {other}', ' {usual}')"
    return f"trim({out})"


def known_digests(texts: DataFrame) -> DataFrame:
    """(digest, license, size) of known texts (license, text); of equal texts the first licence by name."""
    canon = texts.select("license", F.expr(spelled_sql(joined_sql(canonical_sql("text")))).alias("canon")).where("canon <> ''")
    return canon.groupBy(F.md5("canon").alias("digest")).agg(F.min("license").alias("license"), F.max(F.length("canon")).alias("size"))


def default_licenses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LICENSE_TEXTS), "license string, text string")


def scan_licenses(docs: DataFrame, texts: DataFrame | None = None) -> DataFrame:
    """(doc_id, text_license, licenses, n_units) for each document with a known licence text.

    text_license is the licence that the whole text is, or null; licenses the
    sorted names, joined by a comma, of all licences found as whole text, block
    or line; n_units how many units were found (a block of one line counts as
    block and line, and a text of one block as text too).  Null and empty texts
    have no units; rows that repeat a doc_id are summed up.  ``texts`` (license,
    text) is a list of at most ``KNOWN_ROWS`` rows, which is checked.  Other
    columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    known = known_digests(default_licenses(spark) if texts is None else texts)
    sizes = [r["size"] for r in known.select("size").distinct().limit(KNOWN_ROWS + 1).collect()]
    if len(sizes) > KNOWN_ROWS or known.limit(KNOWN_ROWS + 1).count() > KNOWN_ROWS:
        raise ValueError(f"more than {KNOWN_ROWS} known licence texts")
    longest = int(max(sizes, default=0) * _SLACK)
    lines = docs.select("doc_id", F.expr(canonical_sql("text")).alias("lines"))
    kinds = F.expr(f"""concat(
        array(struct('text' as kind, {joined_sql("lines")} as unit)),
        transform(split(lines, r'\\n[ ]*\\n[ \\n]*'), b -> struct('block' as kind, {joined_sql("b")} as unit)),
        transform(split(lines, r'\\n'), l -> struct('line' as kind, trim(l) as unit)))""")
    short = F.filter(kinds, lambda u: (F.length(u["unit"]) > 0) & (F.length(u["unit"]) <= longest))
    units = lines.select("doc_id", F.explode(short).alias("u")).select("doc_id", "u.kind", F.expr(spelled_sql("u.unit")).alias("canon"))
    units = units.where(F.length("canon").isin(sizes)).select("doc_id", "kind", F.md5("canon").alias("digest"))
    found = units.join(F.broadcast(known), "digest")
    return found.groupBy("doc_id").agg(
        F.min(F.when(F.col("kind") == "text", F.col("license"))).alias("text_license"),
        F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"), F.count("*").alias("n_units"))


def license_sql() -> str:
    """The same scan for DuckDB, from the same word lists."""
    flag = ", 'g'"
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({quote(name)}, {quote(text)})" for name, text in LICENSE_TEXTS)
    return f"""
with known as (
    select md5({spelled_sql(joined_sql(canonical_sql("text", flag), flag))}) as digest, min(license) as license
    from (values {values}) t(license, text) group by 1
),
canon as (select doc_id, {canonical_sql("text", flag)} as lines from documents),
units as (
    select doc_id, 'text' as kind, {joined_sql("lines", flag)} as unit from canon
    union all select doc_id, 'block', {joined_sql("b", flag)} from (select doc_id, unnest(string_split_regex(lines, '\\n[ ]*\\n[ \\n]*')) as b from canon)
    union all select doc_id, 'line', trim(l) from (select doc_id, unnest(string_split(lines, chr(10))) as l from canon)
),
found as (
    select u.doc_id, u.kind, k.license from (select doc_id, kind, md5({spelled_sql("unit")}) as digest from units where unit <> '') u join known k using (digest)
)
select doc_id, min(case when kind = 'text' then license end) as text_license,
    array_to_string(list_sort(list(distinct license)), ',') as licenses, count(*) as n_units
from found group by doc_id
"""
