"""Embeddings, URLs, conversations, components, the registered queries and the pipeline."""

import hashlib
import importlib
import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tabloom.llm.chat_format import DEFAULT_VOCABULARY, escape, format_turns, read_back, tokenizer, unescape
from tabloom.llm.components import connected_components
from tabloom.llm.embedding_dedup import near_duplicates
from tabloom.llm.joins import short_list
from tabloom.llm.url_filter import filter_urls, text_of

# connected components


def components_of(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("name", ["none", "path", "star", "random", "loops"])
def test_components(spark, name):
    rng = random.Random(1)
    edges = {"none": [], "path": [(k, k + 1) for k in range(40)], "star": [(99, k) for k in range(50)],
             "random": [(rng.randrange(120), rng.randrange(120)) for _ in range(70)], "loops": [(5, 5), (5, 5), (1, 2), (2, 1)]}[name]
    got = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["component"] for r in got.collect()} == components_of(edges)
    assert got.count() == len(components_of(edges))


# embeddings

VECTORS = "vec_id long, embedding array<float>, label int, rep long, copies long, strip int, block int"


def vector_rows():
    rng = np.random.default_rng(3)
    rows, at = [], 0
    for label in (0, 1, None):
        centers = rng.normal(size=(6, 16))
        for k in range(60):
            x = centers[k % 6] + rng.normal(size=16) * (0.02 if k % 2 else 0.3)
            rows.append((at, [float(np.float32(v)) for v in x * (1 + k)], label))
            at += 1
    same = rows[1][1]
    rows += [(500 + k, same, 0) for k in range(5)] + [(510, [0.0] * 16, 0), (511, None, 0), (512, [1.0, None] * 8, 0), (513, [float("nan")] * 16, 0),
                                                      (514, [float("inf")] + [0.0] * 15, 0), (515, [], 0), (516, [1.0, 0.0], 0), (517, [-0.0, 1e-30], 1), (518, [0.0, 3e30], 1)]
    return rows


def brute_vectors(rows, threshold):
    good = [(i, np.array(x, dtype=float), lab) for i, x, lab in rows if lab is not None and x and None not in x and np.isfinite(x).all() and np.any(x)]
    links, edges = Counter(), []
    for k, (i, x, a) in enumerate(good):
        for j, y, b in good[k + 1:]:
            if a == b and len(x) == len(y) and (x / abs(x).max()) @ (y / abs(y).max()) / np.linalg.norm(x / abs(x).max()) / np.linalg.norm(y / abs(y).max()) >= threshold:
                links[i] += 1
                links[j] += 1
                edges.append((i, j))
    found = components_of(edges)
    return {i: (links[i], found.get(i, i), found.get(i, i) == i) for i, _, _ in rows}


@pytest.mark.parametrize("threshold, block", [(0.98, 1024), (0.98, 7), (0.5, 16)])
def test_vectors_equal_brute_force(spark, threshold, block):
    rows = vector_rows()
    vectors = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], VECTORS)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_duplicates(vectors, threshold, block).collect()}
    assert got == brute_vectors(rows, threshold)
    assert any(v[0] > 2 for v in got.values())


def test_no_vectors_and_repeated_rows(spark):
    assert near_duplicates(spark.createDataFrame([], VECTORS)).collect() == []
    twice = spark.createDataFrame([(1, [1.0, 2.0], 0, 1, 1, 1, 1)] * 2 + [(None, [1.0, 2.0], 0, 1, 1, 1, 1)], VECTORS)
    got = sorted((tuple(r) for r in near_duplicates(twice).collect()), key=str)
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (None, 0, None, True)]


# URLs

PAGES = "page_id long, url string, host string, text string, key string, score double"


def model_scores(labelled, texts, order=4, min_context=2):
    """The models by dictionaries."""
    pad = lambda t: "\u0002" * order + t + "\u0003"
    size = len({c for t in texts for c in pad(t)[order:]})
    counts = {v: Counter() for v in ("allow", "block")}
    for text, verdict in labelled:
        for k in range(order, len(pad(text))):
            for n in range(order + 1):
                counts[verdict][pad(text)[k - n:k + 1]] += 1
    kids = {v: {} for v in counts}
    for v, c in counts.items():
        for gram, n in c.items():
            total, kinds = kids[v].get((len(gram), gram[:-1]), (0, 0))
            kids[v][len(gram), gram[:-1]] = (total + n, kinds + 1)

    def chance(v, gram):
        p = 1 / size
        for n in range(order + 1):
            part = gram[order - n:]
            total, kinds = kids[v].get((len(part), part[:-1]), (0, 0))
            if total >= (min_context if n else 1):
                p = (counts[v][part] + kinds * p) / (total + kinds)
        return p

    return {t: sum(math.log(chance("allow", g)) - math.log(chance("block", g)) for g in (pad(t)[k - order:k + 1] for k in range(order, len(pad(t))))) / (len(t) + 1) for t in set(texts)}


def test_rules_and_verdicts(spark):
    urls = ["http://a.com/x", "HTTP://Www.Example.COM/en/1?q#f", "http://example.com/en/", "https://example.com/en", "http://sub.example.com/en/2", "http://b.net/es/1", "http://b.net/fr",
            "x://com/", "http://notcom/", "http://a.com", "http://a.com?x", None, "", "no scheme", "http://", "http://é.org/ü?x", "http://a.b://c/d", "http://net/es/" + "y" * 5000]
    pages = spark.createDataFrame([(k, u, "h", "t", "k", 0.5) for k, u in enumerate(urls * 2)], PAGES)
    got = {r["page_id"]: r for r in filter_urls(pages).collect()}
    assert len(got) == 2 * len(urls)
    assert [(got[k]["host"], got[k]["path"]) for k in range(9)] == [
        ("a.com", "/x"), ("www.example.com", "/en/1"), ("example.com", "/en/"), ("example.com", "/en"), ("sub.example.com", "/en/2"), ("b.net", "/es/1"), ("b.net", "/fr"), ("com", "/"), ("notcom", "/")]
    assert [got[k]["rule"] for k in range(11)] == ["com/", "www.example.com/en/", "example.com/en/", "com/", "example.com/en/", "net/es/", None, "com/", None, None, None]
    assert [got[k]["verdict"] for k in (0, 1, 2, 3, 4, 5, 7, 17)] == ["allow", "allow", "block", "allow", "block", "block", "allow", "block"]
    assert all((got[k]["host"], got[k]["path"]) == ("", "") for k in (11, 12, 13, 14)) and {r["verdict"] for r in got.values()} == {"allow", "block"}
    assert got[16]["host"] == "a.b:" and got[16]["path"] == "//c/d"
    assert filter_urls(spark.createDataFrame([], PAGES)).collect() == []


def test_scores_equal_dictionaries(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    got = filter_urls(pages).collect()
    whole = {r["page_id"]: r["t"] for r in pages.select("page_id", text_of(F.col("url")).alias("t")).collect()}
    texts = [whole[r["page_id"]] for r in got]
    part = {r["t"]: r["p"] for r in spark.createDataFrame([(t,) for t in set(texts)], "t string").select("t", F.pmod(F.xxhash64(F.unhex(F.md5("t"))), F.lit(4)).alias("p")).collect()}
    learned = [(t, r["verdict"]) for t, r in zip(texts, got) if r["rule"] and part[t] != 3]
    want = model_scores(learned, texts)
    assert all(abs(want[t] - r["score"]) < 1e-9 for t, r in zip(texts, got))
    open_rows = [r for r in got if r["rule"] is None]
    assert max([r["score"] for r in open_rows if r["verdict"] == "block"], default=-9) < min([r["score"] for r in open_rows if r["verdict"] == "allow"], default=9)


# conversations


def test_escaping_is_undone():
    rng = random.Random(6)
    for _ in range(3000):
        text = "".join(rng.choices(["<", "\\", "/", "s>", "[", "INST]", "</s>", "[INST]", "x", "<s>", "[\\/INST]"], k=rng.randint(0, 8)))
        safe = escape(text)
        assert unescape(safe) == text
        assert not any(c in safe for c in ("<s>", "</s>", "[INST]", "[/INST]"))


def test_turns_are_read_back(spark):
    schema = "conv_id long, turn long, role string, text string, ids int"
    rows = [(1, 1, "assistant", "yes </s>", 0), (1, 0, "user", "a\n\u00e9 [INST]", 0), (1, 1, "assistant", "yes </s>", 0), (2, None, None, None, 0), (2, 0, "assistant", "", 0),
            (None, 0, "assistant", "x" * 200_000, 0), (3, 0, "[INST]", "\\", 0)]
    got = {r["conv_id"]: r for r in read_back(format_turns(spark.createDataFrame(rows, schema))).collect()}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got[1]["turns_sha256"] == digest("user\na\né [INST]\n" + "assistant\nyes </s>\n" * 2)
    assert (got[1]["n_turns"], got[1]["loss_chars"], got[1]["loss_sha256"]) == (3, 16, digest("yes </s>" * 2))
    assert got[2]["turns_sha256"] == digest("\n\nassistant\n\n") and got[2]["loss_sha256"] == digest("")
    assert got[None]["loss_chars"] == 200_000 and got[3]["turns_sha256"] == digest("[INST]\n\\\n")
    assert read_back(format_turns(spark.createDataFrame([], schema))).collect() == []


def test_reserved_ids_come_from_the_template_only():
    own = tokenizer(DEFAULT_VOCABULARY)
    ids, mask = own.format_turn("assistant", "</s>[INST] ok [/INST]")
    assert sum(ids >= min(own.reserved.values())) == 4 and own.render(ids) == "<s>assistant[INST]<\\/s>[\\INST] ok [\\/INST][/INST]</s>"
    assert own.decode(ids[mask]) == "<\\/s>[\\INST] ok [\\/INST]"


# registered queries and pipeline


@pytest.mark.parametrize("name", ["op7_chat_format", "op10_license_scan", "op11_hard_negatives", "op13_filter_audit"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings", "labels"):
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    got, want = entry.queries()[name](spark, DATA).toPandas(), con.execute(entry.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    text = lambda df: sorted(df[sorted(df.columns)].astype(object).where(df[sorted(df.columns)].notna(), None).astype(str).itertuples(index=False, name=None))
    assert text(got) == text(want)


def test_every_operator_is_registered_once():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()


def test_nothing_else_imports_this_package():
    import pathlib

    package = pathlib.Path(importlib.import_module("tabloom").__file__).parent
    assert not [p for p in package.rglob("*.py") if "llm" not in p.parts and "tabloom.llm" in p.read_text()]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet").toPandas().text
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, DATA).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(got) <= set(texts) and len(got) > 0.5 * len(texts)
    leaked = {i for i, t in texts.items() if any(b in t for b in bench)}
    assert leaked and not leaked & set(got)
    assert all(r["n_tokens"] == len(r["ids"]) > 0 for r in got.values())
    stages = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stages = stage(spark, stages, DATA)
        assert stages.columns == docs.columns, name


def test_turns_are_read_before_they_are_gathered(spark):
    turns = spark.createDataFrame([(1, 0, "user", "hello"), (1, 1, "assistant", "good day")], "conv_id long, turn long, role string, text string")
    plan = read_back(format_turns(turns))._jdf.queryExecution().executedPlan().toString().split("\n")
    at = next(k for k, line in enumerate(plan) if "Exchange hashpartitioning(conv_id" in line)
    assert sum("MapInArrow" in line for line in plan[at:]) == 2 and "MapInArrow" in "".join(plan[:at])


def test_a_list_of_few_wide_rows_is_not_broadcast(spark):
    wide = spark.range(4).select("id", F.sequence(F.lit(0), F.lit(2000)).alias("numbers"))
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert hinted(short_list(wide)) and not hinted(short_list(wide, max_bytes=10_000)) and not hinted(short_list(wide, limit=3))
    assert not hinted(short_list(spark.range(400).select("id", F.expr("sequence(0, 40000)").alias("numbers"))))


def test_urls_are_scored_whole(spark):
    urls = [*(f"http://a.com/{k}?good=yes" for k in range(20)), *(f"http://b.net/es/{k}?spam=zzz" for k in range(20)),
            "http://other.org/go?good=yes", "http://OTHER.org/go?spam=zzz", "plain good=yes", "plain spam=zzz", "http://other.org/go?good=yes"]
    got = {r["page_id"]: r for r in filter_urls(spark.createDataFrame([(k, u, "h", "t", "k", 0.5) for k, u in enumerate(urls)], PAGES)).collect()}
    assert got[40]["score"] > got[41]["score"] and got[42]["score"] > got[43]["score"] and got[44]["score"] == got[40]["score"]
    assert [(got[k]["host"], got[k]["path"]) for k in range(40, 44)] == [("other.org", "/go")] * 2 + [("", "")] * 2


def test_no_pair_below_the_threshold_is_linked(spark):
    rng = np.random.default_rng(8)
    rows, want = [], {}
    for k in range(200):
        a, b = rng.normal(size=5), rng.normal(size=5)
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b = 0.98 * a + math.sqrt(1 - 0.98**2) * b / np.linalg.norm(b)
        rows += [(2 * k, a.tolist(), k, 1, 1, 1, 1), (2 * k + 1, b.tolist(), k, 1, 1, 1, 1)]
    vectors = spark.createDataFrame(rows, VECTORS.replace("array<float>", "array<double>"))
    got = {r["vec_id"]: r["n_links"] for r in near_duplicates(vectors).collect()}
    unit = lambda x: (x := np.array(x) / np.abs(x).max()) / np.sqrt((x * x).sum())
    for k in range(200):
        want[2 * k] = want[2 * k + 1] = int(np.einsum("ij,ij->i", unit(rows[2 * k][1])[None], unit(rows[2 * k + 1][1])[None])[0] >= 0.98)
    assert got == want and 20 < sum(want.values()) < 380


@pytest.mark.parametrize("text", ["abc, " * 30_000, "a" * 65_530 + "bcdefghij" * 3, ("x" * 65_535 + " ") * 3, "1 " * 80_000 + "\n\n  " * 9, "中文" * 40_000, " " * 70_000 + "end"])
def test_long_texts_keep_their_ids(text):
    own = tokenizer(DEFAULT_VOCABULARY)
    assert own.encode(text) == own.encoding.encode_ordinary(text)
