"""Operators on documents: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
from conftest import plan_of
from pyspark.sql import functions as F

from tabloom.llm import line_dedup
from tabloom.llm.decontaminate import contaminated, within_radius, without_contaminated
from tabloom.llm.jaccard_forest import found_chance, jaccard_join, one_of_each, prefix_depth
from tabloom.llm.language_id import GramTally, held_out, identify, recognised
from tabloom.llm.license_scan import default_licenses, scan_licenses
from tabloom.llm.license_texts import LICENSE_TEXTS
from tabloom.llm.line_dedup import repeated_lines, without_repeated_lines
from tabloom.llm.piece_encoding import default_model, encode_texts, encoder
from tabloom.llm.substring_dedup import remove_repeats

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, rep long, line string, value int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, texts, langs=None):
    """Documents with columns whose names the operators use themselves."""
    rows = [(i, t, (langs or {}).get(i, "en"), "s", None if t is None else len(t), 1, 2, "x", 3) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def some_words(seed, n, size=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(size)}x{rng.randrange(size)}" for _ in range(n)]


def edge_texts():
    return [(900, None), (901, ""), (902, " \n\t "), (903, "one"), (904, "one"), (905, "a b c d"), (906, "x" * 200_000), (907, "word " * 30_000)]


def rows_of(df):
    return [tuple(r) for r in df.collect()]


OPERATORS = [identify, recognised, jaccard_join, one_of_each, remove_repeats, repeated_lines, without_repeated_lines, encode_texts, scan_licenses]


@pytest.mark.parametrize("operator", OPERATORS, ids=lambda f: f.__name__)
def test_empty_table(spark, operator):
    assert operator(spark.createDataFrame([], SCHEMA)).collect() == []


# language identification


def test_languages(spark):
    lang = lambda i: "aa" if i % 2 else "bb"
    letters = {"aa": "xyzwv", "bb": "abcde"}
    rng = random.Random(3)
    texts = [(i, " ".join("".join(rng.choices(letters[lang(i)], k=4)) for _ in range(30))) for i in range(80)]
    langs = {i: lang(i) for i, _ in texts} | {7: None}
    docs = table(spark, [*texts, (500, None), (501, "123 !!"), (502, ""), (7, texts[7][1])], langs)
    got = identify(docs).collect()
    assert len(got) == 84
    for r in got:
        if r["doc_id"] >= 500:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] == lang(r["doc_id"]) and 0 < r["score"] <= 1
    assert {r["held_out"] for r in got} == {True, False}
    left = recognised(docs)
    assert left.columns == docs.columns and left.count() == 81


def test_n_grams_are_counted_in_little_memory():
    import tracemalloc

    rng = np.random.default_rng(5)
    parts = [(lang, rng.integers(0, 3000, 200_000).astype(np.uint64)) for lang in "abc" * 20]
    tracemalloc.start()
    tally = GramTally()
    for lang, keys in parts:
        tally.add(lang, keys.copy())
    got = {}
    for batch in tally.rows():
        for lang, gram, n in zip(*(c.to_pylist() for c in batch.columns)):
            got[lang, gram] = got.get((lang, gram), 0) + n
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = {}
    for lang in "abc":
        grams, n = np.unique(np.concatenate([k for x, k in parts if x == lang]), return_counts=True)
        want |= {(lang, int(g)): int(c) for g, c in zip(grams, n)}
    assert got == want
    # All keys have 96 MB; waiting ones 8 MB, copied to be counted.
    assert peak < 40e6
    assert list(tally.rows()) == []


def test_recognised_sends_a_text_once(spark):
    docs = table(spark, [(1, "some words"), (2, None), (3, "12")], {1: "en", 2: "en", 3: "en"})
    left = recognised(docs.withColumnRenamed("source", "lang_pred"))
    assert [r["doc_id"] for r in left.collect()] == [1] and "lang_pred" in left.columns
    sent = re.findall(r"MapInArrow run\((.*?)\)", plan_of(left))
    assert sent and not any("," in columns for columns in sent)


def test_nothing_to_learn_from(spark):
    got = identify(table(spark, [(1, "abc")], {1: None}).withColumn("lang", F.lit(None).cast("string"))).collect()
    assert [r["lang_pred"] for r in got] == ["und"]


def test_held_out_rule(spark):
    import zlib

    got = spark.range(200).select("id", held_out("id").alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in got)


# n-gram Jaccard join


def shingles(text):
    w = WORD.findall(text or "")
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_classes(texts):
    parent = {i: i for i, _ in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = Counter()
    sets = [(i, shingles(t)) for i, t in texts]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[k + 1:]:
            if a and len(a & b) >= 0.8 * len(a | b):
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: (find(i), links[i]) for i, _ in texts}


def near_texts(groups=6, copies=9):
    texts, rng = [], random.Random(5)
    for g in range(groups):
        base = some_words(g, 150)
        for c in range(copies):
            words = list(base)
            for _ in range(c % 5):
                words[rng.randrange(150)] = f"new{rng.randrange(10**6)}"
            texts.append((g * 100 + c, " ".join(words)))
    return texts + edge_texts()


@pytest.mark.parametrize("block", [4, 256])
def test_jaccard_join_equals_brute_force(spark, block):
    texts = near_texts()
    want = brute_classes(texts)
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_join(table(spark, texts), block=block).collect()}
    assert got == want
    assert any(n > 3 for _, n in want.values())


def test_one_of_each(spark):
    texts = near_texts(2, 4)
    docs = table(spark, texts + texts[:3] + [(None, "no id")])
    got = one_of_each(docs)
    want = sorted(i for i, (c, _) in brute_classes(texts).items() if i == c)
    assert sorted(r["doc_id"] for r in got.where("doc_id is not null").collect()) == want
    assert got.where("doc_id is null").count() == 1 and got.columns == docs.columns


def test_prefix_is_shortened_until_the_recall_is_met():
    assert found_chance(0.8, prefix_depth(0.8, 16, 6, 0.999), 16) >= 0.999
    assert prefix_depth(0.8, 16, 6, 0.5) == 6 and prefix_depth(0.1, 2, 6, 0.9999) == 1


# substring dedup


def brute_removed(texts):
    first, out = {}, {}
    words = {i: WORD.findall(t or "") for i, t in texts}
    for i in sorted(words):
        for k in range(len(words[i]) - 49):
            first.setdefault(tuple(words[i][k:k + 50]), i)
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if first[tuple(w[k:k + 50])] < i:
                gone[k:k + 50] = [True] * 50
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def test_substrings_equal_brute_force(spark):
    passage, exact = some_words(77, 60), some_words(78, 50)
    texts = [(k, " ".join([*some_words(k, 40 + k), *(passage if k % 3 == 0 else exact if k % 3 == 1 else exact[:49]), *some_words(k + 50, 30)])) for k in range(24)]
    texts += [(100, texts[3][1]), (101, texts[3][1].replace(" ", " \n\t")), (102, " ".join(passage * 3))] + edge_texts() + [(950, "word " * 30_000 + "é")]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in remove_repeats(table(spark, texts)).collect()}
    assert got == brute_removed(texts)
    crowded = {r["doc_id"]: r["n_removed"] for r in remove_repeats(table(spark, texts), max_cells=1 << 18).collect()}
    assert crowded == {i: v[1] for i, v in got.items()}


def test_kept_text(spark):
    passage = " ".join(some_words(1, 50))
    got = {r["doc_id"]: r["kept_text"] for r in remove_repeats(table(spark, [(1, passage), (2, f"a {passage}\nb"), (3, None)]), with_text=True).collect()}
    assert got == {1: passage, 2: "a b", 3: ""}


# benchmark decontamination


def items(spark, texts):
    return spark.createDataFrame(list(texts), "item_id long, text string")


def test_passages_are_found(spark):
    bench = {k: some_words(1000 + k, 18 + 7 * k) for k in range(6)}
    texts = []
    for k, words in bench.items():
        changed = [*words]
        changed[0] = "other"
        texts += [(k, " ".join([*some_words(k, 50), *words, *some_words(k + 9, 40)])), (10 + k, "X " + ", ".join(w.upper() for w in changed)),
                  (20 + k, " ".join(some_words(k + 40, 80))), (30 + k, " ".join(words[:8]))]
    listed = items(spark, [*((k, " ".join(w)) for k, w in bench.items()), (50, None), (51, ""), (52, "too short"), (0, " ".join(bench[0]))])
    docs = table(spark, texts + edge_texts() + texts[:2])
    got = {(r["doc_id"], r["item_id"]): (r["start"], r["n_words"], r["similarity"]) for r in contaminated(docs, listed).collect()}
    assert set(got) == {(k, k) for k in bench} | {(10 + k, k) for k in bench}
    assert all(got[k, k] == (50, len(w), 1.0) for k, w in bench.items())
    left = without_contaminated(docs, listed)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(i for i, _ in [*texts, *edge_texts()] if not (i < 6 or 10 <= i < 16))


def brute_contaminated(texts, bench):
    """{(doc_id, item_id): (start, similarity)} over all windows."""
    kinds = lambda w: Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    out = {}
    for i, words in texts.items():
        for k, item in bench.items():
            b = kinds(item)
            for start in range(max(0, len(words) - len(item)) + 1):
                a = kinds(words[start:start + len(item)])
                shared = (a & b).total()
                similarity = shared / (a.total() + b.total() - shared)
                if similarity >= 0.8 and similarity > out.get((i, k), (0, 0))[1]:
                    out[i, k] = start, similarity
    return out


def test_reordered_items_equal_brute_force_over_all_windows(spark):
    bench = {k: some_words(2000 + k, 90 + 6 * k) for k in range(5)}
    texts = {}
    for k, w in bench.items():
        half, third = len(w) // 2, len(w) // 3
        around = some_words(k + 60, 40), some_words(k + 80, 40)
        texts[k] = [*around[0], *w[half:], *w[:half], *around[1]]
        texts[10 + k] = [*around[0], *w[third:], *w[:third], *around[1]]
        texts[20 + k] = [*w[half:], *w[:half]][:-4]
        texts[30 + k] = [*around[0], *w[:half], *around[1], *w[half:]]
        texts[40 + k] = [*w, *around[0], *w[half:], *w[:half]]
    want = brute_contaminated(texts, bench)
    assert {(k + d, k) for k in bench for d in (0, 10, 20, 40)} == set(want)
    found = contaminated(table(spark, [(i, " ".join(w)) for i, w in texts.items()]), items(spark, [(k, " ".join(w)) for k, w in bench.items()]))
    assert {(r["doc_id"], r["item_id"]): (r["start"], r["similarity"]) for r in found.collect()} == want


def test_no_items(spark):
    docs = table(spark, [(1, "some words that stand here alone")])
    assert contaminated(docs, items(spark, [])).collect() == []
    assert without_contaminated(docs, items(spark, [])).count() == 1


def test_blocks_find_every_fingerprint_within_the_radius(spark):
    rng = random.Random(2)
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    low, high = rng.getrandbits(64), rng.getrandbits(64)
    rows = []
    for k in range(60):
        both = low | high << 64
        for bit in rng.sample(range(128), k):
            both ^= 1 << bit
        rows.append((k, 0, 9, signed(both & (2**64 - 1)), signed(both >> 64)))
    windows = spark.createDataFrame(rows, "doc_id long, start int, n int, low long, high long")
    listed = spark.createDataFrame([(1, 9, signed(low), signed(high)), (2, 8, signed(low), signed(high))], "item_id long, n int, low long, high long")
    assert sorted((r["doc_id"], r["item_id"]) for r in within_radius(windows, listed).collect()) == [(k, 1) for k in range(32)]


# line dedup


def brute_lines(texts):
    lines = [(i, n, line.strip(" \t\r\f\v")) for i, t in sorted(texts, key=lambda x: x[0]) if t is not None for n, line in enumerate(t.split("\n"))]
    lines = [x for x in lines if x[2]]
    different = list(dict.fromkeys(x[2] for x in lines))
    sets = [{s[k:k + 8] for k in range(max(1, len(s) - 7))} for s in different]
    parent = list(range(len(different)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    seen, removed, at = set(), defaultdict(list), {s: k for k, s in enumerate(different)}
    for i, n, line in lines:
        group = find(at[line])
        if group in seen:
            removed[i].append(n)
        seen.add(group)
    return {i: removed[i] for i, _ in texts}


def line_texts():
    rng = random.Random(9)
    base = [" ".join(some_words(k, 30)) for k in range(8)]
    texts = []
    for k in range(40):
        line = base[k % 8]
        cut = rng.randrange(len(line) - 4)
        near = line[:cut] + "##" + line[cut + 2:]
        texts.append((k, "\n".join([f"own line number {k} {rng.random()}", near if k > 7 else line, "", " Menu | Home ", "Menu | Home"])))
    return texts + [(100, None), (101, ""), (102, "\n\n"), (103, "word " * 2000 + "\nshort"), (104, "short\r")]


def test_lines_equal_brute_force(spark):
    texts = line_texts()
    docs = table(spark, texts + [(None, "short")])
    got = {r["doc_id"]: list(r["removed"]) for r in repeated_lines(docs).collect()}
    assert got.pop(None) == []
    assert got == brute_lines(texts)


def template_lines(families=300):
    """Lines of one long boilerplate and an own ending, too far from one another to be linked, each with a near copy."""
    rng = random.Random(12)
    ending = lambda n: "".join(rng.choices("abcdefghijklmnop", k=n))
    head = " ".join(some_words(500, 14))[:110]
    texts = []
    for k in range(families):
        tail = ending(18)
        texts += [(k, head + tail + ending(12)), (1000 + k, head + tail + ending(12))]
    return texts


@pytest.mark.parametrize("block", [16, 256])
def test_near_lines_of_a_template_family_equal_brute_force(spark, block):
    texts = template_lines()
    want = brute_lines(texts)
    assert sum(map(len, want.values())) == 300
    got = {r["doc_id"]: list(r["removed"]) for r in repeated_lines(table(spark, texts), block=block).collect()}
    # Two pairs at most share no band.
    assert sum(want[i] != got[i] for i in want) <= 2


def test_blocks_of_lines_get_texts_and_no_sets(spark, monkeypatch):
    written, tables = line_dedup.materialize, []

    def watched(df, label):
        tables.append((df.columns, plan_of(df)))
        return written(df, label)

    monkeypatch.setattr(line_dedup, "materialize", watched)
    assert repeated_lines(table(spark, template_lines(60)), block=16).where("n_removed > 0").count() >= 58
    blocks = [plan for _, plan in tables if "unit_a" in plan]
    assert len(blocks) == 1 and not any("set" in columns for columns, _ in tables)
    # Sets are made above the shuffle of the copies.
    assert blocks[0].index("array_distinct") < blocks[0].index("REPARTITION_BY_NUM") and "array_distinct" not in blocks[0][blocks[0].rindex("REPARTITION_BY_NUM"):]


def test_documents_keep_their_other_lines(spark):
    docs = table(spark, [(1, "first line here\nshared line of text"), (2, "shared line of text\nsecond"), (3, "shared line of text"), (4, None), (5, "")])
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in without_repeated_lines(docs).collect()}
    assert got == {1: ("first line here\nshared line of text", 35), 2: ("second", 6), 4: (None, None), 5: ("", 0)}


# piece encoding


def test_pieces_equal_the_library():
    model = sentencepiece.SentencePieceProcessor(model_file=default_model())
    own = encoder(default_model())
    rng = random.Random(4)
    signs = [*"abcdetheing  \n\n.,!?ABé日語ñ😀\t▁-=#<>0x", "the", "ing", " and", "́", "ก", "한", "<s>", "\u0000", "   "]
    pieces = [model.id_to_piece(i).replace("▁", " ") for i in range(259, model.get_piece_size())]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(4000)] + ["".join(rng.choices(pieces, k=rng.randint(1, 12))) for _ in range(4000)]
    texts += [" " * n for n in range(100)] + ["a" * 5000, "." * 300, "\n" * 50, " \n x"]
    for text in texts:
        ids = model.encode(text)
        assert own.encode(text) == (len(ids), ",".join(map(str, ids)), model.decode(ids)), repr(text)


def test_long_words_with_many_breaks_equal_the_library():
    model = sentencepiece.SentencePieceProcessor(model_file=default_model())
    own = encoder(default_model())
    rng = random.Random(8)
    signs = {"cjk": [chr(c) for c in range(0x4E00, 0x9FA0)], "base64": [*"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"],
             "digits": [*"0123456789.,;:-"], "json": ['{"id":', '"name":', "[1,2,", '"x"', "},", "]}", "null,", "0.5,"]}
    for kind, known in signs.items():
        word = "".join(rng.choices(known, k=10_000))[:10_000]
        for text in (word, f"a {word} b", f"a\n{word}"):
            ids = model.encode(text)
            assert own.encode(text) == (len(ids), ",".join(map(str, ids)), model.decode(ids)), kind
    assert max(map(len, [*own.plain, *own.spaced])) <= 64


def test_encoded_table(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=default_model())
    texts = edge_texts() + [(1, "Plain words.\nNext  line "), (1, "Plain words.\nNext  line ")]
    got = encode_texts(table(spark, texts), with_ids=True).collect()
    assert len(got) == len(texts)
    known = dict(texts)
    for r in got:
        ids = model.encode(known[r["doc_id"]] or "")
        assert list(r["ids"]) == ids and r["n_tokens"] == len(ids) and r["decoded"] == (known[r["doc_id"]] or "")
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


# licence scan


def test_licences_are_found_in_any_dress(spark):
    mit = LICENSE_TEXTS[0][1]
    wrapped = "# Copyright (c) 2020 Somebody\n# All rights reserved.\n" + re.sub(r"(.{50,70}) ", "\\1\n# ", mit.replace("\n\n", "\n"))
    texts = [(1, mit), (2, wrapped.upper()), (3, "Some text.\nReleased under the MIT licence!\nMore."), (4, f"Intro\n\n{LICENSE_TEXTS[6][1]}"), (5, "nothing here"),
             (6, mit + " or not"), (7, None), (8, ""), (9, "Licensed under CC BY 4.0.\nLicensed under CC BY-NC 4.0."), (10, "x" * 300_000)]
    got = {r["doc_id"]: (r["text_license"], r["licenses"]) for r in scan_licenses(table(spark, texts)).collect()}
    assert got == {1: ("MIT", "MIT"), 2: ("MIT", "MIT"), 3: (None, "MIT"), 9: (None, "CC-BY-4.0,CC-BY-NC-4.0")}


def test_own_licence_list(spark):
    listed = spark.createDataFrame([("B", "Use it."), ("A", "use IT"), ("C", "")], "license string, text string")
    got = scan_licenses(table(spark, [(1, "Use it!"), (1, "use it"), (2, "used it")]), listed).collect()
    assert [(r["doc_id"], r["text_license"], r["n_units"]) for r in got] == [(1, "A", 6)]


def test_lines_get_the_same_signatures_when_few_shingles_are_offered(spark):
    texts = [(k, " ".join(some_words(k, n, 4000))) for k, n in enumerate((3, 20, 30, 60, 200, 800, 5000))] + [(50, "=" * 3000), (51, "ab" * 900), (52, "short")]
    lines = line_dedup.document_lines(table(spark, texts)).localCheckpoint()
    want = {r["id"]: list(r["bands"]) for r in line_dedup.signatures(lines).collect()}
    few = {r["id"]: (list(r["bands"]), r["sure"]) for r in line_dedup.signatures(lines, per_bin=6).collect()}
    # Some lines have an empty bin and one may have nothing at all; what is sure is right.
    assert all(bands == want[i] for i, (bands, sure) in few.items() if sure) and 2 < sum(sure for _, sure in few.values()) < len(want)
    found = line_dedup.signed_lines(table(spark, texts), lines.select("id", "doc_id", "line_no"), per_bin=6)
    assert {r["id"]: list(r["bands"]) for r in found.collect()} == want and len(want) == len(texts)


def test_sets_of_shingles_are_hashes(spark):
    texts = ["a", "abcdefgh", "abcdefghi", "xyxyxyxyxyxyxyxy", "\U0001f600" * 9 + "abc", "é" * 20]
    got = spark.createDataFrame([(t,) for t in texts], "line string").select("line", line_dedup._shingle_set("line", 8).alias("s"))
    assert got.schema["s"].dataType.simpleString() == "array<bigint>"
    assert {r["line"]: len(r["s"]) for r in got.collect()} == {t: len({t[k:k + 8] for k in range(max(1, len(t) - 7))}) for t in texts}


def test_lines_that_repeat_few_shingles_are_compared(spark):
    rules = [(2 * k + n, c * (300 + 10 * n)) for k, c in enumerate("-=~*#_+.") for n in range(2)]
    found = repeated_lines(spark.createDataFrame(rules, "doc_id long, text string"))
    assert {r["doc_id"]: r["n_removed"] for r in found.collect()} == {i: i % 2 for i, _ in rules}


def rotated_lines():
    """Lines that repeat a passage, each again from a later start and again with a heading: almost equal sets of shingles."""
    texts = []
    for k in range(20):
        passage = " ".join(some_words(700 + k, 14))[:100]
        texts += [(3 * k, passage * 60), (3 * k + 1, (passage[40:] + passage[:40]) * 60), (3 * k + 2, f"Head {k}: " + passage * 60)]
    return texts


def test_repeated_passages_are_compared_wherever_they_start(spark):
    texts = rotated_lines()
    want = brute_lines(texts)
    assert sum(map(len, want.values())) == 40
    assert {r["doc_id"]: list(r["removed"]) for r in repeated_lines(table(spark, texts)).collect()} == want


def test_whole_texts_of_usual_licences_are_found(spark):
    folder = Path(default_licenses.__code__.co_filename).parent / "license_data"
    whole = {k: (f.stem, f.read_text()) for k, f in enumerate(sorted(folder.glob("*.txt")))}
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "Artistic-1.0-Perl"} <= {name for name, _ in whole.values()}
    texts = [(k, text) for k, (_, text) in whole.items()] + [(100 + k, "# " + text.upper().replace("\n", "\r\n# ")) for k, (_, text) in whole.items()]
    texts += [(200 + k, text + " and more") for k, (_, text) in whole.items()]
    got = {r["doc_id"]: r["text_license"] for r in scan_licenses(table(spark, texts)).where("text_license is not null").collect()}
    assert got == {d + k: name for k, (name, _) in whole.items() for d in (0, 100)}


def thue_morse(size, swap):
    return "".join("ab"[(bin(k).count("1") + swap) % 2] for k in range(size))


def test_words_that_defeat_polynomial_hashes_stay_apart(spark):
    tail = " ".join(f"t{k}" for k in range(49))
    docs = table(spark, [(1, thue_morse(1024, 0) + " " + tail), (2, thue_morse(1024, 1) + " " + tail), (3, thue_morse(256, 0) + " " + tail), (4, thue_morse(256, 1) + " " + tail), (5, thue_morse(256, 1) + " " + tail)])
    assert {r["doc_id"]: r["n_removed"] for r in remove_repeats(docs).collect()} == {1: 0, 2: 0, 3: 0, 4: 0, 5: 50}
    got = {r["doc_id"]: r["class_id"] for r in jaccard_join(table(spark, [(1, thue_morse(1024, 0)), (2, thue_morse(1024, 1)), (3, thue_morse(1024, 1))])).collect()}
    assert got == {1: 1, 2: 2, 3: 2}


def test_stages_keep_columns_of_their_own_names(spark):
    docs = table(spark, [(1, "a line of text that is long enough\nanother line here"), (2, "a line of text that is long enough\nsomething else")])
    docs = docs.withColumn("__removed", F.lit(1)).withColumn("removed", F.lit(2))
    got = {r["doc_id"]: (r["text"], r["removed"], r["__removed"]) for r in without_repeated_lines(docs).collect()}
    assert got == {1: ("a line of text that is long enough\nanother line here", 2, 1), 2: ("something else", 2, 1)}


def test_repetitive_and_short_items_equal_brute_force(spark):
    rng = random.Random(12)
    bench, texts = {}, {}
    for k in range(24):
        tail = some_words(3000 + k, 12)
        bench[k] = [f"a{k}", f"b{k}"] * 44 + tail
        kept = rng.randint(2, 8)
        texts[k] = [*some_words(k, 5), *bench[k][:88 + kept], *some_words(4000 + k, 12 - kept)]
    for k in range(24, 60):
        bench[k] = some_words(3000 + k, rng.randint(5, 30))
        words = list(bench[k])
        if k % 2:
            words[-1] = "other"
        texts[k] = [*some_words(k, 3), *words, *some_words(k + 500, 4)]
    for k in range(60, 66):
        # A document that repeats what the item has once.
        bench[k] = some_words(3000 + k, 100)
        texts[k] = [*bench[k][:88], *["same"] * 12]
    want = brute_contaminated(texts, bench)
    found = contaminated(table(spark, [(i, " ".join(w)) for i, w in texts.items()]), items(spark, [(k, " ".join(w)) for k, w in bench.items()])).collect()
    got = {(r["doc_id"], r["item_id"]): (r["start"], pytest.approx(r["similarity"])) for r in found}
    assert got == want and len(want) > 40


def brute_language(texts, langs, size):
    """{doc_id: (language, score)} by dictionaries, as the profiles are learned from all texts that are not held out."""
    import unicodedata
    import zlib

    def grams(text):
        letters = "".join(c.lower() if unicodedata.category(c)[0] == "L" and len(c.lower()) == 1 else c if unicodedata.category(c)[0] == "L" else " " for c in text or "")
        words = letters.split()
        line = f" {' '.join(words)} " if words else ""
        return Counter(g for n in (1, 2, 3) for k in range(len(line) - n + 1) if (g := line[k:k + n]) != " ")

    top = lambda counts: [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], len(x[0]), x[0]))[:size]]
    totals = defaultdict(Counter)
    for i, t in texts:
        if langs[i] is not None and t is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            totals[langs[i]] += grams(t)
    ranks = {lang: {g: k for k, g in enumerate(top(c))} for lang, c in sorted(totals.items()) if c}
    out = {}
    for i, t in texts:
        own = top(grams(t))
        if not own:
            out[i] = ("und", 0.0)
            continue
        far = {lang: sum(abs(r[g] - k) if g in r else size for k, g in enumerate(own)) for lang, r in ranks.items()}
        best = min(far, key=lambda lang: (far[lang], lang))
        out[i] = (best, 1 - far[best] / (size * len(own)))
    return out


@pytest.mark.parametrize("size", [12, 400])
def test_ranks_and_distances_equal_dictionaries(spark, size):
    rng = random.Random(4)
    alphabets = {"aa": "abcdeé", "bb": "cdefgß", "cc": "efghiÄ", "same": "abcdeé"}
    langs, texts = {}, []
    for i in range(60):
        langs[i] = ("aa", "bb", "cc", "same")[i % 4]
        texts.append((i, rng.choice([" ", "-", "\n1 "]).join("".join(rng.choices(alphabets[langs[i]], k=rng.randint(1, 6))) for _ in range(rng.randint(1, 40)))))
    texts += [(70, "ab ba " * 170_000), (71, ""), (72, None), (73, "a"), (74, "12 34"), (75, "İ ŉ ﬁ")]
    langs |= {70: "bb", 71: "aa", 72: "aa", 73: None, 74: "cc", 75: None}
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify(table(spark, texts, langs), size).collect()}
    want = brute_language(texts, langs, size)
    assert {i: g[0] for i, g in got.items()} == {i: w[0] for i, w in want.items()}
    assert {i: (got[i], want[i]) for i in want if abs(got[i][1] - want[i][1]) >= 1e-12} == {}
