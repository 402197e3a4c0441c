"""Hard negatives, language-model scores and the filter audit against brute force, and their edge cases."""

import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from tabloom.llm.filter_audit import filter_audit
from tabloom.llm.hard_negatives import hard_negatives, strassen
from tabloom.llm.lm_scoring import score_documents, tokens_of
from tabloom.llm.recurrent import GatedModel, class_starts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, row long, round int, count long, part string, failed int"


def documents(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, lang, 5, 6, 7, "p", 8) for i, t, lang in rows], DOCS).repartition(3)


# hard negatives


@pytest.mark.parametrize("m, k, n", [(1, 1, 1), (3, 64, 5), (33, 65, 97), (130, 70, 257), (40, 0, 50), (64, 64, 64)])
def test_strassen_equals_the_product(m, k, n):
    rng = np.random.default_rng(m * n)
    a, b = rng.integers(-2**20, 2**20, (m, k)), rng.integers(-2**20, 2**20, (k, n))
    assert np.array_equal(strassen(a, b, 4), a @ b) and np.array_equal(strassen(a, b), a @ b)


def test_strassen_is_exact_when_only_its_sums_overflow():
    a = np.full((8, 8), 2**61, dtype=np.int64)
    b = np.eye(8, dtype=np.int64)
    assert np.array_equal(strassen(a, b, 2), a)


VECTORS = "vec_id long, embedding array<float>, label int, row long, size int, anchor string, x int"


def brute_negatives(rows, modulus):
    good = [(n, i, [math.floor(256 * x) for x in v], lab) for n, (i, v, lab) in enumerate(rows) if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, v, lab in good:
        if i % modulus:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), j, other) for m, j, w, other in good if m != n and len(w) == len(v)))
        for s, j, _ in [x for x in scored if x[2] == lab][:5]:
            met = [(t, k) for t, k, other in scored if other != lab and 80 * -s <= 100 * -t <= 100 * -s][:5]
            out += [(i, j, rank, k, -s, -t) for rank, (t, k) in enumerate(met, 1)]
    return sorted(out)


def vector_rows():
    rng = np.random.default_rng(4)
    rows = [(k, [float(np.float32(x)) for x in rng.normal(size=6).round(1)], int(rng.integers(3))) for k in range(150)]
    rows += [(k, rows[k][1], rows[k][2]) for k in (0, 10, 20, 31)]  # repeated rows
    rows += [(200 + k, rows[10][1], k % 3) for k in range(20)]  # ties
    rows += [(300, None, 1), (310, [1.0, None], 1), (320, [float("nan")] * 6, 1), (330, [float("inf")] * 6, 0), (340, [], 1), (350, [], 2), (360, [], 1), (370, [1.0] * 6, None), (None, [1.0] * 6, 1), (380, [1.0, 2.0], 1)]
    return rows


@pytest.mark.parametrize("blocks", [(512, 4096), (32, 32)])
def test_negatives_equal_brute_force(spark, blocks):
    rows = vector_rows()
    vectors = spark.createDataFrame([(*r, 1, 2, "a", 3) for r in rows], VECTORS).repartition(4)
    got = hard_negatives(vectors, F.col("vec_id") % 10 == 0, anchor_rows=blocks[0], candidate_rows=blocks[1])
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows, 10)
    assert len(brute_negatives(rows, 10)) > 300


def test_no_vectors_no_anchors_one_label(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert hard_negatives(empty, F.col("vec_id") % 10 == 0).collect() == []
    some = spark.createDataFrame([(k, [1.0, float(k)], 1, 1, 2, "a", 3) for k in range(5)], VECTORS)
    assert hard_negatives(some, F.lit(False)).collect() == [] and hard_negatives(some, F.lit(None).cast("boolean")).collect() == []
    assert hard_negatives(some, F.lit(True)).collect() == []


# language-model scores


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_base(rows):
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _, _ in rows if i is not None}
    counts = Counter()
    for i, t, _ in rows:
        if not held.get(i, True):
            counts.update([*words_of(t), None])
    total = sum(counts.values())
    out = []
    for i, t, _ in rows:
        tokens = [*words_of(t), None]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (len(counts) + 1))) for w in tokens)
        out.append((i, held.get(i, True), len(tokens), sum(counts[w] > 0 for w in tokens), total, base))
    return out


def some_documents():
    rng = np.random.default_rng(6)
    pools = [[f"{p}{k}" for k in range(60)] for p in "abc"]
    rows = [(k, " ".join(rng.choice(pools[k % 3], size=int(rng.integers(1, 80)), p=np.arange(60, 0, -1) / 1830)), "en") for k in range(400)]
    rows += [(500, None, "en"), (501, "", "en"), (502, " \n\x0b\t", None), (503, "Ä É A1 a1  x", "en"), (504, "a1 " * 30_000, "en"), (505, "y" * 100_000, "en"), (None, "a1 unheard", "en"), (7, rows[7][1], "en"), (507, "never seen before " * 3, "en")]
    return rows


@pytest.mark.parametrize("known_words, model_words", [(1 << 18, 1024), (90, 16), (0, 4)])
def test_base_scores_equal_brute_force(spark, known_words, model_words):
    rows = some_documents()
    got = score_documents(documents(spark, rows), known_words=known_words, model_words=model_words, rounds=2).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    got, want = sorted((tuple(r)[:6] for r in got), key=key), sorted(brute_base(rows), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(abs(g[5] - w[5]) <= 1e-9 * max(1, abs(w[5])) for g, w in zip(got, want))


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
@pytest.mark.parametrize("third", [None, "d D"])
def test_tokens_of_a_slice(kind, third):
    texts = ["Long word", "A b  a", third, "", "É C\tc c", "x"]
    for lo, hi in itertools.combinations(range(len(texts) + 1), 2):
        found = tokens_of(pa.array(texts, kind).slice(lo, hi - lo))
        words = found.words.take(pa.array(found.ids)).to_pylist()
        assert [words[a:b] for a, b in itertools.pairwise(found.bounds)] == [words_of(t) for t in texts[lo:hi]]


def test_base_scores_of_batches_cut_into_slices(spark):
    rows = [(k, "X" * (40_000 + 997 * k) + " y Z" * (20_000 + 1_009 * k), "en") for k in range(60)]
    got = sorted(tuple(r)[:6] for r in score_documents(documents(spark, rows).coalesce(1), rounds=1).collect())
    want = sorted(brute_base(rows))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(abs(g[5] - w[5]) <= 1e-9 * abs(w[5]) for g, w in zip(got, want))


def test_model_learns_more_than_word_shares(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = score_documents(docs).toPandas()
    held = got[got.held_out]
    assert 5 < len(held) < len(got) and got.doc_id.is_unique and len(got) == docs.count()
    assert held.score.sum() > held.base_score.sum() and got[~got.held_out].score.sum() > got[~got.held_out].base_score.sum()
    assert np.isfinite(got.score).all() and (got.score < 0).all()


def test_chances_sum_to_one():
    counts = np.array([50, 20, 10, 9, 8, 7, 3, 30, 12])
    model = GatedModel(class_starts(counts[:7], 3), 2, 1, 5, 0.2).start(counts)
    rng = np.random.default_rng(2)
    model.train(iter([np.append(rng.choice(9, size=20, p=counts / counts.sum()), 1).astype(np.int16) for _ in range(50)]))
    states = rng.normal(size=(4, 5)).astype(np.float32)
    total = sum(np.exp(model.log_chances(states, np.full(4, k))) for k in range(9))
    assert np.allclose(total, 1, atol=1e-5)


def slow_score(model, ids):
    h, total, last, p = np.zeros(model.hidden), 0.0, model.end, {k: v.astype(np.float64) for k, v in model.parameters.items()}
    size = model.hidden
    for target in ids:
        pushed, own = p["input"][last] + p["gate_bias"], h @ p["recur"]
        keep, reset = (1 / (1 + np.exp(-(pushed + own)[k * size:(k + 1) * size])) for k in (0, 1))
        new = np.tanh(pushed[2 * size:] + reset * own[2 * size:])
        h = new + keep * (h - new)
        logits = h @ p["classes"] + p["class_bias"]
        c = model.class_of[target]
        total += logits[c] - np.log(np.exp(logits).sum())
        if target < model.n_words:
            inner = p["words"][model.starts[c]:model.starts[c + 1]] @ h + p["word_bias"][model.starts[c]:model.starts[c + 1]]
            total += inner[target - model.starts[c]] - np.log(np.exp(inner).sum())
        last = target
    return total


def test_state_is_carried_over_windows_and_documents_are_apart():
    counts = np.array([50, 20, 10, 9, 8, 7, 3, 30, 12])
    model = GatedModel(class_starts(counts[:7], 3), 2, 1, 6, 0.2).start(counts)
    rng = np.random.default_rng(3)
    docs = [np.append(rng.choice([0, 2, 3, 4, 5, 6, 7, 8], size=n), 1).astype(np.int16) for n in (0, 1, 5, 40, 63, 64, 65, 300, 2, 2)]
    model.train(iter(docs * 5))
    got = model.score(docs, streams=3)
    assert np.allclose(got, [slow_score(model, d) for d in docs], rtol=1e-4, atol=1e-3)
    assert np.allclose(model.score(docs, streams=10), got, atol=1e-3) and np.allclose(model.score(docs[3:4]), got[3], atol=1e-3)


def test_gates_work_on_runs_of_memory(monkeypatch):
    """Every step fills arrays that are there already, and what it reads and writes of them is in one piece."""
    counts = np.array([50, 20, 10, 9, 8, 7, 3, 30, 12])
    model, seen, real = GatedModel(class_starts(counts[:7], 3), 2, 1, 6, 0.2).start(counts), [], GatedModel._gates

    def watched(self, *arrays):
        assert real(self, *arrays) is None
        before, pushed, recur, own, gates, candidate, after = arrays
        seen.append(all(x.flags.c_contiguous for x in (before, pushed[:12], pushed[12:], own[:12], own[12:], gates[:6], gates[6:], candidate, after)))

    monkeypatch.setattr(GatedModel, "_gates", watched)
    docs = [np.append(np.full(n, 3), 1).astype(np.int16) for n in (30, 300, 2, 90, 700)]
    model.train(iter(docs))
    steps = len(seen)
    model.score(docs, streams=3)
    assert 0 < steps < len(seen) and all(seen)


def test_gradients_equal_differences():
    """A window's steps follow the slope of its log-likelihood."""
    counts = np.array([5, 4, 3, 3, 2, 2, 1])
    ids = np.array([0, 2, 3, 5, 1, 4, 6, 2, 1, 3, 0, 1], dtype=np.int16)

    def loss(model):
        # documents end at id 1, so the sum over them is the sum over the stream
        cuts = np.flatnonzero(ids == 1) + 1
        return -model.score(np.split(ids, cuts)[:-1]).sum()

    build = lambda: GatedModel(class_starts(counts[:5], 2), 2, 1, 4, 1e-3).start(counts, 5)
    model, seen = build(), {}
    model._step = lambda name, gradient, rows=slice(None): seen.setdefault(name, []).append((rows, gradient.copy()))
    model._train_window(np.concatenate([[1], ids[:-1]])[:, None], ids[:, None].astype(np.int64), None, np.zeros((1, 4), np.float32))
    for name in ("input", "recur", "gate_bias", "classes", "class_bias", "words", "word_bias"):
        total = np.zeros(model.shapes[name])
        for rows, gradient in seen[name]:
            total[rows] += gradient
        spot = np.unravel_index(np.abs(total).argmax(), total.shape)
        up, down = build(), build()
        up.parameters[name][spot] += 1e-2
        down.parameters[name][spot] -= 1e-2
        assert total[spot] == pytest.approx((loss(up) - loss(down)) / 2e-2, rel=0.03), name


def test_nothing_to_learn_from(spark):
    assert score_documents(documents(spark, [])).collect() == []
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    got = score_documents(documents(spark, [(i, "a b", "en") for i in held])).collect()
    assert [tuple(r)[1:] for r in got] == [(True, 3, 0, 0, 0.0, 0.0)] * 3
    only_ends = score_documents(documents(spark, [(1, None, "en"), (3, "", "en")])).collect()
    assert all(r["n_tokens"] == r["n_known"] == 1 and r["train_tokens"] == 2 and abs(r["score"]) < 0.5 for r in only_ends)


# filter audit


def failing(i, text, first):
    words = WORD.findall(text)
    return {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search("[#$%&*|]", text)), "E": i is not None and i > first}


def brute_audit(rows, labels):
    firsts = {}
    for i, t, _ in rows:
        if i is not None:
            firsts[t or ""] = min(i, firsts.get(t or "", i))
    docs = [(lang or "", {f for f, bad in failing(i, t or "", firsts.get(t or "", 0)).items() if bad}, (i, 1) in {(a, q) for a, q, _ in labels if a is not None}, (i, 1) in {(a, x) for a, _, x in labels if a is not None}) for i, t, lang in rows]
    out = {}
    for part in {d[0] for d in docs}:
        shares = Counter()
        for order in itertools.permutations("ABCDE"):
            left = [d for d in docs if d[0] == part]
            everyone = left
            for step, f in enumerate(order, 1):
                gone, kept = [d for d in left if f in d[1]], [d for d in left if f not in d[1]]
                shares[f] += len(gone)
                out[part, "".join(order), step] = [len(kept), len(gone), sum(f in d[1] for d in everyone) - len(gone), sum(d[1] == {f} for d in everyone), sum(d[2] for d in gone), sum(d[3] for d in gone)]
                left = kept
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shares[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_audit_equals_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = []
    for k in range(120):
        n = int(rng.choice([0, 3, 199, 200, 201, 260]))
        pool = int(rng.choice([2, 90, 100, 101, 400]))
        text = rng.choice([" ", "\n", "  \t"]).join(f"{rng.choice(['W', 'w', 'é'])}{rng.integers(pool)}" for _ in range(n)) + str(rng.choice(["", " #", " ", "|"]))
        rows.append((k, text, str(rng.choice(["en", "de"]))))
    rows += [(300, rows[5][1], "fr"), (301, rows[5][1], None), (5, rows[5][1], "en"), (302, None, None), (303, "", ""), (None, rows[7][1], "en"), (None, "x", "en"), (304, "A" * 50_000, "de"), (305, "w " * 30_000, "de"), (306, "\x1c   \x85", "de")]
    labels = [(k, k % 2, k % 3) for k in range(0, 110, 2)] + [(4, 1, 1), (None, 1, 1), (300, None, 1), (9999, 1, 1), (301, 1, None)]
    got = filter_audit(documents(spark, rows), spark.createDataFrame([(*r, 1) for r in labels], "doc_id long, quality int, toxic int, part int")).collect()
    fields = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r[f] for f in fields) for r in got} == brute_audit(rows, labels)
    assert len(got) == 4 * 600


def test_audit_of_nothing(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit(documents(spark, []), labels).collect() == []
    got = filter_audit(documents(spark, [(1, "a", "en")]), labels).collect()
    assert len(got) == 600 and {r["shapley"] for r in got if r["filter_order"][r["step"] - 1] == "A"} == {120}
