"""Toxicity and language-model scores."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shopflow.llm import brown as B, toxicity as T
from tests.llm.conftest import edge_rows, make

WORDS = ["".join(random.Random(i).choices("abcdefghijklmnop", k=random.Random(-i).randint(2, 9))) for i in range(400)]


def toxic_corpus(n=600, seed=5):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(WORDS, k=60)
        bad = i % 5 == 0
        if bad:
            for w in rng.sample(["zorvex", "quimbly", "wrunkle"], 2):
                words.insert(rng.randrange(60), w + rng.choice(["", ".", "!"]))
        rows.append((i, " ".join(words), "en", "a"))
        labels.append((i, int(bad)))
    return rows, labels


@pytest.fixture(scope="module")
def machine(spark):
    rows, labels = toxic_corpus()
    return T.train(make(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_kernel_is_the_sum_over_gapped_triples():
    def brute(a, b):
        def features(s):
            s, out = [c[0] for c in [[62]] + [[T.letter_code(c)] for c in s] + [[63]]], Counter()
            total = 0.0
            for i in range(len(s)):
                for j in range(i + 1, len(s)):
                    for k in range(j + 1, len(s)):
                        if k - i < T.SPAN:
                            out[s[i], s[j], s[k]] += T.DECAY ** (k - i + 1)
                            total += T.DECAY ** (2 * (k - i + 1))
            return {t: v / math.sqrt(total) for t, v in out.items()}
        x, y = features(a), features(b)
        return sum(v * y.get(t, 0) for t, v in x.items())

    units = ["idiot", "i.d.iot", "idioot", "table", "a", "été"]
    got = T.kernel(units, units)
    assert np.allclose(got, [[brute(a, b) for b in units] for a in units], atol=1e-5)
    assert got[0, 1] > 3 * got[0, 3] and got[0, 2] > got[0, 1]


def test_held_out_documents_and_changed_insults(spark, machine):
    rows, labels = toxic_corpus(seed=99)
    marked = dict(labels)
    scored = {r.doc_id: r for r in T.score(make(spark, rows), machine, ["doc_id"]).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in scored.values())
    wrong = sum(r.predicted != marked[k] for k, r in scored.items())
    assert wrong <= 6
    calm = " ".join(WORDS[:40])
    changed = [(0, calm, "en", "a"), (1, calm + " zor-vex quim_bly", "en", "a"), (2, calm + " zzorvexx wrunnkle", "en", "a"), (3, calm + " z o r v e x and w r u n k l e", "en", "a")]
    got = {r.doc_id: r.predicted for r in T.score(make(spark, changed), machine, ["doc_id"]).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 1}


def test_edge_documents(edge, none, spark, machine):
    rows = T.score(edge, machine, ["doc_id"]).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in edge_rows()) and not any(math.isnan(r.score) for r in rows)
    assert T.score(none, machine, ["doc_id"]).collect() == []
    no_labels = T.train(edge, spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int"))
    assert {r.predicted for r in T.score(edge, no_labels, ["doc_id"]).collect()} == {0}


def test_base_and_class_scores(edge, none):
    model, counts = B.train(edge.select("text"), words=30, endings=20, classes=6)
    c = Counter(w for r in edge_rows() for w in B.tokens(r[1]))
    total, kinds = sum(c.values()), len(c)
    assert (model.tokens, model.kinds) == (total, kinds) and {bytes(r.word): r.n for r in counts.collect()} == c
    other = make(edge.sparkSession, [(50, "entirely new words here", "en", "a"), *edge_rows()])
    got = Counter()
    for r in B.score(other, model, counts, ["doc_id"]).collect():
        got[r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)] += 1
    of = lambda w: int(model.classes.of_item[model.classes.item(w)])
    size, distinct = Counter(), Counter()
    for w, n in c.items():
        size[of(w)] += n
        distinct[of(w)] += 1
    want = Counter()
    for doc, text in [(50, "entirely new words here"), *[(r[0], r[1]) for r in edge_rows()]]:
        listed = B.tokens(text)
        score = 0.0
        for before, w in zip([B.END, *listed], listed):
            k = of(w)
            score += model.after[of(before), k]
            score += math.log10((c[w] - B.DISCOUNT) / size[k]) if c[w] else (math.log10(B.DISCOUNT * distinct[k] / size[k]) if size[k] else 0)
        base = sum(math.log10((c[w] + 1) / (total + kinds + 1)) for w in listed)
        want[doc, len(listed), sum(c[w] > 0 for w in listed), round(base, 6), round(score, 6)] += 1
    assert got == want
    assert B.score(none, model, counts, ["doc_id"]).collect() == []


def test_transitions_are_probabilities(edge):
    model, _ = B.train(edge.select("text"), words=30, endings=20, classes=6)
    assert np.allclose((10 ** model.after).sum(1), 1)


def test_without_training_texts(edge, none):
    model, counts = B.train(none.select("text"))
    rows = B.score(edge, model, counts, ["doc_id"]).collect()
    assert len(rows) == len(edge_rows()) and all(r.n_known == 0 and r.base_score == 0 for r in rows)


def test_exchange_finds_alternating_classes():
    rng = random.Random(1)
    n = 40
    table = np.zeros((n, n), np.int64)
    for _ in range(20000):  # items of one half are always followed by the other half
        a = rng.randrange(20)
        b = 20 + rng.randrange(20)
        table[a, b] += 1
        table[b, rng.randrange(20)] += 1
    of = B.exchange(table, 2)
    assert len(set(of[:20])) == 1 and len(set(of[20:])) == 1 and of[0] != of[20]


def test_classes_beat_single_words(spark):
    rng = random.Random(8)
    langs = [["".join(rng.choices(letters, k=5)) for _ in range(150)] for letters in ("abcdef", "uvwxyz")]
    rows = [(i, " ".join(rng.choices(langs[i % 2], k=100)), "en", "a") for i in range(300)]
    docs = make(spark, rows)
    model, counts = B.train(docs.where("doc_id % 3 > 0").select("text"), words=100, endings=100, classes=8)
    r = B.score(docs.where("doc_id % 3 = 0"), model, counts, ["doc_id"]).agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r.s > 0.95 * r.b and r.s - r.b > 1000


def test_every_ending_has_a_class_by_its_own_neighbours(edge):
    model, _ = B.train(edge.select("text"), words=10, endings=6, classes=5)
    found, pairs = model.classes, Counter()
    for r in edge_rows():
        listed = [B.END, *B.tokens(r[1])]
        pairs.update(zip(map(found.bin, listed), map(found.bin, listed[1:])))
    rest = sorted({-b for p in pairs for b in p if b < 0})
    assert len(rest) > 50 and found.rest.tolist() == rest and len(found.of_item) == found.other + 1 + len(rest)

    def likelihood(number, c):
        of = lambda b: c if b == -number else int(found.of_item[max(b, 0) if b >= 0 else found.other])
        both, left, right = Counter(), Counter(), Counter()
        for (a, b), n in pairs.items():
            both[of(a), of(b)] += n
            left[of(a)] += n
            right[of(b)] += n
        return sum(n * math.log(n) for n in both.values()) - sum(n * math.log(n) for side in (left, right) for n in side.values())

    here, moved = int(found.of_item[found.other]), 0
    for number, chosen in zip(rest, found.of_item[found.other + 1:].tolist()):
        tried = [likelihood(number, c) for c in range(5)]
        assert tried[chosen] > max(tried) - 1e-6
        moved += chosen != here
    assert moved > 10
    unseen = "zz一qqq".encode()
    assert found.item(unseen) == found.other


def test_every_word_has_a_class_by_its_own_neighbours(edge):
    by_form, _ = B.train(edge.select("text"), words=10, endings=6, classes=5)
    model, words = B.train(edge.select("text"), words=10, endings=6, classes=5, own=True)
    found, pairs = model.classes, Counter()
    for r in edge_rows():
        listed = [B.END, *B.tokens(r[1])]
        pairs.update(zip(listed, listed[1:]))
    n = Counter(w for r in edge_rows() for w in B.tokens(r[1]))
    form = {w: int(found.of_item[found.item(w)]) for w in n}
    got = {bytes(r.word): (r.n, r.c) for r in words.collect()}
    assert {w: k for w, (k, _) in got.items()} == n and np.array_equal(by_form.classes.of_item, found.of_item)
    own = {w: c for w, (_, c) in got.items()}
    for w in n:
        if w in found.items:
            assert own[w] == form[w]
            continue
        tried = []
        for c in range(5):
            of = lambda x: c if x == w else form[x]  # noqa: B023, E731
            table = np.zeros((5, 5))
            for (a, b), k in pairs.items():
                table[of(a), of(b)] += k
            tried.append(B._xlogx(table).sum() - B._xlogx(table.sum(0)).sum() - B._xlogx(table.sum(1)).sum())
        assert tried[own[w]] > max(tried) - 1e-6
    assert sum(own[w] != form[w] for w in n) > 20
    table = np.zeros((5, 5))
    for (a, b), k in pairs.items():
        table[own[a], own[b]] += k
    share = (table.sum(0) + 1) / (table.sum() + 5)
    assert np.allclose(model.after, np.log10((table + B.PRIOR * share) / (table.sum(1, keepdims=True) + B.PRIOR)))
    assert model.size.tolist() == [sum(k for w, k in n.items() if own[w] == c) for c in range(5)]
    for r in B.score(edge, model, words, ["doc_id"]).collect():
        assert r.n_known == r.n_tokens
    texts = {r[0]: r[1] for r in edge_rows()}
    for r in B.score(edge.dropDuplicates(["doc_id"]), model, words, ["doc_id"]).collect():
        if Counter(k for k, *_ in edge_rows())[r.doc_id] == 1:
            listed = B.tokens(texts[r.doc_id])
            want = sum(model.after[own[a], own[w]] + math.log10((n[w] - B.DISCOUNT) / model.size[own[w]]) for a, w in zip([B.END, *listed], listed))
            assert math.isclose(r.score, want, rel_tol=1e-9)


def test_forms_of_many_words_at_once():
    rng = random.Random(4)
    words = [b"", b"...", "été!".encode(), b"a", b"ab,", b"abc.)", b"the", "一二".encode()] + ["".join(rng.choices("abcé.,)!-", k=rng.randint(0, 6))).encode() for _ in range(500)]
    found = B.Classes({b"the": 0, b"a": 1, b"": 2} | {e: i for i, e in enumerate(sorted({B.ending(w) for w in words[50:60]}), 3)}, 0, 3)
    found.other = len(found.items)
    made = pa.array([b"skipped", *words], pa.binary())[1:]
    assert found.bins_of(made).tolist() == [found.bin(w) for w in words]
    assert [e.to_bytes(6).lstrip(b"\0") for e in B.endings_of(made).tolist()] == [B.ending(w) for w in words]


def test_many_items_at_once_go_where_each_would():
    rng = np.random.default_rng(3)
    words, classes = 60, 7
    counts = rng.poisson(0.3, (words, words)) * rng.integers(1, 9, (words, words))
    counts[np.arange(0, words, 4), np.arange(0, words, 4)] += 5
    of = rng.integers(0, classes, words)
    member = np.eye(classes)[of]
    table = (member.T @ counts @ member).astype(float)
    r, l, own = counts @ member, counts.T @ member, np.diag(counts).astype(float)
    want = []
    for i in range(words):
        a, b, here, rest = r[i].copy(), l[i].copy(), of[i], table.copy()
        a[here] -= own[i]
        b[here] -= own[i]
        rest[here, :] -= a
        rest[:, here] -= b
        rest[here, here] -= own[i]
        want.append(B._best_class(rest, a, b, own[i], here))
    assert B.best_classes(table, r, l, own, of).tolist() == want and want != of.tolist()
