"""Quality rules, near duplicates, repeated passages."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shopflow.llm import quality as Q, simhash as S, substring as U
from tests.conftest import SF
from tests.llm.conftest import edge_rows, make


def test_counts_against_brute_force(edge):
    def brute(text):
        words = (text or "").encode().split()
        windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        times = Counter(windows)
        marked = {p for i, w in enumerate(windows) if times[w] > 1 for p in (i, i + 1, i + 2)}
        seen, repeated = set(), 0
        for line in (text or "").split("\n"):
            if line.encode().split():
                repeated += line in seen
                seen.add(line)
        return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text or ""), repeated, len(marked)

    rows = Q.assess(edge).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert Counter((r.doc_id, *[r[n] for n in names]) for r in rows) == Counter((x[0], *brute(x[1])) for x in edge_rows())
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in rows)
    assert all(not (r.kept and r.base_failed) for r in rows)


def test_sketches_merge_and_adapt(spark, none):
    def docs(lang, n, symbols):
        return [(i, "word " * 60 + "% " * symbols + f"n{i}", lang, "s") for i in range(n)]

    rng = random.Random(1)
    varied = lambda n: " ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(n))
    rows = [(i, varied(80), "en", "s") for i in range(300)] + [(1000 + i, varied(40) + " " + " ".join("%" + varied(1) for _ in range(40)), "xx", "s") for i in range(300)]
    rows += [(5000, varied(40) + " " + " ".join("%" + varied(1) for _ in range(40)), "en", "s"), (5001, varied(40) + " " + " ".join("%%%%%%" + varied(1) for _ in range(40)), "xx", "s")]
    kept = {r.doc_id: r.kept for r in Q.assess(make(spark, rows)).collect()}
    # half the words with a symbol are odd for one language and usual for the other
    assert not kept[5000] and not kept[5001] and all(v for k, v in kept.items() if k < 5000)
    measured = Q.measure(make(spark, rows)).cache()
    whole = Q.sketch(measured.withColumn("g", F.lit(1)), ["g"])
    parts = Q.sketch(measured.withColumn("g", F.lit(1)).withColumn("h", F.pmod(F.hash("doc_id"), F.lit(5))), ["g", "h"])
    assert sorted(map(tuple, Q.merge(parts, ["g"]).collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    for q in Q.quantiles(whole, ["g"], {"median": 0.5, "upper": 0.9}).collect():
        values = sorted(r[0] for r in measured.select(Q.rule_values()[q.rule]).collect())
        for name, share in (("median", 0.5), ("upper", 0.9)):
            exact = values[int(np.ceil(share * len(values))) - 1]
            assert abs(q[name] - exact) <= 0.0101 * exact
    assert Q.assess(none).collect() == []


def components(fps, most=3):
    left, out = set(fps), {}
    while left:
        todo, group = [left.pop()], []
        while todo:
            x = todo.pop()
            group.append(x)
            near = {y for y in left if bin(x ^ y).count("1") <= most}
            left -= near
            todo += near
        out |= {x: min(group) for x in group}
    return out


def test_golay_keys_meet():
    errors = S.error_patterns()
    assert len(set(errors.tolist())) == 2048 and max(bin(e).count("1") for e in errors.tolist()) == 3
    rng = np.random.default_rng(2)
    fps = rng.integers(0, 1 << 63, 3000, dtype=np.int64) * 2 + rng.integers(0, 2, 3000)
    near = fps.copy().view(np.uint64)
    for _ in range(3):
        near ^= np.uint64(1) << rng.integers(0, 64, len(fps)).astype(np.uint64)
    a, b = ({}, {})
    for keys, f in ((a, fps), (b, near.view(np.int64))):
        k, rows = S.joint_keys(f, errors)
        for x, y in zip(k.tolist(), rows.tolist()):
            keys.setdefault(y, set()).add(x)
    assert all(a[i] & b[i] for i in range(len(fps)))


def test_fingerprints(edge):
    def brute(text):
        w = (text or "").encode().lower().split()
        if not w:
            return 0
        shingles = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [b" ".join(w)]
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    rows = edge_rows()
    fps = [brute(r[1]) for r in rows]
    root = components(fps)
    first = {}
    for r, f in zip(rows, fps):
        if r[0] is not None:
            first[root[f]] = min(first.get(root[f], r[0]), r[0])
    want = Counter((r[0], f"{f:016x}", first.get(root[f])) for r, f in zip(rows, fps))
    assert Counter(map(tuple, S.near_duplicates(edge).collect())) == want
    kept = S.without_copies(edge)
    assert kept.columns == edge.columns and kept.count() == len(set(root.values()))


@pytest.mark.parametrize("longest", [3, 40, 8192])
def test_links_of_dense_groups(spark, longest):
    """A cloud of fingerprints around one centre: long runs of one key, also in blocks."""
    rng = random.Random(4)
    centre, fps = rng.getrandbits(64), set()
    for _ in range(260):
        f = centre
        for b in rng.sample(range(64), rng.randint(0, 5)):
            f ^= 1 << b
        fps.add(f)
    fps |= {rng.getrandbits(64) for _ in range(100)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = S.links(spark.createDataFrame([(f,) for f in signed], "fp long"), longest=longest)
    pairs = links.collect()
    assert all(bin((u ^ v) & (1 << 64) - 1).count("1") <= 3 for u, v in pairs)
    got = {r.node: r.root for r in S.components(links).collect()}
    want = components(fps)
    groups = lambda m: sorted(sorted(k for k in m if m[k] == r) for r in set(m.values()))
    unsigned = {f: got.get(s, s) & (1 << 64) - 1 for f, s in zip(fps, signed)}
    assert groups(unsigned) == groups(want)


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(200) if i % 50 != 49] + [(1000, i) for i in range(1001, 1400)] + [(5, 5)]
    rows = S.components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.root for r in rows} == {i: i // 50 * 50 for i in range(200) if i % 50} | {i: 1000 for i in range(1001, 1400)}
    assert S.components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_no_copies_of_nothing(none):
    assert S.near_duplicates(none).collect() == [] and S.without_copies(none).collect() == []


def brute_spans(rows, window):
    last = U.LAST
    first = {}
    for k, t in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - window + 1):
            g = tuple(w[i:i + window])
            first[g] = min(first.get(g, last), last if k is None else k)
    out = []
    for k, t in rows:
        w = (t or "").encode().split()
        gone = {p for i in range(len(w) - window + 1) if first[tuple(w[i:i + window])] < (last if k is None else k) for p in range(i, i + window)}
        out.append((k, len(w), len(gone), hashlib.sha256(b" ".join(x for p, x in enumerate(w) if p not in gone)).hexdigest()))
    return out


@pytest.mark.parametrize("window,gram,shard", [(50, 10, 1000), (50, 10, 2), (12, 4, 3), (12, 12, 1)])
def test_passages(edge, window, gram, shard):
    rows = [(r[0], r[1]) for r in edge_rows()]
    found = U.dedup(edge, window=window, gram=gram, shard=shard)
    got = [(r.id, r.n_words, r.n_removed, r.kept_sha256) for r in found.collect()]
    assert Counter(got) == Counter(brute_spans(rows, window)) and sum(g[2] for g in got) > 100
    cut = U.without_spans(edge, found)
    assert cut.columns == edge.columns
    assert Counter((r.doc_id, hashlib.sha256(b" ".join((r.text or "").encode().split())).hexdigest()) for r in cut.collect()) == Counter((g[0], g[3]) for g in got)


def test_passages_of_periodic_texts(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("ab") * rng.choice([1, 1, 1, 2]) for _ in range(rng.randint(5, 200)))) for i in range(40)]
    rows += [(100 + i, ("x y z " * 100)[i:]) for i in range(5)]
    found = U.dedup(make(spark, [(*r, "en", "a") for r in rows]), window=8, gram=3, shard=7)
    assert Counter((r.id, r.n_words, r.n_removed, r.kept_sha256) for r in found.collect()) == Counter(brute_spans(rows, 8))


def test_passages_of_nothing(none):
    assert U.dedup(none).collect() == [] and U.without_spans(none, U.dedup(none)).collect() == []


def test_untouched_texts_stay_as_they_are(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = U.dedup(docs)
    kept = found.where("n_removed = 0").select(F.col("id").alias("doc_id"))
    left = U.without_spans(docs, found)
    assert left.join(kept, "doc_id").select("doc_id", "text").exceptAll(docs.select("doc_id", "text")).count() == 0
