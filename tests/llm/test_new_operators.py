"""Divergence audit, vector codes, best-fit packing: against plain Python."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shopflow.llm import codes as C, divergence as D, packing as K
from shopflow.llm.queries import QUERIES
from tests.conftest import SF
from tests.llm.conftest import edge_rows

BYTES = public_tokenizers.path("byte_bpe_50k.json")


# --- divergence

def terms(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return "".join(c if ord(c) > 127 or "a" <= c <= "z" else " " for c in low).split(" ")


def plain_audit(rows, least=3, most=200):
    docs = [(r[2] or "", r[3] or "", [t for t in terms(r[1]) if t]) for r in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = Counter(t for d in own for t in set(d[2]))
        kept = {t for t, n in seen.items() if n >= least}
        counts = {s: Counter() for s in {d[1] for d in own}}
        for _, s, words in own:
            counts[s].update(t for t in words if t in kept)
        whole = sum(counts.values(), Counter())

        def p(c, t):
            return 1 + 10 ** 9 * (c[t] + 1) // (sum(c.values()) + len(kept))

        for s, c in counts.items():
            pair = [(sum((p(c, t) - p(o, t)) ** 2 // p(o, t) for t in kept), i) for i, o in counts.items() if i != s]
            term = [((p(c, t) - p(whole, t)) ** 2 // p(whole, t), t) for t in c if c[t] and p(c, t) > p(whole, t)]
            for part, found in (("pair", pair), ("term", sorted(term, key=lambda x: (-x[0], x[1].encode()))[:most])):
                out += [(lang, s, part, i, v, k + 1) for k, (v, i) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode())))]
    return sorted(out)


@pytest.mark.parametrize("bucket,most", [(16_384, 200), (7, 5)])
def test_audit(edge, bucket, most):
    found = D.audit(edge, bucket=bucket, most=most)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, found.collect())) == plain_audit(edge_rows(), most=most)


def test_audit_of_nothing_and_of_few_terms(spark, none):
    assert D.audit(none).collect() == []
    few = spark.createDataFrame([(1, "a b", "x", "s"), (2, None, "x", "t"), (3, "..", None, None)], "doc_id long, text string, lang string, source string")
    assert sorted(map(tuple, D.audit(few).collect())) == [("x", "s", "pair", "t", 0, 1), ("x", "t", "pair", "s", 0, 1)]


def test_terms_and_shares():
    text = "Aé'B 漢x\x00\x7f~ Zz1İ"
    assert [t.decode() for t in D.terms(text.encode())] == [t for t in terms(text) if t]
    import numpy as np
    rng = random.Random(3)
    counts = [rng.randrange(10 ** k) for k in range(1, 15)]
    totals = [c + rng.randrange(1, 10 ** 15) for c in counts]
    assert D.shares(np.array(counts), np.array(totals)).tolist() == [1 + 10 ** 9 * (c + 1) // t for c, t in zip(counts, totals)]


def test_task_hands_out_in_parts(edge):
    docs = edge.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))

    def total(held):
        return sorted(map(tuple, D.counted(docs, held).groupBy("lang", "source", "term").agg(F.sum("count"), F.sum("docs")).collect()), key=str)

    assert total(1) == total(10 ** 6)


# --- codes

def plain_codes(rows, parts=16, k=64, rounds=2, scale=256):
    def ok(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    def floor(x):
        return int(x) * scale if abs(x) >= 2 ** 53 else math.floor(x * scale)

    rows = [(i, v, label) for i, v, label in rows if ok(v)]
    width = max([parts, *(-(-len(v) // parts) * parts for _, v, _ in rows)])
    padded = {n: [*v, *[0.0] * (width - len(v))] for n, (_, v, _) in enumerate(rows)}
    whole = {n: [floor(x) for x in v] for n, v in padded.items()}
    first = sorted(range(len(rows)), key=lambda n: (rows[n][0] is None, rows[n][0] or 0, rows[n][1]))[:k]
    w = width // parts
    books = [[whole[n][p * w:p * w + w] for n in first] for p in range(parts)]

    def near(n, p):
        x = whole[n][p * w:p * w + w]
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        held = defaultdict(list)
        for n in range(len(rows)):
            for p in range(parts):
                held[p, near(n, p)[1]].append(whole[n][p * w:p * w + w])
        books = [[[sum(x) // len(held[p, e]) for x in zip(*held[p, e])] if held[p, e] else books[p][e] for e in range(len(first))] for p in range(parts)]
    out, most = [], 2 ** 63 - 1
    labels = Counter()
    for n, (i, _, label) in enumerate(rows):
        found = [near(n, p) for p in range(parts)]
        error = min(sum(min(d, most) for d, _ in found), most)
        labels[label] += error
        out.append((i, label, "".join(f"{e:02x}" for _, e in found), error))
    return sorted(((*r, min(labels[r[1]], most)) for r in out), key=str), books


def vectors(n=300, dims=32, seed=5):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(dims)], rng.choice([None, 1, 2])) for i in range(n)]
    rows += [(n + i, rows[7][1], 3) for i in range(60)]  # copies
    rows += [(None, rows[3][1], 1), (5, rows[5][1], 1), (n + 100, None, 1), (n + 101, [float("nan")] * dims, 1), (n + 102, [None] + [0.0] * (dims - 1), 1),
             (n + 103, [float("-inf")] + [0.0] * (dims - 1), 2), (n + 104, [0.5] * (dims - 3), 2), (n + 105, [], None)]
    return rows


SCHEMA = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("parts,k,rounds,large", [(16, 64, 2, None), (8, 5, 4, None), (5, 3, 0, None), (16, 4, 2, 1e9), (4, 6, 1, 1e30)])
def test_codes(spark, parts, k, rounds, large):
    rows = vectors()
    if large:
        rows = rows[:40] + [(1000 + i, [large * (i + 1), -large / 3] + [0.25] * 30, 9) for i in range(4)]
    made, books = C.compress(spark.createDataFrame(rows, SCHEMA).repartition(5), parts=parts, entries=k, rounds=rounds)
    assert made.columns == ["vec_id", "label", "code", "error", "label_error"]
    want, want_books = plain_codes(rows, parts, k, rounds)
    assert books == want_books and sorted(map(tuple, made.collect()), key=str) == want


def test_codes_of_none_and_of_one(spark):
    made, books = C.compress(spark.createDataFrame([], SCHEMA))
    assert made.collect() == [] and books == [[]] * 16
    made, books = C.compress(spark.createDataFrame([(1, [0.1] * 16, 0)], SCHEMA))
    assert [tuple(r) for r in made.collect()] == [(1, 0, "00" * 16, 0, 0)] and books == [[[25]]] * 16


def test_members_stay(spark):
    rows = spark.createDataFrame(vectors(), SCHEMA).where(C.usable("embedding")).select(F.monotonically_increasing_id().alias("row"), F.col("embedding").alias("v"))
    rng = random.Random(2)
    books = [[[rng.randrange(-99, 99) for _ in range(2)] for _ in range(8)] for _ in range(16)]
    held = C.placed(rows, books, 32, 256, 4).cache()
    assert C.compared(held, books, 4).where("moved").count() == 0
    moved = [[[x + 40 for x in e] if i == 0 else e for i, e in enumerate(book)] for book in books]
    looked = C.compared(held, moved, 4)
    assert 0 < looked.where("moved").count() and looked.selectExpr("sum(length(`rows`))").first()[0] == held.selectExpr("sum(length(`rows`))").first()[0]


def test_decompressed_vectors_are_near(spark):
    rows = spark.createDataFrame([r for r in vectors() if r[1] and len(r[1]) == 32], SCHEMA).where(C.usable("embedding"))
    made, books = C.compress(rows)
    back = C.decompress(made, books).join(rows.dropDuplicates(["vec_id"]).select("vec_id", "embedding"), "vec_id").collect()
    assert back and all(abs(sum((math.floor(256 * a) - 256 * b) ** 2 for a, b in zip(r.embedding, r.approximation)) - r.error) < 1e-3 for r in back if r.vec_id != 5)
    assert C.digest(books) == hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


# --- packing

def check_packing(rows, packed, size, library):
    made = defaultdict(list)
    for r in packed:
        made[r.doc_id, r.piece].append(r)
    want = Counter()
    for doc, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % size or size
        cuts = [0, *range(first, len(ids), size), len(ids)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[doc, piece, a, b - a, zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[a:b]))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    filled = defaultdict(list)
    for r in packed:
        filled[r.sequence_id].append((r.offset, r.length))
    for held in filled.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= size
    return len(filled), -(-sum(r.length for r in packed) // size)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTES)


@pytest.mark.parametrize("size", [1024, 64, 1])
def test_packing(edge, library, size):
    rows = [(r[0], r[1]) for r in edge_rows()]
    packed = K.pack(edge, BYTES, size, ids=False).collect()
    sequences, least = check_packing(rows, packed, size, library)
    assert sequences <= least + 2


def test_packing_of_nothing(none):
    assert K.pack(none, BYTES).collect() == []


def test_sequences_hold_the_ids(edge, library):
    packed = K.pack(edge, BYTES, 128)
    ids = {r.sequence_id: r.ids for r in K.sequences(packed).collect()}
    assert all(len(x) <= 128 for x in ids.values())
    assert all(ids[r.sequence_id][r.offset:r.offset + r.length] == r.ids for r in packed.collect())


def test_packing_is_near_the_bound(spark, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").collect()]
    sequences, least = check_packing(docs, QUERIES["op13_configuration_lp"](spark, SF.replace("0.001", "0.01")).collect(), 1024, library)
    assert sequences <= 1.002 * least


@pytest.mark.parametrize("seed", range(6))
def test_configurations_use_every_piece_once(seed):
    rng = random.Random(seed)
    size = rng.choice([7, 50, 200])
    histogram = {length: rng.choice([1, 3, 1000, 10 ** 9]) for length in rng.sample(range(1, size + 1), rng.randint(1, size))}
    made = K.configurations(histogram, size)
    used = Counter()
    for config, times in made:
        assert times > 0 and sum(length * a for length, a in config.items()) <= size
        for length, a in config.items():
            used[length] += a * times
    assert used == Counter(histogram)
    # long pieces need a sequence each
    bound = max([-(-sum(length * n for length, n in histogram.items()) // size), sum(n for length, n in histogram.items() if 2 * length > size)])
    assert sum(times for _, times in made) <= 1.34 * bound + 1


def test_knapsack_is_the_best():
    rng = random.Random(1)
    for _ in range(30):
        size = rng.randint(3, 14)
        lengths = rng.sample(range(1, size + 1), min(3, size))
        prices, counts = {n: rng.random() for n in lengths}, {n: rng.randint(1, 4) for n in lengths}
        found = K.richest(size, prices, counts)
        best = 0.0
        todo = [(0, 0.0, lengths)]
        while todo:
            used, worth, rest = todo.pop()
            best = max(best, worth)
            if rest:
                todo += [(used + a * rest[0], worth + a * prices[rest[0]], rest[1:]) for a in range(counts[rest[0]] + 1) if used + a * rest[0] <= size]
        assert abs(sum(a * prices[n] for n, a in found.items()) - best) < 1e-9 and all(a <= counts[n] for n, a in found.items())
        assert sum(a * n for n, a in found.items()) <= size


def test_encoder_equals_the_library(library):
    encoder = K.Encoder(K.read_definition(BYTES))
    assert encoder.fast is not None
    every = "".join(f"a{chr(c)}1{chr(c)} {chr(c)}" for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for at in range(0, len(every), 70_000):
        text = every[at:at + 70_000]
        assert encoder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids, at
    for text in ["", " ", "<|endoftext|>", "x <|endoftext|>y", " " * 30_000 + "x", "\n" * 20_000, "y" * 30_000, "a  b\t\n c  d"]:
        assert encoder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids
    assert K.Encoder(K.read_definition(public_tokenizers.path("word_bpe_49k.json"))).fast is None
