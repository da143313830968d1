"""BPE, token files, exact search, queries, pipeline."""

import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from shopflow.llm import bpe, token_files, topk
from shopflow.llm.queries import QUERIES
from tests.check_oracles import TABLES, compare
from tests.conftest import SF
from tests.llm.conftest import edge_rows

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
OWN = bpe.Vocabulary(bpe.read_definition(PATH))


@pytest.mark.parametrize("text", [":\U0003d000", "a\u0558b", "Σας ΟΔΟΣ", "İx", "e\u0301\u0323", "\u00a0a\u2003b", "\x1ca"])
def test_odd_characters(text):
    assert OWN.encode(text) == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40) | st.text(alphabet="aAbC's'revellm \n\tÀéΣς١½!?<|endoftext|>́\x1c\x85", max_size=60))
def test_ids_equal_the_library(text):
    assert OWN.encode(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_long_words_take_the_same_merges():
    rng = random.Random(6)
    for n in (1, 2, 300, 700):
        parts = [OWN.ids[c] for c in rng.choices("thequickbrownfx", k=n)]
        assert OWN._scan(list(parts)) == OWN._heap(list(parts))


def test_encode_and_decode(edge, none):
    def want(text):
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        return ids, LIBRARY.decode(ids, skip_special_tokens=False)

    encoded = bpe.encode(edge, PATH)
    rows = bpe.decode(encoded, PATH).collect()
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in rows) == Counter((r[0], tuple(want(r[1])[0]), want(r[1])[1]) for r in edge_rows())
    assert all(r.n_tokens == len(r.ids) for r in rows) and "text" not in encoded.columns
    digests = bpe.encode(edge, PATH, ["doc_id"], digests=True).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert Counter(map(tuple, digests)) == Counter((r[0], len(want(r[1])[0]), sha(" ".join(map(str, want(r[1])[0]))), sha(want(r[1])[1])) for r in edge_rows())
    assert bpe.encode(none, PATH).collect() == []


def test_token_files(edge, none, spark, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write(edge, path, PATH)
    rows = token_files.read(spark, path).orderBy("start").collect()
    order = sorted(edge_rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start = 0
    for r, w in zip(rows, order, strict=True):
        ids = [*LIBRARY.encode(w[1] or "", add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids) == (w[0], start, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    found = {r.doc_id: r.ids for r in token_files.lookup(spark, path, [5, 13, 999]).collect()}
    assert found == {k: [*LIBRARY.encode(t, add_special_tokens=False).ids, 2] for k, t, *_ in edge_rows() if k in (5, 13)}
    token_files.write(none, str(tmp_path / "none"), PATH)
    assert token_files.read(spark, str(tmp_path / "none")).collect() == []


def test_dictionary_shrinks_short_documents(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    token_files.write(docs, str(tmp_path / "t"), PATH)
    blocks = spark.read.parquet(str(tmp_path / "t") + "/blocks").select(F.explode("entries").alias("e")).agg(F.sum("e.length"), F.sum("e.n_tokens")).first()
    assert blocks[0] < 2 * 0.75 * blocks[1]
    rows = spark.read.parquet(str(tmp_path / "t") + "/blocks").select("dict_hash").distinct().collect()
    stored = spark.read.parquet(str(tmp_path / "t") + "/dictionary").first()
    assert [r[0] for r in rows] == [stored.dict_hash] == [hashlib.sha256(stored.dictionary).hexdigest()]


def brute_top(rows, k, queries):
    whole = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    asked = {}
    for i, v in whole:
        if queries(i):
            asked[i] = max(asked.get(i, v), v)
    out = []
    for q, v in asked.items():
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return out


def test_top_k_with_ties_and_odd_vectors(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.5]) for _ in range(6)]) for i in range(300)]
    rows += [(300, None), (320, [None, 1.0]), (340, [float("nan")] * 6), (360, [float("inf")] * 6), (380, []), (400, [1.0]), (420, [0.1] * 9), (None, [1.0] * 6), (7, rows[7][1]), (20, rows[20][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = topk.top_k(df, df.where("vec_id % 20 = 0"), k=9, candidates=37, block=5).collect()
    assert sorted(map(tuple, got)) == sorted(brute_top(rows, 9, lambda i: i % 20 == 0))
    assert topk.top_k(df.limit(0), df).collect() == [] == topk.top_k(df, df.limit(0)).collect()
    assert len(topk.top_k(df.where("vec_id in (1, 40)"), df.where("vec_id = 40")).collect()) == 1


def test_top_k_of_large_values(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) * 10 ** rng.choice([0, 3, 7]) for _ in range(5)]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert sorted(map(tuple, topk.top_k(df, df, k=4, candidates=7, block=16).collect())) == sorted(brute_top(rows, 4, lambda i: True))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", [n for n in oracle_sql() if n in QUERIES])
def test_sql(spark, con, name):
    result, _ = compare(spark, con, name, SF)
    assert result.startswith("ok"), result


def test_every_operator_has_its_query():
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in QUERIES} and "pipeline" in queries()


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF).cache()
        assert out.columns == docs.columns, name
        sizes.append(out.count())
        docs = out
    assert sizes[0] > sizes[1] >= 1 and sizes[2] == sizes[1]
    direct = Counter((r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, SF).collect())
    assert direct == Counter((r.doc_id, tuple(LIBRARY.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect())


def test_pipeline_stages_take_edge_documents(spark, edge, none):
    for docs in (edge, none):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns or name == "token_ids"
            out.collect()


def test_words_of_latin_letters_are_merged_as_by_the_library():
    import random
    import public_tokenizers
    from shopflow.llm import token_files as T

    encoder = T.Encoder(T.read_definition(public_tokenizers.path("word_bpe_49k.json")), "<u2")
    rng = random.Random(9)
    letters = [c for c in map(chr, range(0x130)) if c.isalpha()]
    common = list("etaoinshrdlcumwfgypbvk")
    words = {"".join(rng.choices(rng.choice([common, common, letters]), k=rng.randint(1, 14))) + rng.choice(["", "", ".", ",", "..."]) for _ in range(60_000)}
    words = [w.encode() for w in sorted(words)] + [b"a" * 3000, b"thing" * 400]
    assert encoder.latin and encoder.many(words) == [encoder._latin(w) for w in words]
    other = public_tokenizers.path("byte_bpe_50k.json")
    assert not T.Encoder(T.read_definition(other), "<u2").latin  # no word ends
