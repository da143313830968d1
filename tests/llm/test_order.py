"""Sharding and mixing."""

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shopflow.llm import curriculum as C, hilbert as H
from tests.conftest import SF
from tests.llm.conftest import edge_rows


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(spark, dims, bits):
    n = 1 << dims * bits
    cells = spark.range(n).select(*[(F.shiftright("id", bits * d).bitwiseAND((1 << bits) - 1)).alias(f"c{d}") for d in range(dims)])
    rows = cells.select("*", H.hilbert_index([F.col(f"c{d}") for d in range(dims)], bits).alias("h")).orderBy("h").collect()
    assert [r.h for r in rows] == list(range(n))
    assert all(sum(abs(a[d] - b[d]) for d in range(dims)) == 1 for a, b in zip(rows, rows[1:]))


@pytest.mark.parametrize("shards", [1, 7, 40, 100])
def test_shards(edge, shards):
    rows = H.assign(edge, shards).collect()
    want = Counter((r[0], 16 + len((r[1] or "").encode()), zlib.crc32((r[1] or "").encode())) for r in edge_rows())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append((r.slot, r.hilbert))
    assert all(sorted(s for s, _ in v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(shards))
    counts = [len(slots[i]) for i in range(shards)]
    assert max(counts) - min(counts) <= 1
    along = [h for i in range(shards) for _, h in sorted(slots[i])]
    assert along == sorted(along)


def test_shards_of_nothing_and_again(edge, none):
    assert H.assign(none).collect() == []
    assert sorted(map(str, H.assign(edge).collect())) == sorted(map(str, H.assign(edge.repartition(7)).collect()))


def test_manifest_prunes_without_losing_rows(spark):
    placed = H.assign(spark.read.parquet(f"{SF}/documents.parquet"), 10).cache()
    shards = H.manifest(placed)
    for wanted in ({"source": "src3"}, {"lang": "de"}, {"size": (0, 400)}):
        (name, value), = wanted.items()
        low, high = value if isinstance(value, tuple) else (value, value)
        need = {r.shard for r in placed.where(F.col(name).between(low, high)).collect()}
        left = {r.shard for r in H.prune(shards, **wanted).collect()}
        assert need <= left and len(left) < 10


def test_written_shards(edge, spark, tmp_path):
    unique = edge.where("doc_id is not null").dropDuplicates(["doc_id"]).drop("shard")
    H.write_shards(unique, H.assign(unique, 4), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == unique.count()


def test_native_plans(edge):
    for df in (H.assign(edge), C.curriculum(edge), C.mixed(edge)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_inverse_demand(spark):
    knots = ((0.0, 2.0), (0.4, 0.5), (1.0, 1.0))
    area = lambda t: sum((min(t, b[0]) - a[0]) * (2 * a[1] + (b[1] - a[1]) * (min(t, b[0]) - a[0]) / (b[0] - a[0])) / 2 for a, b in zip(knots, knots[1:]) if t > a[0])
    rows = spark.range(101).select((F.col("id") / 100).alias("u"), C.inverse_demand(F.col("id") / 100, knots).alias("t")).collect()
    assert all(abs(area(r.t) / area(1.0) - r.u) < 1e-9 for r in rows)


def test_mix(edge, none):
    rows = C.curriculum(edge).collect()
    size = lambda t: len((t or "").encode().split())
    assert Counter((r.doc_id, r.source, r["size"]) for r in rows) == Counter((r[0], r[3], size(r[1])) for r in edge_rows())
    sizes = Counter()
    for r in edge_rows():
        sizes[r[3]] += size(r[1])
    weights = dict(zip(sorted(sizes, key=lambda s: (s is None, s or "")), [5.0, 2.0, 1.0] * 9))
    target, left, demand = {}, set(sizes), 1.5 * sum(sizes.values())
    while True:
        level = demand / sum(weights[s] for s in left)
        full = {s for s in left if 2 * sizes[s] <= weights[s] * level}
        if not full:
            break
        target |= {s: 2.0 * sizes[s] for s in full}
        left, demand = left - full, demand - sum(2 * sizes[s] for s in full)
    target |= {s: weights[s] * level for s in left}
    taken = Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6 and 0 <= r.taken <= 2 * r["size"]
        assert (r.position is None) == (r.taken == 0 and r.copies == 0) or r.taken == 0
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)
    again = C.curriculum(edge.repartition(9)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again)) and C.curriculum(none).collect() == []


def test_mixed_documents(edge, none):
    out = C.mixed(edge)
    assert out.columns == edge.columns and C.mixed(none).collect() == []
    marked = edge.withColumn("_k", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).withColumn("_t64", F.xxhash64(F.coalesce("text", F.lit(""))))
    copies = Counter()
    for r in C.curriculum(marked, keep=("_k", "_t64")).collect():
        copies[r._k] += r.copies
    assert Counter(str(r.doc_id or "") for r in out.collect()) == +copies


def test_schedules_shift_sources(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("w " * 20).alias("text"), F.get(F.array(*map(F.lit, "abc")), (F.col("id") % 3).cast("int")).alias("source"))
    rows = C.curriculum(docs).where("position is not null").groupBy("source").agg(F.avg("position").alias("p")).collect()
    at = {r.source: r.p for r in rows}
    assert at["a"] < at["b"] < at["c"]
