import random

import pytest
from pyspark.sql import Window, functions as F

from shopflow.operators import skew as K


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = [("hot" if i % 3 == 0 else f"k{rng.randint(0, 9)}", rng.choice(["x", "y", None]), i, rng.random()) for i in range(3000)]
    return spark.createDataFrame(data, "k string, a string, i int, v double").repartition(7).cache()


def test_numbering_of_hot_keys(rows):
    want = rows.withColumn("row_no", F.row_number().over(Window.partitionBy("k").orderBy("a", "i")))
    for options in ({}, {"ranges": 13}, {"ranges": 1}):
        got = K.number_rows(rows, ["k"], ["a", "i"], **options)
        assert sorted(map(tuple, got.select("k", "i", "row_no").collect())) == sorted(map(tuple, want.select("k", "i", "row_no").collect()))


def test_numbering_without_keys(rows):
    got = K.number_rows(rows, [], ["v", "i"], ranges=9).orderBy("v", "i").collect()
    assert [r.row_no for r in got] == list(range(1, 3001))


def test_no_group_is_whole_key(rows):
    """A hot key is spread over many groups."""
    ranged = K.in_ranges(rows, ["k"], ["i"], 16)
    biggest = ranged.where("k = 'hot'").groupBy("_range").count().agg(F.max("count")).first()[0]
    assert biggest < 500


def test_previous_row(rows):
    w = Window.partitionBy("k").orderBy("i")
    want = rows.withColumn("prev", F.lag(F.struct("a", "v")).over(w)).select("k", "i", "prev.a", "prev.v")
    got = K.previous_row(rows, ["k"], ["i"], ["a", "v"], ranges=11).select("k", "i", "prev.a", "prev.v")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_batches(rows):
    sizes = K.with_batch(rows, 7, ["i"], ["k"], ranges=5).groupBy("k", "batch_no").count().collect()
    by_key = {}
    for r in sizes:
        by_key.setdefault(r.k, {})[r.batch_no] = r["count"]
    for batches in by_key.values():
        assert set(batches) == set(range(len(batches)))
        assert all(batches[b] == 7 for b in range(len(batches) - 1))
    with pytest.raises(ValueError):
        K.with_batch(rows, 0, ["i"])


def test_salted_join(spark, rows):
    right = spark.createDataFrame([("hot", 1), ("k1", 2)], "k string, w int")
    want = rows.join(right, "k", "left").select("k", "i", "w")
    got = K.salted_join(rows, right, ["k"], ["i"], salts=5).select("k", "i", "w")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_ranking_filter_runs_before_the_shuffle(rows):
    plan = K.top_per_key(rows, ["k"], [F.col("i")], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_dedupe_last(rows):
    got = {r.k: r.i for r in K.dedupe_last(rows, ["k"], ["i"]).collect()}
    want = {r.k: r.m for r in rows.groupBy("k").agg(F.max("i").alias("m")).collect()}
    assert got == want
