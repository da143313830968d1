"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight and a schedule, a factor that changes piecewise linearly over training time 0..1. The share of a
source's target that is due by time t is the integral of its schedule up to t over the whole integral. A document that
begins at word u of its source's stream is due when that demand reaches u, so inverting the integral gives its training
position, and sorting by position gives the mix in which the local proportions follow the schedules.

Built from DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shopflow.llm.base import ordered_hash, prefix_sums, scoped, stored, text_of, word_count

#: (time, factor) knots by weight class: the heaviest sources lead, the lightest close the training.
SCHEDULES = {0: ((0.0, 1.5), (1.0, 0.5)), 1: ((0.0, 1.0), (1.0, 1.0)), 2: ((0.0, 0.5), (1.0, 1.5))}
WEIGHTS = (5.0, 2.0, 1.0)


def inverse_demand(u: Column, knots: tuple[tuple[float, float], ...]) -> Column:
    """The time at which the share ``u`` of the demand is due; the schedule is linear between knots."""
    if knots[0][0] != 0.0 or knots[-1][0] != 1.0 or any(f <= 0 for _, f in knots):
        raise ValueError("knots run from 0 to 1 with positive factors")
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:])]
    total, done, time = sum(areas), 0.0, F.lit(1.0)
    pieces = []
    for (t0, f0), (t1, f1), area in zip(knots, knots[1:], (a for a in areas)):
        slope, need = (f1 - f0) / (t1 - t0), u * total - F.lit(done)
        # f0 x + slope x^2 / 2 = need, in the form that also holds for slope 0
        x = 2 * need / (f0 + F.sqrt(F.greatest(F.lit(f0 * f0) + 2 * slope * need, F.lit(0.0))))
        pieces.append((done + area, F.lit(t0) + x))
        done += area
    for upto, value in reversed(pieces):
        time = F.when(u * total <= upto, value).otherwise(time)
    return F.when(u.isNotNull(), F.least(F.greatest(time, F.lit(0.0)), F.lit(1.0)))


def targets(sources: DataFrame, spark: SparkSession, share: float = 1.5, most: float = 2.0,
            weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Adds weight class and target to (source, source_size).

    Weights repeat over the sources by code point, null last. Together the targets are ``share`` times all sizes, each at
    most ``most`` times its own; what a full source cannot take goes to the others by weight. Sources fill up in the order
    of size over weight, so the common level follows from running sums over that order: a source is full if the level
    that fills all before it and it does not exhaust the demand.
    """
    every = Window.partitionBy()
    ranked = sources.withColumn("class", F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights))))
    ranked = ranked.withColumn("weight", F.get(F.array(*map(F.lit, weights)), F.col("class")))
    limit = F.col("source_size") * F.lit(most)
    by_need = Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    sums = (ranked.withColumn("demand", F.sum("source_size").over(every) * F.lit(share))
            .withColumn("filled", F.coalesce(F.sum(limit).over(by_need.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
            .withColumn("left", F.sum("weight").over(by_need.rowsBetween(0, Window.unboundedFollowing))))
    level = (F.col("demand") - F.col("filled")) / F.col("left")
    open_ = limit / F.col("weight") > level
    return (sums.withColumn("open", open_).withColumn("level", F.min(F.when(F.col("open"), level)).over(by_need.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("level", F.first("level", ignorenulls=True).over(by_need.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
            .select("source", "class", "weight", "source_size", F.when(F.col("open"), F.col("weight") * F.col("level")).otherwise(limit).alias("target")))


def curriculum(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[float, ...] = WEIGHTS,
               schedules: dict[int, tuple[tuple[float, float], ...]] = SCHEDULES, keep: tuple[str, ...] = ("doc_id",),
               source: str = "source", text: str = "text") -> DataFrame:
    """One row per document: ``keep``, source, size (words), source_size, target, taken, copies, position.

    The documents of a source follow one another in hash order of (keep, size) and start again until the target is
    reached; the last one is taken in part, so a source's taken words differ from its target by less than one.
    ``taken`` counts the words with repeats, ``copies`` the passes whose middle lies within the target (for a mix of
    whole documents), ``position`` is the training time of the first pass (null if none begins). Null sources are a
    source of their own; null or blank texts have size 0 and are never taken; rows equal in ``keep`` and size are
    interchangeable; an empty table gives no row. Results do not depend on partitioning.
    """
    spark = docs.sparkSession
    narrow = docs.select(*[docs[k].alias(f"_k{i}") for i, k in enumerate(keep)], docs[source].cast("string").alias("source"),
                         word_count(text_of(docs, text)).alias("size"))
    names = [f"_k{i}" for i in range(len(keep))]
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    narrow = (narrow.withColumn("_h", ordered_hash(*names, "size"))
              .withColumn("_bucket", F.floor(F.col("_h") * buckets).cast("int"))
              .withColumn("_source", F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("v"), "source"))))
    narrow = stored(narrow, "mix-rows")
    sizes = narrow.groupBy("_source", "source").agg(F.sum("size").alias("source_size"))
    aims = stored(targets(sizes, spark, share, most, weights)
                  .withColumn("_source", F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("v"), "source"))).drop("source"), "mix-targets")
    placed = prefix_sums(narrow, ["_source"], "_bucket", [F.col("_h"), F.col("size"), *map(F.col, names)], {"_start": "size"})
    mixed = placed.join(aims, "_source")
    whole = F.floor(F.col("target")).cast("long")
    passes = range(int(-(-most // 1)))
    start = [F.col("_start") + F.col("source_size") * k for k in passes]
    taken = sum((F.greatest(F.least(whole - s, F.col("size")), F.lit(0)) for s in start), F.lit(0))
    copies = sum((F.when((F.col("size") > 0) & (s + F.col("size") / 2 <= F.col("target")), 1).otherwise(0) for s in start), F.lit(0))
    u = F.when((F.col("size") > 0) & (F.col("_start") < F.col("target")), F.col("_start") / F.col("target"))
    position = F.coalesce(*[F.when(F.col("class") == k, inverse_demand(u, knots)) for k, knots in schedules.items()])
    again = F.when(F.col("copies") > 1, F.coalesce(*[F.when(F.col("class") == k, inverse_demand((F.col("_start") + F.col("source_size")) / F.col("target"), knots))
                                                   for k, knots in schedules.items()]))
    return (mixed.select(*[F.col(n).alias(k) for n, k in zip(names, keep)], "source", "size", F.col("source_size").cast("long").alias("source_size"),
                         F.col("target").cast("double").alias("target"), taken.cast("long").alias("taken"), copies.alias("copies"),
                         position.alias("position"), F.col("_start"), F.col("class"))
            .withColumn("again", again).drop("_start", "class"))


def in_order(mix: DataFrame) -> DataFrame:
    """The mix range-sorted by training position; documents that are not taken come last."""
    return mix.orderBy(F.col("position").asc_nulls_last(), *[F.col(c) for c in mix.columns if c != "position"])


@scoped
def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The mix itself: whole documents, as often as they are taken, range-sorted by training position; columns of ``docs``.

    A document that is cut at its source's target counts if at least half of it lies within.
    """
    marked = docs.withColumn("_k", F.coalesce(docs[key].cast("string"), F.lit(""))).withColumn("_t64", F.xxhash64(text_of(docs, text)))
    mix = curriculum(marked, keep=("_k", "_t64"), text=text, **options).where("copies > 0")
    times = F.explode(F.when(F.col("copies") > 1, F.array("position", "again")).otherwise(F.array("position"))).alias("_at")
    sequence = stored(mix.select("_k", "_t64", times), "mix-sequence", keep=True)
    rows = marked.dropDuplicates(["_k", "_t64"]).join(sequence, ["_k", "_t64"])
    return rows.orderBy("_at", "_k", "_t64").select(*docs.columns)
