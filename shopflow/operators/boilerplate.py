"""Blocks of lines that pages of one shop share: sampling, matching, storing, removing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shopflow.functions import text
from shopflow.functions.columns import let
from shopflow.operators.shops import product_urls
from shopflow.operators.skew import salted_join, top_per_key
from shopflow.runtime import cut

SAMPLE_DOCS = 3


def sample_docs(urls: DataFrame, pages: DataFrame, n: int = SAMPLE_DOCS, accept: Column | None = None) -> DataFrame:
    """The first ``n`` usable documents per domain: (domain, doc_no, url, markdown), numbered from 1.

    Over all URLs of a domain: stored, at least 500 characters, no repeat of an earlier one, and accepted by the extractor
    (``accept`` over the page columns; everything when left out). Ranking filters keep at most n rows per domain and task.
    """
    docs = (pages.join(urls.select("domain", "url").distinct(), ["domain", "url"])
            .where(F.coalesce(F.col("success"), F.lit(True)) & text.long_enough(F.col("markdown")))
            .withColumn("_key", text.dedupe_key(F.col("markdown"))))
    fresh = top_per_key(docs, ["domain", "_key"], [F.col("url")])
    if accept is not None:
        fresh = fresh.where(accept)
    ranked = fresh.withColumn("doc_no", F.row_number().over(Window.partitionBy("domain").orderBy("url")))
    return ranked.where(F.col("doc_no") <= n).select("domain", "doc_no", "url", "markdown")


def doc_pairs(docs: DataFrame, n: int = SAMPLE_DOCS) -> DataFrame:
    """Pairs i < j of the at most ``n`` sample documents of a domain, numbered in order: n * (n - 1) / 2 at most."""
    listed = (docs.where(F.col("doc_no") <= n).groupBy("domain")
              .agg(F.array_sort(F.collect_list(F.struct("doc_no", "markdown"))).alias("d")))
    pairs = [(i, j) for i in range(n) for j in range(i + 1, n)]
    made = F.filter(F.array(*[F.struct(
        F.lit(k).alias("pair_no"), F.get("d", F.lit(i)).alias("a"), F.get("d", F.lit(j)).alias("b"))
        for k, (i, j) in enumerate(pairs)]), lambda p: p["b"].isNotNull())
    return (listed.select("domain", F.explode(made).alias("p"))
            .select("domain", "p.pair_no", F.col("p.a.doc_no").alias("doc_a"), F.col("p.b.doc_no").alias("doc_b"),
                    F.col("p.a.markdown").alias("text_a"), F.col("p.b.markdown").alias("text_b")))


PAIR = ["domain", "pair_no"]


def met_lines(pairs: DataFrame) -> DataFrame:
    """(domain, pair_no, i, j): equal stripped lines of the two pages of a pair.

    A line that a page repeats meets by its number from the top and by its number from the bottom, as headers and footers
    do. So a line has two partners at most, however often it occurs, and one shuffle by line serves both pages.
    """
    def side(name: str, column: str) -> Column:
        return F.transform(text.stripped_lines(F.col(column)), lambda line, i: F.struct(F.lit(name).alias("side"), i.alias("at"), line.alias("line")))

    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = pairs.select(*PAIR, F.explode(F.concat(side("a", "text_a"), side("b", "text_b"))).alias("l")).select(*PAIR, "l.*")
    same = Window.partitionBy(*PAIR, "line", "side")
    numbered = rows.repartition(parts, *PAIR, "line").select(
        *PAIR, "line", "side", "at", F.row_number().over(same.orderBy("at")).alias("down"), F.row_number().over(same.orderBy(F.col("at").desc())).alias("up"))
    both = numbered.select(*PAIR, "line", "side", "at", F.explode(F.array(F.struct(F.lit("down").alias("way"), F.col("down").alias("n")),
                                                                         F.struct(F.lit("up").alias("way"), F.col("up").alias("n")))).alias("w"))
    place = {s: F.max(F.when(F.col("side") == s, F.col("at"))) for s in ("a", "b")}
    met = both.groupBy(*PAIR, "line", "w").agg(place["a"].alias("i"), place["b"].alias("j")).where("i is not null and j is not null")
    return met.select(*PAIR, "i", "j").distinct()


def run_islands(met: DataFrame) -> DataFrame:
    """(domain, pair_no, a, b, n): the maximal runs along diagonals, from their first lines."""
    diagonal = Window.partitionBy(*PAIR, "_diag").orderBy("i")
    islands = met.withColumn("_diag", F.col("i") - F.col("j")).withColumn("_island", F.col("i") - F.row_number().over(diagonal))
    return islands.groupBy(*PAIR, "_diag", "_island").agg(F.min("i").alias("a"), F.min("j").alias("b"), F.count(F.lit(1)).cast("int").alias("n")).drop("_diag", "_island")


def longest_first(runs: Column) -> Column:
    """The runs (a, b, n) of one pair in order of choice: the longest (then the one that begins first in a, then in b), of all
    others what does not cross it, and so on until nothing is left."""
    kind = "array<struct<a:int,b:int,n:int>>"

    def run(a: Column, b: Column, n: Column) -> Column:
        return F.struct(a.cast("int").alias("a"), b.cast("int").alias("b"), n.cast("int").alias("n"))

    def step(acc: Column, _: Column) -> Column:
        best = F.array_max(F.transform(acc["left"], lambda r: F.struct(r["n"].alias("n"), (-r["a"]).alias("a"), (-r["b"]).alias("b"))))

        def taken(best: Column) -> Column:
            a, b, n = -best["a"], -best["b"], best["n"]

            def around(r: Column) -> Column:
                skip = F.greatest(F.lit(0), a + n - r["a"], b + n - r["b"])
                return F.array(run(r["a"], r["b"], F.least(r["n"], a - r["a"], b - r["b"])), run(r["a"] + skip, r["b"] + skip, r["n"] - skip))

            left = F.filter(F.flatten(F.transform(acc["left"], around)), lambda r: r["n"] > 0)
            return F.struct(left.alias("left"), F.concat(acc["taken"], F.array(run(a, b, n))).alias("taken"))

        return F.when(F.size(acc["left"]) == 0, acc).otherwise(let(best, taken))

    # each choice ends one line of a at least, and no more lines of a have met than the runs hold
    most = F.aggregate(runs, F.lit(0), lambda total, r: total + r["n"])
    zero = F.struct(runs.cast(kind).alias("left"), F.array().cast(kind).alias("taken"))
    return F.aggregate(F.sequence(F.lit(1), F.greatest(most, F.lit(1))), zero, step, lambda acc: acc["taken"])


def common_blocks(pairs: DataFrame) -> DataFrame:
    """Adds ``blocks``: shared runs without unsafe lines, with more than three words, each once, in page order."""
    pairs = cut(pairs)
    listed = run_islands(met_lines(pairs)).groupBy(*PAIR).agg(F.collect_list(F.struct("a", "b", "n")).alias("_runs"))
    chosen = listed.select(*PAIR, F.array_sort(longest_first(F.col("_runs"))).alias("_runs"))
    runs = pairs.join(chosen, PAIR, "left").withColumn("_a", text.stripped_lines(F.col("text_a")))
    safe = F.transform(F.coalesce("_runs", F.array()), lambda r: F.filter(F.slice("_a", r["a"] + 1, r["n"]), text.is_safe_line))
    return (runs.withColumn("blocks", F.array_distinct(F.filter(safe, text.is_valid_block)))
            .drop("_a", "_runs", "text_a", "text_b"))


def first_productive(pairs: DataFrame, domains: DataFrame) -> DataFrame:
    """Blocks of the first pair that has any; every asked domain gets a row, with an empty list if there is none."""
    found = (pairs.where(F.size("blocks") > 0).groupBy("domain")
             .agg(F.min_by("blocks", "pair_no").alias("blocks")))
    return (domains.select("domain").distinct().join(found, "domain", "left")
            .withColumn("blocks", F.coalesce("blocks", F.array().cast("array<array<string>>"))))


def discover(docs: DataFrame, domains: DataFrame) -> DataFrame:
    return first_productive(common_blocks(doc_pairs(docs)), domains)


def attach_blocks(pages: DataFrame, blocks: DataFrame) -> DataFrame:
    """Each page with the blocks of its domain; null where the domain was never checked."""
    return salted_join(pages, blocks.select("domain", "blocks"), ["domain"], ["url"])


def clean_pages(pages: DataFrame, blocks: DataFrame, overlap: str = "union") -> DataFrame:
    """Noise sections out, shared blocks out, whole texts: adds ``too_long`` (before blocks go) and ``clean``."""
    noise_free = pages.withColumn("_text", text.remove_noise(F.col("markdown")))
    return (attach_blocks(noise_free, blocks)
            .withColumn("too_long", text.too_long(F.col("_text")))
            .withColumn("clean", text.remove_blocks(F.col("_text"), F.col("blocks"), overlap)).drop("_text", "blocks"))


def preview_blocks(blocks: DataFrame) -> DataFrame:
    """One row per block: number, first characters, number of lines."""
    return (blocks.select("domain", F.posexplode("blocks").alias("block_no", "block"))
            .select("domain", "block_no", text.block_preview(F.col("block")).alias("preview"),
                    F.size("block").alias("n_lines")))


def discovery_summary(blocks: DataFrame) -> DataFrame:
    """Blocks and lines found per domain."""
    return blocks.select("domain", F.size("blocks").alias("blocks_found"),
                         F.aggregate("blocks", F.lit(0), lambda n, b: n + F.size(b)).alias("total_lines"))


def discover_boilerplate(urls: DataFrame, pages: DataFrame, stored: DataFrame, checked_at,
                         accept: Column | None = None) -> DataFrame:
    """Block rows for the domains with product URLs that were never checked."""
    todo = product_urls(urls).join(stored.select("domain"), "domain", "left_anti")
    return discover(sample_docs(todo, pages, accept=accept), todo).withColumn("checked_at", F.lit(checked_at).try_cast("timestamp"))
