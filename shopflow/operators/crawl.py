"""Breadth-first walk over a stored link graph without cycles, for many shops at once."""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, functions as F

from shopflow.functions import urls
from shopflow.operators.skew import number_rows, salted_join
from shopflow.runtime import Growing, bucketed, growing, written

_SALTS = 8
_LEVEL = ["domain", "url", "depth", "parent_url", "success"]


def wanted_links(edges: DataFrame, include_external: bool = False) -> DataFrame:
    """The edges of a wanted kind."""
    return edges if include_external else edges.where(F.col("kind") == "internal")


def gate_links(edges: DataFrame, include_external: bool = False,
               extensions: list[str] = urls.EXCLUDED_EXTENSIONS,
               patterns: list[str] = urls.EXCLUDED_PATTERNS) -> DataFrame:
    """Adds ``allowed`` to the edges of a wanted kind."""
    return wanted_links(edges, include_external).withColumn("allowed", urls.crawlable(F.col("dst_url"), extensions, patterns))


def met_targets(links: DataFrame, visited: DataFrame) -> DataFrame:
    """The targets of some links that were not visited, once per domain: (domain, url, n, f).

    ``links`` has (domain, dst_url, ord) with the linking page as ``src_url`` and its ``walk`` order;
    ``n`` counts the links, ``f`` holds the walk order and parent of the first one.
    """
    walk = F.concat("walk", F.lpad(F.hex("ord"), 8, "0"))
    first = F.min(F.struct(walk.alias("walk"), F.col("src_url").alias("parent_url")))
    met = links.groupBy("domain", F.col("dst_url").alias("url")).agg(F.count(F.lit(1)).alias("n"), first.alias("f"))
    return met.join(visited.select("domain", "url"), ["domain", "url"], "left_anti")


def gated(met: DataFrame, extensions: list[str] = urls.EXCLUDED_EXTENSIONS, patterns: list[str] = urls.EXCLUDED_PATTERNS) -> DataFrame:
    """Adds ``allowed``: the filters look at a target once, however many links lead to it."""
    return met.withColumn("allowed", urls.crawlable(F.col("url"), extensions, patterns))


def skipped_links(met: DataFrame) -> DataFrame:
    """Links per domain whose targets the filters keep out."""
    return met.where(~F.col("allowed")).groupBy("domain").agg(F.sum("n").alias("urls_skipped"))


def discover_links(level: DataFrame, edges: DataFrame, visited: DataFrame, include_external: bool = False, **gates) -> tuple[DataFrame, DataFrame]:
    """(children not yet visited with their first parent, number of skipped links per domain) of one level."""
    links = (level.where("success").select("domain", F.col("url").alias("src_url"), F.col("url").alias("walk"), "depth")
             .join(wanted_links(edges, include_external), "src_url"))
    depth = level.agg(F.max("depth")).first()[0] or 0  # of the level, one number
    met = gated(met_targets(links, visited), **gates)
    return met.where("allowed").select("domain", "url", F.lit(depth + 1).alias("depth"), "f.parent_url"), skipped_links(met)


def _within_budget(level: DataFrame, spent: DataFrame, max_pages: int, **options) -> DataFrame:
    """Cut every domain at its ``max_pages``-th successful page, in walk order. ``spent`` has (domain, spent)."""
    gain = level.groupBy("domain").agg(F.count_if("success").alias("gain"))
    full = (gain.join(spent, "domain", "left").withColumn("left", F.lit(max_pages) - F.coalesce("spent", F.lit(0)))
            .where(F.col("gain") >= F.col("left")).select("domain", "left"))
    if full.limit(1).count() == 0:
        return level
    pages = level.where("success").join(full, "domain", "left_semi").select("domain", "walk")
    last = (number_rows(pages, ["domain"], ["walk"], "n", **options).join(full, "domain")
            .where(F.col("n") == F.col("left")).select("domain", F.col("walk").alias("_last"), F.lit(True).alias("_full")))
    marked = salted_join(level, last, ["domain"], ["url"])
    return (marked.where(F.col("_full").isNull() | (F.col("walk") <= F.col("_last")))
            .withColumn("closed", F.coalesce("_full", F.lit(False))).drop("_last", "_full"))


def bfs(seeds: DataFrame, edges: DataFrame, pages: DataFrame, max_depth: int | None = None,
        max_pages: int | None = None, partitions: int | None = None, **gates) -> DataFrame:
    """The pages of :func:`walk`."""
    return walk(seeds, edges, pages, max_depth, max_pages, partitions, **gates)[0]


def walk(seeds: DataFrame, edges: DataFrame, pages: DataFrame, max_depth: int | None = None,
         max_pages: int | None = None, partitions: int | None = None, include_external: bool = False, **gates) -> tuple[DataFrame, DataFrame]:
    """Every page reachable from the seeds, visited once per seed domain, with depth and first parent; and per domain the
    successful pages and skipped links: (domain, spent, urls_skipped).

    ``seeds`` (domain, url), ``edges`` (src_url, dst_url, kind, ord), ``pages`` (url, success). A page that is not
    stored or failed is a result but is not expanded. The first parent is the one that comes first in walk order:
    parents in the order of their level, links in page order. A link of an expanded page is skipped if the filters keep its target out. The walk ends when no page is left, and earlier only at
    a given depth or, per domain, at ``max_pages`` successful pages.

    The graph is written once to the shared folder, bucketed by (source, salt), the status of the pages and the visited keys into
    tables of their own, bucketed by key; to the last each level adds its own. So a level moves its frontier and its links, and neither the
    graph nor older levels; the counters of a domain are carried from level to level as one row. A level is written, so a lost executor does not restart the walk.
    Filters and status are asked of the targets that a level meets, not of every link.
    """
    spark = seeds.sparkSession
    status = pages.groupBy("url").agg(F.max("success").alias("success"))
    linked = wanted_links(edges, include_external).select("src_url", "dst_url", "ord").withColumn("salt", F.pmod(F.xxhash64("dst_url"), F.lit(_SALTS)).cast("int"))
    with bucketed(linked, ["src_url", "salt"], "graph", partitions) as graph, bucketed(status, ["url"], "status", partitions) as known, \
            growing(spark, ["domain", "url"], "visited", partitions) as visited:
        return _walk(seeds, graph, visited, known, max_depth, max_pages, gates)


def _walk(seeds: DataFrame, graph: DataFrame, visited: Growing, status: DataFrame, max_depth: int | None, max_pages: int | None,
          gates: dict) -> tuple[DataFrame, DataFrame]:
    start = seeds.select("domain", "url").distinct()
    level = written(start.join(status, "url", "left").select(
        "domain", "url", F.lit(0).alias("depth"), F.lit(None).cast("string").alias("parent_url"),
        F.coalesce("success", F.lit(False)).alias("success"), F.lit("").alias("walk")), "level", keep=True)
    counters = start.select("domain", F.lit(0).cast("long").alias("spent"), F.lit(0).cast("long").alias("urls_skipped")).distinct()
    levels: list[DataFrame] = []
    for depth in count():
        if level.isEmpty():
            break
        bounded = level if max_pages is None else _within_budget(level, counters, max_pages)
        closed = "closed" in bounded.columns
        if closed:
            bounded = written(bounded, "level", keep=True)
        levels.append(bounded.select(*_LEVEL))
        visited.add(bounded.select("domain", "url"))
        gain = bounded.groupBy("domain").agg(F.count_if("success").alias("_spent"))
        if depth == max_depth:
            counters = counted(counters, gain)
            break
        open_pages = bounded.where(F.col("success") & ~F.col("closed")) if closed else bounded.where("success")
        spread = open_pages.select("domain", F.col("url").alias("src_url"), "walk",
                                   F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
        met = gated(met_targets(links_of(spread, graph), visited.rows()), **gates).join(status, "url", "left")
        met = written(met.withColumn("success", F.coalesce("success", F.lit(False))), "met", keep=True)
        counters = written(counted(counters, gain, skipped_links(met)), "counters", keep=True)
        level = met.where("allowed").select("domain", "url", F.lit(depth + 1).alias("depth"), "f.parent_url", "success", "f.walk")
    return reduce(DataFrame.unionByName, levels) if levels else level.select(*_LEVEL), written(counters, "counters", keep=True)


def counted(counters: DataFrame, gain: DataFrame, skipped: DataFrame | None = None) -> DataFrame:
    """The counters with a level's successful pages and skipped links."""
    added = counters.join(gain, "domain", "left")
    added = added.join(skipped.withColumnRenamed("urls_skipped", "_skipped"), "domain", "left") if skipped is not None else added.withColumn("_skipped", F.lit(0))
    return added.select("domain", (F.col("spent") + F.coalesce("_spent", F.lit(0))).alias("spent"),
                        (F.col("urls_skipped") + F.coalesce("_skipped", F.lit(0))).alias("urls_skipped"))


def links_of(frontier: DataFrame, graph: DataFrame) -> DataFrame:
    """Links of the frontier pages; the bucketed graph stays where it is."""
    return frontier.join(graph, ["src_url", "salt"])


def processed(results: DataFrame) -> DataFrame:
    """Pages processed per domain, failed ones included."""
    return results.groupBy("domain").agg(F.count(F.lit(1)).alias("processed"))


def product_ratio(url_table: DataFrame) -> DataFrame:
    product = F.coalesce(F.col("type") == "product", F.lit(False))
    return url_table.groupBy("domain").agg(
        F.count_if(product).alias("products"), F.count_if(~product).alias("others"),
        F.avg(product.cast("double")).alias("product_ratio"))
