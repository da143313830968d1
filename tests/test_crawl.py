import random

from pyspark.sql import functions as F

from shopflow.operators import crawl as C


def by_hand(seeds, edges, ok, max_depth, max_pages):
    out = []
    for domain, start in seeds:
        seen, level, count, done = {start}, [(start, None)], 0, False
        for depth in range(max_depth + 1):
            following = []
            for url, parent in level:
                success = ok.get(url, False)
                out.append((domain, url, depth, parent, success))
                if success:
                    count += 1
                    if count >= max_pages:
                        done = True
                        break
                    for _, dst in sorted(edges.get(url, [])):
                        if dst not in seen:
                            seen.add(dst)
                            following.append((dst, url))
            if done or not following:
                break
            level = following
    return sorted(out, key=str)


def run(spark, seeds, edges, ok, max_depth=5, max_pages=10 ** 6, **gates):
    e = [(s, d, "internal", o) for s, links in edges.items() for o, d in links]
    found = C.bfs(spark.createDataFrame(seeds, "domain string, url string"), spark.createDataFrame(e, "src_url string, dst_url string, kind string, ord int"),
                  spark.createDataFrame(list(ok.items()), "url string, success boolean"), max_depth, max_pages, **gates)
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_tree_and_cycle(spark):
    tree = {"root": [(0, "p1"), (1, "p2")], "p1": [(0, "p3")], "p2": [(0, "p4")]}
    ok = {u: True for u in ["root", "p1", "p2", "p3", "p4"]}
    assert {(u, d) for _, u, d, _, _ in run(spark, [("d", "root")], tree, ok, 2)} == {("root", 0), ("p1", 1), ("p2", 1), ("p3", 2), ("p4", 2)}
    cycle = {"root": [(0, "p1")], "p1": [(0, "root"), (1, "p2")], "p2": [(0, "root"), (1, "p1")]}
    assert {(u, d) for _, u, d, _, _ in run(spark, [("d", "root")], cycle, ok, 3)} == {("root", 0), ("p1", 1), ("p2", 2)}


def test_long_chain_is_walked_to_its_end(spark):
    chain = {f"p{i}": [(0, f"p{i + 1}")] for i in range(60)}
    found = run(spark, [("d", "p0")], chain, {f"p{i}": True for i in range(61)}, None, None)
    assert {(r[1], r[2]) for r in found} == {(f"p{i}", i) for i in range(61)}


def test_random_graphs_with_budget(spark):
    rng = random.Random(7)
    nodes = [f"n{i}" for i in range(40)]
    for max_pages in (10 ** 6, 9):
        edges = {n: [(o, rng.choice(nodes)) for o in range(rng.randint(0, 4))] for n in nodes}
        ok = {n: rng.random() < 0.8 for n in nodes if rng.random() < 0.9}
        seeds = [("a", "n0"), ("b", "n1"), ("c", "n2")]
        assert run(spark, seeds, edges, ok, 4, max_pages) == by_hand(seeds, edges, ok, 4, max_pages)


def test_gates(spark):
    edges = {"https://a/": [(0, "https://a/x.pdf"), (1, "https://a/cart"), (2, "https://a/y")]}
    ok = {"https://a/": True, "https://a/y": True, "https://a/cart": True}
    assert [r[1] for r in run(spark, [("d", "https://a/")], edges, ok)] == ["https://a/", "https://a/y"]
    level = spark.createDataFrame([("d", "https://a/", 0, True)], "domain string, url string, depth int, success boolean")
    e = spark.createDataFrame([("https://a/", d, "internal", o) for o, d in edges["https://a/"]] + [("https://a/", "https://b/", "external", 3)],
                              "src_url string, dst_url string, kind string, ord int")
    children, skipped = C.discover_links(level, e, level)
    assert [tuple(r) for r in children.collect()] == [("d", "https://a/y", 1, "https://a/")]
    assert [tuple(r) for r in skipped.collect()] == [("d", 2)]
    outside, _ = C.discover_links(level, e, level, include_external=True)
    assert {r.url for r in outside.collect()} == {"https://a/y", "https://b/"}


def test_crawl_job(spark):
    from shopflow.plans import jobs

    shops = spark.createDataFrame([("a.de", "NEVER#"), ("b.de", "NEVER#")], "domain string, last_crawled_end string").withColumn(
        "last_crawled_start", F.lit(None).cast("string"))
    bodies = spark.createDataFrame([('{"domain": "https://a.de/"}',), ('{"domain": "b.de"}',), ("junk",)], "body string")
    pages = spark.createDataFrame([("https://a.de", '<a href="/p/1">x</a><a href="/login">l</a>', True, False), ("https://a.de/p/1", "", True, True),
                                   ("https://b.de", "", True, False)], "url string, html string, success boolean, is_product boolean")
    table = spark.createDataFrame([("a.de", "https://a.de/p/1", None, "h")], "domain string, url string, type string, hash string")
    out = jobs.crawl_shops(shops, bodies, pages, table, "T")
    assert {(r.domain, r.url, r.type, r.hash) for r in out["urls"].collect()} == {
        ("a.de", "https://a.de/p/1", "product", None), ("a.de", "https://a.de", None, None), ("b.de", "https://b.de", None, None)}
    assert {r.domain: r.last_crawled_end for r in out["shops"].collect()} == {"a.de": "DONE#T", "b.de": "PROGRESS#T"}
    assert out["rejects"].count() == 1
    kept = jobs.crawl_shops(shops, bodies, pages, table, "T", keep_hash=True)["urls"]
    assert kept.where("url = 'https://a.de/p/1'").first().hash == "h"


def test_walk_carries_counters(spark):
    edges = [("a0", f"https://a/{n}", "internal", i) for i, n in enumerate(["x.pdf", "x.pdf", "cart", "1", "2"])] + [
        ("https://a/1", "https://a/y.jpg", "internal", 0), ("https://a/1", "https://a/2", "internal", 1), ("https://a/2", "https://a/z.zip", "internal", 0), ("b0", "https://b/1", "internal", 0)]
    pages = [(u, u != "https://a/2") for u in ("a0", "b0", "https://a/1", "https://a/2")]
    seeds = spark.createDataFrame([("a", "a0"), ("b", "b0")], "domain string, url string")
    e, p = spark.createDataFrame(edges, "src_url string, dst_url string, kind string, ord int"), spark.createDataFrame(pages, "url string, success boolean")
    found, counters = C.walk(seeds, e, p)
    assert {(r.domain, r.spent, r.urls_skipped) for r in counters.collect()} == {("a", 2, 4), ("b", 1, 0)}
    assert {(r.url, r.depth) for r in found.collect()} == {("a0", 0), ("b0", 0), ("https://a/1", 1), ("https://a/2", 1), ("https://b/1", 1)}
    # pages at the last depth are not expanded, so their links are not skipped
    assert {(r.domain, r.urls_skipped) for r in C.walk(seeds, e, p, max_depth=1)[1].collect()} == {("a", 3), ("b", 0)}


def test_level_does_not_move_visited_keys(spark):
    from shopflow.runtime import growing

    def physical(df):
        return df._jdf.queryExecution().executedPlan().toString()

    links = spark.range(40).select(F.concat(F.lit("d"), (F.col("id") % 1).cast("string")).alias("domain"), (F.col("id") % 20).cast("string").alias("dst_url"), F.lit(True).alias("allowed"), F.lit(0).alias("ord"),
                                   F.lit(True).alias("success"), F.lit("p").alias("src_url"), F.lit("").alias("walk"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        with growing(spark, ["domain", "url"], "v") as visited:
            for part in range(3):
                visited.add(spark.createDataFrame([("d0", str(part * 5 + i)) for i in range(5)], "domain string, url string"))
            met = C.met_targets(links, visited.rows())
            assert physical(met).count("Exchange") == 1 and sorted(int(r.url) for r in met.collect()) == [15, 16, 17, 18, 19]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_filters_and_status_are_asked_once_a_target(spark, monkeypatch):
    """Many links to few targets: the stored graph holds links only."""
    stored, plain = {}, C.bucketed
    monkeypatch.setattr(C, "bucketed", lambda df, keys, name, buckets=None: stored.setdefault(name, df.columns) and plain(df, keys, name, buckets))
    edges = {f"n{i}": [(o, f"n{o}") for o in range(6)] + [(9, "n0.pdf")] for i in range(6)}
    found = run(spark, [("d", "n0")], edges, {f"n{i}": i != 4 for i in range(6)} | {"n0.pdf": True})
    assert [(r[1], r[2], r[4]) for r in found] == [("n0", 0, True), ("n1", 1, True), ("n2", 1, True), ("n3", 1, True), ("n4", 1, False), ("n5", 1, True)]
    assert set(stored["graph"]) == {"src_url", "dst_url", "ord", "salt"} and set(stored["status"]) == {"url", "success"}
