from __future__ import annotations

from pyspark.sql import functions as F

from catalog_queries.registry import query
from shopflow.functions import urls as U
from shopflow.operators import boilerplate, classify, crawl, pages as P
from shopflow.operators.skew import number_rows
from shopflow.plans import jobs
from shopflow.runtime import cut
from shopflow.sources import store

URI = r"^(?:([^:/?#]+):)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?"
NORM = rf"""lower(regexp_extract(url, '{URI}', 1)) || ':' || lower(regexp_extract(url, '{URI}', 2)) ||
  regexp_replace(regexp_extract(url, '{URI}', 3), '/+$', '') ||
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_extract(url, '{URI}', 4), '([?&])utm_[^&]*', '\1', 'gi'), '&{{2,}}', '&', 'g'), '^\?&', '?'), '[?&]$', '')"""


@query(f"SELECT page_id, {NORM} AS norm FROM pages")
def url_normalize(read):
    return read("pages").select("page_id", U.normalize_url(F.col("url")).alias("norm"))


@query(r"""SELECT page_id, regexp_replace(regexp_extract(lower(url), '^[a-z]+://([^/?#:]*)', 1), '^www\.', '') AS domain,
  regexp_extract(lower(url), '^[a-z]+://([^/?#:]*)', 1) AS host FROM pages""")
def domain_normalize(read):
    return read("pages").select("page_id", U.normalize_domain(F.col("url")).alias("domain"), U.host(F.col("url")).alias("host"))


@query(r"""SELECT page_id, regexp_extract(url, '^[^:]+://[^/?#]*([^?#]*)', 1) LIKE '%.html' AS by_extension,
  lower(url) LIKE '%utm\_%' ESCAPE '\' OR regexp_matches(lower(url), '^https?://[^/]*/[de]./.*$') AS by_pattern FROM pages""")
def url_excluded(read):
    url = F.col("url")
    return read("pages").select("page_id", U.has_extension(url, [".HTML"]).alias("by_extension"),
                                U.matches_wildcard(url, ["*utm_*", "http*://*.example.???/[de]?/*"]).alias("by_pattern"))


@query(r"""WITH raw AS (SELECT page_id, unnest(list_concat([url, 'mailto:' || page_id || '@shop.example'], regexp_extract_all(html, '(?is)\b(?:href|src)\s*=\s*["'']([^"'']*)["'']', 1))) AS href FROM pages)
SELECT page_id, href, count(*) AS n FROM raw WHERE href <> '' AND (regexp_matches(lower(href), '^https?:') OR NOT regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:')) GROUP BY ALL""")
def http_links(read):
    """All targets that a page names, its own address and a mail address among them."""
    own = F.array("url", F.concat(F.lit("mailto:"), F.col("page_id").cast("string"), F.lit("@shop.example")))
    named = F.regexp_extract_all("html", F.lit(r"""(?is)\b(?:href|src)\s*=\s*["']([^"']*)["']"""), 1)
    rows = read.spread("pages").select("page_id", F.explode(F.concat(own, named)).alias("href"))
    return P.http_only(rows).groupBy("page_id", "href").agg(F.count(F.lit(1)).alias("n"))


LINKS_SQL = rf"""raw AS (SELECT {NORM} AS src_url, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?\bhref\s*=\s*["'']([^"'']*)["'']', 1)) AS href,
    generate_subscripts(regexp_extract_all(html, '(?is)<a\s[^>]*?\bhref\s*=\s*["'']([^"'']*)["'']', 1), 1) - 1 AS ord FROM given),
abs AS (SELECT src_url, ord, CASE WHEN href LIKE '/%' THEN regexp_extract(src_url, '^([a-z]+://[^/?#]*)', 1) || href ELSE href END AS url
  FROM (SELECT src_url, ord, replace(trim(href), '&amp;', '&') AS href FROM raw)
  WHERE regexp_matches(href, '^(https?:|/)')),
norm AS (SELECT src_url, ord, {NORM} AS dst_url FROM abs),
links AS (SELECT src_url, dst_url, CASE WHEN regexp_replace(regexp_extract(src_url, '//([^/?#:]*)', 1), '^www\.', '') =
  regexp_replace(regexp_extract(dst_url, '//([^/?#:]*)', 1), '^www\.', '') THEN 'internal' ELSE 'external' END AS kind,
  CAST(ord AS BIGINT) AS ord FROM norm)"""


@query(f"WITH given AS (SELECT * FROM pages), {LINKS_SQL} SELECT * FROM links")
def link_edges(read):
    return P.extract_links(read.spread("pages")).withColumn("ord", F.col("ord").cast("long"))


def _graph(read):
    """Parts and suppliers link to each other where a line item ties them; every tenth page is missing."""
    def part(c):
        return F.concat(F.lit("https://shop.example/part/"), c.cast("string"))

    def supp(c):
        return F.concat(F.lit("https://shop.example/supp/"), c.cast("string"))

    ties = read("lineitem").select("l_partkey", "l_suppkey").distinct()
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    edges = (ties.select(part(p).alias("src_url"), supp(s).alias("dst_url"), s.cast("int").alias("ord"))
             .unionByName(ties.select(supp(s).alias("src_url"), part(p).alias("dst_url"), p.cast("int").alias("ord")))
             .withColumn("kind", F.lit("internal")))
    pages = (read("part").select(part(F.col("p_partkey")).alias("url"), (F.col("p_partkey") % 10 != 3).alias("success"))
             .unionByName(read("supplier").select(supp(F.col("s_suppkey")).alias("url"), (F.col("s_suppkey") % 10 != 3).alias("success"))))
    first = read("supplier").agg(F.min("s_suppkey").alias("s"))
    seeds = first.select(F.lit("shop.example").alias("domain"), supp(F.col("s")).alias("url"))
    return seeds, edges, pages


GRAPH_SQL = """
ties AS (SELECT DISTINCT 'https://shop.example/part/' || l_partkey AS p, 'https://shop.example/supp/' || l_suppkey AS s, l_partkey, l_suppkey FROM lineitem),
edges AS (SELECT p AS src, s AS dst, printf('%08X', CAST(l_suppkey AS INTEGER)) AS o FROM ties
          UNION ALL SELECT s, p, printf('%08X', CAST(l_partkey AS INTEGER)) FROM ties),
ok AS (SELECT 'https://shop.example/part/' || p_partkey AS url, p_partkey % 10 <> 3 AS success FROM part
       UNION ALL SELECT 'https://shop.example/supp/' || s_suppkey, s_suppkey % 10 <> 3 FROM supplier),
reached(url, depth, parent, walk, success) USING KEY (url) AS (SELECT 'https://shop.example/supp/' || min(s_suppkey) AS url, 0 AS depth, CAST(NULL AS VARCHAR) AS parent, '' AS walk, true AS success FROM supplier
  UNION ALL
  SELECT dst, depth + 1, parent, walk, success FROM (
    SELECT edges.dst, reached.depth, arg_min(reached.url, reached.walk || o) AS parent, min(reached.walk || o) AS walk, coalesce(any_value(ok.success), false) AS success
    FROM reached JOIN edges ON reached.url = edges.src LEFT JOIN ok ON ok.url = edges.dst
    WHERE reached.success AND edges.dst NOT IN (SELECT url FROM recurring.reached) GROUP BY edges.dst, reached.depth)),
walked AS (SELECT * FROM reached)
"""


@query(f"WITH RECURSIVE {GRAPH_SQL} SELECT 'shop.example' AS domain, url, CAST(depth AS BIGINT) AS depth, parent AS parent_url, success FROM walked")
def bfs_levels(read):
    seeds, edges, pages = _graph(read)
    return crawl.bfs(seeds, edges, pages).withColumn("depth", F.col("depth").cast("long"))


@query(f"""WITH RECURSIVE {GRAPH_SQL}, n AS (SELECT *, coalesce(sum(CASE WHEN success THEN 1 ELSE 0 END) OVER (ORDER BY depth, walk
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM walked)
SELECT 'shop.example' AS domain, url, CAST(depth AS BIGINT) AS depth, success FROM n WHERE before < 40""")
def bfs_budget(read):
    """The walk ends at 40 successful pages."""
    seeds, edges, pages = _graph(read)
    return crawl.bfs(seeds, edges, pages, max_pages=40).select(
        "domain", "url", F.col("depth").cast("long").alias("depth"), "success")


GATED_SQL = GRAPH_SQL.replace("WHERE reached.success AND", "WHERE reached.success AND edges.dst NOT LIKE '%/part/%7' AND")


@query(f"""WITH RECURSIVE {GATED_SQL}
SELECT 'shop.example' AS domain, (SELECT count(*) FROM walked WHERE success) AS spent,
  (SELECT count(*) FROM walked JOIN edges ON url = src WHERE success AND dst LIKE '%/part/%7') AS urls_skipped""")
def walk_counters(read):
    """Successful pages and skipped links of a walk that leaves out the parts whose number ends in 7."""
    seeds, edges, pages = _graph(read)
    return crawl.walk(seeds, edges, pages, extensions=[], patterns=["*/part/*7"])[1]


@query("""WITH e AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)
SELECT 'shop.example' AS domain, count(*) AS processed FROM (SELECT DISTINCT l_partkey FROM e)""")
def processed_pages(read):
    parts = read("lineitem").select(F.lit("shop.example").alias("domain"), "l_partkey").distinct()
    return crawl.processed(parts)


@query("""SELECT 'part' || (p_size % 7) AS domain, count(*) FILTER (WHERE p_type = 'ECONOMY') AS products,
  count(*) FILTER (WHERE p_type <> 'ECONOMY') AS others, round(avg(CASE WHEN p_type = 'ECONOMY' THEN 1.0 ELSE 0.0 END), 6) AS product_ratio
FROM part GROUP BY 1""")
def product_ratio(read):
    rows = read("part").select(F.concat(F.lit("part"), (F.col("p_size") % 7).cast("string")).alias("domain"),
                               F.when(F.col("p_type") == "ECONOMY", F.lit("product")).alias("type"))
    return crawl.product_ratio(rows).withColumn("product_ratio", F.round("product_ratio", 6))


@query("""SELECT 'd' AS domain, CAST(doc_id AS VARCHAR) AS url, doc_id % 4 <> 0 AND doc_id % 5 <> 0 AS success,
  CASE WHEN doc_id % 4 = 0 THEN 'NOT_FOUND' WHEN doc_id % 5 = 0 THEN 'TIMEOUT' END AS error FROM documents""")
def fetch_pages(read):
    k = F.col("doc_id")
    rows = read("documents").select(k, F.lit("d").alias("domain"), k.cast("string").alias("url"), "text")
    stored = rows.where(k % 4 != 0).select("domain", "url", F.col("text").alias("markdown"), (k % 5 != 0).alias("success"),
                                           F.when(k % 5 == 0, F.lit("TIMEOUT")).alias("error"))
    return store.fetch(rows.select("domain", "url"), stored).select("domain", "url", "success", "error")


URLS_SQL = """current AS (SELECT source AS domain, CAST(doc_id AS VARCHAR) AS url, CASE WHEN doc_id % 2 = 0 THEN 'product' END AS type,
    CASE WHEN doc_id % 3 <> 0 THEN sha256(text) END AS hash FROM documents WHERE doc_id % 5 <> 0),
puts AS (SELECT source AS domain, CAST(doc_id AS VARCHAR) AS url, 'product' AS type, NULL AS hash, doc_id AS ord FROM documents WHERE doc_id % 4 = 0
  UNION ALL SELECT source, CAST(doc_id AS VARCHAR), NULL, lang, doc_id + 1000000 FROM documents WHERE doc_id % 8 = 0),
last AS (SELECT * FROM puts QUALIFY row_number() OVER (PARTITION BY domain, url ORDER BY ord DESC) = 1)"""


def _urls(read):
    k = F.col("doc_id")
    docs = read("documents").select(k, F.col("source").alias("domain"), k.cast("string").alias("url"), "text", "lang")
    current = docs.where(k % 5 != 0).select("domain", "url", F.when(k % 2 == 0, F.lit("product")).alias("type"),
                                            F.when(k % 3 != 0, F.sha2("text", 256)).alias("hash"))
    puts = (docs.where(k % 4 == 0).select("domain", "url", F.lit("product").alias("type"), F.lit(None).cast("string").alias("hash"), k.alias("ord"))
            .unionByName(docs.where(k % 8 == 0).select("domain", "url", F.lit(None).cast("string").alias("type"), F.col("lang").alias("hash"),
                                                       (k + 1000000).alias("ord"))))
    return current, puts


@query(f"""WITH {URLS_SQL} SELECT coalesce(c.domain, l.domain) AS domain, coalesce(c.url, l.url) AS url,
  CASE WHEN l.url IS NOT NULL THEN l.type ELSE c.type END AS type, CASE WHEN l.url IS NOT NULL THEN l.hash ELSE c.hash END AS hash
FROM current c FULL JOIN last l ON c.domain = l.domain AND c.url = l.url""")
def url_upsert(read):
    return store.upsert_urls(*_urls(read))


@query(f"""WITH {URLS_SQL} SELECT coalesce(c.domain, l.domain) AS domain, coalesce(c.url, l.url) AS url, coalesce(l.hash, c.hash) AS hash
FROM current c FULL JOIN last l ON c.domain = l.domain AND c.url = l.url""")
def url_upsert_keep_hash(read):
    return store.upsert_urls(*_urls(read), keep_hash=True).select("domain", "url", "hash")


@query("SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def last_wins(read):
    from shopflow.operators.skew import dedupe_last

    return dedupe_last(read("events").select("user_id", "event_type", "ts", "event_id"), ["user_id", "event_type"],
                       ["ts", "event_id"]).drop("ts")


LABEL_SQL = "NOT (url LIKE '%?%' OR url LIKE '%.html%')"


@query(f"""SELECT page_id, {LABEL_SQL} AS is_product, CASE WHEN {LABEL_SQL} THEN 'product' END AS type FROM pages
WHERE length(regexp_extract(lower(url), '^[a-z]+://([^/?#:]*)', 1)) % 2 = 1""")
def classify_urls(read):
    """Trained on the hosts with names of even length, applied to the others. Products by rule: no parameter and no suffix."""
    url = F.col("url")
    marked = read("pages").select("page_id", "url", (~(url.contains("?") | url.contains(".html"))).alias("is_product"), (F.length(U.host(url)) % 2).alias("half"))
    model = classify.train_url_model(marked.where("half = 0"))
    return classify.classify_urls(marked.where("half = 1").select("page_id", "url"), model).select("page_id", "is_product", "type")


@query(rf"""WITH RECURSIVE own AS (SELECT regexp_extract(lower(url), '^[a-z]+://([^/?#:]*)', 1) AS domain, {NORM} AS url, min(page_id) AS page FROM pages GROUP BY 1, 2),
nodes AS (SELECT domain, url, row_number() OVER (PARTITION BY domain ORDER BY page, url) AS k FROM own UNION ALL SELECT DISTINCT domain, 'https://' || domain, 0 FROM own),
given AS (SELECT * FROM pages SEMI JOIN own ON page = page_id), {LINKS_SQL},
edges AS (SELECT src_url AS src, dst_url AS dst, printf('%08X', ord) AS o FROM links WHERE kind = 'internal'
  UNION ALL SELECT p.url, c.url, printf('%08X', 1000000 + c.k) FROM nodes p JOIN nodes c ON c.domain = p.domain AND c.k > 0 AND (c.k - 1) // 2 = p.k),
reached(domain, url, depth, parent, walk, success) USING KEY (domain, url) AS (SELECT DISTINCT domain, 'https://' || domain, 0, CAST(NULL AS VARCHAR), '', true FROM own
  UNION ALL
  SELECT domain, dst, depth + 1, parent, walk, dst IN (SELECT url FROM nodes) FROM (
    SELECT reached.domain, edges.dst, reached.depth, arg_min(reached.url, reached.walk || o) AS parent, min(reached.walk || o) AS walk
    FROM reached JOIN edges ON reached.url = edges.src
    WHERE reached.success AND reached.domain || ' ' || edges.dst NOT IN (SELECT domain || ' ' || url FROM recurring.reached) GROUP BY ALL))
SELECT domain, url, CAST(depth AS BIGINT) AS depth, parent AS parent_url, success FROM reached""")
def crawl_job(read):
    """Walk the links of all given pages; each page also leads to two more of its host, the front page to the first two."""
    host, url = U.host(F.col("url")), U.normalize_url(F.col("url"))
    own = read.spread("pages").groupBy(host.alias("domain"), url.alias("url")).agg(F.min("page_id").alias("page"), F.min_by("html", "page_id").alias("html"))
    hosts = own.select("domain").distinct()
    front = hosts.select("domain", F.concat(F.lit("https://"), F.col("domain")).alias("url"), F.lit("").alias("html"), F.lit(-1).cast("long").alias("page"), F.lit(0).cast("long").alias("k"))
    nodes = cut(number_rows(own, ["domain"], ["page", "url"], "k").unionByName(front))
    two = (nodes.where("k > 0").select("domain", F.floor((F.col("k") - 1) / 2).cast("long").alias("k"), F.struct("k", "url").alias("child"))
           .groupBy("domain", "k").agg(F.array_sort(F.collect_list("child")).alias("children")))
    links = F.array_join(F.transform(F.coalesce("children", F.array()), lambda c: F.concat(F.lit('<a href="'), c["url"], F.lit('">next</a>'))), "")
    stored = nodes.join(two, ["domain", "k"], "left").select("url", F.concat("html", links).alias("html"), F.lit(True).alias("success"), (F.col("page") % 2 == 0).alias("is_product"))
    bodies = hosts.select(F.to_json(F.struct("domain")).alias("body"))
    shops = hosts.select("domain", *[F.lit(None).cast("string").alias(c) for c in (
        "core_domain_name", "shop_name", "shop_image", "shop_type", "shop_country", "last_crawled_start", "last_crawled_end",
        "last_scraped_start", "last_scraped_end")])
    table = shops.select("domain", F.lit("").alias("url"), F.lit(None).cast("string").alias("type"),
                         F.lit(None).cast("string").alias("hash")).limit(0)
    out = jobs.crawl_shops(shops, bodies, stored, table, "2026-01-01T00:00:00Z", extensions=[], patterns=[])
    return out["results"].select("domain", "url", F.col("depth").cast("long").alias("depth"), "parent_url", "success")


@query("""SELECT DISTINCT source AS domain FROM documents WHERE source LIKE 'src1%'""")
def list_domains(read):
    return store.list_domains(read("documents").withColumnRenamed("source", "domain"), "src1")
