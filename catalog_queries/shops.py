from __future__ import annotations

from pyspark.sql import functions as F

from catalog_queries.registry import query
from catalog_queries.tables import DUCK_ISO, ISO, OUTCOME_SQL, SHOPS_SQL, outcome_column, shops
from shopflow.functions import states as St
from shopflow.operators import scrape, shops as S
from shopflow.operators.skew import with_batch
from shopflow.plans import jobs
from shopflow.sources import items, messages, store

CUTOFF = "1999-06-01T00:00:00Z"


@query(f"""WITH {SHOPS_SQL} SELECT domain, split_part(last_crawled_end, '#', 1) || '#' AS state,
  CASE WHEN last_crawled_end NOT LIKE 'NEVER%' THEN split_part(last_crawled_end, '#', 2) END AS ts FROM shops WHERE last_crawled_end IS NOT NULL""")
def state_parse(read):
    parsed = shops(read).where(F.col("last_crawled_end").isNotNull()).select("domain", St.parse_state(F.col("last_crawled_end")).alias("p"))
    return parsed.select("domain", "p.state", "p.ts")


@query(f"""WITH {SHOPS_SQL} SELECT domain, v, regexp_full_match(v, 'NEVER#|PROGRESS#.+|DONE#.+') AS valid FROM (
  SELECT domain, CASE s_suppkey % 5 WHEN 0 THEN 'NEVER#' WHEN 1 THEN 'DONE#' WHEN 2 THEN 'NEVER#x' WHEN 3 THEN last_scraped_end ELSE shop_name END AS v FROM shops)""")
def state_valid(read):
    k = F.col("s_suppkey") % 5
    v = (F.when(k == 0, F.lit("NEVER#")).when(k == 1, F.lit("DONE#")).when(k == 2, F.lit("NEVER#x"))
         .when(k == 3, F.col("last_scraped_end")).otherwise(F.col("shop_name")))
    return shops(read).select("domain", v.alias("v")).withColumn("valid", St.is_valid_state(F.col("v")))


for _op, _col in (("crawl", "last_crawled_end"), ("scrape", "last_scraped_end")):
    @query(f"""WITH {SHOPS_SQL} SELECT domain FROM shops WHERE shop_country = 'COUNTRY#NATION_3'
  AND (coalesce({_col}, 'NEVER#') = 'NEVER#' OR {_col} BETWEEN 'DONE#' AND 'DONE#{CUTOFF}')""", name=f"candidates_{_op}")
    def _candidates(read, op=_op):
        return S.candidates(shops(read), op, CUTOFF, "NATION_3").select("domain")

    @query(f"""WITH {SHOPS_SQL} SELECT domain FROM shops WHERE {_col} BETWEEN 'PROGRESS#' AND 'PROGRESS#{CUTOFF}'""", name=f"stuck_{_op}")
    def _stuck(read, op=_op):
        return S.stuck(shops(read), op, CUTOFF).select("domain")

    @query(f"""WITH {SHOPS_SQL} SELECT domain, '2026-01-01T00:00:00Z' AS started,
      CASE WHEN s_suppkey % 3 = 0 THEN CASE WHEN s_suppkey % 4 > {1 if _op == 'crawl' else 0} THEN 'DONE#' ELSE 'PROGRESS#' END || '2026-01-01T00:00:00Z'
        ELSE {_col} END AS finished FROM shops WHERE s_suppkey % 3 = 0
      UNION ALL SELECT domain, NULL, {_col} FROM shops WHERE s_suppkey % 3 <> 0""", name=f"transitions_{_op}")
    def _transitions(read, op=_op, col=_col):
        table = shops(read).withColumn(col.replace("_end", "_start"), F.lit(None).cast("string"))
        due = table.where(F.col("s_suppkey") % 3 == 0)
        started = store.mark_started(table, due, op, "2026-01-01T00:00:00Z")
        counts = due.select("domain", (F.col("s_suppkey") % 4).alias("processed"))
        done = store.mark_done(started, counts, op, "2026-01-01T00:00:00Z")
        return done.select("domain", F.col(col.replace("_end", "_start")).alias("started"), F.col(col).alias("finished"))


REASON_SQL = """CASE WHEN last_scraped_end LIKE 'PROGRESS#%' THEN 'in_progress'
  WHEN last_crawled_end LIKE 'DONE#%' AND (last_scraped_end LIKE 'NEVER#%' OR (last_scraped_end LIKE 'DONE#%'
    AND last_scraped_end < last_crawled_end)) THEN 'eligible'
  WHEN last_crawled_end IS NULL OR last_crawled_end = 'NEVER#' THEN 'crawl_not_finished' ELSE 'already_scraped' END"""


@query(f"WITH {SHOPS_SQL} SELECT domain FROM shops WHERE {REASON_SQL} = 'eligible'")
def eligible_scrape(read):
    return S.scrape_eligible(shops(read)).select("domain")


@query(f"""WITH {SHOPS_SQL}, r AS (SELECT {REASON_SQL} AS reason FROM shops)
SELECT count(*) AS total_queried, count(*) FILTER (WHERE reason = 'in_progress') AS in_progress,
  count(*) FILTER (WHERE reason = 'crawl_not_finished') AS crawl_not_finished, count(*) FILTER (WHERE reason = 'already_scraped') AS already_scraped,
  count(*) FILTER (WHERE reason = 'eligible') AS eligible, round((count(*) - count(*) FILTER (WHERE reason = 'eligible')) / count(*) * 100, 6) AS filter_rate FROM r""")
def scrape_stats(read):
    return S.scrape_stats(shops(read)).withColumn("filter_rate", F.round("filter_rate", 6))


@query(f"""WITH {SHOPS_SQL} SELECT count(*) AS total_queried, count(*) FILTER (WHERE last_crawled_end LIKE 'PROGRESS#%') AS in_progress,
  count(*) FILTER (WHERE coalesce(last_crawled_end, '') NOT LIKE 'PROGRESS#%') AS eligible,
  round(count(*) FILTER (WHERE last_crawled_end LIKE 'PROGRESS#%') / count(*) * 100, 6) AS filter_rate FROM shops""")
def crawl_stats(read):
    return S.crawl_stats(shops(read)).withColumn("filter_rate", F.round("filter_rate", 6))


@query(f"""WITH {SHOPS_SQL}, due AS (SELECT domain FROM shops WHERE shop_country = 'COUNTRY#NATION_3'
    AND (last_scraped_end = 'NEVER#' OR last_scraped_end BETWEEN 'DONE#' AND 'DONE#{CUTOFF}') AND {REASON_SQL} = 'eligible')
SELECT '{{"domain":"' || domain || '"}}' AS body, CAST((row_number() OVER (ORDER BY domain) - 1) // 10 AS BIGINT) AS batch_no FROM due""")
def orchestrate_scrape(read):
    out = jobs.orchestrate(shops(read), "scrape", "NATION_3", CUTOFF)
    return out["messages"].select("body", "batch_no")


BUYERS_SQL = f"""
span AS (SELECT o_custkey, strftime(min(o_orderdate), '{DUCK_ISO}') AS lo, strftime(max(o_orderdate), '{DUCK_ISO}') AS hi FROM orders GROUP BY o_custkey),
buyers AS (SELECT 'buyer' || c_custkey || '.example.com' AS domain, c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'COUNTRY#NATION_3' ELSE 'COUNTRY#' || n_name END AS shop_country,
  CASE WHEN c_custkey % 5 = 0 THEN 'NEVER#' WHEN c_custkey % 7 = 1 THEN 'PROGRESS#' || lo WHEN c_custkey % 3 = 0 THEN 'DONE#' || lo ELSE 'DONE#' || hi END AS last_crawled_end,
  CASE WHEN c_custkey % 4 = 0 THEN 'NEVER#' WHEN c_custkey % 11 = 1 THEN 'PROGRESS#' || hi ELSE 'DONE#' || lo END AS last_scraped_end
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN span ON o_custkey = c_custkey)"""


def _buyers(read):
    """A shop per customer with orders: half of them in one country, states from the first and last order."""
    span = read("orders").groupBy("o_custkey").agg(F.date_format(F.min("o_orderdate"), ISO).alias("lo"), F.date_format(F.max("o_orderdate"), ISO).alias("hi"))
    k = F.col("c_custkey")
    done_lo, done_hi = F.concat(F.lit("DONE#"), "lo"), F.concat(F.lit("DONE#"), "hi")
    return (read("customer").join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(span, k == F.col("o_custkey")).select(
        F.concat(F.lit("buyer"), k.cast("string"), F.lit(".example.com")).alias("domain"), k,
        F.when(k % 2 == 0, "COUNTRY#NATION_3").otherwise(F.concat(F.lit("COUNTRY#"), "n_name")).alias("shop_country"),
        F.when(k % 5 == 0, F.lit("NEVER#")).when(k % 7 == 1, F.concat(F.lit("PROGRESS#"), "lo")).when(k % 3 == 0, done_lo).otherwise(done_hi).alias("last_crawled_end"),
        F.when(k % 4 == 0, F.lit("NEVER#")).when(k % 11 == 1, F.concat(F.lit("PROGRESS#"), "hi")).otherwise(done_lo).alias("last_scraped_end")))


def _deliver(messages, attempt):
    """A queue that refuses every seventh shop once and every 21st always."""
    n = F.regexp_extract("domain", "^buyer([0-9]+)", 1).cast("long")
    return messages.withColumn("error", F.when(n % 21 == 0, "ServiceUnavailable").when((n % 7 == 0) & F.lit(attempt == 1), "ThrottlingException"))


SENT_SQL = """SELECT domain, '{"domain":"' || domain || '"}' AS body, CAST((row_number() OVER (ORDER BY domain) - 1) // 10 AS BIGINT) AS batch_no,
  CASE WHEN c_custkey % 7 = 0 THEN 2 ELSE 1 END AS attempt, CASE WHEN c_custkey % 21 = 0 THEN 'ServiceUnavailable' END AS error FROM due"""
DUE_CRAWL_SQL = f"""due AS (SELECT domain, c_custkey FROM buyers WHERE shop_country = 'COUNTRY#NATION_3' AND (last_crawled_end = 'NEVER#' OR last_crawled_end BETWEEN 'DONE#' AND 'DONE#{CUTOFF}'))"""


def _orchestrated(read, operation):
    from shopflow.runtime import scratch_path

    return jobs.orchestrate(_buyers(read), operation, "NATION_3", CUTOFF, path=scratch_path(read.spark, "queue"), deliver=_deliver)


@query(f"WITH {BUYERS_SQL}, {DUE_CRAWL_SQL} {SENT_SQL}")
def orchestrate_crawl(read):
    """The outcome of every message of a crawl run, refused ones tried twice."""
    return _orchestrated(read, "crawl")["outcomes"]


@query(f"""WITH {BUYERS_SQL}, due AS (SELECT domain, c_custkey FROM buyers WHERE shop_country = 'COUNTRY#NATION_3'
    AND (last_scraped_end = 'NEVER#' OR last_scraped_end BETWEEN 'DONE#' AND 'DONE#{CUTOFF}') AND {REASON_SQL} = 'eligible') {SENT_SQL}""")
def orchestrate_scrape_sent(read):
    return _orchestrated(read, "scrape")["outcomes"]


@query(f"""WITH {BUYERS_SQL}, {DUE_CRAWL_SQL} SELECT count(*) AS shops_found, count(*) FILTER (WHERE c_custkey % 21 <> 0) AS shops_enqueued,
  count(*) FILTER (WHERE c_custkey % 21 = 0) AS shops_failed, round(count(*) FILTER (WHERE c_custkey % 21 <> 0) / count(*) * 100, 6) AS success_rate FROM due""")
def orchestrate_crawl_summary(read):
    return _orchestrated(read, "crawl")["summary"].withColumn("success_rate", F.round("success_rate", 6))


@query("""SELECT event_id, CASE event_id % 5 WHEN 3 THEN '{"next": "x"}' ELSE 'no json' END AS body, 'INVALID_MESSAGE' AS error FROM events WHERE event_id % 5 IN (3, 4)""")
def message_rejects(read):
    """Messages that cannot be read, with the reason."""
    k = F.col("event_id") % 5
    body = F.when(k == 3, F.lit('{"next": "x"}')).when(k == 4, F.lit("no json")).otherwise(F.to_json(F.struct(F.col("user_id").cast("string").alias("domain"))))
    return messages.valid_messages(read("events").select("event_id", body.alias("body")))[1].select("event_id", "body", "error")


@query(f"""WITH {SHOPS_SQL} SELECT count(*) AS shops_found, count(*) FILTER (WHERE s_suppkey % 9 <> 0) AS shops_enqueued,
  count(*) FILTER (WHERE s_suppkey % 9 = 0) AS shops_failed, round(count(*) FILTER (WHERE s_suppkey % 9 <> 0) / count(*) * 100, 6) AS success_rate FROM shops""")
def orchestration_summary(read):
    sent = shops(read).withColumn("error", F.when(F.col("s_suppkey") % 9 == 0, F.lit("ServiceUnavailable")))
    return S.orchestration_summary(sent).withColumn("success_rate", F.round("success_rate", 6))


@query("""SELECT o_custkey, o_orderkey, CAST((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1) // 3 AS BIGINT) AS batch_no FROM orders""")
def batch_packing(read):
    rows = read("orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return with_batch(rows, 3, ["o_orderdate", "o_orderkey"], ["o_custkey"]).drop("o_orderdate")


@query("""SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 25 AS BIGINT) AS batch_no FROM orders""")
def batch_packing_global(read):
    """Batches over all rows, numbered without a single-task sort."""
    return with_batch(read("orders").select("o_orderkey", "o_orderdate"), 25, ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("""SELECT batch_no, count(*) AS n, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS keys FROM (
  SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 50 AS BIGINT) AS batch_no FROM orders) GROUP BY batch_no""")
def publish_batches(read):
    packed = store.publish(read("orders").select("o_orderkey", "o_custkey"), 50, ["o_orderkey"])
    return packed.select("batch_no", F.size("items").cast("long").alias("n"),
                         F.array_join(F.transform("items", lambda x: x["o_orderkey"].cast("string")), ",").alias("keys"))


@query("""SELECT event_id, CASE event_id % 5 WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE 'shop' || user_id || '.example.com' END AS domain,
  CASE event_id % 5 WHEN 2 THEN 'n' || event_id END AS next,
  CASE event_id % 5 WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE 'https://shop' || user_id || '.example.com' END AS start_url FROM events""")
def parse_messages(read):
    k, d = F.col("event_id") % 5, F.concat(F.lit("shop"), F.col("user_id").cast("string"), F.lit(".example.com"))
    body = (F.when(k == 0, F.concat(F.lit('{"domain": "https://'), d, F.lit('/"}'))).when(k == 1, F.concat(F.lit('{"domain": "http://'), d, F.lit('"}')))
            .when(k == 2, F.concat(F.lit('{"domain": "'), d, F.lit('", "next": "n'), F.col("event_id").cast("string"), F.lit('"}')))
            .when(k == 3, F.lit('{"next": "x"}')).otherwise(F.lit("no json")))
    return messages.parse_messages(read("events").select("event_id", body.alias("body"))).drop("body")


@query(f"""WITH {SHOPS_SQL} SELECT domain, 'example' AS core_domain_name, shop_name, shop_country,
  coalesce(last_crawled_end, 'NEVER#') AS last_crawled_end, last_scraped_end FROM shops""")
def item_roundtrip(read):
    """Shops to items with index keys and back; a missing crawl state returns from the index key."""
    rows = shops(read).withColumns({"core_domain_name": F.lit("example"), "shop_type": F.lit("MARKETPLACE"), **{
        c: F.lit(None).cast("string") for c in ("shop_image", "last_crawled_start", "last_scraped_start")}})
    shop_items, _ = items.split_items(items.encode_items(rows, "shop"))
    return items.decode_items(shop_items, "shop").select(
        "domain", "core_domain_name", "shop_name", "shop_country", "last_crawled_end", "last_scraped_end")


@query("""SELECT 'site.example' AS domain, url, CASE WHEN page_id % 3 = 0 THEN 'product' END AS type,
  CASE WHEN page_id % 2 = 0 THEN sha256(html) END AS hash FROM pages""")
def url_item_roundtrip(read):
    k = F.col("page_id")
    rows = read("pages").select(F.lit("site.example").alias("domain"), "url", F.when(k % 3 == 0, F.lit("product")).alias("type"),
                                F.when(k % 2 == 0, F.sha2("html", 256)).alias("hash"))
    _, url_items = items.split_items(items.encode_items(rows, "url"))
    return items.decode_items(url_items, "url")


@query(f"""WITH {SHOPS_SQL} SELECT domain, CASE WHEN s_suppkey % 2 = 0 THEN 'New ' || shop_name ELSE shop_name END AS shop_name,
  CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE shop_country END AS shop_country FROM shops""")
def partial_update(read):
    table = shops(read).select("domain", "shop_name", "shop_country", "s_suppkey")
    k = F.col("s_suppkey")
    patch = table.where(k % 2 == 0).select(
        "domain", F.concat(F.lit("New "), "shop_name").alias("shop_name"), F.lit(True).alias("shop_name_set"),
        F.lit(None).cast("string").alias("shop_country"), (k % 6 == 0).alias("shop_country_set"))
    return store.apply_patch(table, patch, ["domain"]).drop("s_suppkey")


STATS_SQL = f"""o AS (SELECT 'shop' || (user_id % 10) AS domain, {OUTCOME_SQL} AS outcome FROM events),
stats AS (SELECT domain, count(*) AS total_urls, count(*) AS processed_urls, count(*) FILTER (WHERE outcome = 'success') AS extracted_successfully,
  count(*) FILTER (WHERE outcome = 'unchanged') AS n_unchanged_urls, count(*) FILTER (WHERE outcome = 'validation_error') AS validation_errors,
  count(*) FILTER (WHERE outcome = 'system_error') AS system_errors, count(*) FILTER (WHERE outcome = 'non_product') AS filtered_non_products FROM o GROUP BY domain)"""


def _outcomes(events, *more):
    return events.select(F.concat(F.lit("shop"), (F.col("user_id") % 10).cast("string")).alias("domain"), outcome_column().alias("outcome"),
                         F.col("ts").alias("observed_at"), *more)


@query(f"WITH {STATS_SQL} SELECT *, CAST(0 AS BIGINT) AS token_limit_errors, CAST(0 AS BIGINT) AS fetch_failed FROM stats")
def run_stats(read):
    return scrape.run_stats(_outcomes(read("events")))


@query(f"""WITH {STATS_SQL} SELECT domain, round(extracted_successfully / (total_urls - n_unchanged_urls) * 100, 6) AS success_rate,
  round((validation_errors + system_errors) / (total_urls - n_unchanged_urls) * 100, 6) AS error_rate,
  round((processed_urls - n_unchanged_urls) / total_urls * 100, 6) AS progress FROM stats""")
def rates(read):
    r = scrape.rates(scrape.run_stats(_outcomes(read("events"))))
    return r.select("domain", *[F.round(c, 6).alias(c) for c in ("success_rate", "error_rate", "progress")])


@query("""WITH u AS (SELECT source AS domain, lpad(CAST(doc_id AS VARCHAR), 12, '0') AS url, doc_id FROM documents),
cur AS (SELECT domain, CASE WHEN max(doc_id) % 3 = 0 THEN NULL WHEN max(doc_id) % 3 = 1 THEN 'unknown' ELSE max(url) END AS next FROM u WHERE doc_id % 2 = 0 GROUP BY domain)
SELECT u.domain, u.url FROM u JOIN cur USING (domain) WHERE next IS NULL OR next = 'unknown' OR url >= next""")
def resume_cursor(read):
    urls = read("documents").select(F.col("source").alias("domain"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("url"), "doc_id")
    top = urls.where(F.col("doc_id") % 2 == 0).groupBy("domain").agg(F.max("doc_id").alias("m"), F.max("url").alias("u"))
    cursors = top.select("domain", F.when(F.col("m") % 3 == 0, F.lit(None)).when(F.col("m") % 3 == 1, F.lit("unknown")).otherwise(F.col("u")).alias("next"))
    return scrape.resume(urls.select("domain", "url"), cursors)


@query("""WITH c AS (SELECT 'cust' || c_custkey AS domain, (c_custkey * 2654435761) % 4294967296 AS ip,
  CASE WHEN c_custkey % 4 = 0 THEN 'COUNTRY#XX' END AS known FROM customer)
SELECT domain, coalesce(known, 'COUNTRY#' || n_name) AS shop_country FROM c LEFT JOIN nation
  ON ip BETWEEN CAST(n_nationkey AS BIGINT) * 134217728 AND CAST(n_nationkey AS BIGINT) * 134217728 + 100000000""")
def country_range(read):
    k = F.col("c_custkey")
    shops_ = read("customer").select(F.concat(F.lit("cust"), k.cast("string")).alias("domain"), ((k * 2654435761) % 4294967296).alias("ip"),
                                     F.when(k % 4 == 0, F.lit("COUNTRY#XX")).alias("shop_country"))
    lo = F.col("n_nationkey").cast("long") * 134217728
    ranges = read("nation").select(lo.alias("lo"), (lo + 100000000).alias("hi"), F.col("n_name").alias("country"))
    return S.country_of_ip(shops_, ranges).select("domain", "shop_country")


def _model(texts):
    """Stands for a model: reads the number in the first line; fails, answers nonsense or finds no product by its remainder.

    A footer that should have been removed makes the reply invalid.
    """
    def reply(text: str) -> str:
        number = int(text.split("\n", 1)[0].rsplit(" ", 1)[1])
        if number % 11 == 2:
            raise ValueError("LengthFinishReasonError: reply cut off")
        if number % 11 == 4:
            raise RuntimeError("model unavailable")
        state = "GONE" if number % 11 == 5 or "Delivery is free" in text else "SOLD"
        return (f'{{"is_product": {"false" if number % 11 == 6 else "true"}, "shopsProductId": "{number}", '
                f'"title": {{"text": "Old chair", "language": "en"}}, "price": {{"amount": {number}, "currency": "EUR"}}, "state": "{state}", "images": []}}')

    return texts.map(reply)


@query("""SELECT source AS domain, CAST(doc_id AS VARCHAR) AS url, CASE WHEN doc_id % 7 = 1 THEN 'fetch_failed' WHEN doc_id % 3 = 0 THEN 'unchanged'
  WHEN doc_id % 11 = 2 THEN 'token_limit' WHEN doc_id % 11 = 4 THEN 'system_error' WHEN doc_id % 11 = 5 THEN 'validation_error'
  WHEN doc_id % 11 = 6 THEN 'non_product' ELSE 'success' END AS outcome FROM documents""")
def scrape_job(read):
    """Outcomes of a scrape of all documents as pages that share a footer; some are gone or unchanged, the model fails on some."""
    k = F.col("doc_id")
    docs = read.spread("documents").select(
        k, F.col("source").alias("domain"), k.cast("string").alias("url"),
        F.concat(F.lit("# Old chair no. "), k.cast("string"), F.lit("\n"), "text", F.lit("\nDelivery is free for all orders\nVisit us in the old mill")).alias("markdown"))
    pages = docs.where(k % 7 != 1).select("domain", "url", "markdown", F.lit(True).alias("success"), F.lit(None).cast("string").alias("error"))
    table = docs.select("domain", "url", F.lit("product").alias("type"), F.when(k % 3 == 0, F.sha2("markdown", 256)).alias("hash"))
    shops_ = docs.select("domain").distinct().withColumns({c: F.lit(None).cast("string") for c in (
        "last_scraped_start", "last_scraped_end")})
    footer = F.array(F.array(F.lit("Delivery is free for all orders"), F.lit("Visit us in the old mill")))
    requests = shops_.select("domain", F.lit(None).cast("string").alias("next"))
    out = jobs.scrape_shops(shops_, requests, table, pages, shops_.select("domain", footer.alias("blocks")), "2026-01-01T00:00:00Z", extractor=_model)
    return out["outcomes"].select("domain", "url", "outcome")


@query("""WITH r AS (SELECT DISTINCT (l_orderkey * 8 + l_linenumber) * 1000 AS lo, l_linenumber FROM lineitem),
c AS (SELECT 'host' || event_id AS domain, (event_id * 7919) % 100000000 AS ip FROM events)
SELECT domain, CASE WHEN ip <= lo + 600 THEN 'COUNTRY#C' || l_linenumber END AS shop_country FROM c ASOF LEFT JOIN r ON ip >= lo""")
def country_ranges(read):
    """An address range for every order line."""
    line = F.col("l_linenumber")
    ranges = read("lineitem").select(((F.col("l_orderkey") * 8 + line) * 1000).alias("lo"), F.concat(F.lit("C"), line.cast("string")).alias("country")).distinct()
    ranges = ranges.withColumn("hi", F.col("lo") + 600)
    ip = (F.col("event_id") * 7919) % 100_000_000
    hosts = read("events").select(
        F.concat(F.lit("host"), F.col("event_id").cast("string")).alias("domain"), ip.alias("ip"), F.lit(None).cast("string").alias("shop_country"))
    return S.country_of_ip(hosts, ranges).select("domain", "shop_country")
