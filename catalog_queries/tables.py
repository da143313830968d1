"""Inputs of the queries, derived from the given tables; the SQL texts derive them the same way."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from catalog_queries.registry import Reader
from shopflow.functions import urls as U

ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"
DUCK_ISO = "%Y-%m-%dT%H:%M:%SZ"

LINES_SQL = r"""
doc_lines AS (
  SELECT doc_id, source, i AS line_no, ls[i + 1] AS line, len(ls) AS n_lines
  FROM (SELECT *, unnest(range(len(ls))) AS i FROM (
    SELECT doc_id, source, CASE WHEN s[-1] = '' THEN s[1:len(s) - 1] ELSE s END AS ls
    FROM (SELECT doc_id, source, string_split(text, chr(10)) AS s FROM documents)))
)"""

SHOPS_SQL = f"""
ship AS (SELECT l_suppkey, strftime(min(l_shipdate), '{DUCK_ISO}') AS lo, strftime(max(l_shipdate), '{DUCK_ISO}') AS hi
         FROM lineitem GROUP BY l_suppkey),
shops AS (
  SELECT 'shop' || s_suppkey || '.example.com' AS domain, s_suppkey, 'COUNTRY#' || n_name AS shop_country, s_name AS shop_name,
    CASE WHEN s_suppkey % 11 = 0 THEN NULL WHEN s_suppkey % 5 = 0 THEN 'NEVER#' WHEN s_suppkey % 5 = 1 THEN 'PROGRESS#' || lo
         WHEN s_suppkey % 2 = 0 THEN 'DONE#' || hi ELSE 'DONE#' || lo END AS last_crawled_end,
    CASE WHEN s_suppkey % 4 = 0 THEN 'NEVER#' WHEN s_suppkey % 7 = 1 THEN 'PROGRESS#' || hi
         WHEN s_suppkey % 3 = 0 THEN 'DONE#' || hi ELSE 'DONE#' || lo END AS last_scraped_end
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN ship ON l_suppkey = s_suppkey
)"""


def shops(read: Reader) -> DataFrame:
    """A shop per supplier; country from its nation, states from its first and last shipment."""
    ship = read("lineitem").groupBy("l_suppkey").agg(
        F.date_format(F.min("l_shipdate"), ISO).alias("lo"), F.date_format(F.max("l_shipdate"), ISO).alias("hi"))
    k = F.col("s_suppkey")
    done_hi, done_lo = F.concat(F.lit("DONE#"), "hi"), F.concat(F.lit("DONE#"), "lo")
    return (read("supplier").join(read("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(ship, k == F.col("l_suppkey")).select(
        F.concat(F.lit("shop"), k.cast("string"), F.lit(".example.com")).alias("domain"), k,
        F.concat(F.lit("COUNTRY#"), "n_name").alias("shop_country"), F.col("s_name").alias("shop_name"),
        F.when(k % 11 == 0, F.lit(None)).when(k % 5 == 0, F.lit("NEVER#")).when(k % 5 == 1, F.concat(F.lit("PROGRESS#"), "lo"))
        .when(k % 2 == 0, done_hi).otherwise(done_lo).alias("last_crawled_end"),
        F.when(k % 4 == 0, F.lit("NEVER#")).when(k % 7 == 1, F.concat(F.lit("PROGRESS#"), "hi"))
        .when(k % 3 == 0, done_hi).otherwise(done_lo).alias("last_scraped_end")))


HOSTS_SQL = r"""
hosts AS (SELECT lower(regexp_extract(url, '^https?://([^/?#:]*)', 1)) AS host, min(page_id) AS first_page
          FROM pages GROUP BY 1),
cores AS (SELECT regexp_replace(host, '^www\.', '') AS domain, host, first_page,
            string_split(regexp_replace(host, '^www\.', ''), '.') AS l FROM hosts),
named AS (SELECT domain, first_page, CASE
            WHEN len(l) = 1 THEN l[1]
            WHEN len(l) >= 3 AND length(l[-1]) = 2 AND l[-2] IN ('ac','co','com','edu','go','gob','gov','gv','ltd','me','ne',
              'net','nom','or','org','plc','sch') THEN l[-3]
            ELSE l[-2] END AS core FROM cores),
site AS (SELECT domain, core, min(first_page) AS first_page FROM named GROUP BY 1, 2)
"""


def sites(read: Reader) -> DataFrame:
    """Domains of the web pages with their core name and first page."""
    domain = U.normalize_domain(F.col("url"))
    return (read("pages").groupBy(domain.alias("domain")).agg(F.min("page_id").alias("first_page"))
            .withColumn("core_domain_name", U.core_domain(F.col("domain"))))


PRODUCTS_SQL = """
seller AS (SELECT l_partkey, min(l_suppkey) AS s FROM lineitem GROUP BY l_partkey),
products AS (
  SELECT 'S' || s AS shop_id, CAST(p_partkey AS VARCHAR) AS shops_product_id, p_partkey, s_name AS shop_name,
    ['AUCTION_HOUSE','AUCTION_PLATFORM','COMMERCIAL_DEALER','MARKETPLACE'][s % 4 + 1] AS shop_type,
    'https://shop' || s || '.example.com/p/' || p_partkey AS url,
    p_name AS title, lower(p_type) || ' ' || replace(p_brand, '#', ' ') AS description,
    ['AVAILABLE','SOLD','LISTED','RESERVED','REMOVED','UNKNOWN'][p_size % 6 + 1] AS state,
    CAST(round(p_retailprice * 100) AS BIGINT) AS amount, 1700 + p_size AS origin_year,
    TIMESTAMP '2020-01-01' + INTERVAL 1 MINUTE * p_partkey AS created
  FROM part JOIN seller ON l_partkey = p_partkey JOIN supplier ON s_suppkey = s
)"""


def products(read: Reader) -> DataFrame:
    """A product per part, sold by its first supplier, priced in cents."""
    seller = read("lineitem").groupBy("l_partkey").agg(F.min("l_suppkey").alias("s"))
    types = F.array(*map(F.lit, ["AUCTION_HOUSE", "AUCTION_PLATFORM", "COMMERCIAL_DEALER", "MARKETPLACE"]))
    states = F.array(*map(F.lit, ["AVAILABLE", "SOLD", "LISTED", "RESERVED", "REMOVED", "UNKNOWN"]))
    en = F.lit("en").alias("language")
    null = F.lit(None)
    money = "struct<amount:bigint,currency:string>"
    minute = F.make_interval(mins=F.col("p_partkey").cast("int"))
    return (read("part").join(seller, F.col("p_partkey") == F.col("l_partkey"))
            .join(read("supplier").select(F.col("s_suppkey").alias("s"), "s_name"), "s").select(
        F.concat(F.lit("S"), F.col("s").cast("string")).alias("shop_id"),
        F.col("p_partkey").cast("string").alias("shops_product_id"), F.col("s_name").alias("shop_name"),
        F.get(types, (F.col("s") % 4).cast("int")).alias("shop_type"),
        F.concat(F.lit("https://shop"), F.col("s").cast("string"), F.lit(".example.com/p/"), F.col("p_partkey").cast("string")).alias("url"),
        F.struct(F.col("p_name").alias("text"), en).alias("title"),
        F.struct(F.concat_ws(" ", F.lower("p_type"), F.replace("p_brand", F.lit("#"), F.lit(" "))).alias("text"), en).alias("description"),
        F.get(states, F.col("p_size") % 6).alias("state"),
        F.struct(F.round(F.col("p_retailprice") * 100).cast("long").alias("amount"), F.lit("EUR").alias("currency")).alias("price"),
        null.cast(money).alias("price_estimate_min"), null.cast(money).alias("price_estimate_max"),
        (F.lit(1700) + F.col("p_size")).alias("origin_year"), null.cast("int").alias("origin_year_min"),
        null.cast("int").alias("origin_year_max"),
        *[null.cast("string").alias(c) for c in ("authenticity", "condition", "provenance", "restoration")],
        null.cast("timestamp").alias("auction_start"), null.cast("timestamp").alias("auction_end"),
        (F.lit("2020-01-01 00:00:00").cast("timestamp") + minute).alias("created"),
        (F.lit("2020-01-01 00:00:00").cast("timestamp") + minute).alias("updated"), F.col("p_partkey")))


OUTCOME_SQL = """CASE event_type WHEN 'purchase' THEN 'success' WHEN 'view' THEN 'unchanged' WHEN 'click' THEN 'non_product'
  WHEN 'error' THEN 'system_error' ELSE 'validation_error' END"""


def outcome_column():
    kind = F.col("event_type")
    return (F.when(kind == "purchase", "success").when(kind == "view", "unchanged").when(kind == "click", "non_product")
            .when(kind == "error", "system_error").otherwise("validation_error"))


STATE_SQL = """CASE event_type WHEN 'purchase' THEN 'SOLD' WHEN 'view' THEN 'LISTED' WHEN 'click' THEN 'AVAILABLE'
  WHEN 'error' THEN 'UNKNOWN' ELSE 'RESERVED' END"""


def observations(read_events: DataFrame) -> DataFrame:
    """Product observations: a product per user, the value as price in cents, no price on errors."""
    kind = F.col("event_type")
    state = (F.when(kind == "purchase", "SOLD").when(kind == "view", "LISTED").when(kind == "click", "AVAILABLE")
             .when(kind == "error", "UNKNOWN").otherwise("RESERVED"))
    amount = F.when(kind != "error", F.round(F.col("value") * 100).cast("long"))
    return read_events.select(
        F.lit("S1").alias("shop_id"), F.col("user_id").cast("string").alias("shops_product_id"),
        amount.alias("amount"), F.lit("EUR").alias("currency"), state.alias("state"), F.col("ts").alias("observed_at"),
        F.col("event_id").alias("seq"))


EVENTS_SQL = f"""
obs AS (SELECT CAST(user_id AS VARCHAR) AS pid, ts, event_id,
          CASE WHEN event_type <> 'error' THEN CAST(round(value * 100) AS BIGINT) END AS amount, {STATE_SQL} AS state FROM events),
prev AS (SELECT *, lag(amount) OVER w AS old_amount, lag(state) OVER w AS old_state, row_number() OVER w AS n
         FROM obs WINDOW w AS (PARTITION BY pid ORDER BY ts, event_id)),
derived AS (
  SELECT pid, ts, 'CREATED' AS event_type, NULL::BIGINT AS old_amount, amount AS new_amount, NULL::VARCHAR AS old_state, state AS new_state
  FROM prev WHERE n = 1
  UNION ALL
  SELECT pid, ts, CASE WHEN old_amount IS NULL THEN 'PRICE_DISCOVERED' WHEN amount IS NULL THEN 'PRICE_REMOVED'
           WHEN amount < old_amount THEN 'PRICE_DROPPED' ELSE 'PRICE_INCREASED' END, old_amount, amount, NULL, NULL
  FROM prev WHERE n > 1 AND amount IS DISTINCT FROM old_amount
  UNION ALL
  SELECT pid, ts, 'STATE_' || state, NULL, NULL, old_state, state FROM prev WHERE n > 1 AND state <> old_state
)"""
