"""Choosing shops for a crawl or a scrape, lookups, country by address."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shopflow.functions import states
from shopflow.functions.columns import ratio
from shopflow.functions.states import operation_column, parse_state
from shopflow.operators.skew import carry_forward
from shopflow.schemas import DEFAULT_COUNTRY, STATE_DONE, STATE_NEVER, STATE_PROGRESS


def product_urls(urls: DataFrame, domain: str | None = None) -> DataFrame:
    found = urls.where(F.col("type") == "product")
    if domain is not None:
        found = found.where(F.col("domain") == domain)
    return found.select("domain", "url")


def shops_by_core(shops: DataFrame, name: str, without: str | None = None) -> DataFrame:
    """Shops of one core name (equality), leaving out a domain if asked."""
    found = shops.where(F.col("core_domain_name") == name)
    return found if without is None else found.where(F.col("domain") != without)


def lookup(df: DataFrame, **keys) -> DataFrame:
    for name, value in keys.items():
        df = df.where(F.col(name) == value)
    return df


def _instant(text: Column) -> Column:
    return F.try_to_timestamp(text)


def candidates(shops: DataFrame, operation: str, cutoff: str, country: str | None = DEFAULT_COUNTRY,
               parse_ts: bool = False) -> DataFrame:
    """Shops of a country that never ran the operation or finished it at or before ``cutoff``.

    States compare as text, like keys of an index; ``parse_ts`` compares instants. Shops without a country are in no
    index and never chosen.
    """
    state = F.coalesce(F.nullif(F.col(operation_column(operation)), F.lit("")), F.lit(STATE_NEVER))
    key = F.lit(country or DEFAULT_COUNTRY)
    if parse_ts:
        done = state.startswith(STATE_DONE) & (
            _instant(F.substring(state, len(STATE_DONE) + 1, 64)) <= _instant(F.lit(cutoff)))
    else:
        done = state.between(STATE_DONE, STATE_DONE + cutoff)
    return shops.where((F.col("shop_country") == states.country_key(key)) & ((state == STATE_NEVER) | done))


def crawl_eligible(shops: DataFrame) -> DataFrame:
    return shops.where(crawl_reason() == "eligible")


def crawl_reason() -> Column:
    running = F.coalesce(F.col("last_crawled_end").startswith(STATE_PROGRESS), F.lit(False))
    return F.when(running, "in_progress").otherwise("eligible")


def scrape_reason(parse_ts: bool = False) -> Column:
    """Why a shop is or is not scraped: eligible, in_progress, crawl_not_finished or already_scraped."""
    crawl_end, scrape_end = F.col("last_crawled_end"), F.col("last_scraped_end")
    crawl, scrape = parse_state(crawl_end), parse_state(scrape_end)

    def time(state: Column) -> Column:
        return _instant(state["ts"]) if parse_ts else state["ts"]

    due = (crawl["state"] == STATE_DONE) & (
        (scrape["state"] == STATE_NEVER) | ((scrape["state"] == STATE_DONE) & (time(scrape) < time(crawl))))
    return (F.when(F.coalesce(scrape_end.startswith(STATE_PROGRESS), F.lit(False)), "in_progress")
            .when(F.coalesce(due, F.lit(False)), "eligible")
            .when(crawl_end.isNull() | (crawl_end == STATE_NEVER), "crawl_not_finished")
            .otherwise("already_scraped"))


def scrape_eligible(shops: DataFrame, parse_ts: bool = False) -> DataFrame:
    return shops.where(scrape_reason(parse_ts) == "eligible")


def stuck(shops: DataFrame, operation: str, before: str) -> DataFrame:
    """Shops whose operation is in progress since ``before`` or longer."""
    state = F.col(operation_column(operation))
    return shops.where(state.between(STATE_PROGRESS, STATE_PROGRESS + before))


def crawl_stats(shops: DataFrame) -> DataFrame:
    reason = crawl_reason()
    counted = shops.agg(F.count(F.lit(1)).alias("total_queried"),
                        F.count_if(reason == "in_progress").alias("in_progress"),
                        F.count_if(reason == "eligible").alias("eligible"))
    return _with_filter_rate(counted)


def scrape_stats(shops: DataFrame, parse_ts: bool = False) -> DataFrame:
    names = ["in_progress", "crawl_not_finished", "already_scraped", "eligible"]
    counted = (shops.select(scrape_reason(parse_ts).alias("reason"))
               .agg(F.count(F.lit(1)).alias("total_queried"),
                    *[F.count_if(F.col("reason") == n).alias(n) for n in names]))
    return _with_filter_rate(counted)


def _with_filter_rate(counted: DataFrame) -> DataFrame:
    return counted.withColumn(
        "filter_rate", ratio(F.col("total_queried") - F.col("eligible"), F.col("total_queried")) * 100)


def orchestration_summary(messages: DataFrame) -> DataFrame:
    """Counts of one run over messages with a nullable ``error``; the failed ones are :func:`failed_domains`."""
    sent = F.col("error").isNull()
    return (messages.agg(F.count(F.lit(1)).alias("shops_found"), F.count_if(sent).alias("shops_enqueued"),
                         F.count_if(~sent).alias("shops_failed"))
            .withColumn("success_rate", ratio(F.col("shops_enqueued"), F.col("shops_found")) * 100))


def failed_domains(messages: DataFrame) -> DataFrame:
    return messages.where(F.col("error").isNotNull()).select("domain", "error")


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.select("domain").limit(n)


def ip_to_long(ip: Column) -> Column:
    """Dotted IPv4 text as a number; null for anything else."""
    octets = F.transform(F.split(ip, r"\."), lambda o: o.cast("long"))
    value = F.aggregate(octets, F.lit(0).cast("long"), lambda acc, o: acc * 256 + o)
    return F.when(ip.rlike(r"^(25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(\.(25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}$"), value)


def country_of_ip(shops: DataFrame, ranges: DataFrame, parts: int | None = None) -> DataFrame:
    """Fill a missing ``shop_country`` from the number ``ip``; ``ranges`` are disjoint (lo, hi, country).

    An as-of join: shops and range starts are sorted together in ranges of addresses, and each shop takes the last start
    before it. So neither the number of ranges nor an address that many shops share makes a task large.
    """
    shop, found = F.struct(*[F.col(c).alias(c) for c in shops.columns]), F.struct("hi", "country")
    none = {"shop": shops.select(shop.alias("s")).schema["s"].dataType, "found": ranges.select(found.alias("f")).schema["f"].dataType}
    asked = shops.select(F.col("ip").cast("long").alias("at"), F.lit(1).alias("side"), F.xxhash64(*[F.col(c).cast("string") for c in ("domain", "ip")]).alias("tie"),
                         shop.alias("shop"), F.lit(None).cast(none["found"]).alias("found"))
    starts = ranges.select(F.col("lo").cast("long").alias("at"), F.lit(0).alias("side"), F.lit(0).cast("long").alias("tie"),
                           F.lit(None).cast(none["shop"]).alias("shop"), found.alias("found"))
    met = carry_forward(starts.unionByName(asked), ["at", "side", "tie"], "found", "last", parts).where("side = 1")
    hit = F.when(F.col("at") <= F.col("last.hi"), states.country_key(F.col("last.country")))
    return met.select(*[F.coalesce(f"shop.{c}", hit).alias(c) if c == "shop_country" else F.col(f"shop.{c}").alias(c) for c in shops.columns])
