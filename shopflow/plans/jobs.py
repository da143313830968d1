"""Whole jobs composed from the operators. Each returns its output tables as lazy frames by name."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from shopflow.functions import states, text, urls as U
from shopflow.operators import boilerplate, catalogue, classify, crawl, extract, pages as P, register, scrape, search, shops as S
from shopflow.operators.skew import dedupe_last
from shopflow.runtime import cut
from shopflow.schemas import DEFAULT_COUNTRY, PAGE_SIZE, PRODUCT_KEY
from shopflow.sources import messages, store


def orchestrate(shops: DataFrame, operation: str, country: str | None = DEFAULT_COUNTRY, cutoff: str | None = None,
                now: datetime | None = None, days: int = 2, parse_ts: bool = False, path: str | None = None, run: str = "0",
                deliver: Callable[[DataFrame, int], DataFrame] = messages.within_limits) -> dict[str, DataFrame]:
    """Shops due for a crawl or scrape as messages, sent, with the outcome of each, filter statistics and summary.

    Options ``path``, ``run`` and ``deliver`` are those of :func:`messages.send_messages`.
    """
    states.operation_column(operation)
    found = S.candidates(shops, operation, cutoff or states.cutoff(now, days), country, parse_ts)
    if operation == "crawl":
        stats, chosen = S.crawl_stats(found), S.crawl_eligible(found)
    else:
        stats, chosen = S.scrape_stats(found, parse_ts), S.scrape_eligible(found, parse_ts)
    out = messages.to_messages(chosen)
    sent = messages.send_messages(out, path, run, deliver)
    return {"messages": out, "outcomes": sent, "failed": S.failed_domains(sent), "stats": stats, "summary": S.orchestration_summary(sent),
            "preview": S.preview(chosen)}


def crawl_shops(shops: DataFrame, bodies: DataFrame, pages: DataFrame, url_table: DataFrame, ts: str,
                model=None, max_depth: int | None = None, max_pages: int | None = None,
                keep_hash: bool = False, **gates) -> dict[str, DataFrame]:
    """Walk the stored pages of the shops named by work messages and store their classified URLs.

    ``model`` is a URL classifier; without one ``type`` comes from a column ``is_product`` of ``pages``.
    """
    good, rejects = messages.valid_messages(bodies)
    named = good.select("domain", "start_url").distinct()
    seeds = named.select("domain", U.normalize_url(F.col("start_url")).alias("url"))
    stored = pages.withColumn("url", U.normalize_url(F.col("url")))
    walked, counters = crawl.walk(seeds, P.extract_links(pages), stored, max_depth, max_pages, **gates)
    fetched = walked.where("success")
    if model is not None:
        typed = classify.classify_urls(fetched, model)
    else:
        typed = fetched.join(stored.groupBy("url").agg(F.max("is_product").alias("is_product")), "url").withColumn(
            "type", F.when(F.col("is_product"), F.lit("product")))
    rows = typed.select("domain", "url", "type", F.lit(None).cast("string").alias("hash"), F.lit(0).alias("ord"))
    table = store.upsert_urls(url_table, rows, "ord", keep_hash)
    counts = crawl.processed(walked)
    started = store.mark_started(shops, named, "crawl", ts)
    return {"results": walked, "urls": table, "processed": counts, "counters": counters, "rejects": rejects,
            "shops": store.mark_done(started, counts, "crawl", ts)}


def scrape_shops(shops: DataFrame, requests: DataFrame, url_table: DataFrame, pages: DataFrame, blocks: DataFrame,
                 ts: str, extractor: Callable | None = None, content: str = "markdown",
                 batch_size: int = store.PUBLISH_BATCH, include_estimates: bool = False) -> dict[str, DataFrame]:
    """Scrape the product URLs of the requested domains (domain, next): outcomes, products, new hashes, states.

    The hash check runs before cleaning and extraction; checked and extracted pages are written once and feed all outputs.
    Requested domains without stored blocks are sampled for some first (pages that read like products); ``new_blocks``
    holds what was found. ``extractor`` maps a batch of texts to replies; a text it fails on is one failed page.
    """
    wanted = scrape.scrape_urls(url_table, requests)
    checked = cut(P.with_change(store.fetch(wanted, pages), url_table, content))
    due = checked.where(F.col("success") & F.col("changed"))
    product = extract.looks_like_product(F.col("markdown"), F.col("url"))
    found = cut(boilerplate.discover_boilerplate(wanted.withColumn("type", F.lit("product")), checked.where("success").select("domain", "url", "markdown", "success"),
                                                 blocks, ts, accept=product))
    known = blocks.select("domain", "blocks").unionByName(found.select("domain", "blocks"))
    extracted = cut(extract.extract_products(boilerplate.clean_pages(due, known), extractor)
                    .select("domain", "url", "hash", "success", "changed", "extract_error", "errors", "extracted"))
    skipped = checked.where(~(F.col("success") & F.col("changed"))).select("domain", "url", "hash", "success", "changed")
    outcomes = scrape.route_outcomes(extracted.unionByName(skipped, allowMissingColumns=True))
    stats = scrape.run_stats(outcomes)
    good = extract.to_payload(outcomes.where(F.col("outcome") == "success"), include_estimates)
    fresh = extracted.select("domain", "url", F.col("hash").alias("_new"))
    hashes = (url_table.join(fresh, ["domain", "url"], "left")
              .withColumn("hash", F.coalesce("_new", "hash")).drop("_new"))
    started = store.mark_started(shops, requests.where(F.col("next").isNull()), "scrape", ts)
    counts = stats.select("domain", F.col("processed_urls").alias("processed"))
    return {"outcomes": outcomes, "products": good, "batches": store.publish(good, batch_size), "urls": hashes,
            "stats": stats, "report": scrape.rates(stats), "new_blocks": found,
            "shops": store.mark_done(started, counts, "scrape", ts)}


def register_shops(changes: DataFrame, shops: DataFrame, suffixes: DataFrame | None = None) -> dict[str, DataFrame]:
    """Change records to registration requests; records without a domain are rejects. ``suffixes`` is a suffix table for core names."""
    good, rejects = register.new_shops(changes, suffixes)
    return {"plan": register.registration_plan(good, shops), "rejects": rejects}


def put_products(products: DataFrame, shops: DataFrame, current: DataFrame, ts: Column,
                 compare: tuple[str, ...] = ("state", "price"), order: list[str] | None = None,
                 write: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
    """Bulk create or update: enrichment, overflow check, comparison with the catalogue, events.

    Several puts of one product take effect one after another in ``order``; the catalogue keeps the last. ``write(rows)``
    stores created and updated rows and returns the products (key, reason) that it could not store: their puts come out as
    ``unprocessed`` with the reason as ``error``, give no events and leave the catalogue as it was.
    ``products`` carries ``amount`` as decimal(20,0) and ``currency``; the catalogue holds integer amounts.
    """
    enriched = catalogue.enrich_with_shop(products, shops)
    priced = (enriched.withColumn("error", F.coalesce("error", F.when(
        catalogue.overflow(F.col("amount")), F.lit("MONETARY_AMOUNT_OVERFLOW"))))
        .withColumn("price", F.when(F.col("error").isNull() & F.col("amount").isNotNull(), F.struct(
            F.col("amount").cast("long").alias("amount"), F.col("currency")))).drop("amount", "currency"))
    results = cut(catalogue.put_results(priced, current, list(compare), order))
    if write is not None:
        lost = write(results.where(F.col("outcome").isin("created", "updated"))).groupBy(*PRODUCT_KEY).agg(F.min("reason").alias("_reason"))
        results = catalogue.mark_unprocessed(results, lost)
    written = results.where(F.col("outcome").isin("created", "updated"))
    events = catalogue.events_between(written.withColumn("_ts", ts), PRODUCT_KEY, F.col("outcome") == "created", F.col("before.price"),
                                      F.col("price"), F.col("before.state"), F.col("state"), "_ts")
    columns = [c for c in current.columns if c in written.columns]
    last = dedupe_last(written, PRODUCT_KEY, ["put_no"])
    table = (current.join(last.select(*PRODUCT_KEY), PRODUCT_KEY, "left_anti")
             .unionByName(last.select(*columns), allowMissingColumns=True))
    return {"results": results.drop("before", "put_no"), "catalogue": table, "events": events}


def search_products(products: DataFrame, wanted: catalogue.SearchFilter, sort: str = "score", order: str | None = None,
                    size: int = PAGE_SIZE, after: tuple | None = None, watchlist: DataFrame | None = None,
                    user_id=None) -> DataFrame:
    """One page of matching products as summaries with total, cursor and user state."""
    ranked = search.score(products, wanted.product_query) if sort == "score" else products
    matching = ranked.where(wanted.to_column())
    order = order or ("desc" if sort == "score" else "asc")
    paged = catalogue.page(matching, catalogue.sort_column(sort), PRODUCT_KEY, order, size, after, with_total=True)
    extra = ["cursor", "total"] + (["score"] if sort == "score" else [])
    kept = [c for c in catalogue.SUMMARY_COLUMNS if c in products.columns]
    return catalogue.with_user_state(paged.select(*kept, *extra), watchlist, user_id)


def search_shops(shops: DataFrame, wanted: catalogue.ShopFilter, sort: str = "name", order: str = "asc",
                 size: int = PAGE_SIZE, after: tuple | None = None) -> DataFrame:
    """One page of matching shops (shop_id, name, shop_type, created, updated) with total and cursor."""
    found = shops
    if sort == "score":
        if not wanted.name_query:
            raise ValueError("sorting by score needs a text")
        found = search.score(shops, wanted.name_query, F.col("name"))
    return catalogue.page(found.where(wanted.to_column()), catalogue.sort_column(sort, "shop"), ["shop_id"], order, size,
                          after, with_total=True)


def boilerplate_shrink(pages: DataFrame) -> DataFrame:
    """How much of every page stays after the blocks shared within its domain are removed.

    ``pages`` is (domain, url, html).
    """
    marked = cut(P.html_to_markdown(pages).select("domain", "url", "markdown").withColumn("success", F.lit(True)))
    typed = marked.select("domain", "url", F.lit("product").alias("type"))
    empty = marked.select("domain").limit(0)
    blocks = boilerplate.discover_boilerplate(typed, marked, empty, "1970-01-01T00:00:00Z")
    cleaned = boilerplate.clean_pages(marked, cut(blocks))
    return cleaned.select("domain", "url", F.length("markdown").alias("raw_chars"), F.length("clean").alias("clean_chars"),
                          text.deletion_rate(F.col("markdown"), F.col("clean")).alias("kept"))
