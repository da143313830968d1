"""Outcome of every scraped page, run statistics and rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shopflow.functions import urls as U
from shopflow.functions.columns import ratio
from shopflow.operators.shops import product_urls
from shopflow.operators.skew import salted_join

# The outcomes of a page.
OUTCOMES = ["fetch_failed", "unchanged", "token_limit", "system_error", "validation_error", "non_product", "success"]


def resume(urls: DataFrame, cursors: DataFrame) -> DataFrame:
    """Product URLs of each asked domain from its cursor ``next`` on, in URL order.

    ``cursors`` is (domain, next). A null or unknown cursor starts at the first URL.
    """
    known = (cursors.where(F.col("next").isNotNull())
             .join(urls.select("domain", F.col("url").alias("next")), ["domain", "next"], "left_semi")
             .select("domain", F.col("next").alias("_from")))
    starts = cursors.select("domain").distinct().join(known, "domain", "left")
    return (salted_join(urls, starts, ["domain"], ["url"], "inner")
            .where(F.col("_from").isNull() | (F.col("url") >= F.col("_from"))).drop("_from"))


def outcome(success: Column, changed: Column, error: Column, errors: Column, is_product: Column) -> Column:
    """One label per page. ``error`` is the extractor's failure text, ``errors`` the failed checks."""
    return (F.when(~F.coalesce(success, F.lit(False)), "fetch_failed")
            .when(~F.coalesce(changed, F.lit(True)), "unchanged")
            .when(F.coalesce(error.contains("LengthFinishReason"), F.lit(False)), "token_limit")
            .when(error.isNotNull(), "system_error")
            .when(F.coalesce(F.size(errors) > 0, F.lit(False)) | is_product.isNull(), "validation_error")
            .when(is_product, "success").otherwise("non_product"))


def route_outcomes(df: DataFrame) -> DataFrame:
    """Adds ``outcome`` to rows with success, changed, extract_error, errors and extracted."""
    return df.withColumn("outcome", outcome(F.col("success"), F.col("changed"), F.col("extract_error"),
                                            F.col("errors"), F.col("extracted.is_product")))


def run_stats(outcomes: DataFrame, keys: tuple[str, ...] = ("domain",)) -> DataFrame:
    """Counters per domain; a token-limit error is a system error too."""
    def n(*labels: str) -> Column:
        return F.count_if(F.col("outcome").isin(*labels))

    return outcomes.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_urls"), F.count("outcome").alias("processed_urls"),
        n("success").alias("extracted_successfully"), n("unchanged").alias("n_unchanged_urls"),
        n("validation_error").alias("validation_errors"), n("system_error", "token_limit").alias("system_errors"),
        n("token_limit").alias("token_limit_errors"), n("non_product").alias("filtered_non_products"),
        n("fetch_failed").alias("fetch_failed"))


def rates(stats: DataFrame, of: str = "total_urls") -> DataFrame:
    """Adds success, error and progress percentages, and seconds per page where start and end times are given.

    ``of`` is the page count the rates refer to: ``processed_urls`` while running, ``total_urls`` at the end.
    """
    base = F.col(of) - F.col("n_unchanged_urls")
    out = stats.withColumns({
        "success_rate": ratio(F.col("extracted_successfully"), base) * 100,
        "error_rate": ratio(F.col("validation_errors") + F.col("system_errors"), base) * 100,
        "progress": ratio(F.col("processed_urls") - F.col("n_unchanged_urls"), F.col("total_urls")) * 100})
    if {"start_time", "end_time"} <= set(stats.columns):
        seconds = F.col("end_time").cast("double") - F.col("start_time").cast("double")
        out = out.withColumns({"duration_seconds": seconds, "seconds_per_page": ratio(seconds, base)})
    return out


def scrape_urls(urls: DataFrame, messages: DataFrame) -> DataFrame:
    """Product URLs to scrape for the domains of some work messages (domain, next)."""
    return resume(product_urls(urls), messages.select(U.clean_domain(F.col("domain")).alias("domain"), "next"))
