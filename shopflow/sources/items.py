"""Single-table item layout: shops and URLs in one table, attributes as ``{"name": {"S": "text"}}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shopflow.functions import states, urls
from shopflow.schemas import (
    DEFAULT_SHOP_TYPE, ITEM, ITEM_MAP, META_KEY, SHOP_COLUMNS, STATE_NEVER, URL_COLUMNS, URL_PREFIX,
)


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """One JSON item per line as column ``item``."""
    return spark.read.schema(ITEM).text(path).toDF("item")


def _attributes(item: Column) -> Column:
    return F.from_json(item, ITEM_MAP)


def _text(attributes: Column, name: str) -> Column:
    return F.nullif(attributes[name]["S"], F.lit(""))


def split_items(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items with column ``item`` to (shop items, URL items) by their sort key."""
    key = _attributes(F.col("item"))["sk"]["S"]
    return items.where(key == META_KEY), items.where(key.startswith(URL_PREFIX))


def decode_items(items: DataFrame, kind: str) -> DataFrame:
    """Typed columns of ``shop`` or ``url`` items; absent attributes are null, index keys fill country and states."""
    parsed = items.select(_attributes(F.col("item")).alias("a"))
    a = F.col("a")
    if kind == "url":
        return parsed.select(
            states.domain_from_key(a["pk"]["S"]).alias("domain"), a["url"]["S"].alias("url"),
            a["type"]["S"].alias("type"), a["hash"]["S"].alias("hash"))
    if kind != "shop":
        raise ValueError(f"kind must be 'shop' or 'url', got: {kind}")
    domain = a["domain"]["S"]
    return parsed.select(
        domain.alias("domain"), urls.core_domain(domain).alias("core_domain_name"),
        a["shop_name"]["S"].alias("shop_name"), a["shop_image"]["S"].alias("shop_image"),
        a["shop_type"]["S"].alias("shop_type"),
        states.country_key(F.coalesce(*[_text(a, c) for c in ("shop_country", "gsi2_pk", "gsi3_pk")]))
        .alias("shop_country"),
        a["last_crawled_start"]["S"].alias("last_crawled_start"),
        F.coalesce(_text(a, "last_crawled_end"), _text(a, "gsi2_sk")).alias("last_crawled_end"),
        a["last_scraped_start"]["S"].alias("last_scraped_start"),
        F.coalesce(_text(a, "last_scraped_end"), _text(a, "gsi3_sk")).alias("last_scraped_end"))


def with_index_columns(df: DataFrame, kind: str) -> DataFrame:
    """Sparse index keys: null wherever the row is not part of the index."""
    if kind == "url":
        typed = F.col("type").isNotNull()
        return df.withColumns({"gsi1_pk": F.when(typed, states.shop_key(F.col("domain"))), "gsi1_sk": F.col("type")})
    located = F.col("shop_country").isNotNull() & (F.col("shop_country") != "")

    def end(name: str) -> Column:
        return F.when(located, F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(STATE_NEVER)))

    core = F.nullif(F.col("core_domain_name"), F.lit(""))
    return df.withColumns({
        "gsi2_pk": F.when(located, F.col("shop_country")), "gsi2_sk": end("last_crawled_end"),
        "gsi3_pk": F.when(located, F.col("shop_country")), "gsi3_sk": end("last_scraped_end"),
        "gsi4_pk": core, "gsi4_sk": F.when(core.isNotNull(), F.col("domain"))})


def encode_items(df: DataFrame, kind: str) -> DataFrame:
    """Inverse of :func:`decode_items`: JSON items without null attributes, index keys included."""
    keyed = with_index_columns(df, kind).withColumn("pk", states.shop_key(F.col("domain")))
    if kind == "url":
        keyed = keyed.withColumn("sk", states.url_key(F.col("url")))
        names = ["pk", "sk", "url", "type", "hash", "gsi1_pk", "gsi1_sk"]
    else:
        keyed = keyed.withColumn("sk", F.lit(META_KEY))
        names = ["pk", "sk", *SHOP_COLUMNS, "gsi2_pk", "gsi2_sk", "gsi3_pk", "gsi3_sk", "gsi4_pk", "gsi4_sk"]
    pairs = F.map_from_arrays(
        F.array(*[F.lit(n) for n in names]), F.array(*[F.struct(F.col(n).alias("S")) for n in names]))
    dropped = F.map_filter(pairs, lambda _, v: v["S"].isNotNull() & ((v["S"] != "") if kind == "shop" else F.lit(True)))
    return keyed.select(F.to_json(dropped).alias("item"))


def new_shops_frame(df: DataFrame) -> DataFrame:
    """Fill the defaults of freshly entered shops: core name, country key, type, both end states."""
    present = set(df.columns)

    def column(name: str) -> Column:
        return F.col(name) if name in present else F.lit(None).cast("string")

    return df.select(
        "domain", urls.core_domain(F.col("domain")).alias("core_domain_name"), column("shop_name").alias("shop_name"),
        column("shop_image").alias("shop_image"),
        F.coalesce(column("shop_type"), F.lit(DEFAULT_SHOP_TYPE)).alias("shop_type"),
        states.country_key(column("shop_country")).alias("shop_country"),
        column("last_crawled_start").alias("last_crawled_start"),
        states.validate_state(F.coalesce(column("last_crawled_end"), F.lit(STATE_NEVER))).alias("last_crawled_end"),
        column("last_scraped_start").alias("last_scraped_start"),
        states.validate_state(F.coalesce(column("last_scraped_end"), F.lit(STATE_NEVER))).alias("last_scraped_end"))
