"""Table schemas and allowed values. Nothing is inferred when reading."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values.
STATE_NEVER = "NEVER#"
STATE_PROGRESS = "PROGRESS#"
STATE_DONE = "DONE#"
SHOP_PREFIX = "SHOP#"
URL_PREFIX = "URL#"
COUNTRY_PREFIX = "COUNTRY#"
META_KEY = "META#"
DEFAULT_SHOP_TYPE = "COMMERCIAL_DEALER"
DEFAULT_COUNTRY = "DE"

# Fixed values.
PRODUCT_STATES = ["AVAILABLE", "SOLD", "LISTED", "RESERVED", "REMOVED", "UNKNOWN"]
LANGUAGES = ["de", "en", "fr", "es"]
CURRENCIES = ["EUR", "GBP", "USD", "AUD", "CAD", "NZD"]
SHOP_TYPES = ["AUCTION_HOUSE", "AUCTION_PLATFORM", "COMMERCIAL_DEALER", "MARKETPLACE"]

# Sort fields a caller may name.
PRODUCT_SORTS = ["created", "originYear", "price", "score", "updated"]
SHOP_SORTS = ["created", "name", "score", "updated"]
MAX_DOMAINS_PER_SHOP = 100
MAX_WATCHED_PER_USER = 5
PAGE_SIZE = 21

SHOP_COLUMNS = [
    "domain", "core_domain_name", "shop_name", "shop_image", "shop_type", "shop_country",
    "last_crawled_start", "last_crawled_end", "last_scraped_start", "last_scraped_end",
]
URL_COLUMNS = ["domain", "url", "type", "hash"]

ITEM_MAP = "MAP<STRING, STRUCT<S: STRING>>"
ITEM = T.StructType([T.StructField("item", T.StringType())])
MESSAGE = T.StructType([T.StructField("domain", T.StringType()), T.StructField("next", T.StringType())])
CHANGE = (
    "eventID STRING, eventName STRING, "
    f"dynamodb STRUCT<NewImage: {ITEM_MAP}, SequenceNumber: STRING>"
)

PAGES = "domain STRING, url STRING, html STRING, markdown STRING, success BOOLEAN, error STRING"
EDGES = "src_url STRING, dst_url STRING, kind STRING, ord INT"
BLOCKS = "domain STRING, blocks ARRAY<ARRAY<STRING>>, checked_at TIMESTAMP"

MONEY = "STRUCT<amount: BIGINT, currency: STRING>"
LTEXT = "STRUCT<text: STRING, language: STRING>"
EXTRACTED = (
    f"STRUCT<is_product: BOOLEAN, shopsProductId: STRING, title: {LTEXT}, description: {LTEXT}, price: {MONEY}, "
    f"priceEstimateMin: {MONEY}, priceEstimateMax: {MONEY}, state: STRING, images: ARRAY<STRING>, "
    "auctionStart: STRING, auctionEnd: STRING>"
)
EXTRACTED_KEYS = [
    "is_product", "shopsProductId", "title", "description", "price", "priceEstimateMin", "priceEstimateMax",
    "state", "images", "auctionStart", "auctionEnd",
]
PRODUCTS = (
    f"shop_id STRING, shops_product_id STRING, shop_name STRING, shop_type STRING, url STRING, title {LTEXT}, "
    f"description {LTEXT}, state STRING, price {MONEY}, price_estimate_min {MONEY}, price_estimate_max {MONEY}, "
    "images ARRAY<STRUCT<url: STRING, prohibited_content: STRING>>, origin_year INT, origin_year_min INT, "
    "origin_year_max INT, authenticity STRING, condition STRING, provenance STRING, restoration STRING, "
    "auction_start TIMESTAMP, auction_end TIMESTAMP, created TIMESTAMP, updated TIMESTAMP"
)
SUMMARY_COLUMNS = [
    "shop_id", "shops_product_id", "shop_name", "shop_type", "url", "title", "state", "price",
    "price_estimate_min", "price_estimate_max", "images", "auction_start", "auction_end", "created", "updated",
]
PRODUCT_KEY = ["shop_id", "shops_product_id"]
