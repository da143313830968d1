"""Product catalogue: filters, paging, views, events, enrichment, watchlists.

The contract behind these operators names inputs, outputs and rules but no formulas; where a choice was needed it is
stated in the docstring.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shopflow.functions import text, urls
from shopflow.operators.skew import look_back, previous_row, salted_join, top_per_key
from shopflow.schemas import (
    CURRENCIES, LANGUAGES, MAX_WATCHED_PER_USER, PAGE_SIZE, PRODUCT_KEY, PRODUCT_SORTS, SHOP_SORTS, SUMMARY_COLUMNS,
)

MAX_AMOUNT = (1 << 63) - 1
Range = tuple


def _between(value: Column, bounds: Range | None) -> Column | None:
    if bounds is None:
        return None
    low, high = bounds
    parts = ([value >= F.lit(low)] if low is not None else []) + ([value <= F.lit(high)] if high is not None else [])
    return reduce(Column.__and__, parts) & value.isNotNull() if parts else value.isNotNull()


def _all(predicates: list[Column | None]) -> Column:
    given = [p for p in predicates if p is not None]
    return reduce(Column.__and__, given) if given else F.lit(True)


def query_words(query: str) -> list[str]:
    return sorted({w for w in "".join(c if c.isalnum() else " " for c in query.lower()).split()})


def product_text() -> Column:
    return F.concat_ws(" ", F.col("title.text"), F.col("description.text"))


def product_words() -> Column:
    return text.words(product_text())


@dataclass
class SearchFilter:
    """A product search as data; unset members do not restrict.

    The text matches when every query word is a word of the title or description. A price range compares amounts of
    products in ``currency``; convert first to compare others. An origin year range matches products whose year
    interval meets it.
    """

    language: str
    currency: str
    product_query: str
    shop_name: list[str] | None = None
    exclude_shop_name: list[str] | None = None
    shop_type: list[str] | None = None
    price: Range | None = None
    state: list[str] | None = None
    origin_year: Range | None = None
    authenticity: list[str] | None = None
    condition: list[str] | None = None
    provenance: list[str] | None = None
    restoration: list[str] | None = None
    created: Range | None = None
    updated: Range | None = None
    auction_start: Range | None = None
    auction_end: Range | None = None
    _lists: tuple = field(default=("shop_name", "shop_type", "state", "authenticity", "condition", "provenance",
                                   "restoration"), repr=False)

    def __post_init__(self):
        if self.language not in LANGUAGES or self.currency not in CURRENCIES:
            raise ValueError(f"unsupported language or currency: {self.language}, {self.currency}")
        if len(self.product_query) < 3:
            raise ValueError("the text query needs at least 3 characters")

    def predicates(self) -> Column:
        """Everything but the text."""
        lists = [F.col(c).isin(getattr(self, c)) for c in self._lists if getattr(self, c)]
        excluded = None
        if self.exclude_shop_name:
            excluded = F.col("shop_name").isNull() | ~F.col("shop_name").isin(self.exclude_shop_name)
        price = _between(F.col("price.amount"), self.price)
        if price is not None:
            price = price & (F.col("price.currency") == self.currency)
        years = None
        if self.origin_year is not None:
            low, high = self.origin_year
            first = F.coalesce("origin_year_min", "origin_year", "origin_year_max")
            last = F.coalesce("origin_year_max", "origin_year", "origin_year_min")
            years = first.isNotNull() & (F.lit(True) if high is None else first <= high) & (
                F.lit(True) if low is None else last >= low)
        times = [_between(F.col(c), getattr(self, c)) for c in ("created", "updated", "auction_start", "auction_end")]
        return _all([*lists, excluded, price, years, *times])

    def to_column(self) -> Column:
        """The whole search as one predicate, cheap comparisons before the text."""
        wanted = F.array(*[F.lit(w) for w in query_words(self.product_query)])
        return self.predicates() & (F.size(F.array_except(wanted, product_words())) == 0)


@dataclass
class ShopFilter:
    """A shop search: every word of ``name_query`` occurs in the name, a type list, time ranges."""

    name_query: str | None = None
    shop_type: list[str] | None = None
    created: Range | None = None
    updated: Range | None = None

    def to_column(self) -> Column:
        named = None
        if self.name_query:
            wanted = F.array(*[F.lit(w) for w in query_words(self.name_query)])
            named = F.size(F.array_except(wanted, text.words(F.col("name")))) == 0
        return _all([F.col("shop_type").isin(self.shop_type) if self.shop_type else None,
                     _between(F.col("created"), self.created), _between(F.col("updated"), self.updated), named])


def sort_column(name: str, kind: str = "product") -> Column:
    allowed = {"product": PRODUCT_SORTS, "shop": SHOP_SORTS}.get(kind, ["created"])
    if name not in allowed:
        raise ValueError(f"cannot sort {kind} by {name}; one of {allowed}")
    return {"originYear": F.col("origin_year"), "price": F.col("price.amount") if kind == "product" else None}.get(
        name, F.col(name))


def page(df: DataFrame, sort: Column, ids: list[str], order: str = "asc", size: int = PAGE_SIZE,
         after: tuple | None = None, with_total: bool = False) -> DataFrame:
    """One page in (sort value, id) order, strictly after the cursor ``after = (sort value, id, ...)``.

    Adds ``cursor`` to every row: that of the last row continues the listing. Missing values sort first upwards and
    last downwards. ``with_total`` adds the number of matches before paging.
    """
    if order not in ("asc", "desc"):
        raise ValueError(f"order must be 'asc' or 'desc', got: {order}")
    cursor = F.struct(sort.alias("sort_value"), *[F.col(c).alias(f"id{i}") for i, c in enumerate(ids)])
    keyed = df.withColumn("cursor", cursor)
    types = keyed.schema["cursor"].dataType.fields
    rest = keyed
    if after is not None:
        start = F.struct(*[F.lit(v).cast(t.dataType).alias(t.name) for v, t in zip(after, types)])
        rest = keyed.where(F.col("cursor") > start if order == "asc" else F.col("cursor") < start)
    ordered = rest.orderBy(F.col("cursor").asc() if order == "asc" else F.col("cursor").desc()).limit(size)
    if with_total:
        ordered = ordered.withColumn("total", df.select(F.count(F.lit(1))).scalar())
    return ordered


def next_cursor(paged: DataFrame, order: str = "asc") -> DataFrame:
    """Cursor of the last row of a page; null for an empty page."""
    return paged.agg((F.max("cursor") if order == "asc" else F.min("cursor")).alias("search_after"))


def page_by_key(df: DataFrame, keys: list[str], n: int, token: tuple | None = None) -> DataFrame:
    """Up to ``n`` rows after ``token`` in key order, with ``has_more`` telling whether rows follow."""
    key = F.struct(*keys)
    rest = df
    if token is not None:
        types = df.select(*keys).schema.fields
        rest = df.where(key > F.struct(*[F.lit(v).cast(t.dataType).alias(t.name) for v, t in zip(token, types)]))
    ahead = rest.orderBy(*keys).limit(n + 1)
    return (ahead.withColumn("has_more", ahead.select(F.count(F.lit(1))).scalar() > n)
            .orderBy(*keys).limit(n))


def saved_searches_of(filters: DataFrame, user_id, order: str = "desc", offset: int = 0,
                      size: int = PAGE_SIZE) -> DataFrame:
    """A user's saved searches by creation time, with the total."""
    own = filters.where(F.col("user_id") == user_id)
    keys = [F.col(c).asc() if order == "asc" else F.col(c).desc() for c in ("created", "filter_id")]
    total = own.select(F.count(F.lit(1))).scalar()
    return own.withColumn("total", total).orderBy(*keys).offset(offset).limit(size)


def history(events: DataFrame, **key) -> DataFrame:
    """Events of one product by time, those of one moment by type."""
    for name, value in key.items():
        events = events.where(F.col(name) == value)
    return events.orderBy("timestamp", "event_type", "event_id")


def summary(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in SUMMARY_COLUMNS if c in df.columns])


def convert_price(df: DataFrame, rates: DataFrame, currency: str, column: str = "price") -> DataFrame:
    """Show a price in another currency by rates (from, to, rate); null where no rate is known.

    The allowed currencies bound the rates that can match to one row per source currency.
    """
    useful = (rates.where((F.col("to") == currency) & F.col("from").isin(CURRENCIES))
              .groupBy(F.col("from").alias("_from")).agg(F.max("rate").alias("_rate")))
    joined = df.join(F.broadcast(useful), F.col(f"{column}.currency") == F.col("_from"), "left")
    amount = F.when(F.col(f"{column}.currency") == currency, F.col(f"{column}.amount")).otherwise(
        F.round(F.col(f"{column}.amount") * F.col("_rate")).cast("long"))
    return joined.withColumn(column, F.when(amount.isNotNull(), F.struct(
        amount.alias("amount"), F.lit(currency).alias("currency")))).drop("_from", "_rate")


def price_event(old: Column, new: Column) -> Column:
    same = old["currency"] == new["currency"]
    return (F.when(old.isNull() & new.isNotNull(), "PRICE_DISCOVERED")
            .when(old.isNotNull() & new.isNull(), "PRICE_REMOVED")
            .when(same & (new["amount"] < old["amount"]), "PRICE_DROPPED")
            .when(same & (new["amount"] > old["amount"]), "PRICE_INCREASED"))


def events_between(df: DataFrame, keys: list[str], first: Column, old_price: Column, new_price: Column,
                   old_state: Column, new_state: Column, ts: str) -> DataFrame:
    """Event rows for observations with their predecessor; prices compare only within one currency."""
    created = F.when(first, F.struct(
        F.lit("CREATED").alias("event_type"), F.lit(None).cast(new_price_type(df)).alias("old_price"),
        new_price.alias("new_price"), F.lit(None).cast("string").alias("old_state"), new_state.alias("new_state")))
    kind = price_event(old_price, new_price)
    none = F.lit(None).cast("string")
    priced = F.when(~first & kind.isNotNull(), F.struct(
        kind.alias("event_type"), old_price.alias("old_price"), new_price.alias("new_price"),
        none.alias("old_state"), none.alias("new_state")))
    moved = F.when(~first & ~old_state.eqNullSafe(new_state), F.struct(
        F.concat(F.lit("STATE_"), new_state).alias("event_type"), F.lit(None).cast(new_price_type(df)).alias("old_price"),
        F.lit(None).cast(new_price_type(df)).alias("new_price"), old_state.alias("old_state"),
        new_state.alias("new_state")))
    exploded = df.select(*keys, F.col(ts).alias("timestamp"),
                         F.explode(F.array_compact(F.array(created, priced, moved))).alias("e"))
    return exploded.select(
        *keys, F.sha2(F.concat_ws("|", *keys, F.col("timestamp").cast("string"), F.col("e.event_type")), 256)
        .alias("event_id"), "e.event_type", "e.old_price", "e.new_price", "e.old_state", "e.new_state", "timestamp")


def new_price_type(df: DataFrame):
    return df.schema["price"].dataType


def derive_events(observations: DataFrame, keys: list[str] = PRODUCT_KEY, ts: str = "observed_at",
                  tie: tuple[str, ...] = (), ranges: int | None = None) -> DataFrame:
    """Events from consecutive observations (keys, ``ts``, price, state) of each product.

    The first observation gives CREATED, later ones price and state events where something changed.
    """
    seen = previous_row(observations.withColumn("_seen", F.lit(True)), keys, [ts, *tie], ["_seen", "price", "state"],
                        "prev", ranges)
    return events_between(seen, keys, F.col("prev").isNull(), F.col("prev.price"), F.col("price"),
                          F.col("prev.state"), F.col("state"), ts)


def enrich_with_shop(products: DataFrame, shops: DataFrame) -> DataFrame:
    """Adds shop_id and shop_name by the host of the product URL, or ``error``.

    ``shops`` is (shop_id, shop_name, domains). The host counts with and without ``www.``; of two
    shops that claim it the smaller id owns it.
    """
    listed = shops.select("shop_id", "shop_name", F.explode("domains").alias("_host"))
    domains = listed.groupBy(urls.normalize_domain(F.col("_host")).alias("_host")).agg(
        F.min(F.struct("shop_id", "shop_name")).alias("s")).select("_host", "s.*")
    found = F.regexp_replace(urls.host(F.col("url")), r"^www\.", "")
    hosted = products.drop("shop_id", "shop_name").withColumn("_host", F.when(found.contains("."), found))
    return (salted_join(hosted, domains, ["_host"], ["url"])
            .withColumn("error", F.when(F.col("_host").isNull(), "NO_DOMAIN").when(F.col("shop_id").isNull(),
                                                                                   "SHOP_NOT_FOUND"))
            .drop("_host"))


def overflow(amount: Column) -> Column:
    """True when an amount (decimal) does not fit the catalogue's integer."""
    return F.coalesce(amount > F.lit(MAX_AMOUNT).cast("decimal(20,0)"), F.lit(False))


def put_results(incoming: DataFrame, catalogue: DataFrame, compare: list[str], order: list[str] | None = None) -> DataFrame:
    """Adds ``outcome`` to enriched products: failed, created, updated, or skipped when nothing changed; ``before``, the state
    and price a row meets; ``put_no``, its place among the puts of its product.

    A row meets the put of its product before it in ``order`` (then by content), the first one meets the catalogue.
    """
    kept = list(dict.fromkeys([*compare, "price", "state"]))
    tie = F.xxhash64(*[c for c in incoming.columns if c not in PRODUCT_KEY])
    seen = look_back(incoming.where("error IS NULL").withColumn("_tie", tie), PRODUCT_KEY, [*(order or []), "_tie"], "put_no", kept, "_put").drop("_tie")
    old = catalogue.select(*PRODUCT_KEY, F.struct(*kept).alias("_stored"))
    joined = seen.join(old, PRODUCT_KEY, "left").withColumn("before", F.coalesce("_put", "_stored")).drop("_put", "_stored")
    same = reduce(Column.__and__, [F.col(f"before.{c}").eqNullSafe(F.col(c)) for c in compare])
    judged = joined.withColumn("outcome", F.when(F.col("before").isNull(), "created").when(same, "skipped").otherwise("updated"))
    failed = incoming.where("error IS NOT NULL").withColumn("outcome", F.lit("failed"))
    return judged.unionByName(failed, allowMissingColumns=True)


def mark_unprocessed(results: DataFrame, lost: DataFrame) -> DataFrame:
    """Puts of the products in ``lost`` (key, _reason) that would have been written become ``unprocessed`` with that reason."""
    hit = F.col("_reason").isNotNull() & F.col("outcome").isin("created", "updated")
    joined = results.join(lost, PRODUCT_KEY, "left")
    return joined.withColumn("error", F.when(hit, F.col("_reason")).otherwise(F.col("error"))).withColumn(
        "outcome", F.when(hit, "unprocessed").otherwise(F.col("outcome"))).drop("_reason")


def put_problems(results: DataFrame) -> DataFrame:
    """A row for each put that did not take effect, with its reason; for batches of any size."""
    return results.where(F.col("outcome").isin("failed", "unprocessed")).select("url", "outcome", "error")


def put_summary(results: DataFrame, batch: str = "batch_no") -> DataFrame:
    """Per batch (of bounded size): skipped count, unprocessed URLs, failed URLs with their code."""
    return results.groupBy(batch).agg(
        F.count_if(F.col("outcome") == "skipped").alias("skipped"),
        F.array_sort(F.collect_list(F.when(F.col("outcome") == "unprocessed", F.col("url")))).alias("unprocessed"),
        F.map_from_entries(F.array_sort(F.collect_set(F.when(F.col("outcome") == "failed", F.struct("url", "error")))))
        .alias("failed"))


def with_user_state(products: DataFrame, watchlist: DataFrame, user_id=None) -> DataFrame:
    """Adds ``user_state`` (watching, notifications) of one user; null without a user."""
    kind = "struct<watching:boolean,notifications:boolean>"
    if user_id is None:
        return products.withColumn("user_state", F.lit(None).cast(kind))
    own = watchlist.where(F.col("user_id") == user_id).select(*PRODUCT_KEY, F.col("notifications").alias("_n"),
                                                              F.lit(True).alias("_w"))
    state = F.struct(F.coalesce("_w", F.lit(False)).alias("watching"), F.coalesce("_n", F.lit(False)).alias("notifications"))
    return products.join(own, PRODUCT_KEY, "left").withColumn("user_state", state).drop("_w", "_n")


def watchlist_page(watchlist: DataFrame, products: DataFrame, user_id, order: str = "desc", size: int = PAGE_SIZE,
                   after: tuple | None = None) -> DataFrame:
    """A user's watched products with their detail, newest first by default."""
    own = watchlist.where(F.col("user_id") == user_id).select(
        "user_id", *PRODUCT_KEY, "notifications", F.col("created").alias("watched_since"))
    detail = own.join(products, PRODUCT_KEY)
    return page(detail, F.col("watched_since"), PRODUCT_KEY, order, size, after)


def admit(existing: DataFrame, new: DataFrame, limit: int = MAX_WATCHED_PER_USER) -> DataFrame:
    """Adds ``admitted``: whether a watch request fits into the user's limit, in order of ``created``.

    Requests repeat the user and product key at most once; a product already watched is not admitted again.
    """
    keys = ["user_id", *PRODUCT_KEY]
    fresh = top_per_key(new, keys, [F.col("created")]).join(existing.select(*keys), keys, "left_anti")
    taken = existing.groupBy("user_id").agg(F.count(F.lit(1)).alias("_taken"))
    first = top_per_key(fresh.select(*keys, "created"), ["user_id"], [F.col("created"), *map(F.col, PRODUCT_KEY)], limit)
    ranked = first.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("created", *PRODUCT_KEY))).alias("_q"))
    room = ranked.join(taken, "user_id", "left").withColumn(
        "_room", F.greatest(F.lit(0), limit - F.coalesce("_taken", F.lit(0))).cast("int"))
    chosen = room.select("user_id", F.explode(F.slice("_q", F.lit(1), F.col("_room"))).alias("q")).select(
        "user_id", "q.*", F.lit(True).alias("_ok"))
    return (new.join(chosen, [*keys, "created"], "left")
            .withColumn("admitted", F.coalesce("_ok", F.lit(False))).drop("_ok"))


def utc(value: str) -> datetime:
    return datetime.fromisoformat(value.replace("Z", "+00:00"))
