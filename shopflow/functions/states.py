"""Keys, life-cycle states and time text as column expressions."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, functions as F

from shopflow.schemas import (
    COUNTRY_PREFIX, DEFAULT_SHOP_TYPE, SHOP_PREFIX, SHOP_TYPES, STATE_DONE, STATE_NEVER, STATE_PROGRESS, URL_PREFIX,
)

STATE_PATTERN = f"^(?:{STATE_NEVER}|{STATE_PROGRESS}.+|{STATE_DONE}.+)$"
OPERATIONS = {"crawl": "last_crawled", "scrape": "last_scraped"}


def _blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def shop_key(domain: Column) -> Column:
    return F.concat(F.lit(SHOP_PREFIX), domain)


def url_key(url: Column) -> Column:
    return F.concat(F.lit(URL_PREFIX), url)


def country_key(country: Column) -> Column:
    """Adds the country prefix once; null and empty stay as they are."""
    return (F.when(country.startswith(COUNTRY_PREFIX) | (country == ""), country)
            .otherwise(F.concat(F.lit(COUNTRY_PREFIX), country)))


def domain_from_key(key: Column) -> Column:
    """Domain of a shop key; only a leading prefix goes."""
    return F.when(key.startswith(SHOP_PREFIX), F.substring(key, len(SHOP_PREFIX) + 1, 1 << 30)).otherwise(key)


def is_valid_state(state: Column) -> Column:
    return state.isNull() | state.rlike(STATE_PATTERN)


def validate_state(state: Column) -> Column:
    """The state itself; fails the job on a malformed one. Use :func:`is_valid_state` to split rejects."""
    return F.when(is_valid_state(state), state).otherwise(
        F.raise_error(F.concat(F.lit("Invalid state value: "), state)).cast("string"))


def parse_state(state: Column, strict: bool = True) -> Column:
    """``STRUCT<state, ts>``; null in gives null out, an unknown prefix fails (or is null when not strict)."""

    def pair(name: str, ts: Column) -> Column:
        return F.struct(F.lit(name).alias("state"), ts.cast("string").alias("ts"))

    def rest(prefix: str) -> Column:
        return F.substring(state, len(prefix) + 1, 1 << 30)

    unknown = F.lit(None).cast("struct<state:string,ts:string>")
    if strict:
        unknown = F.when(state.isNotNull(), F.raise_error(F.concat(F.lit("Invalid state key: "), state))
                         .cast("struct<state:string,ts:string>"))
    return (F.when(state.startswith(STATE_NEVER), pair(STATE_NEVER, F.lit(None)))
            .when(state.startswith(STATE_PROGRESS), pair(STATE_PROGRESS, rest(STATE_PROGRESS)))
            .when(state.startswith(STATE_DONE), pair(STATE_DONE, rest(STATE_DONE)))
            .otherwise(unknown))


def operation_column(operation: str, suffix: str = "end") -> str:
    if operation not in OPERATIONS:
        raise ValueError(f"operation must be 'crawl' or 'scrape', got: {operation}")
    return f"{OPERATIONS[operation]}_{suffix}"


def utc_text(at: Column) -> Column:
    """A timestamp as ISO text in UTC, to the second."""
    return F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def cutoff(now: datetime | None = None, days: int = 2) -> str:
    """ISO text of ``now - days`` in UTC."""
    now = now or datetime.now(timezone.utc)
    return (now.astimezone(timezone.utc) - timedelta(days=days)).isoformat()


def shop_type(name: Column) -> Column:
    return F.when(name.isin(SHOP_TYPES), name).otherwise(F.lit(DEFAULT_SHOP_TYPE))


def display_name(shop_name: Column, core_name: Column, derived_core: Column) -> Column:
    return F.coalesce(_blank_to_null(shop_name), _blank_to_null(core_name), derived_core)
