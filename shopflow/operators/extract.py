"""Typed product records from cleaned page text: prompt, extraction, validation, payload."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from shopflow.functions import states, text
from shopflow.functions.columns import let, once
from shopflow.runtime import cut
from shopflow.schemas import CURRENCIES, EXTRACTED, EXTRACTED_KEYS, LANGUAGES, PRODUCT_STATES

SYSTEM_TEMPLATE = ("Extract one product of an antiques shop from the page text below as a JSON object that follows the "
                   "schema. Use its field names, null for what is missing, and no text around the object.\n\nSchema:\n%s")
USER_TEMPLATE = "Current time: %s\n\nPage text:\n%s"

# Words and signs read by the rule-based extractor.
_AMOUNT = r"([0-9]{1,3}(?:[., ][0-9]{3})+(?:[.,][0-9]{1,2})?(?![0-9])|[0-9]+(?:[.,][0-9]{1,2})?(?![0-9]))"
_SIGN = r"(EUR|GBP|USD|AUD|CAD|NZD|[€£$])"
_NUMBER_WORDS = r"(?iu)\b(?:art(?:ikel)?\.?\s*-?\s*nr|lot(?:\s*-?\s*nr)?|sku|item\s+no|ref)\b\.?\s*[:#]?\s*([A-Za-z0-9][\w-]*)"
_STATES = {
    "SOLD": ["sold", "verkauft", "vendu", "vendido"],
    "RESERVED": ["reserved", "reserviert", "réservé", "reservado"],
    "AVAILABLE": ["available", "in stock", "verfügbar", "auf lager", "vorrätig", "disponible"],
}
_FUNCTION_WORDS = {
    "de": ["und", "der", "die", "das", "ein", "mit", "nicht", "für"],
    "en": ["the", "and", "of", "with", "for", "is", "that", "by"],
    "fr": ["le", "la", "les", "des", "et", "une", "pour", "dans"],
    "es": ["el", "los", "las", "y", "una", "por", "para", "del"],
}


_ALLOWED = {"state": PRODUCT_STATES, "language": LANGUAGES, "currency": CURRENCIES}


def json_schema(kind: DataType, name: str = "") -> dict:
    """JSON schema of a record type: every member may be null, no others are allowed; named sets of values are listed."""
    if isinstance(kind, StructType):
        return {"type": ["object", "null"], "properties": {f.name: json_schema(f.dataType, f.name) for f in kind.fields}, "additionalProperties": False}
    if isinstance(kind, ArrayType):
        return {"type": ["array", "null"], "items": json_schema(kind.elementType)}
    types = {"string": "string", "bigint": "integer", "boolean": "boolean", "double": "number"}
    made = {"type": [types[kind.simpleString()], "null"]}
    return made | ({"enum": [*sorted(_ALLOWED[name]), None]} if name in _ALLOWED else {})


def record_schema(df: DataFrame) -> str:
    """The schema of the extracted record as JSON text."""
    kind = df.sparkSession.range(0).select(F.lit(None).cast(EXTRACTED).alias("r")).schema["r"].dataType
    return json.dumps(json_schema(kind), separators=(",", ":"))


def with_prompt(df: DataFrame, schema_json: str | None, now: Column, content: str = "clean") -> DataFrame:
    """Adds ``system_prompt``, with the schema of the extracted record if none is given, and ``user_prompt``; ``now`` is text or a timestamp."""
    schema_json = record_schema(df) if schema_json is None else schema_json
    if not isinstance(df.select(now.alias("n")).schema["n"].dataType, StringType):
        now = states.utc_text(now)
    return df.withColumns({
        "system_prompt": F.lit(SYSTEM_TEMPLATE % schema_json),
        "user_prompt": F.concat(F.lit(USER_TEMPLATE.split("%s")[0]), now, F.lit(USER_TEMPLATE.split("%s")[1]),
                                F.col(content))})


def _cents(number: Column) -> Column:
    """Minor units of a written amount; the last separator with one or two digits behind it is the decimal one."""
    whole = F.regexp_replace(F.regexp_replace(number, r"[.,][0-9]{1,2}$", ""), r"[., ]", "")
    part = F.rpad(F.regexp_extract(number, r"[.,]([0-9]{1,2})$", 1), 2, "0")
    return F.concat(whole, part).try_cast("decimal(38,0)")


def _language(hits: Column) -> Column:
    """Language with the most function words among the hits; the later one in the alphabet on a tie."""
    return F.array_max(F.array(*[
        F.struct(F.size(F.filter(hits, _one_of(words))).alias("n"), F.lit(code).alias("code"))
        for code, words in _FUNCTION_WORDS.items()]))["code"]


def _one_of(words: list[str]):
    return lambda w: w.isin(words)


def _state(hits: Column, words: Column) -> Column:
    found = F.lit("UNKNOWN")
    for name, phrases in reversed(_STATES.items()):
        single = F.exists(hits, _one_of([p for p in phrases if " " not in p]))
        hit = reduce(Column.__or__, [words.contains(f" {p} ") for p in phrases if " " in p], single)
        found = F.when(hit, name).otherwise(found)
    return found


def rule_reply(content: Column, url: Column) -> Column:
    """JSON reply of the rule-based extractor: first header as title, written price, state words, image links."""
    before = F.regexp_extract(content, _SIGN + r"\s*" + _AMOUNT, 0)
    after = F.regexp_extract(content, _AMOUNT + r"\s*" + _SIGN, 0)
    written = let(before, lambda w: F.when(w != "", w).otherwise(after))

    def price(w: Column) -> Column:
        sign = F.regexp_extract(w, _SIGN, 1)
        currency = F.when(sign == "€", "EUR").when(sign == "£", "GBP").when(sign == "$", "USD").otherwise(sign)
        amount = _cents(F.regexp_extract(w, _AMOUNT, 1))
        return F.when(w != "", F.struct(amount.alias("amount"), currency.alias("currency")))

    facts = F.struct(
        F.concat(F.lit(" "), text.word_text(content), F.lit(" ")).alias("words"),
        text.strip(F.regexp_extract(content, r"(?m)^#{1,6}[ \t]*(\S.*)$", 1)).alias("title"),
        F.regexp_extract(content, _NUMBER_WORDS, 1).alias("number"), let(written, price).alias("price"))

    telling = sorted({w for words in [*_FUNCTION_WORDS.values(), *_STATES.values()] for w in words if " " not in w})

    def reply(f: Column) -> Column:
        return let(F.filter(F.split(f["words"], " "), _one_of(telling)), lambda hits: with_hits(f, hits))

    def with_hits(f: Column, hits: Column) -> Column:
        own_number = F.when(f["number"] != "", f["number"]).otherwise(
            F.regexp_extract(url, r"([^/?#]+)/?(?:[?#].*)?$", 1))
        return F.to_json(F.struct(
            ((f["title"] != "") & (f["price"].isNotNull() | (f["number"] != ""))).alias("is_product"),
            own_number.alias("shopsProductId"),
            F.when(f["title"] != "", F.struct(f["title"].alias("text"), _language(hits).alias("language"))).alias("title"),
            f["price"].alias("price"), _state(hits, f["words"]).alias("state"),
            F.array_distinct(F.regexp_extract_all(content, F.lit(r"(?i)(https?://[^\s()\"'<>]+\.(?:jpe?g|png))"), 1))
            .alias("images")))

    return let(facts, reply)


def _kind(v: Column, path: str) -> Column:
    """JSON type of a member: BIGINT, STRING, BOOLEAN, OBJECT<..>, ARRAY<..>, VOID, or null when absent."""
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def _get(v: Column, path: str, dtype: str = "string") -> Column:
    return F.try_variant_get(v, path, dtype)


def _is_text(v: Column, path: str) -> Column:
    return F.coalesce(_kind(v, path) == "STRING", F.lit(False))


def _absent(v: Column, path: str) -> Column:
    return _kind(v, path).isNull() | (_kind(v, path) == "VOID")


def _checks(v: Column, body: Column) -> list[Column]:
    def bad(condition: Column, message: str) -> Column:
        return F.when(F.coalesce(condition, F.lit(True)), F.lit(message))

    def ltext(name: str, required: bool) -> list[Column]:
        absent = _absent(v, f"$.{name}")
        wrong = ~_kind(v, f"$.{name}").startswith("OBJECT")
        inside = ~F.coalesce(wrong, F.lit(True))
        return [
            bad(absent, f"{name}: missing") if required else F.lit(None).cast("string"),
            bad(~absent & wrong, f"{name}: not an object"),
            F.when(inside & ~_is_text(v, f"$.{name}.text"), f"{name}.text: not a text"),
            F.when(inside & ~F.coalesce(_get(v, f"$.{name}.language").isin(LANGUAGES), F.lit(False)),
                   f"{name}.language: not allowed")]

    def money(name: str) -> list[Column]:
        absent = _absent(v, f"$.{name}")
        wrong = ~_kind(v, f"$.{name}").startswith("OBJECT")
        inside = ~F.coalesce(wrong, F.lit(True))
        amount = _get(v, f"$.{name}.amount", "double")
        fits = _get(v, f"$.{name}.amount", "bigint").isNotNull()
        whole = fits & (amount >= 0) & (amount == F.floor(amount))
        return [
            bad(~absent & wrong, f"{name}: not an object"),
            F.when(inside & ~F.coalesce(whole, F.lit(False)), f"{name}.amount: not a non-negative integer"),
            F.when(inside & ~F.coalesce(_get(v, f"$.{name}.currency").isin(CURRENCIES), F.lit(False)),
                   f"{name}.currency: not allowed")]

    def optional_text(name: str) -> Column:
        return bad(~_absent(v, f"$.{name}") & ~_is_text(v, f"$.{name}"), f"{name}: not a text")

    images = _get(v, "$.images", "array<string>")
    image_kind = _kind(v, "$.images")
    return [
        F.when(F.size(F.array_except(F.json_object_keys(body), F.array(*[F.lit(k) for k in EXTRACTED_KEYS]))) > 0,
               "unknown member"),
        bad(_kind(v, "$.is_product").isNotNull() & (_kind(v, "$.is_product") != "BOOLEAN"), "is_product: not a boolean"),
        bad(~_is_text(v, "$.shopsProductId"), "shopsProductId: missing or not a text"),
        *ltext("title", True), *ltext("description", False),
        *money("price"), *money("priceEstimateMin"), *money("priceEstimateMax"),
        bad(~F.coalesce(_get(v, "$.state").isin(PRODUCT_STATES), F.lit(False)), "state: missing or not allowed"),
        bad(image_kind.isNotNull() & ~image_kind.startswith("ARRAY"), "images: not a list"),
        F.when(F.exists(images, lambda u: ~F.coalesce(u.rlike(r"(?i)^https?://[^\s/?#]+"), F.lit(False))),
               "images: not a web address"),
        optional_text("auctionStart"), optional_text("auctionEnd"),
    ]


def _record(v: Column) -> Column:
    def ltext(name: str) -> Column:
        return F.when(~_absent(v, f"$.{name}"), F.struct(
            _get(v, f"$.{name}.text").alias("text"), _get(v, f"$.{name}.language").alias("language")))

    def money(name: str) -> Column:
        return F.when(~_absent(v, f"$.{name}"), F.struct(
            _get(v, f"$.{name}.amount", "bigint").alias("amount"), _get(v, f"$.{name}.currency").alias("currency")))

    return F.struct(
        F.coalesce(_get(v, "$.is_product", "boolean"), F.lit(False)).alias("is_product"),
        _get(v, "$.shopsProductId").alias("shopsProductId"), ltext("title").alias("title"),
        ltext("description").alias("description"), money("price").alias("price"),
        money("priceEstimateMin").alias("priceEstimateMin"), money("priceEstimateMax").alias("priceEstimateMax"),
        _get(v, "$.state").alias("state"),
        F.coalesce(_get(v, "$.images", "array<string>"), F.array().cast("array<string>")).alias("images"),
        _get(v, "$.auctionStart").alias("auctionStart"), _get(v, "$.auctionEnd").alias("auctionEnd")).cast(EXTRACTED)


def with_extracted(df: DataFrame, reply: str = "reply") -> DataFrame:
    """Adds ``extracted`` (null when invalid) and ``errors``, one entry per failed check, from a reply text."""
    body = once(df, _body=text.salvage_json(F.col(reply)))
    parsed = once(body, _v=F.try_parse_json("_body"))
    v = F.col("_v")
    empty = ~F.coalesce(F.schema_of_variant(v).startswith("OBJECT<") & (F.size(F.json_object_keys("_body")) > 0),
                        F.lit(False))
    errors = F.when(empty, F.array(F.lit("no data"))).otherwise(F.array_compact(F.array(*_checks(v, F.col("_body")))))
    checked = once(parsed, errors=errors)
    return once(checked, extracted=F.when(F.size("errors") == 0, _record(v))).drop("_v", "_body")


def validate_extracted(df: DataFrame, reply: str = "reply") -> tuple[DataFrame, DataFrame]:
    """(valid rows with ``extracted``, invalid rows with one row per failed check)."""
    checked = with_extracted(df, reply)
    bad = checked.where(F.size("errors") > 0).drop("extracted")
    return (checked.where(F.size("errors") == 0).drop("errors"),
            bad.withColumn("error", F.explode("errors")).drop("errors"))


def _guarded(extractor: Callable[[pd.Series], pd.Series]) -> Callable[[pd.Series], pd.DataFrame]:
    """The extractor with failures as values: a batch that raises is tried again text by text."""
    def one(text: str) -> tuple[str | None, str | None]:
        try:
            return extractor(pd.Series([text])).iloc[0], None
        except Exception as e:
            return None, f"{type(e).__name__}: {e}"

    def run(texts: pd.Series) -> pd.DataFrame:
        try:
            return pd.DataFrame({"reply": list(extractor(texts)), "error": None})
        except Exception:
            return pd.DataFrame([one(t) for t in texts], columns=["reply", "error"])

    return run


def extract_products(df: DataFrame, extractor: Callable[[pd.Series], pd.Series] | None = None,
                     content: str = "clean") -> DataFrame:
    """Adds ``reply``, ``extract_error``, ``extracted`` and ``errors``.

    ``extractor`` maps a batch of texts (say, prompts to a model) to a batch of reply texts. Its replies are written once,
    so neither a second output nor a lost executor asks it again; a text on which it raises has the error as
    ``extract_error`` and no reply. Without an extractor the rule-based one is used, which stays in the JVM.
    """
    if extractor is None:
        return with_extracted(once(df, reply=rule_reply(F.col(content), F.col("url"))).withColumn("extract_error", F.lit(None).cast("string")))
    asked = df.withColumn("_r", F.pandas_udf(_guarded(extractor), "reply string, error string")(F.col(content)))
    return with_extracted(cut(asked.select(*df.columns, F.col("_r.reply").alias("reply"), F.col("_r.error").alias("extract_error"))))


def looks_like_product(content: Column, url: Column) -> Column:
    """Decision of the rule-based extractor alone."""
    return F.coalesce(F.get_json_object(rule_reply(content, url), "$.is_product") == "true", F.lit(False))


def to_payload(df: DataFrame, include_estimates: bool = False) -> DataFrame:
    """Flat payload of valid records; the price estimates only when asked for."""
    e = F.col("extracted")
    columns = [
        F.col("url"), e["shopsProductId"].alias("shops_product_id"), e["title"].alias("title"),
        e["description"].alias("description"), e["price"].alias("price"), e["state"].alias("state"),
        e["images"].alias("images"), e["auctionStart"].alias("auction_start"), e["auctionEnd"].alias("auction_end")]
    if include_estimates:
        columns += [e["priceEstimateMin"].alias("price_estimate_min"), e["priceEstimateMax"].alias("price_estimate_max")]
    kept = [F.col("domain")] if "domain" in df.columns else []
    return df.where(e.isNotNull()).select(*kept, *columns)
