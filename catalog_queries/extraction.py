from __future__ import annotations

import json

from pyspark.sql import functions as F

from catalog_queries.registry import query
from shopflow.operators import extract as E
from shopflow.functions import text as T


def _reply(read):
    """A reply per part, broken in a different way by part key."""
    k = F.col("p_partkey")
    p = k.cast("string")
    good = F.concat(
        F.lit('{"is_product": true, "shopsProductId": "'), p, F.lit('", "title": {"text": "'), F.col("p_name"), F.lit('", "language": "'),
        F.when(k % 8 == 1, F.lit("it")).otherwise(F.lit("en")), F.lit('"}, "price": {"amount": '),
        F.when(k % 8 == 2, F.lit("-5")).when(k % 8 == 3, F.lit("1.5")).otherwise(p), F.lit(', "currency": "EUR"}, "state": "'),
        F.when(k % 8 == 4, F.lit("GONE")).otherwise(F.lit("SOLD")), F.lit('"'),
        F.when(k % 8 == 5, F.lit(', "extra": 1')).otherwise(F.lit("")),
        F.when(k % 8 == 6, F.lit(', "images": ["ftp://a/b.jpg"]')).otherwise(F.lit(', "images": ["https://a.b/c.jpg"]')), F.lit("}"))
    return read("part").select(k, F.when(k % 8 == 7, F.lit("sorry, no data")).when(k % 3 == 1, F.concat(F.lit("Here: "), good, F.lit(" and {more}")))
                               .otherwise(good).alias("reply"))


@query("""SELECT p_partkey, CASE p_partkey % 8 WHEN 1 THEN 'title.language: not allowed' WHEN 2 THEN 'price.amount: not a non-negative integer'
  WHEN 3 THEN 'price.amount: not a non-negative integer' WHEN 4 THEN 'state: missing or not allowed' WHEN 5 THEN 'unknown member'
  WHEN 6 THEN 'images: not a web address' WHEN 7 THEN 'no data' ELSE '' END AS errors,
  CASE WHEN p_partkey % 8 = 0 THEN p_name END AS title, CASE WHEN p_partkey % 8 = 0 THEN p_partkey END AS amount FROM part""")
def validate_replies(read):
    checked = E.with_extracted(_reply(read))
    return checked.select("p_partkey", F.array_join("errors", ";").alias("errors"), F.col("extracted.title.text").alias("title"),
                          F.col("extracted.price.amount").alias("amount"))


@query("""SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '{"a": ' || p_partkey || '}' WHEN 1 THEN '{"a": {"b": ' || p_partkey || '}}'
  WHEN 2 THEN '{}' WHEN 3 THEN '{"t": "x y"}' ELSE '{"a": 1}' END AS json FROM part""")
def salvage_json(read):
    k, p = F.col("p_partkey") % 5, F.col("p_partkey").cast("string")
    reply = (F.when(k == 0, F.concat(F.lit('{"a": '), p, F.lit("}"))).when(k == 1, F.concat(F.lit('```json\n{"a": {"b": '), p, F.lit("}}\n```")))
             .when(k == 2, F.concat(F.lit('{"a": '), p)).when(k == 3, F.lit('text {"t": "x\ny"}')).otherwise(F.lit('{"a": 1} {"b": 2}')))
    return read("part").select("p_partkey", T.salvage_json(reply).alias("json"))


@query("""SELECT doc_id, '# ' || doc_id || ' old chair' AS header_title, (doc_id % 9000 + 1) * 100 + 50 AS amount, CASE doc_id % 3 WHEN 0 THEN 'SOLD' WHEN 1 THEN 'RESERVED' ELSE 'AVAILABLE' END AS state,
  'A-' || doc_id AS number FROM documents""".replace("'# ' || doc_id || ' old chair' AS header_title", "doc_id || ' old chair' AS title"))
def extract_products(read):
    """Rule-based extraction from product pages written over the documents, behind their cleaned text."""
    k = F.col("doc_id")
    p = k.cast("string")
    page = F.concat(F.lit("# "), p, F.lit(" old chair\nLot Nr: A-"), p, F.lit("\nPrice: EUR "), (k % 9000 + 1).cast("string"), F.lit(",50\n"),
                    F.when(k % 3 == 0, F.lit("sold")).when(k % 3 == 1, F.lit("reserviert")).otherwise(F.lit("in stock")), F.lit("\n"),
                    F.regexp_replace("text", r"(?iu)\b(sold|verkauft|vendu|vendido|reserved|reserviert)\b", ""))
    rows = read.spread("documents").select(k, page.alias("clean"), F.concat(F.lit("https://a.example/p/"), p).alias("url"))
    done = E.to_payload(E.extract_products(rows))
    return done.select(F.regexp_extract("url", "([0-9]+)$", 1).cast("long").alias("doc_id"), F.col("title.text").alias("title"),
                       F.col("price.amount").alias("amount"), "state", F.col("shops_product_id").alias("number"))


def _null(kind, **more):
    return {"type": [kind, "null"], **more}


def _object(**members):
    return _null("object", properties=members, additionalProperties=False)


_MONEY = _object(amount=_null("integer"), currency=_null("string", enum=["AUD", "CAD", "EUR", "GBP", "NZD", "USD", None]))
_TEXT = _object(text=_null("string"), language=_null("string", enum=["de", "en", "es", "fr", None]))
#: What the schema in the prompt must be.
SCHEMA = json.dumps(_object(
    is_product=_null("boolean"), shopsProductId=_null("string"), title=_TEXT, description=_TEXT, price=_MONEY, priceEstimateMin=_MONEY, priceEstimateMax=_MONEY,
    state=_null("string", enum=["AVAILABLE", "LISTED", "REMOVED", "RESERVED", "SOLD", "UNKNOWN", None]), images=_null("array", items=_null("string")),
    auctionStart=_null("string"), auctionEnd=_null("string")), separators=(",", ":"))


@query(f"""WITH p AS (SELECT doc_id, 'Extract one product of an antiques shop from the page text below as a JSON object that follows the schema. Use its field names, null for what is missing, '
  || 'and no text around the object.' || chr(10) || chr(10) || 'Schema:' || chr(10) || '{SCHEMA}' AS system_prompt,
  'Current time: ' || strftime(TIMESTAMP '2026-01-01 00:00:00' + INTERVAL 1 MINUTE * doc_id, '%Y-%m-%dT%H:%M:%SZ') || chr(10) || chr(10) || 'Page text:' || chr(10) || text AS user_prompt FROM documents)
SELECT doc_id, sha256(system_prompt) AS system_hash, sha256(user_prompt) AS user_hash FROM p""")
def prompts(read):
    """The whole prompts of every document, a minute apart."""
    rows = read("documents").select("doc_id", F.col("text").alias("clean"))
    at = F.lit("2026-01-01 00:00:00").cast("timestamp") + F.make_interval(mins=F.col("doc_id").cast("int"))
    made = E.with_prompt(rows, None, at)
    return made.select("doc_id", F.sha2("system_prompt", 256).alias("system_hash"), F.sha2("user_prompt", 256).alias("user_hash"))
