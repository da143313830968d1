import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shopflow.operators import classify, extract as E
from shopflow.plans import jobs

GOOD = {"is_product": True, "shopsProductId": "LOT123", "title": {"text": "Antique Chair", "language": "en"}, "state": "AVAILABLE",
        "price": {"amount": 50000, "currency": "EUR"}, "images": ["https://a.b/1.jpg"], "auctionStart": None}
CASES = [({}, []), ({"state": None}, ["state: missing or not allowed"]), ({"title": None}, ["title: missing"]), ({"shopsProductId": 5}, ["shopsProductId: missing or not a text"]),
         ({"price": {"amount": -1, "currency": "CHF"}}, ["price.amount: not a non-negative integer", "price.currency: not allowed"]),
         ({"price": {"amount": "70", "currency": "EUR"}}, []), ({"price": {"amount": 1.5, "currency": "EUR"}}, ["price.amount: not a non-negative integer"]),
         ({"price": None, "description": None, "images": []}, []), ({"title": "x"}, ["title: not an object"]), ({"title": {"text": "x", "language": "it"}}, ["title.language: not allowed"]),
         ({"description": {"text": 1, "language": "en"}}, ["description.text: not a text"]), ({"images": ["ftp://x"]}, ["images: not a web address"]),
         ({"images": "x"}, ["images: not a list"]), ({"extra": 1}, ["unknown member"]), ({"is_product": "maybe"}, ["is_product: not a boolean"]),
         ({"auctionEnd": 5}, ["auctionEnd: not a text"]), ({"title": {"text": "x", "language": "en", "more": 1}}, [])]


def test_validation(spark):
    rows = [(i, json.dumps({**GOOD, **change})) for i, (change, _) in enumerate(CASES)] + [(99, "no json"), (100, "[1]"), (101, None)]
    got = {r.i: r for r in E.with_extracted(spark.createDataFrame(rows, "i int, reply string")).collect()}
    for i, (_, errors) in enumerate(CASES):
        assert got[i].errors == errors, CASES[i]
        assert (got[i].extracted is None) == bool(errors)
    assert all(got[i].errors == ["no data"] for i in (99, 100, 101))
    assert got[0].extracted.price.amount == 50000 and got[5].extracted.price.amount == 70 and got[0].extracted.description is None
    ok, bad = E.validate_extracted(spark.createDataFrame(rows, "i int, reply string"))
    assert bad.where("i = 4").count() == 2 and ok.where("i = 4").count() == 0


def test_payload(spark):
    full = {**GOOD, "priceEstimateMin": {"amount": 1, "currency": "EUR"}, "auctionEnd": "2024-05-24T10:00:00Z"}
    df = E.with_extracted(spark.createDataFrame([("u", json.dumps(full))], "url string, reply string"))
    row = E.to_payload(df).first()
    assert (row.url, row.shops_product_id, row.state, row.images, row.auction_end) == ("u", "LOT123", "AVAILABLE", ["https://a.b/1.jpg"], "2024-05-24T10:00:00Z")
    assert "price_estimate_min" not in row and E.to_payload(df, True).first().price_estimate_min.amount == 1


TEXTS = [("# Alter Stuhl\nArt.Nr.: A-17\nPreis 1.234,50 €\nDer Stuhl ist verkauft und nicht mehr da", ("A-17", 123450, "EUR", "SOLD", "de", True)),
         ("## Old chair\n$1,234.5 in stock for the house\n![c](https://a.b/c.JPG)", ("x9", 123450, "USD", "AVAILABLE", "en", True)),
         ("# Only a title\nand the text", ("x9", None, None, "UNKNOWN", "en", False)), ("£ 12000 for the # thing", ("x9", 1200000, "GBP", "UNKNOWN", "en", None))]


def test_rule_extractor(spark):
    df = spark.createDataFrame([(i, t, "https://a.b/p/x9?q=1") for i, (t, _) in enumerate(TEXTS)], "i int, clean string, url string")
    got = {r.i: r for r in E.extract_products(df).collect()}
    for i, (_, (number, amount, currency, state, language, product)) in enumerate(TEXTS):
        e = got[i].extracted
        if product is None:
            assert e is None and got[i].errors == ["title: missing"]
            continue
        assert (e.shopsProductId, e.price and e.price.amount, e.price and e.price.currency, e.state, e.title.language, e.is_product) == (
            number, amount, currency, state, language, product)
    assert got[1].extracted.images == ["https://a.b/c.JPG"]


def test_plugged_extractor(spark):
    def model(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: "Sure! " + json.dumps({**GOOD, "shopsProductId": t}))

    df = spark.createDataFrame([("A", "u")], "clean string, url string")
    assert E.extract_products(df, model).first().extracted.shopsProductId == "A"


def test_failing_texts_are_single_failures(spark, tmp_path):
    """Behind cleaning and on files, where the optimizer moves columns about; undiscovered shops are sampled first."""
    def model(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: 1 // (t.count("boom") == 0) and json.dumps({**GOOD, "shopsProductId": str(len(t.split("\n")))}))

    body = "\n".join(f"Line {{i}} number {j} of the page" for j in range(30))
    rows = [("a.de", f"u{i}", f"# Chair {i}\nLot: {i}\n" + body.replace("{i}", str(i)) + ("\nboom" if i == 2 else "") + "\nAll offers are without guarantee") for i in range(5)]
    spark.createDataFrame(rows, "domain string, url string, markdown string").withColumns({"success": F.lit(True), "error": F.lit(None).cast("string")}).write.parquet(str(tmp_path / "p"))
    pages = spark.read.parquet(str(tmp_path / "p"))
    table = pages.select("domain", "url", F.lit("product").alias("type"), F.lit(None).cast("string").alias("hash"))
    shops = spark.createDataFrame([("a.de", None, "NEVER#")], "domain string, last_scraped_start string, last_scraped_end string")
    none = spark.createDataFrame([], "domain string, blocks array<array<string>>")
    out = jobs.scrape_shops(shops, shops.select("domain", F.lit(None).cast("string").alias("next")), table, pages, none, "T", extractor=model)
    assert {r.url: r.outcome for r in out["outcomes"].collect()} == {"u0": "success", "u1": "success", "u2": "system_error", "u3": "success", "u4": "success"}
    assert out["new_blocks"].first().blocks == [["All offers are without guarantee"]]
    assert {r.shops_product_id for r in out["products"].collect()} == {"32"}


def test_amounts_too_large_are_errors(spark):
    df = spark.createDataFrame([("# Chair\nLot: 1\nEUR " + "9" * 30,), ("# Chair\nLot: 1\nEUR " + "9" * 50,)], "clean string").withColumn("url", F.lit("u"))
    assert {tuple(r.errors) for r in E.extract_products(df).collect()} == {("price.amount: not a non-negative integer",)}


def test_scrape_job(spark):
    text = "# Old chair\nLot: 7\nPrice: EUR 5,00\nsold"
    pages = spark.createDataFrame([("a.de", "u1", text, True, None), ("a.de", "u2", text + " again", True, None), ("a.de", "u3", "nothing here", True, None), ("a.de", "u4", "x", False, "t/o")],
                                  "domain string, url string, markdown string, success boolean, error string")
    table = spark.createDataFrame([("a.de", f"u{i}", "product") for i in range(1, 6)] + [("a.de", "c", None)], "domain string, url string, type string").withColumn(
        "hash", F.when(F.col("url") == "u2", F.sha2(F.lit(text + " again"), 256)))
    shops = spark.createDataFrame([("a.de", None, "NEVER#"), ("b.de", None, "NEVER#")], "domain string, last_scraped_start string, last_scraped_end string")
    requests = spark.createDataFrame([("a.de", None), ("b.de", None)], "domain string, next string")
    blocks = spark.createDataFrame([("a.de", [])], "domain string, blocks array<array<string>>")
    out = jobs.scrape_shops(shops, requests, table, pages, blocks, "T", batch_size=2)
    assert {r.url: r.outcome for r in out["outcomes"].collect()} == {"u1": "success", "u2": "unchanged", "u3": "validation_error", "u4": "fetch_failed", "u5": "fetch_failed"}
    assert [r.price.amount for r in out["products"].collect()] == [500] and out["batches"].count() == 1
    assert {r.domain: r.last_scraped_end for r in out["shops"].collect()} == {"a.de": "DONE#T", "b.de": "PROGRESS#T"}
    again = jobs.scrape_shops(shops, requests, out["urls"], pages, blocks, "T")
    assert {r.url: r.outcome for r in again["outcomes"].collect()}["u1"] == "unchanged"


PRODUCT = ["https://www.moebel-eins.example/produkt/kommode-eiche-geschnitzt-um-1900", "https://www.bilderhaus.example/en/shop/brass-lamp-harbour",
           "https://www.bilderhaus.example/en/shop/brass-lamp-forest-night", "https://www.bilderhaus.example/en/shop/linen-cloth-blue-stripes"]
OTHER = ["https://alte-zeit.example/angebote-stuehle", "https://www.moebel-eins.example/produkt-kategorie/stil/stil-barock", "https://www.moebel-eins.example",
         "https://www.bilderhaus.example/en/news/summer-opening", "https://www.moebel-eins.example/produkt-schlagwort/barock-nussbaum", "https://alte-zeit.example/agb-versand"]


def test_classifier(spark):
    labelled = spark.createDataFrame([(u, True) for u in PRODUCT] + [(u, False) for u in OTHER], "url string, is_product boolean")
    model = classify.train_url_model(labelled, 1 << 12)
    urls = labelled.select("url").unionByName(spark.createDataFrame([(None,)], "url string"))
    got = {r.url: r for r in classify.classify_urls(urls, model).collect()}
    assert all(got[u].is_product and got[u].type == "product" for u in PRODUCT) and not any(got[u].is_product for u in OTHER)
    assert (got[None].is_product, got[None].confidence, got[None].type) == (False, 0.0, None)
    assert all(0.5 <= got[u].confidence <= 1 for u in PRODUCT + OTHER)
    one = classify.classify_urls(urls.where(F.col("url") == PRODUCT[0]), model).first()
    assert one.confidence == pytest.approx(got[PRODUCT[0]].confidence, abs=1e-6)
    assert classify.evaluate_url_model(model, labelled) == 1.0


def test_foreign_classifier(spark):
    def make():
        import numpy as np

        return lambda urls: np.array([0.9 if "shop" in u else 0.2 for u in urls])

    df = spark.createDataFrame([("a/shop/1",), ("b",)], "url string")
    got = {r.url: (r.is_product, round(r.confidence, 6)) for r in classify.classify_urls(df, make_predictor=make).collect()}
    assert got == {"a/shop/1": (True, 0.9), "b": (False, 0.8)}
