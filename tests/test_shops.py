import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from shopflow.operators import register as R, scrape, shops as S
from shopflow.plans import jobs
from shopflow.sources import items, messages, store

NEVER, DONE, PROG = "NEVER#", "DONE#", "PROGRESS#"
MATRIX = [("stale.example", DONE + "2025-06-03T08:30:00Z", DONE + "2025-05-30T22:10:00Z", "eligible"),
          ("busy.example", DONE + "2025-06-03T08:30:00Z", PROG + "2025-06-03T09:45:00Z", "in_progress"),
          ("uncrawled.example", None, DONE + "2025-05-30T22:10:00Z", "crawl_not_finished"),
          ("fresh.example", DONE + "2025-06-01T00:00:00Z", DONE + "2025-06-02T00:00:00Z", "already_scraped"),
          ("first-time.example", DONE + "2025-06-04T17:00:00Z", NEVER, "eligible")]


def shops(spark, rows):
    return spark.createDataFrame(rows, "domain string, last_crawled_end string, last_scraped_end string, shop_country string")


def test_scrape_matrix(spark):
    df = shops(spark, [(d, c, s, "COUNTRY#DE") for d, c, s, _ in MATRIX])
    assert {r.domain: r.r for r in df.select("domain", S.scrape_reason().alias("r")).collect()} == {d: r for d, _, _, r in MATRIX}
    stats = S.scrape_stats(df).first().asDict()
    assert stats == {"total_queried": 5, "in_progress": 1, "crawl_not_finished": 1, "already_scraped": 1, "eligible": 2, "filter_rate": 60.0}
    running = shops(spark, [("p.de", PROG + "t", DONE + "t", "COUNTRY#DE"), ("n.de", DONE + "t", None, "COUNTRY#DE")])
    assert {r.r for r in running.select(S.scrape_reason().alias("r")).collect()} == {"already_scraped"}


def test_candidates(spark):
    df = shops(spark, [("never.de", NEVER, NEVER, "COUNTRY#DE"), ("old.de", DONE + "2020-01-01T00:00:00Z", NEVER, "COUNTRY#DE"),
                       ("new.de", DONE + "2025-12-01T00:00:00Z", NEVER, "COUNTRY#DE"), ("busy.de", PROG + "2020-01-01T00:00:00Z", NEVER, "COUNTRY#DE"),
                       ("fr.fr", NEVER, NEVER, "COUNTRY#FR"), ("none.de", NEVER, NEVER, None), ("edge.de", DONE + "2025-01-01T00:00:00Z", NEVER, "COUNTRY#DE")])
    chosen = {r.domain for r in S.candidates(df, "crawl", "2025-01-01T00:00:00Z").collect()}
    assert chosen == {"never.de", "old.de", "edge.de"}
    assert {r.domain for r in S.candidates(df, "crawl", "2025-01-01T00:00:00Z", "COUNTRY#FR").collect()} == {"fr.fr"}
    assert {r.domain for r in S.candidates(df, "crawl", "2025-01-01T00:00:00+00:00", parse_ts=True).collect()} == chosen
    with pytest.raises(ValueError):
        S.candidates(df, "walk", "x")
    assert [r.domain for r in S.stuck(df, "crawl", "2021-01-01T00:00:00Z").collect()] == ["busy.de"]


def test_orchestrate(spark):
    df = shops(spark, [(f"s{i:02}.de", DONE + "2025-06-01T00:00:00Z", NEVER, "COUNTRY#DE") for i in range(23)] + [("x.de", NEVER, NEVER, "COUNTRY#DE")])
    out = jobs.orchestrate(df, "scrape", now=datetime(2026, 1, 1, tzinfo=timezone.utc))
    rows = out["messages"].collect()
    assert sorted(json.loads(r.body)["domain"] for r in rows) == [f"s{i:02}.de" for i in range(23)]
    sizes = {}
    for r in rows:
        sizes[r.batch_no] = sizes.get(r.batch_no, 0) + 1
    assert sizes == {0: 10, 1: 10, 2: 3}
    assert out["stats"].first().crawl_not_finished == 1 and out["summary"].first().shops_enqueued == 23
    assert out["preview"].count() == 5


def test_messages(spark):
    bodies = ['{"domain": "https://example.com/"}', '{"domain": "example.com", "next": "https://example.com/p"}', '{"next": "x"}', "{bad", '{"domain": ""}', None]
    got = [tuple(r) for r in messages.parse_messages(spark.createDataFrame([(b,) for b in bodies], "body string")).select("domain", "next", "start_url").collect()]
    assert got == [("example.com", None, "https://example.com"), ("example.com", "https://example.com/p", "https://example.com")] + [(None, None, None)] * 4
    good, bad = messages.valid_messages(spark.createDataFrame([(b,) for b in bodies], "body string"))
    assert good.count() == 2 and bad.count() == 4
    tries = spark.createDataFrame([("a", "x", i) for i in range(11)] + [("b", "y", i) for i in range(10)], "message_id string, body string, received_at int")
    again, dead = messages.split_dead(tries)
    assert [r.message_id for r in again.collect()] == ["b"] and [r.message_id for r in dead.collect()] == ["a"]


def test_items(spark):
    item = {"pk": {"S": "SHOP#a.example.de"}, "sk": {"S": "META#"}, "domain": {"S": "a.example.de"}, "gsi3_pk": {"S": "COUNTRY#DE"}, "gsi2_sk": {"S": NEVER}}
    url = {"pk": {"S": "SHOP#a.de"}, "sk": {"S": "URL#https://a.de/1"}, "url": {"S": "https://a.de/1"}, "type": {"S": "product"}}
    mixed = spark.createDataFrame([(json.dumps(item),), (json.dumps(url),)], "item string")
    shop_items, url_items = items.split_items(mixed)
    shop = items.decode_items(shop_items, "shop").first()
    assert (shop.domain, shop.core_domain_name, shop.shop_country, shop.last_crawled_end, shop.shop_type) == ("a.example.de", "example", "COUNTRY#DE", NEVER, None)
    assert tuple(items.decode_items(url_items, "url").first()) == ("a.de", "https://a.de/1", "product", None)
    fresh = items.new_shops_frame(spark.createDataFrame([("example.com", "US"), ("no.de", None)], "domain string, shop_country string"))
    encoded = {json.loads(r.item)["domain"]["S"]: json.loads(r.item) for r in items.encode_items(fresh, "shop").collect()}
    us = encoded["example.com"]
    assert us["pk"]["S"] == "SHOP#example.com" and us["shop_country"]["S"] == us["gsi2_pk"]["S"] == "COUNTRY#US"
    assert us["gsi2_sk"]["S"] == us["gsi3_sk"]["S"] == NEVER and us["gsi4_pk"]["S"] == "example" and us["gsi4_sk"]["S"] == "example.com"
    assert "gsi3_pk" not in encoded["no.de"] and "shop_name" not in us and us["shop_type"]["S"] == "COMMERCIAL_DEALER"
    back = json.loads(items.encode_items(items.decode_items(url_items, "url"), "url").first().item)
    assert back["gsi1_pk"]["S"] == "SHOP#a.de" and back["gsi1_sk"]["S"] == "product" and "hash" not in back


def test_upsert(spark):
    cur = spark.createDataFrame([("d", "a", "product", "h1"), ("d", "b", None, "h2")], "domain string, url string, type string, hash string")
    inc = spark.createDataFrame([("d", "a", None, "v1", 1), ("d", "a", "product", "v2", 2), ("d", "c", None, None, 3)], "domain string, url string, type string, hash string, ord int")
    table = store.upsert_urls(cur, inc)
    assert {(r.url, r.type, r.hash) for r in table.collect()} == {("a", "product", "v2"), ("b", None, "h2"), ("c", None, None)}
    tied = spark.createDataFrame([("d", f"u{i}", None, None, i // 3) for i in range(9)], inc.schema)
    assert store.upsert_urls(cur, tied).count() == 11


def test_patch(spark):
    base = spark.createDataFrame([(1, "n", ["a"]), (2, "m", ["b"])], "id int, name string, domains array<string>")
    patch = spark.createDataFrame([(1, ["a", "c"], True)], "id int, domains array<string>, domains_set boolean")
    assert {r.id: (r.name, r.domains) for r in store.apply_patch(base, patch, ["id"]).collect()} == {1: ("n", ["a", "c"]), 2: ("m", ["b"])}
    named = patch.select("id", F.lit("x").alias("name"), F.lit(True).alias("name_set"))
    with pytest.raises(ValueError):
        store.apply_patch(base, named, ["id"], immutable=("name",))
    empty = patch.select("id", F.lit(None).cast("string").alias("name"), F.lit(False).alias("name_set"))
    assert store.apply_patch(base, empty, ["id"]).where("id = 1").first().name == "n"


def test_core_names(spark):
    df = spark.createDataFrame([(d, d.split(".")[-2]) for d in ["apple.com", "apple.de", "apple-store.fr", "pineapple.com"]], "domain string, core_domain_name string")
    assert {r.domain for r in S.shops_by_core(df, "apple").collect()} == {"apple.com", "apple.de"}
    assert {r.domain for r in S.shops_by_core(df, "apple", without="apple.de").collect()} == {"apple.com"}
    hosts = spark.createDataFrame([("shop.example.co.uk",), ("a.b.example.com",), ("co.uk",), ("x.unknown",), ("city.kawasaki.jp",)], "domain string")
    suffixes = spark.createDataFrame([("uk",), ("co.uk",), ("com",), ("jp",), ("kawasaki.jp",)], "suffix string")
    got = {r.domain: r.core_domain_name for r in R.core_domain_by_table(hosts, suffixes).collect()}
    assert got == {"shop.example.co.uk": "example", "a.b.example.com": "example", "co.uk": "", "x.unknown": "unknown", "city.kawasaki.jp": "city"}


def plan(spark, new, known):
    n = spark.createDataFrame([(d, d.split(".")[-2], None, "ODD", None) for d in new], "domain string, core_domain_name string, shop_name string, shop_type string, shop_image string")
    k = spark.createDataFrame([(d, d.split(".")[-2]) for d in known], "domain string, core_domain_name string")
    return {r.domain: (r.action, r.identifier, r.domains, r.name, r.error) for r in R.registration_plan(n, k, ranges=3).collect()}


def test_registration(spark):
    got = plan(spark, ["new.de", "vase.fr", "two.de", "two.com"], ["vase.net", "vase.de", "new.de", "other.com"])
    assert got == {"new.de": ("POST", None, ["new.de"], "new", None), "vase.fr": ("PATCH", "vase.de", ["vase.de", "vase.net", "vase.fr"], None, None),
                   "two.com": ("POST", None, ["two.com"], "two", None), "two.de": ("PATCH", "two.com", ["two.com", "two.de"], None, None)}
    full = plan(spark, ["zz.big.de"], [f"d{i:03}.big.de" for i in range(100)])
    assert full["zz.big.de"][2:] == (None, None, "TOO_MANY_DOMAINS")
    fits = plan(spark, ["zz.big.de"], [f"d{i:03}.big.de" for i in range(99)])
    assert len(fits["zz.big.de"][2]) == 100


def test_change_records(spark):
    def record(name, image, seq):
        return (name, (image, seq))

    def attrs(**kw):
        return {k: (v,) for k, v in kw.items()}

    rows = [record("INSERT", attrs(pk="SHOP#a.de", sk="META#"), "1"), record("MODIFY", attrs(pk="SHOP#b.de", sk="META#"), "2"),
            record("INSERT", attrs(pk="X", sk="META#"), "3"), record("INSERT", attrs(pk="SHOP#a.de", sk="URL#x"), "4"), record("INSERT", None, "5"),
            record("INSERT", attrs(pk="SHOP#z", sk="META#", domain="c.shop.de", shop_type="MARKETPLACE", shop_name="C"), None)]
    df = spark.createDataFrame(rows, "eventName string, dynamodb struct<NewImage: map<string, struct<S: string>>, SequenceNumber: string>")
    known = spark.createDataFrame([], "domain string, core_domain_name string")
    out = jobs.register_shops(df, known)
    got = {r.domain: (r.action, r.name, r.shop_type) for r in out["plan"].collect()}
    assert got == {"a.de": ("POST", "a", "COMMERCIAL_DEALER"), "c.shop.de": ("POST", "C", "MARKETPLACE")}
    assert [r.sequence_number for r in out["rejects"].collect()] == ["3"]


@pytest.mark.parametrize("n,ok,same,bad,sys,want", [(100, 80, 20, 0, 0, (100.0, 0.0)), (100, 40, 0, 0, 0, (40.0, 0.0)), (100, 0, 100, 0, 0, (0.0, 0.0)),
                                                    (100, 0, 0, 10, 5, (0.0, 15.0)), (100, 0, 50, 8, 2, (0.0, 20.0))])
def test_rates(spark, n, ok, same, bad, sys, want):
    df = spark.createDataFrame([(n, ok, same, bad, sys, n)], "total_urls int, extracted_successfully int, n_unchanged_urls int, validation_errors int, system_errors int, processed_urls int")
    r = scrape.rates(df).first()
    assert (r.success_rate, r.error_rate) == pytest.approx(want)


def test_progress_and_throughput(spark):
    df = spark.createDataFrame([(200, 100, 0, 0.0, 100.0), (100, 50, 25, 0.0, 300.0), (0, 0, 0, 0.0, 1.0)],
                               "total_urls int, processed_urls int, n_unchanged_urls int, start_time double, end_time double").withColumns(
        {c: F.lit(0) for c in ("extracted_successfully", "validation_errors", "system_errors")})
    got = [(r.progress, r.seconds_per_page) for r in scrape.rates(df).collect()]
    assert got == [(50.0, 0.5), (25.0, 4.0), (0.0, 0.0)]


def test_resume(spark):
    urls = spark.createDataFrame([(d, f"{d}/{i}") for d in "abc" for i in range(4)], "domain string, url string")
    cursors = spark.createDataFrame([("a", "a/2"), ("b", "gone"), ("c", None)], "domain string, next string")
    got = scrape.resume(urls, cursors).groupBy("domain").count().collect()
    assert {r.domain: r["count"] for r in got} == {"a": 2, "b": 4, "c": 4}


def test_outcomes(spark):
    rows = [("a", False, None, None, None, None), ("b", True, False, None, None, None), ("c", True, True, "LengthFinishReasonError", None, None), ("d", True, True, "boom", None, None),
            ("e", True, True, None, ["x"], None), ("f", True, True, None, [], (False,)), ("g", True, True, None, [], (True,)), ("h", True, True, None, [], None)]
    df = spark.createDataFrame(rows, "domain string, success boolean, changed boolean, extract_error string, errors array<string>, extracted struct<is_product: boolean>")
    got = {r.domain: r.outcome for r in scrape.route_outcomes(df).collect()}
    assert got == dict(zip("abcdefgh", ["fetch_failed", "unchanged", "token_limit", "system_error", "validation_error", "non_product", "success", "validation_error"]))
    stats = scrape.run_stats(scrape.route_outcomes(df).withColumn("domain", F.lit("d"))).first()
    assert (stats.system_errors, stats.token_limit_errors, stats.validation_errors, stats.fetch_failed) == (2, 1, 2, 1)


def test_country_of_ip(spark):
    ip = S.ip_to_long(F.col("ip"))
    df = spark.createDataFrame([("a", "1.2.3.4", None), ("b", "1.2.3.5", "COUNTRY#FR"), ("c", "9.9.9.9", None), ("d", "1.300.3.4", None), ("e", None, None), ("f", "2.0.255.255", None)],
                               "domain string, ip string, shop_country string").withColumn("ip", ip)
    ranges = spark.createDataFrame([(16909056, 16909311, "DE"), (33554432, 33685503, "AT")], "lo long, hi long, country string")
    got = {r.domain: r.shop_country for r in S.country_of_ip(df, ranges).collect()}
    assert got == {"a": "COUNTRY#DE", "b": "COUNTRY#FR", "c": None, "d": None, "e": None, "f": "COUNTRY#AT"}


def test_sent_messages(spark, tmp_path):
    rows = [(f"s{i}.de", f'{{"domain": "s{i}.de"}}') for i in range(12)] + [("long.de", '{"domain": "long.de", "x": "' + "y" * 300_000 + '"}'), ("none", '{"domain": ""}')]
    df = spark.createDataFrame(rows, "domain string, body string")
    calls = []

    def deliver(part, attempt):
        calls.append((attempt, part.count()))
        refused = F.when(F.col("domain") == "s3.de", "Down").when((F.col("domain") == "s4.de") & F.lit(attempt == 1), "Busy")
        return messages.within_limits(part).withColumn("error", F.coalesce("error", refused))

    for _ in range(2):  # the same run again leaves one copy of each message
        calls.clear()
        got = {r.domain: (r.attempt, r.error) for r in messages.send_messages(df, str(tmp_path / "q"), "r1", deliver).collect()}
    assert calls == [(1, 14), (2, 4)]
    assert got == {f"s{i}.de": (1, None) for i in range(12)} | {"s3.de": (2, "Down"), "s4.de": (2, None), "long.de": (2, "MESSAGE_TOO_LONG"), "none": (2, "INVALID_MESSAGE")}
    stored = [r.value for r in spark.read.text(str(tmp_path / "q")).collect()]
    assert sorted(stored) == sorted(b for d, b in rows[:12] if d != "s3.de")


def test_crawl_orchestration_counts_failures(spark):
    rows = [(f"s{i}.de", "COUNTRY#DE", "NEVER#" if i % 2 else "DONE#2020-01-01T00:00:00Z", None) for i in range(30)] + [("busy.de", "COUNTRY#DE", "PROGRESS#2020-01-01T00:00:00Z", None)]
    df = spark.createDataFrame(rows, "domain string, shop_country string, last_crawled_end string, last_scraped_end string")
    out = jobs.orchestrate(df, "crawl", now=datetime(2026, 1, 1, tzinfo=timezone.utc),
                           deliver=lambda m, attempt: m.withColumn("error", F.when(F.col("domain").isin("s1.de", "s2.de"), "Down")))
    summary = out["summary"].first()
    assert (summary.shops_found, summary.shops_enqueued, summary.shops_failed) == (30, 28, 2)
    assert {(r.domain, r.error) for r in out["failed"].collect()} == {("s1.de", "Down"), ("s2.de", "Down")}


def test_suffix_rules(spark):
    rules = spark.createDataFrame([(r,) for r in ("uk", "co.uk", "com", "*.ck", "!www.ck", "jp", "*.kawasaki.jp", "!city.kawasaki.jp")], "suffix string")
    hosts = {"shop.example.co.uk": "example", "example.uk": "example", "co.uk": "", "a.b.example.com": "example", "x.shop.foo.ck": "shop", "foo.ck": "", "shop.foo.ck": "shop",
             "a.www.ck": "www", "b.c.kawasaki.jp": "b", "city.kawasaki.jp": "city", "x.city.kawasaki.jp": "city", "one.unknown": "unknown"}
    df = spark.createDataFrame([(h,) for h in hosts], "domain string")
    assert {r.domain: r.core_domain_name for r in R.core_domain_by_table(df, rules).collect()} == hosts


def test_registration_by_suffix_table(spark):
    rows = [("INSERT", {"SequenceNumber": "1", "NewImage": {"pk": {"S": "SHOP#tools.shop.foo.ck"}, "sk": {"S": "META#"}}})]
    changes = spark.createDataFrame(rows, "eventName string, dynamodb struct<SequenceNumber:string,NewImage:map<string,struct<S:string>>>")
    rules = spark.createDataFrame([("*.ck",)], "suffix string")
    assert [r.core_domain_name for r in R.new_shops(changes, rules)[0].collect()] == ["shop"] and [r.core_domain_name for r in R.new_shops(changes)[0].collect()] == ["foo"]


def test_country_of_shared_address_and_many_ranges(spark):
    ranges = spark.range(20_000).select((F.col("id") * 100).alias("lo"), (F.col("id") * 100 + 59).alias("hi"), F.col("id").cast("string").alias("country"))
    df = spark.range(9_000).select(F.concat(F.lit("d"), "id").alias("domain"), F.when(F.col("id") % 3 == 0, F.lit(777_720)).otherwise(F.col("id") * 211).cast("long").alias("ip"),
                                   F.lit(None).cast("string").alias("shop_country"))
    found = S.country_of_ip(df, ranges, 12)
    assert found.columns == df.columns
    for r in found.collect():
        assert r.shop_country == (f"COUNTRY#{r.ip // 100}" if r.ip % 100 < 60 else None), r
