import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopflow.operators import catalogue as C, search as Q
from shopflow.plans import jobs
from shopflow.schemas import PRODUCTS

T0 = datetime(2026, 1, 1)


@pytest.fixture(scope="module")
def products(spark):
    rng = random.Random(8)
    words = ["old", "red", "oak", "chair", "table", "clock", "vase"]
    rows = []
    for i in range(300):
        text = {"text": " ".join(rng.choices(words, k=3)).title(), "language": "en"}
        price = rng.choice([None, {"amount": rng.randint(1, 20) * 100, "currency": rng.choice(["EUR", "USD"])}])
        rows.append({"shop_id": f"s{i % 7}", "shops_product_id": f"p{i}", "shop_name": f"Shop {i % 7}", "shop_type": rng.choice(["MARKETPLACE", "AUCTION_HOUSE"]), "title": text,
                     "description": rng.choice([None, {"text": " ".join(rng.choices(words, k=4)), "language": "en"}]), "state": rng.choice(["SOLD", "LISTED", "AVAILABLE"]),
                     "price": price, "origin_year": rng.choice([None, 1800, 1900]), "origin_year_min": rng.choice([None, 1790]), "condition": rng.choice([None, "GOOD", "POOR"]),
                     "auction_start": rng.choice([None, T0 + timedelta(days=rng.randint(0, 9))]), "created": T0 + timedelta(minutes=rng.randint(0, 50)), "updated": T0})
    return spark.createDataFrame(rows, PRODUCTS).cache()


FILTERS = [dict(language="en", currency="EUR", product_query="Old chair"), dict(language="de", currency="EUR", product_query="oak", price=(300, 1500)),
           dict(language="en", currency="USD", product_query="red", price=(None, 900), state=["SOLD"]), dict(language="en", currency="EUR", product_query="vase", exclude_shop_name=["Shop 1"]),
           dict(language="en", currency="EUR", product_query="clock", origin_year=(1795, 1850), condition=["GOOD"], shop_type=["MARKETPLACE"]),
           dict(language="en", currency="EUR", product_query="table", auction_start=(T0, T0 + timedelta(days=4)), shop_name=["Shop 2", "Shop 3"]),
           dict(language="en", currency="EUR", product_query="unicorn")]


def by_hand(p, f):
    words = set(f"{p.title.text} {p.description.text if p.description else ''}".lower().split())
    if not set(f["product_query"].lower().split()) <= words:
        return False
    for name in ("shop_name", "shop_type", "state", "condition"):
        if f.get(name) and p[name] not in f[name]:
            return False
    if p.shop_name in f.get("exclude_shop_name", []):
        return False
    if "price" in f:
        lo, hi = f["price"]
        if p.price is None or p.price.currency != f["currency"] or (lo is not None and p.price.amount < lo) or (hi is not None and p.price.amount > hi):
            return False
    if "origin_year" in f:
        first = p.origin_year_min or p.origin_year
        last = p.origin_year or p.origin_year_min
        if first is None or last < f["origin_year"][0] or first > f["origin_year"][1]:
            return False
    if "auction_start" in f:
        lo, hi = f["auction_start"]
        if p.auction_start is None or not lo <= p.auction_start <= hi:
            return False
    return True


def test_filters(spark, products):
    rows = products.collect()
    want = {(i, p.shops_product_id) for i, f in enumerate(FILTERS) for p in rows if by_hand(p, f)}
    got = {(i, r[0]) for i, f in enumerate(FILTERS) for r in products.where(C.SearchFilter(**f).to_column()).select("shops_product_id").collect()}
    assert got == want and len(want) > 20

    def bounds(f, name, cast):
        return f"struct<min:{cast},max:{cast}>", ({"min": f[name][0], "max": f[name][1]} if name in f else None)

    lists = ("shop_name", "exclude_shop_name", "shop_type", "state", "authenticity", "condition", "provenance", "restoration")
    stored, kinds = [], ["language:string", "currency:string", "product_query:string"] + [f"{c}:array<string>" for c in lists]
    ranges = [("price", "bigint"), ("origin_year", "int"), ("created", "timestamp"), ("updated", "timestamp"), ("auction_start", "timestamp"), ("auction_end", "timestamp")]
    kinds += [f"{n}:{bounds({}, n, c)[0]}" for n, c in ranges]
    for i, f in enumerate(FILTERS):
        stored.append(("u", str(i), (f["language"], f["currency"], f["product_query"], *[f.get(c) for c in lists], *[bounds(f, n, c)[1] for n, c in ranges])))
    filters = spark.createDataFrame(stored, f"user_id string, filter_id string, product_search struct<{','.join(kinds)}>")
    assert {(int(r.filter_id), r.shops_product_id) for r in Q.match_filters(filters, products).collect()} == want


def searches(spark, rows):
    lists = "shop_name exclude_shop_name shop_type state authenticity condition provenance restoration".split()
    ranges = {"price": "bigint", "origin_year": "int"} | dict.fromkeys(["created", "updated", "auction_start", "auction_end"], "timestamp")
    kinds = ["language:string", "currency:string", "product_query:string"] + [f"{c}:array<string>" for c in lists] + [f"{c}:struct<min:{t},max:{t}>" for c, t in ranges.items()]
    made = [(u, str(i), ("en", "EUR", q, *[None] * len(lists), price, *[None] * 5)) for i, (u, q, price) in enumerate(rows)]
    return spark.createDataFrame(made, f"user_id string, filter_id string, product_search struct<{','.join(kinds)}>")


@pytest.mark.parametrize("tile", [3, 4096])
def test_filters_meet_where_they_are_checked(spark, products, tile):
    """Pairs of a search and a product are only made by the last join, so they are neither shuffled nor spilled."""
    queries = [("old", None), ("old oak", (5000, None)), ("oak old clock", None), ("clock", (None, 30000)), ("clock nowhere", None), ("", None)] * 3
    filters = searches(spark, [("u", q, price) for q, price in queries])
    found = Q.match_filters(filters, products, tile=tile)
    plan = found._jdf.queryExecution().optimizedPlan()
    while plan.children().size() == 1:
        plan = plan.children().apply(0)
    sides = [plan.children().apply(i).output().toString() for i in range(plan.children().size())]
    assert len(sides) == 2 and not any("filter_id" in s and "shops_product_id" in s for s in sides)
    rows = products.collect()
    want = sorted((str(i), p.shops_product_id) for i, (q, price) in enumerate(queries) for p in rows
                  if q and by_hand(p, dict(language="en", currency="EUR", product_query=q) | ({"price": price} if price else {})))
    assert sorted((r.filter_id, r.shops_product_id) for r in found.collect()) == want and len(want) > 100


def test_filter_rules():
    for bad in (dict(language="it", currency="EUR", product_query="abc"), dict(language="en", currency="CHF", product_query="abc"), dict(language="en", currency="EUR", product_query="ab")):
        with pytest.raises(ValueError):
            C.SearchFilter(**bad)
    with pytest.raises(ValueError):
        C.sort_column("name")


@pytest.mark.parametrize("order", ["asc", "desc"])
def test_pages_have_no_gaps(products, order):
    seen, after = [], None
    for _ in range(30):
        rows = C.page(products, C.sort_column("price"), ["shop_id", "shops_product_id"], order, 40, after).collect()
        seen += [r.shops_product_id for r in rows]
        if len(rows) < 40:
            break
        after = tuple(rows[-1].cursor)
    assert len(seen) == 300 and len(set(seen)) == 300
    prices = {r.shops_product_id: (r.price.amount if r.price else -1) for r in products.collect()}
    values = [prices[s] for s in seen]
    assert values == sorted(values, reverse=order == "desc")


def test_page_by_key(spark):
    df = spark.createDataFrame([("d", f"u{i:02}") for i in range(15)], "domain string, url string")
    seen, token = [], None
    for _ in range(5):
        rows = C.page_by_key(df, ["domain", "url"], 5, token).collect()
        seen += [r.url for r in rows]
        token = (rows[-1].domain, rows[-1].url)
        if not rows[-1].has_more:
            break
    assert seen == [f"u{i:02}" for i in range(15)]


def test_search_job(spark, products):
    watch = spark.createDataFrame([("me", "s0", "p0", True)], "user_id string, shop_id string, shops_product_id string, notifications boolean")
    found = jobs.search_products(products, C.SearchFilter("en", "EUR", "old"), watchlist=watch, user_id="me", size=500)
    rows = found.collect()
    assert rows and all(r.total == len(rows) for r in rows)
    scores = {r.shops_product_id: r.score for r in rows}
    assert all(s > 0 for s in scores.values())
    ids = {r.shops_product_id: r.user_state for r in rows}
    assert all(s.watching == (i == "p0") for i, s in ids.items())
    assert jobs.search_products(products, C.SearchFilter("en", "EUR", "old"), sort="created").first().user_state is None


def test_score_by_hand(spark):
    import math

    docs = ["red oak chair", "red red table", "blue", ""]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, t string")
    got = {r.id: r.score for r in Q.score(df, "Red chair", F.col("t")).collect()}
    mean = 7 / 4
    for i, d in enumerate(docs):
        want = 0.0
        for term, n in (("red", 2), ("chair", 1)):
            tf = d.split().count(term)
            want += math.log(1 + (4 - n + 0.5) / (n + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d.split()) / mean)) if tf else 0
        assert got[i] == pytest.approx(want)


OBS = [("a", 1, None, "LISTED"), ("a", 2, 100, "LISTED"), ("a", 3, 100, "LISTED"), ("a", 4, 80, "AVAILABLE"), ("a", 5, 90, "AVAILABLE"), ("a", 6, None, "SOLD"), ("b", 1, 5, "SOLD")]
WANT = {("a", 1, "CREATED"), ("a", 2, "PRICE_DISCOVERED"), ("a", 4, "PRICE_DROPPED"), ("a", 4, "STATE_AVAILABLE"), ("a", 5, "PRICE_INCREASED"), ("a", 6, "PRICE_REMOVED"),
        ("a", 6, "STATE_SOLD"), ("b", 1, "CREATED")}


def test_events(spark):
    df = spark.createDataFrame([("s", p, t, a and (a, "EUR"), s) for p, t, a, s in OBS],
                               "shop_id string, shops_product_id string, observed_at int, price struct<amount:bigint,currency:string>, state string")
    for options in ({}, {"ranges": 4}):
        events = C.derive_events(df, **options)
        assert {(r.shops_product_id, r.timestamp, r.event_type) for r in events.collect()} == WANT
    rows = {(r.event_type): r for r in C.history(events, shops_product_id="a").collect()}
    assert (rows["PRICE_DROPPED"].old_price.amount, rows["PRICE_DROPPED"].new_price.amount) == (100, 80) and rows["STATE_SOLD"].old_state == "AVAILABLE"
    money = df.withColumn("price", F.struct(F.col("observed_at").cast("long").alias("amount"), F.when(F.col("observed_at") == 2, "USD").otherwise("EUR").alias("currency")))
    kinds = {(r.timestamp, r.event_type) for r in C.derive_events(money.where("shops_product_id = 'a' AND observed_at < 4")).collect()}
    assert kinds == {(1, "CREATED")}


def test_put_and_enrich(spark):
    shops = spark.createDataFrame([("S1", "One", ["one.de", "www.one.com"])], "shop_id string, shop_name string, domains array<string>")
    rows = [("https://www.one.de/a", "a", "SOLD", 100), ("https://one.com:8080/b", "b", "SOLD", 5), ("https://two.de/c", "c", "SOLD", 1), ("https://localhost:8080/d", "d", "SOLD", 1),
            ("https://one.de/e", "e", "SOLD", 2 ** 63), ("https://one.de/f", "f", "SOLD", None)]
    incoming = spark.createDataFrame([(*r[:3], r[3] and str(r[3])) for r in rows], "url string, shops_product_id string, state string, amount string").withColumns(
        {"amount": F.col("amount").cast("decimal(20,0)"), "currency": F.lit("EUR")})
    current = spark.createDataFrame([("S1", "a", "LISTED", (100, "EUR")), ("S1", "b", "SOLD", (5, "EUR"))], "shop_id string, shops_product_id string, state string, price struct<amount:bigint,currency:string>")
    out = jobs.put_products(incoming, shops, current, F.lit(T0))
    assert {r.shops_product_id: (r.outcome, r.error) for r in out["results"].collect()} == {
        "a": ("updated", None), "b": ("skipped", None), "c": ("failed", "SHOP_NOT_FOUND"), "d": ("failed", "NO_DOMAIN"), "e": ("failed", "MONETARY_AMOUNT_OVERFLOW"), "f": ("created", None)}
    assert {(r.shops_product_id, r.event_type) for r in out["events"].collect()} == {("a", "STATE_SOLD"), ("f", "CREATED")}
    assert {r.shops_product_id: r.state for r in out["catalogue"].collect()} == {"a": "SOLD", "b": "SOLD", "f": "SOLD"}
    s = C.put_summary(out["results"].withColumn("batch_no", F.lit(0))).first()
    assert s.skipped == 1 and s.unprocessed == [] and s.failed["https://two.de/c"] == "SHOP_NOT_FOUND" and len(s.failed) == 3


def test_puts_of_one_product_follow_each_other(spark):
    shops = spark.createDataFrame([("S2", "Two", ["one.de"]), ("S1", "One", ["one.de"])], "shop_id string, shop_name string, domains array<string>")
    rows = [("https://one.de/a", "a", "SOLD", 90, 3), ("https://one.de/a", "a", "LISTED", 100, 1), ("https://one.de/a", "a", "LISTED", 90, 2), ("https://one.de/a", "a", "SOLD", 90, 4)]
    incoming = spark.createDataFrame(rows, "url string, shops_product_id string, state string, amount int, at int").withColumns(
        {"amount": F.col("amount").cast("decimal(20,0)"), "currency": F.lit("EUR")})
    current = spark.createDataFrame([], "shop_id string, shops_product_id string, state string, price struct<amount:bigint,currency:string>")
    out = jobs.put_products(incoming, shops, current, F.lit(T0), order=["at"])
    assert sorted((r["at"], r.outcome) for r in out["results"].collect()) == [(1, "created"), (2, "updated"), (3, "updated"), (4, "skipped")]
    assert sorted(r.event_type for r in out["events"].collect()) == ["CREATED", "PRICE_DROPPED", "STATE_SOLD"]
    assert [(r.shop_id, r.state, r.price.amount) for r in out["catalogue"].collect()] == [("S1", "SOLD", 90)]


def test_watch_limit(spark):
    schema = "user_id string, shop_id string, shops_product_id string, created int"
    existing = spark.createDataFrame([("u", "s", f"e{i}", i) for i in range(3)], schema)
    new = spark.createDataFrame([("u", "s", f"n{i}", 10 + i) for i in range(4)] + [("u", "s", "e0", 5)] + [("v", "s", f"m{i}", i) for i in range(50)], schema)
    got = {(r.user_id, r.shops_product_id) for r in C.admit(existing, new).where("admitted").collect()}
    assert got == {("u", "n0"), ("u", "n1")} | {("v", f"m{i}") for i in range(5)}
    assert C.admit(existing, new).count() == 55


def nearest(vectors, k, queries=None):
    ids = sorted(vectors)
    m = np.array([vectors[i] for i in ids], dtype=np.float32).astype(float)
    m /= np.where(np.linalg.norm(m, axis=1) == 0, 1, np.linalg.norm(m, axis=1))[:, None]
    sims = np.round(m @ m.T, 12)
    out = {}
    for r, i in enumerate(ids):
        order = sorted((j for j in range(len(ids)) if j != r), key=lambda j: (-sims[r, j], ids[j]))[:k]
        out[i] = [ids[j] for j in order]
    return out


@pytest.mark.parametrize("queries,points", [(512, 4096), (12, 15)])
def test_similar(spark, queries, points):
    """Clustered vectors; a third of them are copies of one vector."""
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(5, 8)) * 4
    vectors = {i: (centres[i % 5] + rng.normal(size=8) * 0.2).round(3).tolist() for i in range(120)}
    for i in range(0, 120, 3):
        vectors[i] = [1.0, 0.5, 0.0, 0.0, 0.0, 0.0, 0.0, 2.0]
    df = spark.createDataFrame(list(vectors.items()), "id long, vector array<float>")
    got = {}
    for r in Q.similar(df.repartition(3), 4, query_block=queries, point_block=points).orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append(r.other_id)
    assert got == nearest(vectors, 4)
    if points < 100:
        asked = df.where("id < 10")
        part = {}
        for r in Q.similar(df, 4, asked, queries, points).orderBy("id", "rank").collect():
            part.setdefault(r.id, []).append(r.other_id)
        assert part == {i: got[i] for i in range(10)}


def test_similar_shuffles_neither_side_to_the_other(spark):
    df = spark.createDataFrame([(i, [1.0, float(i), 0.5]) for i in range(40)] + [(40, [float("nan"), 0.0, 0.0])], "id long, vector array<float>")
    found = Q.similar(df, 3, query_block=8, point_block=8)
    plan = found._jdf.queryExecution().optimizedPlan().toString(), found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan[1] and "RepartitionByExpression" not in plan[0]
    assert plan[1].count("Exchange") == 1  # the k best of each part of the points
    rows = found.collect()
    assert len(rows) == 120 and all(40 not in (r.id, r.other_id) for r in rows)


def test_convert_and_unique(spark):
    from shopflow.operators.register import uniqueness_violations

    df = spark.createDataFrame([(1, (100, "GBP")), (2, (7, "EUR")), (3, (5, "NZD")), (4, None)], "id int, price struct<amount:bigint,currency:string>")
    rates = spark.createDataFrame([("GBP", "EUR", 1.155)], "from string, to string, rate double")
    assert {r.id: r.price and tuple(r.price) for r in C.convert_price(df, rates, "EUR").collect()} == {1: (116, "EUR"), 2: (7, "EUR"), 3: None, 4: None}
    shops = spark.createDataFrame([("1", "A b", ["x.de", "y.de"]), ("2", "a-B", ["y.de"])], "shop_id string, name string, domains array<string>")
    assert {(r.kind, r.value) for r in uniqueness_violations(shops).collect()} == {("slug", "a-b"), ("domain", "y.de")}
