import json

from pyspark.sql import functions as F

from shopflow.sources import messages
from shopflow.streaming import streams as S
from shopflow.streaming.keyed import KeyedLog, last_put


def write(path, name, rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(json.dumps(r) for r in rows))


def test_changed_pages_over_two_runs(spark, tmp_path):
    src, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    schema = "domain string, url string, markdown string, observed_at timestamp"

    def run():
        S.run_to_parquet(S.changed_stream(spark.readStream.schema(schema).json(str(src))), out, cp)
        return sorted((r.url, r.observed_at.isoformat()) for r in spark.read.parquet(out).where("not late").collect())

    def row(url, text, hour):
        return {"domain": "d", "url": url, "markdown": text, "observed_at": f"2026-01-01T{hour:02}:00:00Z"}

    write(src, "1.json", [row("a", "x", 2), row("b", "y", 2)])
    assert [u for u, _ in run()] == ["a", "b"]
    write(src, "2.json", [row("a", "x", 3), row("b", "z", 3), row("a", "late", 1)])
    assert [u for u, _ in run()] == ["a", "b", "b"]
    write(src, "3.json", [row("a", "new", 4)])
    assert [u for u, _ in run()] == ["a", "a", "b", "b"]
    assert [(r.url, r.observed_at.hour) for r in spark.read.parquet(out).where("late").collect()] == [("a", 1)]


def test_events_over_two_runs(spark, tmp_path):
    src, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    schema = "shop_id string, shops_product_id string, amount long, currency string, state string, observed_at timestamp, seq long"

    def row(amount, state, seq):
        return {"shop_id": "s", "shops_product_id": "p", "amount": amount, "currency": "EUR", "state": state, "observed_at": f"2026-01-01T{seq:02}:00:00Z", "seq": seq}

    def run():
        S.run_to_parquet(S.event_stream(spark.readStream.schema(schema).json(str(src))), out, cp)
        return sorted(((r.timestamp.hour, r.event_type, r.old_amount, r.new_amount) for r in spark.read.parquet(out).collect()), key=str)

    write(src, "1.json", [row(None, "LISTED", 1), row(100, "LISTED", 2)])
    first = run()
    assert [e for _, e, _, _ in first] == ["CREATED", "PRICE_DISCOVERED"]
    write(src, "2.json", [row(90, "SOLD", 3), row(5, "LISTED", 1)])
    assert sorted(map(str, run())) == sorted(map(str, [(1, "CREATED", None, None), (1, S.LATE, None, 5), (2, "PRICE_DISCOVERED", None, 100),
                                                       (3, "PRICE_DROPPED", 100, 90), (3, "STATE_SOLD", None, None)]))


def test_registration_stream(spark, tmp_path):
    src = tmp_path / "in"

    def record(name, seq, **attrs):
        return {"eventName": name, "dynamodb": {"SequenceNumber": seq, "NewImage": {k: {"S": v} for k, v in attrs.items()}}}

    known = spark.createDataFrame([("shop.de", "shop")], "domain string, core_domain_name string")
    plan, rejects, cp = (str(tmp_path / n) for n in ("plan", "rejects", "cp"))

    def run():
        S.registration_stream(messages.read_changes(spark, str(src)), lambda: known, plan, rejects, cp).awaitTermination()
        return {r.domain: r.action for r in spark.read.parquet(plan).collect()}

    write(src, "1.json", [record("INSERT", "1", pk="SHOP#shop.fr", sk="META#"), record("INSERT", "2", pk="?", sk="META#"), record("MODIFY", "3", pk="SHOP#x.de", sk="META#")])
    assert run() == {"shop.fr": "PATCH"}
    write(src, "2.json", [record("INSERT", "4", pk="SHOP#other.de", sk="META#")])
    assert run() == {"shop.fr": "PATCH", "other.de": "POST"}
    assert [r.sequence_number for r in spark.read.parquet(rejects).collect()] == ["2"]


def test_url_puts(spark, tmp_path):
    src, table, cp = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "cp")
    schema = "domain string, url string, type string, hash string, ord long"

    def run():
        S.url_stream(spark.readStream.schema(schema).json(str(src)), table, cp).awaitTermination()
        return {r.url: r.type for r in S.latest_urls(spark.read.parquet(table)).collect()}

    write(src, "1.json", [{"domain": "d", "url": "a", "type": "product", "ord": 1}, {"domain": "d", "url": "a", "ord": 2}, {"domain": "d", "url": "b", "ord": 3}])
    assert run() == {"a": None, "b": None}
    write(src, "2.json", [{"domain": "d", "url": "b", "type": "product", "ord": 1}])
    assert run() == {"a": None, "b": "product"}


def test_lifecycle_and_windows(spark, tmp_path):
    src = tmp_path / "in"
    write(src, "1.json", [{"domain": "d", "operation": "crawl", "state": f"S{h}", "outcome": "success", "observed_at": f"2026-01-01T{h:02}:00:00Z"} for h in (3, 1, 2)])
    stream = spark.readStream.schema("domain string, operation string, state string, outcome string, observed_at timestamp").json(str(src))
    S.run_to_parquet(S.lifecycle_stream(stream), str(tmp_path / "l"), str(tmp_path / "lc"), "update")
    row = spark.read.parquet(str(tmp_path / "l")).first()
    assert (row.last_crawled_end, row.last_scraped_end) == ("S3", None)
    S.run_to_parquet(S.windowed_progress(stream, "2 hours"), str(tmp_path / "w"), str(tmp_path / "wc"), "update")
    counts = {r.window.start.hour: r.total_urls for r in spark.read.parquet(str(tmp_path / "w")).where(F.col("total_urls") > 0).collect()}
    assert counts == {0: 1, 2: 2}


def test_log_is_folded_and_bounded(spark, tmp_path):
    path = str(tmp_path / "log")
    log = KeyedLog(spark, path, ["k"], keep=("h",), fold_every=2)
    want = {}
    for batch in range(9):
        puts = [(k, batch * 10 + k, None if (k + batch) % 3 else f"h{batch}") for k in range(batch % 4 + 1)]
        log.write(batch, spark.createDataFrame(puts, "k int, v int, h string"))
        want |= {k: (v, h or want.get(k, (0, None))[1]) for k, v, h in puts}
        got = {r.k: (r.v, r.h) for r in log.read().collect()}
        assert got == want
        stored = last_put(spark.read.parquet(path).drop("batch"), ["k"], ("h",))
        assert {r.k: (r.v, r.h) for r in stored.collect()} == want
        assert len(log.folders()) <= 2 + 2 * log.fold_every
    before = {r.k: r.v for r in log.read(8).collect()}
    log.write(8, spark.createDataFrame([(0, 1, None)], "k int, v int, h string"))  # the batch again
    assert {r.k: r.v for r in log.read(8).collect()} == before and {r.k: r.v for r in log.read().collect()} == before | {0: 1}


def test_keys_not_seen_for_long_are_forgotten(spark, tmp_path):
    src, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    for name, rows in (("1", [("a", "x", 1), ("b", "x", 20)]), ("2", [("a", "x", 21), ("b", "x", 21)])):
        write(src, f"{name}.json", [{"domain": "d", "url": u, "markdown": t, "observed_at": f"2026-01-{day:02}T00:00:00Z"} for u, t, day in rows])
        pages = spark.readStream.schema("domain string, url string, markdown string, observed_at timestamp").json(str(src))
        S.run_to_parquet(S.changed_stream(pages, forget="10 days"), out, cp)
    assert sorted((r.url, r.observed_at.day) for r in spark.read.parquet(out).collect()) == [("a", 1), ("a", 21), ("b", 20)]


def test_key_with_a_third_of_the_rows(spark, tmp_path):
    """Against a fold in plain Python, over four batches; the plan of a batch has no Python and cuts the key into ranges."""
    import random
    rng = random.Random(4)
    rows = [("s", "hot" if rng.random() < 0.4 else f"p{rng.randrange(40)}", rng.choice([None, 100, 90]), "EUR", rng.choice("AB"), rng.randrange(60), i) for i in range(1200)]
    batch_of = {i: min(3, max(0, r[5] // 15 + rng.choice([0, 0, 0, 1]))) for i, r in enumerate(rows)}
    src, out, cp = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    schema = "shop_id string, shops_product_id string, amount long, currency string, state string, minute int, seq long"
    want, last = [], {}
    for b in range(4):
        part = [r for i, r in enumerate(rows) if batch_of[i] == b]
        df = spark.createDataFrame(part, schema).withColumn("observed_at", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("minute") * 60)).drop("minute")
        df.write.mode("append").parquet(src)
        S.run_to_parquet(S.event_stream(spark.readStream.schema(df.schema).parquet(src)), out, cp)
        start = dict(last)
        for _, p, amount, _, state, minute, seq in sorted(part, key=lambda r: (r[5], r[6])):
            if p in start and (minute, seq) < start[p][:2]:
                want.append((p, S.LATE, None, amount, None, state, minute))
                continue
            old = last.get(p)
            if old is None:
                want.append((p, "CREATED", None, amount, None, state, minute))
            else:
                _, _, was, state_was = old
                if was != amount:
                    kind = "PRICE_DISCOVERED" if was is None else "PRICE_REMOVED" if amount is None else "PRICE_DROPPED" if amount < was else "PRICE_INCREASED"
                    want.append((p, kind, was, amount, None, None, minute))
                if state_was != state:
                    want.append((p, f"STATE_{state}", None, None, state_was, state, minute))
            last[p] = (minute, seq, amount, state)
    got = [(r.shops_product_id, r.event_type, r.old_amount, r.new_amount, r.old_state, r.new_state, (r.t - 1_700_000_000) // 60)
           for r in spark.read.parquet(out).withColumn("t", F.unix_seconds("timestamp")).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_late_rows_are_an_output(spark, tmp_path):
    src, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")

    def run(name, *hours):
        write(src, name, [{"domain": "d", "outcome": "success", "observed_at": f"2026-01-01T{h:02}:30:00Z"} for h in hours])
        stream = spark.readStream.schema("domain string, outcome string, observed_at timestamp").json(str(src))
        S.windows_with_late(stream, out, cp, "1 hour", "2 hours").awaitTermination()

        def hours_of(part):
            return sorted((r.window.start.hour, getattr(r, "total_urls", 1)) for r in spark.read.parquet(part).collect())

        return hours_of(f"{out}/closed"), hours_of(f"{out}/open/batch={int(name[0])}"), hours_of(f"{out}/late")

    assert run("0.json", 1, 1, 4) == ([(1, 2)], [(4, 1)], [])
    assert run("1.json", 1, 3, 5) == ([(1, 2)], [(3, 1), (4, 1), (5, 1)], [(1, 1)])
    assert run("2.json", 9, 4) == ([(1, 2), (3, 1), (4, 2), (5, 1)], [(9, 1)], [(1, 1)])
    assert run("3.json", 4) == ([(1, 2), (3, 1), (4, 2), (5, 1)], [(9, 1)], [(1, 1), (4, 1)])


def test_look_back_joins_a_batch_with_the_state_once(spark, tmp_path):
    """Range sampling, sorting and the late rows read the joined batch from one stored copy."""
    from shopflow.streaming.keyed import LookBack

    leaves = []

    def late(rows):
        leaves.append(rows._jdf.queryExecution().withCachedData().collectLeaves().size())
        return rows.select("k", "t", "v", F.lit(None).cast("string").alias("prev"), F.lit(True).alias("late"))

    batches = [spark.createDataFrame(rows, "k string, t long, v string") for rows in ([("a", 5, "x"), ("b", 1, "y")], [("a", 3, "z"), ("a", 6, "w"), ("b", 2, "y")])]
    run = LookBack(batches[0], ["k"], ["t"], ["v"], late=late,
                   emit=lambda rows: rows.select("k", "t", "v", F.col("prev.v").alias("prev"), F.lit(False).alias("late"))).handle(f"{tmp_path}/out", f"{tmp_path}/state")
    for i, batch in enumerate(batches):
        run(batch, i)
    assert leaves == [1, 1]
    got = spark.read.parquet(f"{tmp_path}/out")
    assert {tuple(r) for r in got.drop("batch").collect()} == {("a", 5, "x", None, False), ("b", 1, "y", None, False), ("a", 3, "z", None, True), ("a", 6, "w", "x", False), ("b", 2, "y", "y", False)}
    assert all(not d.storageLevel.useMemory for d in batches)
