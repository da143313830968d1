from __future__ import annotations

from pyspark.sql import functions as F

from catalog_queries.registry import query
from catalog_queries.registration import PLAN_SQL, _split
from catalog_queries.shops import STATS_SQL, _outcomes
from catalog_queries.tables import EVENTS_SQL, OUTCOME_SQL, observations
from shopflow.runtime import scratch_path
from shopflow.streaming import streams as S


def _paths(read, name):
    return scratch_path(read.spark, name), scratch_path(read.spark, f"{name}-checkpoint")


def _in_batches(read, rows, batch, count, run):
    """Feed ``rows`` to a stream in ``count`` micro-batches, numbered by ``batch``: each is stored, then the stream runs on it."""
    path = scratch_path(read.spark, "arrivals")
    numbered = rows.withColumn("_batch", batch)
    for k in range(count):
        numbered.where(F.col("_batch") == k).drop("_batch").write.mode("append").parquet(path)
        run(read.spark.readStream.schema(rows.schema).parquet(path))


def _last(read, path, keys):
    """Last emitted row per key of an update-mode output."""
    from shopflow.operators.skew import dedupe_last

    return dedupe_last(read.spark.read.parquet(path), keys, ["seq"]).drop("seq", "batch")


@query("""SELECT 'shop' || (user_id % 10) AS domain, max_by(state, ts) FILTER (WHERE event_type IN ('click', 'view')) AS last_crawled_end,
  max_by(state, ts) FILTER (WHERE event_type NOT IN ('click', 'view')) AS last_scraped_end FROM (
  SELECT *, CASE WHEN event_id % 2 = 0 THEN 'PROGRESS#' ELSE 'DONE#' END || event_id AS state FROM events) GROUP BY 1""")
def stream_lifecycle(read):
    e = read.stream("events")
    rows = e.select(F.concat(F.lit("shop"), (F.col("user_id") % 10).cast("string")).alias("domain"),
                    F.when(F.col("event_type").isin("click", "view"), "crawl").otherwise("scrape").alias("operation"),
                    F.concat(F.when(F.col("event_id") % 2 == 0, "PROGRESS#").otherwise("DONE#"), F.col("event_id").cast("string")).alias("state"),
                    F.col("ts").alias("observed_at"))
    path, checkpoint = _paths(read, "lifecycle")
    S.run_to_parquet(S.lifecycle_stream(rows), path, checkpoint, "update")
    return _last(read, path, ["domain"])


@query(f"WITH {STATS_SQL} SELECT *, CAST(0 AS BIGINT) AS token_limit_errors, CAST(0 AS BIGINT) AS fetch_failed FROM stats")
def stream_progress(read):
    path, checkpoint = _paths(read, "progress")
    S.run_to_parquet(S.progress_stream(_outcomes(read.stream("events"))), path, checkpoint, "update")
    return _last(read, path, ["domain"])


@query(f"""WITH o AS (SELECT 'shop' || (user_id % 10) AS domain, time_bucket(INTERVAL 1 DAY, ts) AS w, {OUTCOME_SQL} AS outcome FROM events)
SELECT domain, strftime(w, '%Y-%m-%d') AS day, count(*) AS total_urls, count(*) FILTER (WHERE outcome = 'success') AS extracted_successfully FROM o GROUP BY 1, 2""")
def stream_windowed(read):
    path, checkpoint = _paths(read, "windowed")
    S.run_to_parquet(S.windowed_progress(_outcomes(read.stream("events")), "1 day"), path, checkpoint, "update")
    return _last(read, path, ["domain", "window"]).select(
        "domain", F.date_format("window.start", "yyyy-MM-dd").alias("day"), "total_urls", "extracted_successfully")


@query("SELECT CAST(user_id AS VARCHAR) AS message_id, count(*) AS receives FROM events WHERE event_type = 'error' GROUP BY 1 HAVING count(*) > 10")
def stream_dead_letters(read):
    attempts = read.stream("events").where("event_type = 'error'").select(F.col("user_id").cast("string").alias("message_id"))
    path, checkpoint = _paths(read, "dead")
    S.run_to_parquet(S.dead_letter_stream(attempts), path, checkpoint, "update")
    return _last(read, path, ["message_id"])


@query("""SELECT url, hash FROM (SELECT 'u' || user_id AS url, sha256(event_type) AS hash, ts, event_id,
  lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev, event_type FROM events) WHERE prev IS NULL OR prev <> event_type""")
def stream_changes(read):
    pages = read.stream("events").select(F.lit("d").alias("domain"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("url"),
                                         F.col("event_type").alias("markdown"), F.col("ts").alias("observed_at"))
    path, checkpoint = _paths(read, "changes")
    S.run_to_parquet(S.changed_stream(pages), path, checkpoint)
    return read.spark.read.parquet(path).where("not late").select("url", "hash")


@query(f"WITH {EVENTS_SQL} SELECT pid AS shops_product_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, event_type, old_amount, new_amount, old_state, new_state FROM derived")
def stream_events(read):
    path, checkpoint = _paths(read, "events")
    S.run_to_parquet(S.event_stream(observations(read.stream("events"))), path, checkpoint)
    return read.spark.read.parquet(path).select("shops_product_id", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"),
                                                "event_type", "old_amount", "new_amount", "old_state", "new_state")


@query("""SELECT source AS domain, CAST(doc_id % 50 AS VARCHAR) AS url, max_by(lang, doc_id) AS type, max_by(sha256(text), doc_id) AS hash FROM documents GROUP BY 1, 2""")
def stream_urls(read):
    rows = read.stream("documents").select(F.col("source").alias("domain"), (F.col("doc_id") % 50).cast("string").alias("url"), F.col("lang").alias("type"),
                                           F.sha2("text", 256).alias("hash"), F.col("doc_id").alias("ord"))
    path, checkpoint = _paths(read, "urls")
    S.url_stream(rows, path, checkpoint).awaitTermination()
    return S.latest_urls(read.spark.read.parquet(path))


@query(f"WITH {PLAN_SQL}")
def stream_registration(read):
    """The registration plan from a stream of change records, one per page of a new host."""
    from shopflow.functions import urls as U

    new, known = _split(read)
    names = new.select("domain", "first_page")
    pages = read.stream("pages").select(U.normalize_domain(F.col("url")).alias("domain"), "page_id")
    rows = pages.join(names, (pages["domain"] == names["domain"]) & (F.col("page_id") == F.col("first_page"))).select(
        names["domain"], F.col("page_id").cast("string").alias("n"))
    image = F.create_map(F.lit("pk"), F.struct(F.concat(F.lit("SHOP#"), "domain").alias("S")), F.lit("sk"), F.struct(F.lit("META#").alias("S")))
    records = rows.select(F.lit("INSERT").alias("eventName"), F.struct(image.alias("NewImage"), F.col("n").alias("SequenceNumber")).alias("dynamodb"))
    path, checkpoint = _paths(read, "registration")
    S.registration_stream(records, lambda: known, path, path + "-rejects", checkpoint).awaitTermination()
    return read.spark.read.parquet(path).drop("image", "batch").withColumn("domains", F.array_join("domains", ","))


#: Arrival: four parts of the month one after another; what was held up comes with a fifth batch.
BATCH_SQL = "CASE WHEN event_id % 10 = 3 THEN 4 ELSE day(ts) // 8 END"


def _batch():
    return F.when(F.col("event_id") % 10 == 3, 4).otherwise(F.floor(F.dayofmonth("ts") / 8))


@query(f"""WITH o AS (SELECT 'shop' || (user_id % 10) AS domain, ts, time_bucket(INTERVAL 1 DAY, ts) AS w, {OUTCOME_SQL} AS outcome, {BATCH_SQL} AS b FROM events),
seen AS (SELECT b, max(max(ts)) OVER (ORDER BY b) - INTERVAL 3 DAY AS mark FROM o GROUP BY b),
judged AS (SELECT o.*, w + INTERVAL 1 DAY <= (SELECT max(mark) FROM seen WHERE seen.b < o.b) IS TRUE AS late FROM o),
counted AS (SELECT domain, w, count(*) AS n, count(*) FILTER (WHERE outcome = 'success') AS good FROM judged WHERE NOT late GROUP BY ALL)
SELECT CASE WHEN w + INTERVAL 1 DAY <= (SELECT max(mark) FROM seen) THEN 'closed' ELSE 'open' END AS part, domain, strftime(w, '%Y-%m-%d') AS day, n, good FROM counted
UNION ALL
SELECT 'late', domain, strftime(w, '%Y-%m-%d'), count(*), count(*) FILTER (WHERE outcome = 'success') FROM judged WHERE late GROUP BY ALL""")
def stream_late(read):
    """Daily counters over five micro-batches, three days behind the latest event; every tenth event arrives last, most of them too late."""
    path, checkpoint = _paths(read, "late")
    outcomes = _outcomes(read("events"), "ts", "event_id")
    _in_batches(read, outcomes, _batch(), 5,
                lambda stream: S.windows_with_late(stream, path, checkpoint, "1 day", "3 days").awaitTermination())
    day = F.date_format("window.start", "yyyy-MM-dd").alias("day")

    def part(name):
        rows = read.spark.read.parquet(f"{path}/{name}/batch=4" if name == "open" else f"{path}/{name}")
        return rows.select(F.lit(name).alias("part"), "domain", day, F.col("total_urls").alias("n"), F.col("extracted_successfully").alias("good"))

    late = read.spark.read.parquet(f"{path}/late").groupBy("domain", "window").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("outcome") == "success").alias("good"))
    return part("closed").union(part("open")).union(late.select(F.lit("late").alias("part"), "domain", day, "n", "good"))


@query(f"""WITH p AS (SELECT 'u' || user_id AS url, event_type, ts, event_id, {BATCH_SQL} AS b FROM events),
known AS (SELECT *, max(ts) OVER (PARTITION BY url ORDER BY b RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last FROM p),
fresh AS (SELECT *, lag(event_type) OVER (PARTITION BY url ORDER BY b, ts, sha256(event_type)) AS prev FROM known WHERE last IS NULL OR ts >= last)
SELECT url, sha256(event_type) AS hash, false AS late, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts FROM fresh WHERE prev IS NULL OR prev <> event_type
UNION ALL SELECT url, sha256(event_type), true, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') FROM known WHERE ts < last""")
def stream_changes_in_batches(read):
    """Changed pages over five micro-batches; pages older than the last one of their URL come out as late."""
    pages = read("events").select(F.lit("d").alias("domain"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("url"),
                                  F.col("event_type").alias("markdown"), F.col("ts").alias("observed_at"), "ts", "event_id")
    path, checkpoint = _paths(read, "changes")
    _in_batches(read, pages, _batch(), 5, lambda stream: S.run_to_parquet(S.changed_stream(stream), path, checkpoint))
    return read.spark.read.parquet(path).select("url", "hash", "late", F.date_format("observed_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"))


@query("""WITH p AS (SELECT source AS domain, CAST(doc_id % 50 AS VARCHAR) AS url, lang AS type, CASE WHEN doc_id % 3 <> 0 THEN sha256(text) END AS hash, doc_id FROM documents)
SELECT domain, url, max_by(type, doc_id) AS type, max_by(hash, doc_id) FILTER (WHERE hash IS NOT NULL) AS hash FROM p GROUP BY 1, 2""")
def stream_urls_folded(read):
    """URL puts over six micro-batches, folded every second one; a put without a hash keeps the hash before it."""
    doc = F.col("doc_id")
    puts = read("documents").select(F.col("source").alias("domain"), (doc % 50).cast("string").alias("url"), F.col("lang").alias("type"),
                                    F.when(doc % 3 != 0, F.sha2("text", 256)).alias("hash"), doc.alias("ord"))
    path, checkpoint = _paths(read, "urls")
    _in_batches(read, puts, F.least(F.floor(F.log2(F.col("ord") + 2) / 2), F.lit(5)), 6,
                lambda stream: S.url_stream(stream, path, checkpoint, keep_hash=True, fold_every=2).awaitTermination())
    return S.latest_urls(read.spark.read.parquet(path), keep_hash=True)
