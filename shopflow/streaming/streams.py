"""Structured Streaming forms of the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from shopflow.functions import text
from shopflow.operators.catalogue import events_between
from shopflow.operators.register import new_shops, registration_plan
from shopflow.operators.scrape import run_stats
from shopflow.runtime import remove
from shopflow.sources.messages import MAX_RECEIVES
from shopflow.streaming.keyed import FOLD_EVERY, PUT, KeyedLog, LookBack, last_put


def registration_stream(changes: DataFrame, read_shops: Callable[[], DataFrame], plan_path: str, reject_path: str,
                        checkpoint: str) -> StreamingQuery:
    """Change records to registration plan files; a bad record becomes a reject and stops nothing.

    ``read_shops`` returns the current shop table at the start of every batch. Batch folders make a replay harmless.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        good, bad = new_shops(batch)
        registration_plan(good, read_shops()).write.mode("overwrite").parquet(f"{plan_path}/batch={batch_id}")
        bad.write.mode("overwrite").parquet(f"{reject_path}/batch={batch_id}")

    return (changes.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def url_stream(results: DataFrame, table_path: str, checkpoint: str, order: str = "ord", keep_hash: bool = False,
               fold_every: int = FOLD_EVERY) -> StreamingQuery:
    """Classified URLs into a table of puts, the last put of a key per micro-batch only.

    The current table is :func:`latest_urls` over the puts, so a batch never rewrites the table; every ``fold_every`` batches the
    puts are folded into one per key, which bounds what is stored. With ``keep_hash`` a put without a hash keeps the one before.
    """
    keys, keep = ["domain", "url"], ("hash",) if keep_hash else ()

    def handle(batch: DataFrame, batch_id: int) -> None:
        log = KeyedLog(batch.sparkSession, table_path, keys, keep, fold_every=fold_every)
        last = batch.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in batch.columns if c not in keys]), order).alias("_put"),
                                        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_{c}") for c in keep])
        log.write(batch_id, last.select(*[F.col(f"_{c}").alias(c) if c in keep else F.col(c) if c in keys else F.col(f"_put.{c}") for c in batch.columns]))

    return (results.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def latest_urls(puts: DataFrame, order: str = "ord", keep_hash: bool = False) -> DataFrame:
    """The current table of puts as stored; folded and older rows of a key tell the same."""
    return last_put(puts.drop("batch"), ["domain", "url"], ("hash",) if keep_hash else ()).drop(PUT, order)


def changed_stream(pages: DataFrame, content: str = "markdown", forget: str | None = None) -> LookBack:
    """Pages (domain, url, content, observed_at) whose hash differs from the last one seen for their URL.

    A page older than the last one of its URL changes nothing and comes out with ``late`` set. Only hashes reach the state.
    ``forget`` (an interval) drops pages that were not seen for that long before the latest one. Run it by :func:`run_to_parquet`.
    """
    hashed = pages.select("domain", "url", text.content_hash(F.col(content)).alias("hash"), "observed_at")
    names = ["domain", "url", "hash", "observed_at"]
    changed = F.col("prev").isNull() | ~F.col("prev.hash").eqNullSafe(F.col("hash"))
    return LookBack(hashed, ["domain", "url"], ["observed_at"], ["hash"], tie=["hash"], forget=forget,
                    emit=lambda rows: rows.where(changed).select(*names, F.lit(False).alias("late")),
                    late=lambda rows: rows.select(*names, F.lit(True).alias("late")))


def lifecycle_stream(events: DataFrame) -> DataFrame:
    """Latest crawl and scrape state per domain from (domain, operation, state, observed_at); update mode."""
    def latest(operation: str):
        at = F.when(F.col("operation") == operation, F.struct("observed_at", "state"))
        return F.max(at)["state"]

    return events.groupBy("domain").agg(latest("crawl").alias("last_crawled_end"), latest("scrape").alias("last_scraped_end"))


def progress_stream(outcomes: DataFrame) -> DataFrame:
    """Running counters per domain; update or complete mode."""
    return run_stats(outcomes)


def windowed_progress(outcomes: DataFrame, width: str = "10 minutes", late: str | None = None,
                      ts: str = "observed_at") -> DataFrame:
    """Counters per domain and time window. Late rows correct their window, however late; a window's state is forgotten, and
    rows for it no longer count, only when the caller names ``late``.
    """
    timed = outcomes.withColumn(ts, F.col(ts).cast("timestamp"))
    timed = timed if late is None else timed.withWatermark(ts, late)
    return run_stats(timed.withColumn("window", F.window(ts, width)), ("domain", "window"))


def windows_with_late(outcomes: DataFrame, path: str, checkpoint: str, width: str = "10 minutes", delay: str = "10 minutes",
                      ts: str = "observed_at", keys: tuple[str, ...] = ("domain",)) -> StreamingQuery:
    """Counters per key and time window, each written once when its window closes; rows that come later are an output of their own.

    The watermark is the latest time of all batches so far less ``delay``; a window closes at the end of the batch that moves the watermark
    past its end. A row for a closed window is late, any other counts, however old it is. Folders of ``path``: ``closed``
    and ``late`` with one folder per batch, ``open`` with the windows that the last batch left open, ``seen`` with its latest
    time. A replayed batch starts from what the batch before it left, so it writes the same again.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        gap = F.expr(f"INTERVAL {delay}")
        rows = batch.withColumn(ts, F.col(ts).cast("timestamp")).withColumn("window", F.window(ts, width)).persist()
        try:
            seen = spark.read.parquet(f"{path}/seen/batch={batch_id - 1}").first()[0] if batch_id else None
            shut = F.lit(False) if seen is None else F.coalesce(F.col("window.end") <= F.timestamp_micros(F.lit(seen)) - gap, F.lit(False))
            rows.where(shut).write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")
            counts = run_stats(rows.where(~shut), (*keys, "window"))
            if batch_id:
                counts = counts.unionByName(spark.read.parquet(f"{path}/open/batch={batch_id - 1}"))
            sums = [F.sum(c).alias(c) for c in counts.columns if c not in (*keys, "window")]
            rows.agg(F.greatest(F.max(F.unix_micros(ts)), F.lit(seen).cast("long")).alias("seen")).write.mode("overwrite").parquet(f"{path}/seen/batch={batch_id}")
            latest = spark.read.parquet(f"{path}/seen/batch={batch_id}").first()[0]
            done = F.lit(False) if latest is None else F.coalesce(F.col("window.end") <= F.timestamp_micros(F.lit(latest)) - gap, F.lit(False))
            merged = counts.groupBy(*keys, "window").agg(*sums).persist()
            try:
                merged.where(done).write.mode("overwrite").parquet(f"{path}/closed/batch={batch_id}")
                merged.where(~done).write.mode("overwrite").parquet(f"{path}/open/batch={batch_id}")
            finally:
                merged.unpersist()
            for part in ("open", "seen"):
                remove(spark, f"{path}/{part}/batch={batch_id - 2}")
        finally:
            rows.unpersist()

    return (outcomes.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def dead_letter_stream(attempts: DataFrame, max_receive: int = MAX_RECEIVES) -> DataFrame:
    """Messages received more than ``max_receive`` times; update mode."""
    return attempts.groupBy("message_id").agg(F.count(F.lit(1)).alias("receives")).where(F.col("receives") > max_receive)


LATE = "LATE_OBSERVATION"


def event_stream(observations: DataFrame, forget: str | None = None) -> LookBack:
    """Events of products from a stream of (shop_id, shops_product_id, amount, currency, state, observed_at, seq).

    An observation before the last one of its product gives a LATE_OBSERVATION row, the same one again gives nothing.
    ``forget`` (an interval) drops products that were not seen for that long before the latest one. Run it by :func:`run_to_parquet`.
    """
    price = F.when(F.col("amount").isNotNull(), F.struct(F.col("amount").cast("long").alias("amount"), "currency"))
    kept = ["shop_id", "shops_product_id"]

    def named(rows: DataFrame) -> DataFrame:
        return rows.select(*kept, "event_type", F.col("old_price.amount").alias("old_amount"), F.col("new_price.amount").alias("new_amount"),
                           "old_state", "new_state", "timestamp")

    def emit(rows: DataFrame) -> DataFrame:
        return named(events_between(rows, kept, F.col("prev").isNull(), F.col("prev.price"), F.col("price"), F.col("prev.state"), F.col("state"), "observed_at"))

    def late(rows: DataFrame) -> DataFrame:
        return rows.select(*kept, F.lit(LATE).alias("event_type"), F.lit(None).cast("long").alias("old_amount"), F.col("price.amount").alias("new_amount"),
                           F.lit(None).cast("string").alias("old_state"), F.col("state").alias("new_state"), F.col("observed_at").alias("timestamp"))

    rows = observations.select(*kept, price.alias("price"), "state", "observed_at", "seq")
    return LookBack(rows, kept, ["observed_at", "seq"], ["price", "state"], tie=["price", "state"], once=True, forget=forget, emit=emit, late=late)


def run_to_parquet(stream: DataFrame | LookBack, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process everything available and wait. Update and complete results, and those of a look-back, are written one folder per batch."""
    if isinstance(stream, LookBack):
        writer, mode = stream.rows.writeStream.foreachBatch(stream.handle(path, f"{checkpoint}-state")), "append"
    elif mode == "append":
        writer = stream.writeStream.format("parquet").option("path", path)
    else:
        writer = stream.writeStream.foreachBatch(
            lambda df, i: df.withColumn("seq", F.lit(i)).write.mode("overwrite").parquet(f"{path}/batch={i}"))
    query = (writer.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
