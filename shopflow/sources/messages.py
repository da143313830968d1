"""Work messages in and out, change records, rejects."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from shopflow.functions import urls
from shopflow.operators.skew import with_batch
from shopflow.runtime import cut
from shopflow.schemas import CHANGE, MESSAGE

MESSAGES_PER_BATCH = 10
MAX_RECEIVES = 10
MAX_BODY_BYTES = 262_144


def parse_messages(df: DataFrame, body: str = "body") -> DataFrame:
    """Adds ``domain``, ``next`` and ``start_url``; all null for invalid JSON or a message without a domain.

    Works on batch and streaming frames.
    """
    parsed = F.from_json(F.col(body), MESSAGE)
    ok = parsed["domain"].isNotNull() & (parsed["domain"] != "")
    return (df.withColumn("_m", parsed)
            .withColumn("domain", F.when(ok, urls.clean_domain(F.col("_m.domain"))))
            .withColumn("next", F.when(ok, F.col("_m.next")))
            .withColumn("start_url", urls.start_url(F.col("domain"))).drop("_m"))


def split_rejects(df: DataFrame, reason: str = "error") -> tuple[DataFrame, DataFrame]:
    """(rows without a reason, rows with one); the rejects keep all columns."""
    return df.where(F.col(reason).isNull()).drop(reason), df.where(F.col(reason).isNotNull())


def valid_messages(df: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    parsed = parse_messages(df, body).withColumn("error", F.when(F.col("domain").isNull(), F.lit("INVALID_MESSAGE")))
    return split_rejects(parsed)


def to_messages(shops: DataFrame, batch_size: int = MESSAGES_PER_BATCH, **options) -> DataFrame:
    """One JSON body per domain with its batch number; batches hold at most ``batch_size`` messages."""
    body = F.to_json(F.struct("domain"))
    return with_batch(shops.select("domain"), batch_size, ["domain"], **options).withColumn("body", body)


def within_limits(messages: DataFrame, attempt: int = 1) -> DataFrame:
    """Adds ``error``: bodies that a queue does not take, for their length or for want of a domain."""
    body = F.col("body")
    return messages.withColumn("error", F.when(F.octet_length(body) > MAX_BODY_BYTES, "MESSAGE_TOO_LONG")
                               .when(F.coalesce(F.get_json_object(body, "$.domain"), F.lit("")) == "", "INVALID_MESSAGE"))


def send_messages(messages: DataFrame, path: str | None = None, run: str = "0", deliver: Callable[[DataFrame, int], DataFrame] = within_limits,
                  attempts: int = 2) -> DataFrame:
    """The outcome of every message: its columns, ``attempt`` (the last one made) and ``error`` (null once it was taken).

    ``deliver(messages, attempt)`` hands messages over and adds ``error``; what fails is tried again, all failed messages of an attempt at once. Taken bodies are stored as JSON lines
    under ``path`` in a folder of the run; the same run again writes the same folder, so nothing is sent twice.
    """
    pending, taken = messages, []
    for attempt in range(1, attempts + 1):
        tried = cut(deliver(pending, attempt).withColumn("attempt", F.lit(attempt)))
        taken.append(tried if attempt == attempts else tried.where("error is null"))
        pending = tried.where("error is not null").drop("error", "attempt")
    outcomes = reduce(DataFrame.unionByName, taken)
    if path is not None:
        write_messages(outcomes.where("error is null"), f"{path}/run={run}")
    return outcomes


def write_messages(messages: DataFrame, path: str) -> None:
    """Bodies as JSON lines; what the folder held before goes."""
    messages.select("body").write.mode("overwrite").text(path)


def read_changes(spark: SparkSession, path: str, files_per_trigger: int = 10) -> DataFrame:
    """Change records as a stream of JSON lines."""
    return (spark.readStream.schema(CHANGE).option("maxFilesPerTrigger", files_per_trigger).json(path))


def split_dead(attempts: DataFrame, max_receive: int = MAX_RECEIVES) -> tuple[DataFrame, DataFrame]:
    """Messages by number of receipts: (to be tried again, dead letters)."""
    counted = attempts.groupBy("message_id").agg(
        F.count(F.lit(1)).alias("receives"), F.max_by("body", F.struct("received_at")).alias("body"))
    return counted.where(F.col("receives") <= max_receive), counted.where(F.col("receives") > max_receive)
