"""Stored tables: pages, boilerplate blocks, URLs, product batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shopflow.functions import states
from shopflow.operators.skew import dedupe_last, with_batch
from shopflow.schemas import BLOCKS, PAGES, URL_COLUMNS

PUBLISH_BATCH = 50
BLOCK_BUCKETS = 64


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGES).parquet(path)


def fetch(urls: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages of the wanted URLs. A URL without a stored page stays as a failed fetch."""
    stored = pages.withColumn("_found", F.lit(True))
    return (urls.join(stored, ["domain", "url"], "left")
            .withColumn("success", F.coalesce(F.col("success"), F.lit(False)))
            .withColumn("error", F.when(F.col("_found").isNull(), F.lit("NOT_FOUND")).otherwise(F.col("error")))
            .drop("_found"))


def list_domains(df: DataFrame, prefix: str = "", column: str = "domain") -> DataFrame:
    return df.where(F.col(column).startswith(prefix)).select(column).distinct()


def save_by_key(df: DataFrame, table: str, keys: list[str], buckets: int) -> None:
    """Write a table bucketed and sorted by its keys; joins of two such tables on the keys need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).format("parquet").saveAsTable(table)


def _with_bucket(blocks: DataFrame) -> DataFrame:
    return blocks.withColumn("bucket", F.pmod(F.xxhash64("domain"), F.lit(BLOCK_BUCKETS)).cast("int"))


def write_blocks(blocks: DataFrame, path: str) -> None:
    """Write the block rows, empty lists included, and replace the folders of the buckets they touch.

    ``blocks`` must hold the full content of those buckets; see :func:`merge_blocks`.
    """
    (_with_bucket(blocks.select("domain", "blocks", "checked_at")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path))


def merge_blocks(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Block table with the rows of ``incoming`` in place of those of the same domain."""
    return current.join(incoming.select("domain"), "domain", "left_anti").unionByName(incoming)


def read_blocks(spark: SparkSession, path: str, domains: DataFrame | None = None) -> DataFrame:
    """Stored blocks. With ``domains``, one row per asked domain: null blocks mean it was never checked."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    return blocks if domains is None else domains.select("domain").distinct().join(blocks, "domain", "left")


def upsert_urls(current: DataFrame, incoming: DataFrame, order: str = "ord", keep_hash: bool = False) -> DataFrame:
    """New URL table. Put semantics: the last row per key replaces the stored one as a whole, so a put without a hash
    erases it unless ``keep_hash``.
    """
    last = dedupe_last(incoming, ["domain", "url"], [order]).select(
        "domain", "url", F.struct("type", "hash").alias("put"))
    merged = current.select(*URL_COLUMNS).join(last, ["domain", "url"], "full_outer")
    put = F.col("put").isNotNull()
    new_hash = F.coalesce("put.hash", "hash") if keep_hash else F.col("put.hash")
    return merged.select("domain", "url", F.when(put, F.col("put.type")).otherwise(F.col("type")).alias("type"),
                          F.when(put, new_hash).otherwise(F.col("hash")).alias("hash"))


def publish(products: DataFrame, batch_size: int = PUBLISH_BATCH, order: list[str] | None = None,
            **options) -> DataFrame:
    """Product rows packed into collections of ``batch_size``, the remainder in a shorter last one."""
    order = order or ["url"]
    packed = with_batch(products, batch_size, order, **options)
    row = F.struct(*products.columns)
    return packed.groupBy("batch_no").agg(
        F.transform(F.array_sort(F.collect_list(F.struct(F.struct(*order).alias("o"), row.alias("v")))),
                    lambda x: x["v"]).alias("items"))


def apply_patch(base: DataFrame, patch: DataFrame, keys: list[str], immutable: tuple[str, ...] = ()) -> DataFrame:
    """Change only what a patch supplies.

    A patch has the key columns and, per changed column, the new value and ``<column>_set``; a column whose flag is
    not true stays. Arrays are replaced as a whole.
    """
    fields = [c for c in base.columns if f"{c}_set" in patch.columns]
    frozen = [c for c in fields if c in immutable]
    if frozen:
        raise ValueError(f"columns cannot be changed: {frozen}")
    wanted = patch.select(*keys, *[F.struct(F.col(f"{c}_set").alias("on"), F.col(c).alias("v")).alias(f"_p_{c}")
                                   for c in fields])
    joined = base.join(wanted, keys, "left")
    return joined.select(*[
        F.when(F.coalesce(F.col(f"_p_{c}.on"), F.lit(False)), F.col(f"_p_{c}.v")).otherwise(F.col(c)).alias(c)
        if c in fields else F.col(c) for c in base.columns])


def mark_started(shops: DataFrame, domains: DataFrame, operation: str, ts) -> DataFrame:
    """Start an operation on some domains: start time and ``PROGRESS#`` state."""
    start, end = states.operation_column(operation, "start"), states.operation_column(operation)
    hit = F.col("_hit").isNotNull()
    joined = shops.join(domains.select("domain").distinct().withColumn("_hit", F.lit(1)), "domain", "left")
    return joined.withColumns({
        start: F.when(hit, F.lit(ts)).otherwise(F.col(start)),
        end: F.when(hit, F.concat(F.lit("PROGRESS#"), F.lit(ts))).otherwise(F.col(end))}).select(*shops.columns)


def mark_done(shops: DataFrame, processed: DataFrame, operation: str, ts) -> DataFrame:
    """Finish an operation. ``processed`` has (domain, processed); a crawl of one URL or none stays in progress."""
    end = states.operation_column(operation)
    least = 1 if operation == "crawl" else 0
    joined = shops.join(processed.select("domain", F.col("processed").alias("_n")), "domain", "left")
    return joined.withColumn(end, F.when(F.col("_n") > least, F.concat(F.lit("DONE#"), F.lit(ts)))
                             .otherwise(F.col(end))).select(*shops.columns)
