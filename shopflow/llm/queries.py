"""The operators' queries: production parameters, whole tables, whole results. SQL counterparts are in ``sql.py``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from shopflow.llm import bpe, brown, codes, curriculum, divergence, hilbert, packing, quality, simhash, substring, token_files, topk, toxicity
from shopflow.runtime import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 39 along a Hilbert curve over source, language and size; counts are at most one apart (law ``rows``)."""
    placed = hilbert.assign(documents(spark, sf_dir), 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
                         "hilbert")


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.assess(documents(spark, sf_dir), keep=["doc_id", "lang", "source"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                         F.array_join("failed_rules", ",").alias("failed_rules"))


@query
def op7_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = curriculum.in_order(curriculum.curriculum(documents(spark, sf_dir)))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "copies", "position")


@query
def op9_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


@query
def op10_suffix_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.dedup(documents(spark, sf_dir))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op4_branch_and_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries: the rows whose id is divisible by 20."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"))


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(documents(spark, sf_dir), word_tokenizer(), ["doc_id"], digests=True)


@query
def op6_zstd_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write(documents(spark, sf_dir), path, word_tokenizer())
    return token_files.read(spark, path, ids=False)


@query
def op2_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose key's checksum modulo 4 is 2 are held out from training."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(toxicity.remainder(F.col("doc_id"), 4) != 2)
    scored = toxicity.score(docs, toxicity.train(docs, labels), ["doc_id"])
    return scored.select("doc_id", (toxicity.remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")


@query
def op8_brown_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose key's checksum modulo 7 is 2 are held out from training."""
    docs = documents(spark, sf_dir)
    held_out = toxicity.remainder(F.col("doc_id"), 7) == 2
    cut = brown.Cut(docs, ["doc_id"], training=~held_out)
    model, words = brown.train(docs.where(~held_out).select("text"), divide=True, own=True, cut=cut)
    scored = brown.score(docs, model, words, ["doc_id"], cut=cut)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score",
                         "score", brown.perplexity(F.col("score"), F.col("n_tokens")).alias("perplexity"))


@query
def op11_translate_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


@query
def op12_resident_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = codes.compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return rows.select("vec_id", "code", "error", "label_error", F.lit(codes.digest(books)).alias("codebooks_sha256"))


@query
def op13_configuration_lp(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), ids=False)
