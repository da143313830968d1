"""Exact top-k search by columnar branch and bound.

Candidates are packed into blocks in vertical layout: one row of values per dimension. A task streams candidate blocks past
a block of queries. Products are summed one block of dimensions at a time; what the remaining dimensions can still add is
at most the product of the remaining norms (Cauchy-Schwarz), and candidates that cannot reach a query's k-th score so far
are dropped from the arrays before the next dimensions. Only the k best of each query leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from shopflow.llm.base import stored

K = 20
SCALE = 64
CANDIDATES = 4096  # per block
QUERIES = 512
DIMENSIONS = 16  # summed at a time
EXACT = float(1 << 53)


def usable(vector: str) -> Column:
    """Neither null nor with null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(False))


def vertical(ids: np.ndarray, lists: pa.Array, scale: int) -> dict:
    """A block of floor(scale * x), dimensions by vectors; shorter vectors end in zeros."""
    lengths = np.diff(lists.offsets.to_numpy())
    block = np.zeros((len(ids), max(lengths.max(), 1)))
    block[np.arange(block.shape[1]) < lengths[:, None]] = np.floor(scale * lists.flatten().to_numpy().astype(np.float64))
    kind = "<i2" if np.abs(block).max() < 1 << 15 else "<f8"
    return {"n": len(ids), "kind": kind, "ids": ids.astype("<i8").tobytes(), "data": np.ascontiguousarray(block.T).astype(kind).tobytes()}


BLOCK = "n int, kind string, ids binary, data binary"
BLOCK_ARROW = pa.schema([("n", pa.int32()), ("kind", pa.string()), ("ids", pa.binary()), ("data", pa.binary())])


def pack(vectors: DataFrame, size: int, scale: int) -> DataFrame:
    """Blocks of at most ``size`` vectors (id, v)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                yield pa.RecordBatch.from_pylist([vertical(part.column(0).to_numpy(), part.column(1), scale)], BLOCK_ARROW)

    return vectors.mapInArrow(run, BLOCK)


def unpack(n: int, kind: str, ids: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, "<i8"), np.frombuffer(data, kind).reshape(-1, n).astype(np.float64)


class Best:
    """The k best of each query of a block, best first, ties to the smaller id."""

    def __init__(self, ids: np.ndarray, k: int) -> None:
        self.queries, self.k = ids, k
        self.scores = [np.empty(0, np.float64)] * len(ids)
        self.found = [np.empty(0, np.int64)] * len(ids)
        self.least = np.full(len(ids), -np.inf)

    def add(self, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores[q], scores]), np.concatenate([self.found[q], ids])
        if len(ids) > 4 * self.k:
            at = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, ids = scores[at], ids[at]
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores[q], self.found[q] = scores[order], ids[order]
        if len(order) == self.k:
            self.least[q] = scores[order[-1]]


def search_block(best: Best, queries: np.ndarray, ids: np.ndarray, values: np.ndarray, step: int = DIMENSIONS) -> None:
    """Stream one block past the queries. ``queries`` and ``values`` are vertical: dimensions by vectors."""
    dims = max(len(queries), len(values))
    queries, values = (np.pad(x, ((0, dims - len(x)), (0, 0))) for x in (queries, values))
    if np.abs(queries).max(initial=0) * np.abs(values).max(initial=0) * dims >= EXACT:
        return search_large(best, queries, ids, values)
    cuts = [*range(0, dims, step), dims]
    # squared norms from each cut on
    rest_q, rest_v = ([np.sqrt((x[c:] ** 2).sum(0)) * (1 + 1e-9) for c in cuts] for x in (queries, values))
    partial = queries[:cuts[1]].T @ values[:cuts[1]]
    bound = partial + np.outer(rest_q[1], rest_v[1])
    for q in range(queries.shape[1]):
        alive = np.flatnonzero((bound[q] >= best.least[q] - 0.5) & (ids != best.queries[q]))
        sums = partial[q, alive]
        for at in range(1, len(cuts) - 1):
            if not len(alive):
                break
            sums = sums + queries[cuts[at]:cuts[at + 1], q] @ values[cuts[at]:cuts[at + 1], alive]
            near = sums + rest_q[at + 1][q] * rest_v[at + 1][alive] >= best.least[q] - 0.5
            if not near.all():
                alive, sums = alive[near], sums[near]
        if len(alive):
            best.add(q, ids[alive], sums)


def search_large(best: Best, queries: np.ndarray, ids: np.ndarray, values: np.ndarray) -> None:
    """Products beyond exact doubles: whole numbers of any size, scores held within 64 bits."""
    whole_q, whole_v = ([[int(x) for x in column] for column in m.T] for m in (queries, values))
    for q, row in enumerate(whole_q):
        scores = [max(-(1 << 63), min((1 << 63) - 1, sum(a * b for a, b in zip(row, v)))) for v in whole_v]
        own = ids != best.queries[q]
        best.scores[q], best.found[q] = best.scores[q].astype(object), best.found[q]
        merged = sorted([*zip(best.scores[q], best.found[q]), *((s, i) for s, i, o in zip(scores, ids, own) if o)], key=lambda x: (-x[0], x[1]))[:best.k]
        best.scores[q] = np.array([s for s, _ in merged], object)
        best.found[q] = np.array([i for _, i in merged], np.int64)
        if len(merged) == best.k:
            best.least[q] = float(merged[-1][0]) - abs(float(merged[-1][0])) * 1e-15


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, scale: int = SCALE, key: str = "vec_id", vector: str = "embedding",
          candidates: int = CANDIDATES, block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k rows of ``vectors`` with the largest integer inner product.

    Components are floor(scale * x). Null vectors and vectors with null or non-finite components take no part, nor do rows
    without an id. A query meets every row but those with its own id; ties go to the smaller id; repeated rows are
    candidates each. A query id that occurs more than once is searched with its greatest vector. Vectors of different
    lengths are compared as if filled up with zeros. No query or no candidate gives no row.
    """
    spark = vectors.sparkSession

    def rows(df):
        return df.select(df[key].cast("long").alias("id"), df[vector].cast("array<double>").alias("v")).where(F.col("id").isNotNull() & usable("v"))

    packed = stored(pack(rows(vectors), candidates, scale), "topk-candidates")
    asked = stored(rows(queries).groupBy("id").agg(F.max("v").alias("v")), "topk-asked")
    n = -(-asked.count() // block)  # query blocks, dealt by hash

    def one_block(key: tuple, group: pa.Table) -> pa.Table:
        made = vertical(group.column("id").to_numpy(), group.column("v").combine_chunks(), scale)
        return pa.Table.from_pylist([{"q": key[0].as_py(), **made}], pa.schema([("q", pa.int32()), *BLOCK_ARROW]))

    asked = stored(asked.withColumn("q", F.pmod(F.xxhash64("id"), F.lit(max(n, 1))).cast("int")).groupBy("q").applyInArrow(one_block, "q int, " + BLOCK), "topk-queries")
    # a stated query set against all rows in blocks: each candidate block is sent once to each query block
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sent = packed.select(*[F.col(x).alias(f"c_{x}") for x in ("n", "kind", "ids", "data")], F.explode(F.sequence(F.lit(0), F.lit(max(n, 1) - 1))).alias("q"))
    met = sent.join(asked, "q").select("q", "n", "kind", "ids", "data", "c_n", "c_kind", "c_ids", "c_data")
    met = met.repartition(parts, "q", F.pmod(F.xxhash64("c_ids"), F.lit(4)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple[Best, np.ndarray]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                q, n, kind, ids, data, *candidate = (column[i].as_py() for column in batch.columns)
                if q not in known:
                    query_ids, values = unpack(n, kind, ids, data)
                    known[q] = Best(query_ids, k), values
                search_block(known[q][0], known[q][1], *unpack(*candidate))
        for best, _ in known.values():
            counts = [len(x) for x in best.found]
            if sum(counts):
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(best.queries, counts), pa.int64()), pa.array(np.concatenate(best.found), pa.int64()),
                                                  pa.array([int(s) for x in best.scores for s in x], pa.int64())], names=["query_id", "vec_id", "score"])

    found = met.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
