"""SimHash near-duplicate detection with Golay-code fuzzy keys.

The 64 bits are cut into segments of 22, 21 and 21 bits. Of two fingerprints that differ in 3 bits or fewer, at least two
segments differ in one bit or none. Each segment, filled up with zeros, is a word of the binary Golay code of length 23,
in which every word lies within 3 bits of exactly one code word. A segment's keys are the code words nearest to it and to
its one-bit neighbours: one if it lies within 2 bits of a code word, else about six. Segments that differ in one bit share
a key, so each pair of segments gives joint keys by which every link is found. Rows that share a joint key are sorted
together and compared; what is passed on is a forest of links per key, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from shopflow.llm.base import by_batch, stored

SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, width
MOST_BITS = 3
GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
SHORT_RUN = 48
LONGEST_RUN = 8192


def fingerprint(text: str, width: int = 3) -> int:
    """Majority bits over the hashes of all word shingles of the text with A-Z lowered; no word: 0."""
    words = text.encode().lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    shingles = map(b" ".join, zip(*[words[i:] for i in range(width)])) if len(words) >= width else [b" ".join(words)]
    hashes = np.fromiter((digest(s, 42) for s in shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        block = np.unpackbits(hashes[i:i + (1 << 14)].astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += np.add.reduce(block, axis=0, dtype=np.uint16)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", width: int = 3) -> DataFrame:
    """``keep`` and the fingerprint as a signed long ``fp``."""
    marked = docs.select(*[docs[c].alias(c) for c in keep], docs[text].cast("string").alias("_text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t or "", width) for t in batch.column(batch.num_columns - 1).to_pylist()], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps)], names=[*keep, "fp"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in marked.schema.fields[:-1]] + ["fp long"])
    return by_batch(marked, run, schema)


def remainder(words: np.ndarray) -> np.ndarray:
    """The words modulo the generator polynomial: 0 for code words."""
    left = words.copy()
    for bit in range(22, 10, -1):
        left = np.where(left >> bit & 1, left ^ (GENERATOR << bit - 11), left)
    return left


def error_patterns() -> np.ndarray:
    """By remainder: the one pattern of 3 bits or fewer that has it."""
    patterns = [0] + [sum(1 << i for i in c) for r in (1, 2, 3) for c in combinations(range(23), r)]
    table = np.empty(2048, np.int64)
    table[remainder(np.array(patterns, np.int64))] = patterns
    return table


def segment_keys(values: np.ndarray, width: int, errors: np.ndarray) -> np.ndarray:
    """A row per value: the indices (12 bits) of the code words nearest to it and to each one-bit neighbour; repeats are -1."""
    flips = np.concatenate([[0], 1 << np.arange(width)])
    near = values[:, None] ^ flips
    keys = np.sort((near ^ errors[remainder(values)[:, None] ^ remainder(flips)]) >> 11, axis=1)
    keys[:, 1:][keys[:, 1:] == keys[:, :-1]] = -1
    return keys


def joint_keys(fps: np.ndarray, errors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (joint key, position in ``fps``)."""
    bits = fps.view(np.uint64)
    each = [segment_keys(((bits >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64), n, errors) for at, n in SEGMENTS]
    keys, rows = [], []
    for pair, (i, j) in enumerate(combinations(range(3), 2)):
        a, b = each[i], each[j]
        ra, ca = np.nonzero(a >= 0)
        ka = a[ra, ca]
        counts = (b >= 0).sum(1)
        flat, starts = b[b >= 0], np.concatenate([[0], np.cumsum(counts)[:-1]])
        times = counts[ra]
        row = np.repeat(ra, times)
        within = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
        keys.append((pair << 24) | (np.repeat(ka, times) << 12) | flat[starts[row] + within])
        rows.append(row)
    return np.concatenate(keys), np.concatenate(rows)


def forest(fps: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links that connect all that is connected within ``most`` bits; each value leaves the rest when it is reached."""
    rest, links = np.unique(fps), []
    while len(rest) > 1:
        ahead, rest = [rest[0]], rest[1:]
        while ahead and len(rest):
            at = ahead.pop()
            near = np.bitwise_count((rest ^ at).view(np.uint64)) <= most
            if near.any():
                links.append((np.full(near.sum(), at), rest[near]))
                ahead.extend(rest[near])
                rest = rest[~near]
    return links


def run_links(keys: np.ndarray, fps: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the runs of equal keys; short runs by shifted comparison, longer ones by their forest."""
    out = []
    begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.append(begins, len(keys)))
    for at, n in zip(begins[sizes > SHORT_RUN], sizes[sizes > SHORT_RUN]):
        out += forest(fps[at:at + n], most)
    short = np.repeat(sizes <= SHORT_RUN, sizes)
    k, f = keys[short], fps[short]
    for lag in range(1, SHORT_RUN):
        same = np.flatnonzero(k[lag:] == k[:-lag]) if len(k) > lag else []
        if not len(same):
            break
        a, b = f[same], f[same + lag]
        near = np.bitwise_count((a ^ b).view(np.uint64)) <= most
        out.append((a[near], b[near]))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, b = (np.concatenate([x[i] for x in out]) for i in (0, 1))
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1)[a != b], axis=0)
    return pairs[:, 0], pairs[:, 1]


def links(nodes: DataFrame, most: int = MOST_BITS, longest: int = LONGEST_RUN, parts: int | None = None) -> DataFrame:
    """Links (u, v) between distinct fingerprints ``fp`` that connect exactly what is connected within ``most`` bits.

    A task holds at most ``longest`` rows of a key. Rows of longer runs are passed on as they are, split into blocks, and
    each pair of blocks is a task of its own.
    """
    if not 0 <= most <= MOST_BITS:
        raise ValueError("the keys find links of 3 bits or fewer")
    errors = error_patterns()
    parts = parts or int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def spread_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column(0).to_numpy()
            for at in range(0, len(whole), 256):  # a fingerprint has up to a hundred keys
                fps = whole[at:at + 256]
                keys, rows = joint_keys(fps, errors)
                yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int32)), pa.array(fps[rows])], names=["key", "fp"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(u, v, key=None):
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()),
                                               pa.array(np.full(len(u), key), pa.int32()) if key is not None else pa.nulls(len(u), pa.int32())],
                                              names=["u", "v", "key"])

        held_k, held_f, over = np.empty(0, np.int32), np.empty(0, np.int64), None
        for batch in batches:
            k = np.concatenate([held_k, batch.column(0).to_numpy()])
            f = np.concatenate([held_f, batch.column(1).to_numpy()])
            if over is not None:  # the rest of a run that is too long
                n = int(np.searchsorted(k, over, side="right"))
                if n:
                    yield rows(f[:n], f[:n], over)
                k, f = k[n:], f[n:]
                over = over if not len(k) else None
            if not len(k):
                held_k, held_f = k, f
                continue
            last = int(np.searchsorted(k, k[-1]))
            if last:
                yield from pieces(k[:last], f[:last], rows)
            held_k, held_f = k[last:], f[last:]
            if len(held_k) > longest:
                over = held_k[0]
                yield rows(held_f, held_f, over)
                held_k, held_f = held_k[:0], held_f[:0]
        if len(held_k):
            yield from pieces(held_k, held_f, rows)

    def pieces(k, f, rows):
        begins = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        sizes = np.diff(np.append(begins, len(k)))
        for at, n in zip(begins[sizes > longest], sizes[sizes > longest]):
            yield rows(f[at:at + n], f[at:at + n], k[at])
        fits = np.repeat(sizes <= longest, sizes)
        u, v = run_links(k[fits], f[fits], most)
        if len(u):
            yield rows(u, v)

    keyed = nodes.select("fp").mapInArrow(spread_keys, "key int, fp long")
    met = stored(keyed.repartition(parts, "key").sortWithinPartitions("key", "fp").mapInArrow(meet, "u long, v long, key int"), "simhash-links")
    long_runs = met.where("key is not null")
    sizes = stored(long_runs.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / longest).cast("int").alias("blocks")), "simhash-runs")
    blocks = (long_runs.join(sizes, "key").withColumn("at", F.pmod(F.xxhash64("u"), F.col("blocks")))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("key", F.least("at", "other").alias("i"), F.greatest("at", "other").alias("j"), "u"))

    def tile(group: pa.Table) -> pa.Table:
        pairs = forest(group.column("u").to_numpy(), most)
        u, v = (np.concatenate([p[i] for p in pairs]) if pairs else np.empty(0, np.int64) for i in (0, 1))
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return met.where("key is null").select("u", "v").union(blocks.groupBy("key", "i", "j").applyInArrow(tile, "u long, v long")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node with an edge; edges are (u, v).

    Alternates large-star and small-star steps (Kiveris et al., 2014) until nothing changes. Each step takes minima per
    node, pre-aggregated, and joins them back as a stored table, so Spark splits a node that owns many edges.
    """
    def state(df):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components")
    known = state(now)
    while known[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "components-min")
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "components-large")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "components-min")
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = stored(small.select("e.u", "e.v").where("u <> v").distinct(), "components")
        last, known = known, state(now)
        if last == known:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def classified(docs: DataFrame, key: str, text: str, width: int, most: int, longest: int) -> tuple[DataFrame, DataFrame]:
    """The documents as (_key, t64, fp) and the fingerprints as (fp, root, component_id)."""
    marked = docs.select(docs[key].alias("_key"), F.xxhash64(F.coalesce(docs[text].cast("string"), F.lit(""))).alias("t64"), docs[text].alias("_t"))
    rows = stored(fingerprints(marked, ["_key", "t64"], "_t", width), "simhash-rows")
    nodes = stored(rows.groupBy("fp").agg(F.min("_key").alias("first")), "simhash-nodes")
    roots = components(links(nodes, most, longest))
    rooted = stored(nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first"), "simhash-roots")
    named = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-names")
    return rows, stored(rooted.join(named, "root").select("fp", "root", "component_id"), "simhash-classes")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, most: int = MOST_BITS,
                    longest: int = LONGEST_RUN) -> DataFrame:
    """(key, fingerprint, component_id) for every document: the smallest key reachable over links of ``most`` bits or fewer.

    Whole texts count; null, empty and blank texts have fingerprint zero and are linked like any other. Repeated rows give
    repeated rows. Null keys are linked but never name a component unless all its keys are null (then null). An empty
    table gives no row; other columns are not read.
    """
    rows, classes = classified(docs, key, text, width, most, longest)
    return rows.join(classes, "fp").select(F.col("_key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def first_rows(docs: DataFrame, key: str, text: str, first: DataFrame) -> DataFrame:
    """The rows that ``first`` (_n, _k, _t64: key is null, key, text hash) names, one each, all columns."""
    keyed = docs.select("*", docs[key].isNull().alias("_n"), F.coalesce(docs[key].cast("string"), F.lit("")).alias("_k"),
                        F.xxhash64(F.coalesce(docs[text].cast("string"), F.lit(""))).alias("_t64"))
    return keyed.join(first, ["_n", "_k", "_t64"], "left_semi").dropDuplicates(["_n", "_k", "_t64"]).select(*docs.columns)


def without_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, most: int = MOST_BITS) -> DataFrame:
    """One document of each component, all columns: the one with the least key (rows without a key come last), then text hash."""
    rows, classes = classified(docs, key, text, width, most, LONGEST_RUN)
    first = rows.join(classes, "fp").groupBy("root").agg(F.min(F.struct(F.col("_key").isNull().alias("n"), "_key", "t64")).alias("m"))
    first = stored(first.select(F.col("m.n").alias("_n"), F.coalesce(F.col("m._key").cast("string"), F.lit("")).alias("_k"), F.col("m.t64").alias("_t64")), "simhash-kept")
    return first_rows(docs, key, text, first)
