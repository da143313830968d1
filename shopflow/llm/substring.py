"""Removal of passages that already occur in an earlier document, by suffix automata of reference shards.

A passage is a window of consecutive words. Which shards can hold a window's match is told by an anchor: of all short word
n-grams inside the window, the one with the least hash. Equal windows have equal anchors, so the windows of an anchor form
a shard of their own, and only anchors met in two documents or more matter. The distinct stretches of text around such an
anchor are the references of its shard: a suffix automaton over their words, each state marked with the earliest document
that contains it, is built in a task. All stretches of the anchor are then streamed through it for their matching
statistics: where the match reaches the window length, the state says which document had the window first.

An anchor with many distinct stretches is split into shards of bounded size; its stretches stream through each of them, one
shard's stretches past one shard's automaton at a time.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shopflow.llm.base import by_batch, scoped, stored

WINDOW = 50
GRAM = 10
LONGEST_STRETCH = 64  # windows in a stretch
SHARD = 500  # distinct stretches in an automaton
LAST = (1 << 63) - 1  # rows without an id come after all others


def gram_hashes(words: list[bytes], gram: int) -> np.ndarray:
    """Mixed 64-bit hashes of the word n-grams; collisions cost time only, the automata compare words."""
    each = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    n = len(words) - gram + 1
    total = np.zeros(n, np.uint64)
    factor = 1
    for j in range(gram):
        total += each[j:j + n] * np.uint64(factor)
        factor = factor * 0x9E3779B97F4A7C15 % (1 << 64)
    total ^= total >> np.uint64(29)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return total ^ (total >> np.uint64(32))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def stretches(words: list[bytes], window: int = WINDOW, gram: int = GRAM, longest: int = LONGEST_STRETCH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first window and number of windows of each run of windows with one anchor."""
    if len(words) < window:
        return np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int32)
    anchor = sliding_min(gram_hashes(words, gram), window - gram + 1)
    begins = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    sizes = np.diff(np.append(begins, len(anchor)))
    if sizes.max() > longest:  # periodic text
        begins = np.concatenate([np.arange(b, b + n, longest) for b, n in zip(begins, sizes)])
        sizes = np.diff(np.append(begins, len(anchor)))
    return anchor[begins].view(np.int64), begins.astype(np.int32), sizes.astype(np.int32)


class Automaton:
    """Suffix automaton over several word sequences; ``first`` is the earliest document in which a state's words occur."""

    def __init__(self) -> None:
        self.length, self.link, self.next, self.first = [0], [-1], [{}], [LAST]

    def _state(self, length: int, link: int, follow: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(follow)
        self.first.append(LAST)
        return len(self.length) - 1

    def _split(self, state: int, word, target: int) -> int:
        """The state for the words of ``state`` followed by ``word``, out of ``target``, which also holds longer ones."""
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def add(self, words: list, document: int) -> None:
        last = 0
        for word in words:
            known = self.next[last].get(word)
            if known is not None:
                last = self._split(last, word, known)
            else:
                state, new = last, self._state(self.length[last] + 1, 0, {})
                while state >= 0 and word not in self.next[state]:
                    self.next[state][word] = new
                    state = self.link[state]
                if state >= 0:
                    self.link[new] = self._split(state, word, self.next[state][word])
                last = new
            if document < self.first[last]:
                self.first[last] = document

    def finish(self) -> None:
        """Words of a state are suffixes of the words of the states that link to it."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            up = self.link[state]
            if self.first[state] < self.first[up]:
                self.first[up] = self.first[state]

    def earliest(self, words: list, window: int) -> list[int]:
        """For each window of ``words`` the earliest document that contains it; ``LAST`` if none does."""
        out, state, length = [], 0, 0
        for i, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            else:
                length = 0
            if i >= window - 1:
                if length < window:
                    out.append(LAST)
                    continue
                while self.length[self.link[state]] >= window:
                    state = self.link[state]
                length = min(length, self.length[state])
                out.append(self.first[state])
        return out


def runs_of(values: list[int]) -> list[dict]:
    """Runs of equal values but ``LAST``, as from, to (exclusive), first."""
    out: list[dict] = []
    for i, v in enumerate(values):
        if v == LAST:
            continue
        if out and out[-1]["to"] == i and out[-1]["first"] == v:
            out[-1]["to"] = i + 1
        else:
            out.append({"from": i, "to": i + 1, "first": v})
    return out


RUNS = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32()), ("first", pa.int64())]))


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def kept_words(words: list[bytes], spans: list[tuple[int, int]]) -> list[bytes]:
    out, at = [], 0
    for a, b in spans:
        out += words[at:a]
        at = b
    return out + words[at:]


def _identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    plain = F.coalesce(docs[text].cast("string"), F.lit(""))
    return docs.select(docs[key].cast("long").alias("id"), F.coalesce(docs[key].cast("long"), F.lit(LAST)).alias("key"), F.xxhash64(plain).alias("t64"), plain.alias("text"))


def matches(distinct: DataFrame, window: int, shard: int) -> DataFrame:
    """(h, sid, runs) for distinct stretches (h, sid, words, first): which windows occur first in which document."""
    sizes = stored(distinct.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "substring-sizes")
    shards = F.ceil(F.col("n") / shard).cast("int")
    several = distinct.join(sizes, "h").withColumn("home", F.pmod(F.col("sid"), shards).cast("int"))
    # a tile (shard, part) streams the stretches of one home past the references of another; both are of bounded size
    every = F.sequence(F.lit(0), shards - 1)
    tiles = F.concat(F.transform(every, lambda p: F.struct(F.col("home").alias("shard"), p.alias("part"), F.lit(0).alias("guest"))),
                     F.transform(F.filter(every, lambda s: s != F.col("home")), lambda s: F.struct(s.alias("shard"), F.col("home").alias("part"), F.lit(1).alias("guest"))))
    dealt = several.withColumn("tile", F.explode(tiles)).select("h", "tile.shard", "tile.part", "tile.guest", "sid", "words", "first")
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                                               pa.array([r[2] for r in rows], RUNS)], names=["h", "sid", "runs"])

        now, automaton, waiting, done, finished = None, None, [], [], False

        def close():
            """The references are complete: stream them through their own automaton."""
            nonlocal finished
            if automaton is not None and not finished:
                automaton.finish()
                finished = True
                done.extend((now[0], sid, runs_of(automaton.earliest(words, window))) for sid, words in waiting)
                waiting.clear()

        for batch in batches:
            for h, shard_no, part, guest, sid, words, first in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if (h, shard_no, part) != now:
                    close()
                    now, automaton, finished = (h, shard_no, part), Automaton(), False
                words = words.split(" ")
                if guest:
                    close()
                    done.append((h, sid, runs_of(automaton.earliest(words, window))))
                else:
                    automaton.add(words, first)
                    if shard_no == part:
                        waiting.append((sid, words))
            if len(done) > 1000:
                yield out(done)
                done.clear()
        close()
        if done:
            yield out(done)

    schema = "h long, sid long, runs array<struct<from:int,to:int,first:long>>"
    found = dealt.repartition(parts, "h", "shard", "part").sortWithinPartitions("h", "shard", "part", "guest").mapInArrow(run, schema)
    # a stretch alone at its anchor has all its windows from its first document
    n = F.size(F.split("words", " ")) - (window - 1)
    single = distinct.join(sizes, "h", "left_anti").select("h", "sid", F.array(F.struct(F.lit(0).alias("from"), n.cast("int").alias("to"), F.col("first"))).alias("runs"))
    return found.union(single)


@scoped
def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM, shard: int = SHARD) -> DataFrame:
    """One row per document row: id, t64 (hash of the text), n_words, n_removed, spans, kept_sha256.

    ``spans`` are the merged word ranges (from, to) covered by windows that a document with a smaller id contains; windows
    are judged on the input. ``kept_sha256`` is of the kept words joined by one space. Null, empty and short texts lose
    nothing. Rows without an id come after all rows with one and never precede each other; rows that repeat an id never
    remove each other's words; whole copies of an earlier document's words are told by their hash and lose all words. An
    empty table gives no row. Very long texts stay in one task each, cut into stretches of bounded length.
    """
    ids = _identified(docs, key, text)

    def anchors(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_words, shas, hs, begins, sizes = [], [], [], [], []
        for t in batch.column(3).to_pylist():
            words = t.encode().split()
            h, b, s = stretches(words, window, gram)
            n_words.append(len(words))
            shas.append(hashlib.sha256(b" ".join(words)).hexdigest())
            hs.append(h)
            begins.append(b)
            sizes.append(s)
        return pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(n_words, pa.int64()), pa.array(shas), pa.array(hs, pa.list_(pa.int64())),
                                           pa.array(begins, pa.list_(pa.int32())), pa.array(sizes, pa.list_(pa.int32()))],
                                          names=["id", "key", "t64", "n_words", "sha", "hs", "begins", "sizes"])

    base = stored(by_batch(ids, anchors, "id long, key long, t64 long, n_words long, sha string, hs array<long>, begins array<int>, sizes array<int>"), "substring-base")
    # whole copies: the first of equal word sequences takes part, the others are done
    owners = stored(base.groupBy("sha").agg(F.min("key").alias("owner")), "substring-owners")
    owned = stored(base.select("id", "key", "t64", "n_words", "sha").join(owners, "sha"), "substring-owned", keep=True)
    firsts = owned.where(f"key = owner and n_words >= {window}").select("key", "t64").distinct()
    taking = stored(base.where(f"n_words >= {window}").select("key", "t64", "hs", "begins", "sizes").dropDuplicates(["key", "t64"])
                    .join(firsts, ["key", "t64"]), "substring-taking")
    marks = taking.select("key", "t64", F.explode(F.arrays_zip(F.col("hs").alias("h"), F.col("begins").alias("at"), F.col("sizes").alias("n"))).alias("m")).select("key", "t64", "m.h", "m.at", "m.n")
    shared = stored(marks.groupBy("h").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low < high").select("h"), "substring-shared")
    met = marks.join(shared, "h").groupBy("key", "t64").agg(F.collect_list(F.struct("h", "at", "n")).alias("marks"))
    affected = stored(ids.select("key", "t64", "text").join(met, ["key", "t64"]).dropDuplicates(["key", "t64"]), "substring-affected")

    def cut_out(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        keys, t64s, hs, ats, texts = [], [], [], [], []
        for k, t64, t, found in zip(*(batch.column(i).to_pylist() for i in range(4))):
            words = t.encode().split()
            for m in found:
                keys.append(k)
                t64s.append(t64)
                hs.append(m["h"])
                ats.append(m["at"])
                texts.append(b" ".join(words[m["at"]:m["at"] + m["n"] + window - 1]))
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(t64s, pa.int64()), pa.array(hs, pa.int64()), pa.array(ats, pa.int32()),
                                           pa.array(texts, pa.binary()).cast(pa.string())], names=["key", "t64", "h", "at", "words"])

    pieces = stored(by_batch(affected, cut_out, "key long, t64 long, h long, at int, words string").withColumn("sid", F.xxhash64("words")), "substring-pieces")
    distinct = stored(pieces.groupBy("h", "sid", "words").agg(F.min("key").alias("first")), "substring-distinct")
    runs = stored(matches(distinct, window, shard), "substring-runs").select("h", "sid", F.explode("runs").alias("r"))
    runs = stored(runs.groupBy("h", "sid", F.col("r.from").alias("from"), F.col("r.to").alias("to")).agg(F.min("r.first").alias("first")), "substring-runs")
    covered = (pieces.select("key", "t64", "h", "at", "sid").join(runs, ["h", "sid"]).where("first < key")
               .groupBy("key", "t64").agg(F.collect_list(F.struct((F.col("at") + F.col("from")).alias("from"), (F.col("at") + F.col("to") + (window - 1)).alias("to"))).alias("ranges")))

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        removed, spans, shas = [], [], []
        for t, ranges in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            words = t.encode().split()
            spans.append(merged([(r["from"], r["to"]) for r in ranges]))
            removed.append(sum(b - a for a, b in spans[-1]))
            shas.append(hashlib.sha256(b" ".join(kept_words(words, spans[-1]))).hexdigest())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(removed, pa.int64()),
                                           pa.array([[{"from": a, "to": b} for a, b in s] for s in spans], pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))),
                                           pa.array(shas)], names=["key", "t64", "n_removed", "spans", "kept_sha256"])

    schema = "key long, t64 long, n_removed long, spans array<struct<from:int,to:int>>, kept_sha256 string"
    partly = by_batch(affected.select("key", "t64", "text").join(covered, ["key", "t64"]).select("key", "t64", "text", "ranges"), judge, schema)
    judged = owned.join(stored(partly, "substring-partly", keep=True), ["key", "t64"], "left")
    copy = F.expr(f"owner < key and n_words >= {window}")
    none = F.array().cast("array<struct<from:int,to:int>>")
    return judged.select("id", "t64", "n_words", F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
                         F.when(copy, F.array(F.struct(F.lit(0).alias("from"), F.col("n_words").cast("int").alias("to")))).otherwise(F.coalesce("spans", none)).alias("spans"),
                         F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))


def without_spans(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with the spans of ``dedup`` cut out of their texts; blanks between kept words stay. All columns are kept."""
    cut = found.where("n_removed > 0").select(F.coalesce("id", F.lit(LAST)).alias("_key"), F.col("t64").alias("_t64"), "spans").dropDuplicates(["_key", "_t64"])
    keyed = docs.withColumn("_key", F.coalesce(docs[key].cast("long"), F.lit(LAST))).withColumn("_t64", F.xxhash64(F.coalesce(docs[text].cast("string"), F.lit(""))))
    joined = keyed.join(cut, ["_key", "_t64"], "left").drop("_key", "_t64")
    columns = docs.columns
    at = columns.index(text)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = batch.column(len(columns)).to_pylist()
        texts = [t if not s else _cut(t, s) for t, s in zip(batch.column(at).to_pylist(), spans)]
        made = list(batch.columns[:len(columns)])
        made[at] = pa.array(texts, batch.column(at).type)
        return pa.RecordBatch.from_arrays(made, names=columns)

    return by_batch(joined, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))


def _cut(text: str, spans: list[dict]) -> str:
    """The text without the words of the spans and the blanks that follow them."""
    raw = text.encode()
    starts, ends, at = [], [], 0
    for word in raw.split():
        at = raw.index(word, at)
        starts.append(at)
        at += len(word)
        ends.append(at)
    out, at = [], 0
    for s in spans:
        out.append(raw[at:starts[s["from"]]])
        at = starts[s["to"]] if s["to"] < len(starts) else len(raw)
    return b"".join([*out, raw[at:]]).decode()
