"""Packing of documents into few training sequences by a configuration linear program.

Only the lengths of the pieces matter for the packing, and there are no more of them than a sequence has tokens. So the
histogram of lengths, counted by Spark, goes to the driver, whatever the number of documents. A configuration says how many pieces of
each length one sequence takes. The linear program over all configurations is solved by multiplicative weights: each
length has a price, the configuration of the greatest worth is found by a knapsack over the tokens, it is used for a small
share of the pieces it holds, and the prices of these lengths fall. The uses are then rounded down to whole sequences; what is
left is filled sequence by sequence with the configuration of the greatest worth among the pieces that are left.

Spark numbers the pieces of each length, without a shuffle of the documents, and looks up which sequence and place a number has.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from shopflow.llm.base import kept_in_worker, scoped, stored
from shopflow.llm.bpe import byte_letters, read_definition

SIZE = 1024
END = 2
TURNS = 100  # configurations that the linear program may mix
STEP = 0.25  # share of the scarcest length's pieces that one turn gives to a configuration
BONUS = 0.5  # of a price, for pieces as long as a sequence
RATE = 0.5  # by which a bonus falls when all pieces of its length are covered
LONGEST_BLANK = 10_000  # blanks in a row that the fast encoder is given

#: Fixed: how the byte-level vocabularies cut a text into pieces.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """Ids of texts as the tokenizers library gives them, special tokens recognised.

    A byte-level vocabulary whose merges have their ids in order is encoded by tiktoken, several times as fast; all others, and
    texts with very long runs of blanks, by the library itself.
    """

    def __init__(self, definition: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(definition)
        self.library.no_truncation()
        self.library.no_padding()
        self.fast = self._fast(json.loads(definition))

    @staticmethod
    def _fast(spec: dict):
        model, cut = spec["model"], spec["pre_tokenizer"] or {}
        vocab, merges = model.get("vocab"), model.get("merges")
        plain = spec["normalizer"] is None and cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space") and model.get("type") == "BPE"
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if not plain or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")) \
                or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] or not t["special"] for t in spec["added_tokens"]):
            return None
        letters = byte_letters()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        if sorted(vocab.get(c, -1) for c in letters) != list(range(256)) or any(vocab.get(a + b) != 256 + rank for rank, (a, b) in enumerate(pairs)):
            return None
        import tiktoken

        ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items() if token not in special}
        return tiktoken.Encoding("byte-level", pat_str=PIECES, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or " " * LONGEST_BLANK in text or any(c * LONGEST_BLANK in text for c in "\n\t\r"):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")
        return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)


def pieces(docs: DataFrame, definition: str, size: int, end: int, ids: bool) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, task, turn[, ids]); ``turn`` counts the earlier pieces of that length in the task."""
    shipped = docs.sparkSession.sparkContext.broadcast(definition)  # as large as the vocabulary
    name = "packing-" + hashlib.sha256(definition.encode()).hexdigest()
    key = docs.schema[0].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "turn", *["ids"] * ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_in_worker(name, lambda: Encoder(shipped.value))
        task, seen = TaskContext.get().partitionId(), [0] * (size + 1)
        for batch in batches:
            rows: list[tuple] = []
            held = []
            for at, text in enumerate(batch.column(1).to_pylist()):
                made = np.append(encoder.ids(text or ""), np.uint32(end)).astype("<u4")
                first = len(made) % size or size
                for piece, (a, b) in enumerate(zip([0, *range(first, len(made), size)], range(first, len(made) + 1, size))):
                    rows.append((at, piece, a, b - a, zlib.crc32(made[a:b]), task, seen[b - a]))
                    seen[b - a] += 1
                    if ids:
                        held.append(made[a:b].astype(np.int32))
            if rows:
                at, *columns = (np.array(c, np.int64) for c in zip(*rows))
                out = [batch.column(0).take(pa.array(at)), *map(pa.array, columns)]
                yield pa.RecordBatch.from_arrays([*out, pa.array(held, pa.list_(pa.int32()))] if ids else out, names=names)

    return docs.mapInArrow(run, f"doc_id {key}, piece long, start long, length long, ids_crc32 long, task long, turn long" + ", ids array<int>" * ids)


def richest(size: int, prices: dict[int, float], counts: dict[int, int]) -> dict[int, int]:
    """The configuration of the greatest worth with at most ``counts`` pieces of each length: a knapsack by dynamic programming.

    Many pieces of a length are offered in packs of 1, 2, 4 and so on.
    """
    packs = []
    for length, price in prices.items():
        left, pack = min(counts[length], size // length), 1
        while left > 0:
            take = min(pack, left)
            packs.append((length, take, take * length, take * price))
            left, pack = left - take, 2 * pack
    worth, taken = np.zeros(size + 1), np.zeros((len(packs), size + 1), bool)
    for i, (_, _, weight, value) in enumerate(packs):
        with_it = worth[:size + 1 - weight] + value
        better = with_it > worth[weight:] + 1e-12
        taken[i, weight:] = better
        worth[weight:] = np.where(better, with_it, worth[weight:])
    at, chosen = size, {}
    for i in range(len(packs) - 1, -1, -1):
        if taken[i, at]:
            length, take, weight, _ = packs[i]
            chosen[length] = chosen.get(length, 0) + take
            at -= weight
    return chosen


class Prices:
    """A length's price: its share of a sequence, and up to ``BONUS`` of that more for long pieces that are not covered yet.

    Shares alone are the optimum of the dual wherever sequences can be filled whole. The bonus keeps small pieces, which can
    close any gap, for sequences that need them; its weights fall by ``RATE`` with each time that a length is covered.
    """

    def __init__(self, size: int, demand: dict[int, int]) -> None:
        self.size, self.demand, self.weight = size, demand, dict.fromkeys(demand, 1.0)

    def __getitem__(self, length: int) -> float:
        share = length / self.size
        return share * (1 + BONUS * share * self.weight[length])

    def cover(self, config: dict[int, int], amount: float) -> None:
        for length, a in config.items():
            self.weight[length] *= (1 - RATE) ** (amount * a / self.demand[length])


def linear_program(size: int, demand: dict[int, int], prices: Prices, turns: int, step: float) -> list[tuple[dict[int, int], float]]:
    """Uses of configurations, by multiplicative weights: each turn gives the best one a share of its scarcest length."""
    left, uses = {length: float(n) for length, n in demand.items()}, []
    for _ in range(turns):
        open_ = [length for length, n in left.items() if n >= 1]
        if not open_:
            break
        best = richest(size, {length: prices[length] for length in open_}, {length: int(left[length]) for length in open_})
        amount = step * min(left[length] / a for length, a in best.items())
        for length, a in best.items():
            left[length] -= amount * a
        prices.cover(best, amount)
        uses.append((best, amount))
    return uses


def configurations(histogram: dict[int, int], size: int, turns: int = TURNS, step: float = STEP) -> list[tuple[dict[int, int], int]]:
    """(configuration, number of sequences): packs every piece of the histogram exactly once."""
    left = {length: n for length, n in sorted(histogram.items(), reverse=True) if n and length < size}
    made = [({size: 1}, histogram[size])] if histogram.get(size) else []
    prices = Prices(size, dict(left))

    def use(config: dict[int, int], times: int) -> None:
        made.append((config, times))
        for length, a in config.items():
            left[length] -= times * a
            if not left[length]:
                del left[length]

    for config, amount in linear_program(size, dict(left), prices, turns, step):
        if times := min(int(amount), *(left.get(length, 0) // a for length, a in config.items())):
            use(config, times)
    while left:
        # the longest piece that is left must go somewhere: the best filling around it
        longest = max(left)
        rest = {length: n - (length == longest) for length, n in left.items() if length <= size - longest and n > (length == longest)}
        config = richest(size - longest, {length: prices[length] for length in rest}, rest)
        config[longest] = config.get(longest, 0) + 1
        times = min(left[length] // a for length, a in config.items())
        use(config, times)
        prices.cover(config, times)
    return made


def places(made: list[tuple[dict[int, int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: (first number, pieces in a sequence, first sequence, offset) of each run of numbers."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for config, times in made:
        offset = 0
        for length in sorted(config, reverse=True):
            runs.setdefault(length, []).append((used.get(length, 0), config[length], sequence, offset))
            used[length] = used.get(length, 0) + times * config[length]
            offset += length * config[length]
        sequence += times
    return {length: tuple(np.array(c, np.int64) for c in zip(*rows)) for length, rows in runs.items()}


@scoped
def pack(docs: DataFrame, tokenizer_path: str, size: int = SIZE, end: int = END, key: str = "doc_id", text: str = "text", ids: bool = True,
         turns: int = TURNS, step: float = STEP) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset[, ids]) of all pieces.

    A document is its ids and ``end``; a longer one than ``size`` is cut into pieces of ``size``, of which the first may be
    shorter. Null and empty texts are one piece of the end alone. Repeated rows are packed each; an empty table gives no row.
    """
    if size < 1:
        raise ValueError("a sequence holds at least one token")
    narrow = docs.select(docs[key].alias("doc_id"), docs[text].cast("string").alias("text"))
    cut = stored(pieces(narrow, read_definition(tokenizer_path), size, end, ids), "packing-pieces", keep=True)
    counts = stored(cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "packing-counts")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most a row for each length
    runs = docs.sparkSession.sparkContext.broadcast(places(configurations(histogram, size, turns, step)))  # bounded by turns and lengths
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")), "packing-starts", keep=True)
    numbered = cut.join(starts, ["length", "task"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("turn")).alias("number"), *["ids"] * ids)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, numbers = batch.column("length").to_numpy(), batch.column("number").to_numpy()
            sequences, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                first, each, sequence, offset = runs.value[int(length)]
                run = np.searchsorted(first, numbers[rows], side="right") - 1
                turn, place = np.divmod(numbers[rows] - first[run], each[run])
                sequences[rows], offsets[rows] = sequence[run] + turn, offset[run] + place * length
            rest = [batch.column("ids")] if ids else []
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequences), pa.array(offsets), *rest], names=[key, *names])

    names = ["piece", "start", "length", "ids_crc32", "sequence_id", "offset", *["ids"] * ids]
    schema = f"`{key}` {narrow.schema[0].dataType.simpleString()}, " + ", ".join(f"{c} long" for c in names[:6]) + ", ids array<int>" * ids
    return numbered.mapInArrow(look_up, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of rows packed with ids: each sequence end to end, no longer than the size they were packed for."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
