"""Byte-pair encoding and decoding with a contiguous rank array per word.

A word holds its parts and, in an array beside them, the merge rank of each adjacent pair. The least rank is found by
scanning the array, the boundary is deleted and the two neighbouring ranks are refreshed. Long words, for which repeated
scans are slow, find the same leftmost least rank by a heap.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from shopflow.llm.base import kept_in_worker

NO_RANK = 1 << 60
LOW = (1 << 24) - 1  # bits of an id
SHORT_WORD = 256
CACHE = 150_000  # distinct chunks that a worker remembers in a generation; two are held
PIECES = 60_000


class Remembered(dict):
    """Values by chunk; two generations bound its size."""

    def __init__(self, make, limit: int = CACHE) -> None:
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def renew(self) -> None:
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()


class Vocabulary:
    """Encoder and decoder of a tokenizer file with byte letters and word ends.

    How a text is normalised and cut into pieces is left to the library, whose character tables are of its own Unicode version;
    the merges of a piece are made here.
    """

    def __init__(self, definition: str) -> None:
        library = Tokenizer.from_str(definition)
        self.normalise, self.pieces = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        spec = json.loads(definition)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        self.merges = {(self.ids[a], self.ids[b]): rank << 24 | self.ids[a + b] for rank, (a, b) in enumerate(model["merges"])}
        self.tokens = {i: t for t, i in self.ids.items()}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens |= {i: t for t, i in special.items()}
        self.special = special
        self.digits = {i: str(i).encode() for i in self.tokens}
        self.letters_of = {i: t.encode() for i, t in self.tokens.items()}
        self.letter = Remembered(lambda c: self.pieces(c)[0][0])
        self.known_pieces = Remembered(self.word, PIECES)
        self.at_special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def word(self, word: str) -> list[int]:
        """The ids of one piece, given as byte letters."""
        letters = list(word)
        letters[-1] += self.end
        parts = list(map(self.ids.get, letters))
        if None in parts:
            parts = [p for p in parts if p is not None]
        return self._scan(parts) if len(parts) <= SHORT_WORD else self._heap(parts)

    def _scan(self, parts: list[int]) -> list[int]:
        """``near`` holds for each adjacent pair its rank and, in the low bits, the id of their merge."""
        get = self.merges.get
        near = list(map(get, zip(parts, parts[1:]), repeat(NO_RANK)))
        while near and (least := min(near)) != NO_RANK:
            at = near.index(least)
            parts[at] = least & LOW
            del parts[at + 1], near[at]
            if at < len(near):
                near[at] = get((parts[at], parts[at + 1]), NO_RANK)
            if at:
                near[at - 1] = get((parts[at - 1], parts[at]), NO_RANK)
        return parts

    def _heap(self, parts: list[int]) -> list[int]:
        n = len(parts)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(self.merges[p] >> 24, i, p) for i, p in enumerate(zip(parts, parts[1:])) if p in self.merges]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j < 0 or (parts[i], parts[j]) != pair:
                continue
            parts[i], parts[j] = self.merges[pair] & LOW, None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (found := self.merges.get((parts[a], parts[b]))) is not None:
                    heapq.heappush(heap, (found >> 24, a, (parts[a], parts[b])))
        return [p for p in parts if p is not None]

    def encode_chunk(self, chunk: str) -> list[int]:
        """The ids of text without ASCII blanks; no piece spans a blank, so texts may be encoded chunk by chunk."""
        core = chunk.rstrip(".,")
        if core.isalpha() and (core.isascii() or max(core) < "\u0130"):  # Latin letters, a piece that needs lower case; then one of marks
            piece = core.lower()
            ids = self.known_pieces[piece if piece.isascii() else "".join(map(self.letter.__getitem__, piece))]
            return ids if len(core) == len(chunk) else ids + self.known_pieces[chunk[len(core):]]
        out: list[int] = []
        for part in self.at_special.split(chunk) if self.at_special else [chunk]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                for piece, _ in self.pieces(self.normalise(part)):
                    out += self.known_pieces[piece]
        return out

    def encode(self, text: str) -> list[int]:
        return [i for chunk in text.encode().split() for i in self.encode_chunk(chunk.decode())]

    def decode(self, ids: list[int]) -> str:
        """The tokens joined by one space; unknown ids give nothing."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printing characters stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_definition(path: str) -> str:
    """A tokenizer file on the driver; tasks get its content, which is as large as the vocabulary, by broadcast."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, path: str, keep: list[str] | None = None, text: str = "text", digests: bool = False) -> DataFrame:
    """``keep`` (default: all columns but the text), n_tokens and ids; with ``digests`` the hashes ids_sha256 and decoded_sha256 in place of ids.

    Whole texts are encoded, special tokens written in a text are recognised. Null and empty texts have no ids. Repeated rows
    are encoded each; an empty table gives no row; columns named like a result are replaced.
    """
    made = ["n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["n_tokens", "ids"]
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in [*made, text]]
    definition = docs.sparkSession.sparkContext.broadcast(read_definition(path))
    marked = docs.select(*[docs[c].alias(c) for c in keep], docs[text].cast("string").alias("_text"))

    spec_hash = hashlib.sha256(definition.value.encode()).hexdigest()

    def chunks_known() -> Remembered:
        vocabulary = Vocabulary(definition.value)
        digits, letters = vocabulary.digits, vocabulary.letters_of

        def made_of(chunk: bytes):
            ids = vocabulary.encode_chunk(chunk.decode())
            if digests:
                return len(ids), b" ".join([digits[i] for i in ids]), b" ".join([letters[i] for i in ids])
            return array("i", ids).tobytes()

        made = Remembered(made_of)
        made.vocabulary = vocabulary
        return made

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = kept_in_worker(f"bpe-{digests}-{spec_hash}", chunks_known)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            if digests:
                counts, hashes, decoded = [], [], []
                for t in texts:
                    # of each chunk: number of ids, ids, decoded text; chunks of no id leave no space between others
                    n, ids, tokens = zip(*map(known.__getitem__, (t or "").encode().split()), (0, b"", b""))
                    if 0 in n[:-1]:
                        ids, tokens = (*filter(None, ids), b""), (*filter(None, tokens), b"")
                    counts.append(sum(n))
                    hashes.append(hashlib.sha256(b" ".join(ids[:-1])).hexdigest())
                    decoded.append(hashlib.sha256(b" ".join(tokens[:-1])).hexdigest())
                    known.renew()
                    known.vocabulary.known_pieces.renew()
                columns = [pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())]
            else:
                rows = [array("i", b"".join([known[c] for c in (t or "").encode().split()])) for t in texts]
                columns = [pa.array([len(r) for r in rows], pa.int64()), pa.array(rows, pa.list_(pa.int32()))]
            known.renew()
            known.vocabulary.known_pieces.renew()
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*keep, *made])

    kinds = {"n_tokens": "long", "ids": "array<int>", "ids_sha256": "string", "decoded_sha256": "string"}
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in marked.schema.fields[:-1]] + [f"{c} {kinds[c]}" for c in made])
    return marked.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Adds the tokens of ``ids`` joined by one space; null ids give null, unknown ids nothing."""
    definition = encoded.sparkSession.sparkContext.broadcast(read_definition(path))
    rest = [c for c in encoded.columns if c != name]
    at = rest.index(ids)
    source = encoded.select(*[encoded[c] for c in rest])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(definition.value)
        for batch in batches:
            texts = [None if x is None else vocabulary.decode(x) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*rest, name])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema] + [f"`{name}` string"])
    return source.mapInArrow(run, schema)
