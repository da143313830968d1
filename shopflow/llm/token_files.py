"""Token files: documents' ids in ascending document order, each document a zstandard frame of its own.

All frames share a dictionary trained on serialized id arrays, so that short documents compress well and any one of them is
read by decompressing its frame alone. A file row is a block: frames end to end in ``payload`` and an index ``entries`` of
(doc_id, offset, length, start, n_tokens) in document order, with the hash of the dictionary that the frames need. The
files are Parquet, so Spark commits them whole, retries lost tasks and reads the index without the payload.
"""

from __future__ import annotations

import hashlib
import json
import os
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shopflow.llm.base import kept_in_worker, stored
from shopflow.llm.bpe import Remembered, byte_letters, read_definition

CHUNKS = 150_000  # that a worker remembers in a generation; two are held
PROBES = ["word", "Chairs.", "été,", "GROSS", "Ärger..", "ñandú", "x", "Straße"]
WORD_END = b"\xff"
BLOCK_BYTES = 4 << 20
BLOCK_DOCS = 4096
SAMPLE_DOCS = 2000  # documents the dictionary is trained on
SAMPLE_BYTES = 16_384  # longest text among them
DICTIONARY_BYTES = 65_536

ENTRIES = pa.list_(pa.struct([("doc_id", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())]))


def tokenizer(definition: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    made = Tokenizer.from_str(definition)
    made.no_truncation()
    made.no_padding()
    return made


def piece_encoder(definition: str) -> Callable[[bytes], list[int]] | None:
    """Merges of one piece with ``WORD_END`` behind it, for byte-level vocabularies with word ends whose merges have their ids in order.

    The end is a byte that no text holds. It joins the last letter before any other merge, since these pairs have the
    lower ids, and ids in merge order are ranks, so tiktoken makes the same merges.
    """
    model = json.loads(definition)["model"]
    end, vocab, letters = model.get("end_of_word_suffix"), model.get("vocab"), byte_letters()
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges") or []]
    if not end or model.get("type") != "BPE" or any(c + e not in vocab for c in letters for e in ("", end)):
        return None
    made = [vocab.get(a + b, -1) for a, b in merges]
    if made != sorted(set(made)) or min(made, default=0) <= max(vocab[c + e] for c in letters for e in ("", end)):
        return None
    import tiktoken

    known = {*made, *(vocab[c + e] for c in letters for e in ("", end))}
    ranks = {bytes(letters[c] for c in t.removesuffix(end)) + (WORD_END if t.endswith(end) else b""): i for t, i in vocab.items() if i in known}
    return tiktoken.Encoding("pieces", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._encode_single_piece


class Encoder:
    """Serialized ids of texts.

    No token spans an ASCII blank, so each distinct chunk between blanks is encoded once; nor does one span letters and the
    full stops or commas behind them. Latin letters are merged as the one piece that the library would make of them, if
    that gives the library's ids for the words of ``PROBES``; all other chunks go through the library.
    """

    def __init__(self, definition: str, kind: str) -> None:
        self.tokenizer, self.kind, self.width = tokenizer(definition), kind, int(kind[-1])
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.special and not t.normalized]
        self.mark = min(special, default=None)
        self.mark_id = self.tokenizer.token_to_id(self.mark) if special else None
        self.tails = Remembered(lambda c: self.many([c])[0], 1000)
        self.known = Remembered(lambda c: self.many([c])[0], CHUNKS)
        self.code = "H" if self.width == 2 else "I"
        self.piece = piece_encoder(definition)
        self.latin = (self.piece is not None and sys.byteorder == "little" and array(self.code).itemsize == self.width
                      and [self._latin(p.encode()) for p in PROBES] == self.many([p.encode() for p in PROBES]))

    def many(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of each chunk. Chunks go to the library a few thousand at once, with a special token between them."""
        out: list[bytes] = []
        for at in range(0, len(chunks), 4096):
            part = [c.decode() for c in chunks[at:at + 4096]]
            if self.mark is None or any("<" in c for c in part):
                out += [np.array(x.ids, self.kind).tobytes() for x in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
                continue
            ids = np.array(self.tokenizer.encode_batch_fast([self.mark.join(part)], add_special_tokens=False)[0].ids, np.uint32)
            raw, cuts = ids.astype(self.kind).tobytes(), np.flatnonzero(ids == self.mark_id) * self.width
            out += [raw[a:b] for a, b in zip([0, *(cuts + self.width).tolist()], [*cuts.tolist(), len(raw)])]
        return out

    def _latin(self, chunk: bytes) -> bytes | None:
        """The ids of Latin letters and of full stops or commas behind them; None for any other chunk."""
        core = chunk.rstrip(b".,")
        if core.isalpha():
            piece = core.lower()
        elif core and (text := core.decode()).isalpha() and max(text) < "\u0130":
            piece = text.lower().encode()
        else:
            return None
        ids = array(self.code, self.piece(piece + WORD_END)).tobytes()
        return ids if len(core) == len(chunk) else ids + self.tails[chunk[len(core):]]

    def texts(self, texts: list[str | None], end: int) -> Iterator[bytes]:
        last = np.array([end], self.kind).tobytes()
        known = self.known
        for at in range(0, len(texts), 256):
            split = [(t or "").encode().split() for t in texts[at:at + 256]]
            rest = []
            for chunk in set().union(*split).difference(known):
                made = known.old.get(chunk) or (self._latin(chunk) if self.latin else None)
                if made is None:
                    rest.append(chunk)
                else:
                    known[chunk] = made
            rest.sort(key=lambda c: b"<" in c)
            known.update(zip(rest, self.many(rest)))
            for chunks in split:
                yield b"".join([*map(known.__getitem__, chunks), last])
            known.renew()
            self.tails.renew()


def compression_dict(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def train_dictionary(docs: DataFrame, definition: str, kind: str, end: int, text: str = "text", key: str = "doc_id",
                     sample: int = SAMPLE_DOCS, longest: int = SAMPLE_BYTES, size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from at most ``sample`` documents of at most ``longest`` bytes, least key hash first.

    It changes the size of the files only. Too few documents to train on give raw content, none gives no dictionary.
    """
    short = docs.select(F.xxhash64(docs[key]).alias("h"), docs[text].cast("string").alias("t")).where(F.octet_length("t") <= longest)
    total = docs.count()
    share = F.lit(min((1 << 63) - 1, int(1.5 * sample / max(total, 1) * (1 << 63))))
    near = F.col("h").bitwiseAND((1 << 63) - 1) <= share
    rows = short.where(near).orderBy("h", "t").limit(sample).collect()
    samples = list(Encoder(definition, kind).texts([r.t for r in rows], end))
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def write(docs: DataFrame, path: str, tokenizer_path: str, end: int = 2, key: str = "doc_id", text: str = "text", level: int = 3) -> None:
    """Encode whole texts and write blocks under ``path``/blocks and the dictionary under ``path``/dictionary.

    Ids end with ``end``; null and empty texts have just that. Rows without an id come first, rows that repeat an id follow
    each other in text order. An empty table gives no block. Ids are stored in 16 bits where the vocabulary allows.
    """
    spark = docs.sparkSession
    definition = read_definition(tokenizer_path)
    kind = "<u2" if tokenizer(definition).get_vocab_size() <= 1 << 16 and end < 1 << 16 else "<u4"
    dictionary = train_dictionary(docs, definition, kind, end, text, key)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, bytearray(dictionary), kind)], "dict_hash string, dictionary binary, kind string").coalesce(1).write.parquet(f"{path}/dictionary")
    spec_hash = hashlib.sha256(definition.encode()).hexdigest()
    shipped = spark.sparkContext.broadcast((definition, dictionary))  # vocabulary and dictionary have fixed sizes
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(docs[key].cast("long").alias("doc_id"), docs[text].cast("string").alias("text")).repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    names = ["part", "block", "dict_hash", "first_doc", "last_doc", "entries", "payload"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spec, trained = shipped.value
        encoder = kept_in_worker(f"encoder-{kind}-{spec_hash}", lambda: Encoder(spec, kind))
        packer = zstandard.ZstdCompressor(level=level, dict_data=compression_dict(trained))
        part, block, start = TaskContext.get().partitionId(), 0, 0
        entries, frames, size = [], [], 0

        def full():
            known = [e["doc_id"] for e in entries if e["doc_id"] is not None]
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([digest]), pa.array([min(known, default=None)], pa.int64()),
                 pa.array([max(known, default=None)], pa.int64()), pa.array([entries], ENTRIES), pa.array([b"".join(frames)], pa.binary())], names=names)

        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), encoder.texts(batch.column(1).to_pylist(), end)):
                frame = packer.compress(ids)
                n = len(ids) // int(kind[-1])
                entries.append({"doc_id": doc, "offset": size, "length": len(frame), "start": start, "n_tokens": n})
                frames.append(frame)
                size, start = size + len(frame), start + n
                if size >= BLOCK_BYTES or len(entries) >= BLOCK_DOCS:
                    yield full()
                    entries, frames, size, block = [], [], 0, block + 1
        if entries:
            yield full()

    schema = ("part int, block int, dict_hash string, first_doc long, last_doc long, "
              "entries array<struct<doc_id:long,offset:long,length:long,start:long,n_tokens:long>>, payload binary")
    ordered.mapInArrow(run, schema).write.option("compression", "none").parquet(f"{path}/blocks")


def _unpackers(spark: SparkSession, path: str):
    """(kind, dictionary) by hash; a path has one dictionary of fixed size."""
    rows = spark.read.parquet(f"{path}/dictionary").collect()
    return spark.sparkContext.broadcast({r.dict_hash: (r.kind, bytes(r.dictionary)) for r in rows})


def read(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) read back from the files; ``start`` counts the ids of all documents before it."""
    blocks = spark.read.parquet(f"{path}/blocks")
    shipped = _unpackers(spark, path)
    totals = blocks.select("part", F.explode("entries.n_tokens").alias("n")).groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start")), "token-starts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = {h: (kind, zstandard.ZstdDecompressor(dict_data=compression_dict(d))) for h, (kind, d) in shipped.value.items()}
        for batch in batches:
            for part, digest, entries, payload in zip(*(batch.column(i) for i in range(4))):
                kind, unpacker = unpack[digest.as_py()]
                view, listed = memoryview(payload.as_buffer()), entries.as_py()
                arrays = [np.frombuffer(unpacker.decompress(view[e["offset"]:e["offset"] + e["length"]]), kind).astype("<u4") for e in listed]
                columns = [pa.array([part.as_py()] * len(listed), pa.int32()), pa.array([e["doc_id"] for e in listed], pa.int64()),
                           pa.array([e["start"] for e in listed], pa.int64()), pa.array([len(a) for a in arrays], pa.int64()),
                           pa.array([zlib.crc32(a.tobytes()) for a in arrays], pa.int64())]
                if ids:
                    columns.append(pa.array([a.astype(np.int32) for a in arrays], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=["part", "doc_id", "_at", "n_tokens", "ids_crc32", *["ids"] * ids])

    schema = "part int, doc_id long, _at long, n_tokens long, ids_crc32 long" + ", ids array<int>" * ids
    rows = blocks.select("part", "dict_hash", "entries", "payload").mapInArrow(run, schema).join(starts, "part")
    return rows.select("doc_id", (F.col("_start") + F.col("_at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * ids)


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of a few documents: only blocks whose range holds one are read, only their frames are decompressed."""
    wanted = sorted(set(doc_ids))
    blocks = spark.read.parquet(f"{path}/blocks")
    near = blocks.where(F.exists(F.array(*map(F.lit, wanted)), lambda d: (d >= F.col("first_doc")) & (d <= F.col("last_doc")))
                        & (F.col("last_doc") >= wanted[0]) & (F.col("first_doc") <= wanted[-1]))
    rows = near.select("dict_hash", "payload", F.explode(F.filter("entries", lambda e: e["doc_id"].isin(wanted))).alias("e")).select(
        F.col("e.doc_id").alias("doc_id"), "dict_hash", F.substring("payload", (F.col("e.offset") + 1).cast("int"), F.col("e.length").cast("int")).alias("frame"))
    shipped = _unpackers(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = {h: (kind, zstandard.ZstdDecompressor(dict_data=compression_dict(d))) for h, (kind, d) in shipped.value.items()}
        for batch in batches:
            ids = [np.frombuffer(unpack[h][1].decompress(f), unpack[h][0]).astype(np.int32) for h, f in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return rows.mapInArrow(run, "doc_id long, ids array<int>")
