"""Vector compression to one code per part, by Lloyd rounds over resident members.

Vectors of whole numbers are cut into equal parts; each part position has a codebook. The parts themselves are the members:
they are dealt once to owners by (position, entry, salt) and lie there in blocks. In a round every owner compares its
members with the new codebook where they are; members that keep their entry stay without a shuffle, only those that change
it migrate to their new owner. Owners then sum up what they hold, and the codebook, which the parameters bound, is
replaced. A salt spreads an entry that owns many members over as many owners as there are shuffle partitions.

Sums and distances are exact: doubles where their products are whole numbers below 2^53, whole numbers of any size beyond.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from shopflow.llm.base import scoped, stored
from shopflow.llm.topk import usable

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
SLICE = 4096  # vectors placed at once
HELD = 1 << 22  # bytes of members compared at once
EXACT = float(1 << 53)
MOST = (1 << 63) - 1

BLOCK = "position int, entry int, salt int, wide boolean, rows binary, data binary"
BLOCK_ARROW = pa.schema([("position", pa.int32()), ("entry", pa.int32()), ("salt", pa.int32()), ("wide", pa.bool_()), ("rows", pa.binary()), ("data", pa.binary())])


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of finite doubles, as doubles or, where those are too large to be compared, as Python numbers."""
    with np.errstate(over="ignore"):
        scaled = np.floor(scale * values)
    if np.abs(scaled).max(initial=0) < 1 << 24:
        return scaled
    numbers = np.empty(values.shape, object)
    for at, x in np.ndenumerate(values):
        numbers[at] = int(x) * scale if abs(x) >= 1 << 53 else math.floor(scale * x)
    return numbers


def as_bytes(members: np.ndarray) -> tuple[bool, bytes]:
    """(wide, bytes): 32-bit numbers, or decimal text for numbers that doubles cannot compare."""
    if members.dtype == object:
        return True, ",".join(map(str, members.ravel())).encode()
    return False, members.astype("<i4").tobytes()


def from_bytes(wide: bool, data: bytes, n: int) -> np.ndarray:
    if not wide:
        return np.frombuffer(data, "<i4").reshape(n, -1).astype(np.float64)
    members = np.empty(data.count(b",") + 1, object)
    members[:] = list(map(int, data.decode().split(",")))
    return members.reshape(n, -1)


def nearest(members: np.ndarray, book: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of each member; ties go to the lower entry."""
    largest = max((abs(x) for row in book for x in row), default=0)
    if members.dtype != object and 4 * members.shape[1] * max(np.abs(members).max(initial=0), largest) ** 2 < EXACT:
        entries = np.array(book, np.float64)
        scores = (entries ** 2).sum(1) - 2 * (members @ entries.T)
        best = scores.argmin(1)
        return best.astype(np.int32), (scores[np.arange(len(best)), best] + (members ** 2).sum(1)).astype(np.int64)
    best, errors = np.empty(len(members), np.int32), np.empty(len(members), np.int64)
    for i, member in enumerate(members):
        distance, best[i] = min((sum((int(x) - y) ** 2 for x, y in zip(member, entry)), e) for e, entry in enumerate(book))
        errors[i] = min(distance, MOST)
    return best, errors


def dealt(position: int, entries: np.ndarray, rows: np.ndarray, members: np.ndarray, salt: int) -> Iterator[dict]:
    """A block for each entry among the members."""
    order = np.argsort(entries, kind="stable")
    cuts = np.flatnonzero(np.diff(entries[order])) + 1
    for at in np.split(order, cuts) if len(order) else []:
        wide, data = as_bytes(members[at])
        yield {"position": position, "entry": int(entries[at[0]]), "salt": salt, "wide": wide, "rows": rows[at].astype("<i8").tobytes(), "data": data}


def padded(lists: pa.Array, width: int) -> np.ndarray:
    lengths = np.diff(lists.offsets.to_numpy())
    values = np.zeros((len(lengths), width))
    values[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy()
    return values


def placed(rows: DataFrame, books: list, width: int, scale: int, salts: int) -> DataFrame:
    """The blocks of the first assignment of (row, v)."""
    part = width // len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                piece = batch.slice(at, SLICE)
                numbers, values = piece.column(0).to_numpy(), whole(padded(piece.column(1), width), scale)
                turn += 1
                made = []
                for p, book in enumerate(books):
                    members = values[:, p * part:(p + 1) * part]
                    made += dealt(p, nearest(members, book)[0], numbers, members, turn % salts)
                yield pa.RecordBatch.from_pylist(made, BLOCK_ARROW)

    return rows.mapInArrow(run, BLOCK)


def gathered(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(position, entries, rows, members) of the blocks of a batch, many blocks of a position at once."""
    positions, wide, entries = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("position", "wide", "entry"))
    rows, data = batch.column("rows").to_pylist(), batch.column("data").to_pylist()
    for position in np.unique(positions):
        for large in (False, True):
            blocks = np.flatnonzero((positions == position) & (wide == large))
            turns = np.cumsum([len(data[i]) for i in blocks]) // HELD
            for at in np.split(blocks, np.flatnonzero(np.diff(turns)) + 1) if len(blocks) else []:
                numbers = np.frombuffer(b"".join([rows[i] for i in at]), "<i8")
                members = from_bytes(large, (b"," if large else b"").join([data[i] for i in at]), len(numbers))
                yield int(position), np.repeat(entries[at], [len(rows[i]) // 8 for i in at]), numbers, members


def compared(resident: DataFrame, books: list, salts: int) -> DataFrame:
    """The blocks under another codebook; ``moved`` marks members whose entry is another now."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = TaskContext.get().partitionId()
        for batch in batches:
            for position, before, numbers, members in gathered(batch):
                entries = nearest(members, books[position])[0]
                turn += 1
                made = []
                for moved in (False, True):
                    at = np.flatnonzero((entries != before) == moved)
                    made += [b | {"moved": moved} for b in dealt(position, entries[at], numbers[at], members[at], turn % salts)]
                yield pa.RecordBatch.from_pylist(made, BLOCK_ARROW.append(pa.field("moved", pa.bool_())))

    return resident.mapInArrow(run, BLOCK + ", moved boolean")


def updated(resident: DataFrame, books: list) -> list:
    """The codebooks with each entry replaced by the floor of its members' mean; entries without a member stay."""
    def add(held: dict, position: int, entry: int, n: int, total: list[int]) -> None:
        known = held.setdefault((position, entry), [0, [0] * len(total)])
        known[0] += n
        known[1] = [a + b for a, b in zip(known[1], total)]

    def rows(held: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([p for p, _ in held], pa.int32()), pa.array([e for _, e in held], pa.int32()), pa.array([n for n, _ in held.values()], pa.int64()),
                                           pa.array([",".join(map(str, t)) for _, t in held.values()], pa.string())], names=["position", "entry", "n", "total"])

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            for position, entries, _, members in gathered(batch):
                for entry in np.unique(entries):
                    own = members[entries == entry]
                    add(held, position, int(entry), len(own), [int(x) for x in own.sum(0)])
        yield rows(held)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            for position, entry, n, total in zip(*(c.to_pylist() for c in batch.columns)):
                add(held, position, entry, n, list(map(int, total.split(","))))
        yield rows(held)

    # owners' sums are whole numbers of any size, as text; a row for each entry, no more than the codebooks hold, reaches the driver
    schema = "position int, entry int, n long, total string"
    parts = int(resident.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sums = resident.mapInArrow(own, schema).repartition(parts, "position", "entry").mapInArrow(met, schema)
    books = [[list(entry) for entry in book] for book in books]
    for row in sums.collect():
        books[row.position][row.entry] = [int(x) // row.n for x in row.total.split(",")]
    return books


def coded(resident: DataFrame, books: list) -> DataFrame:
    """(row, position, code, error) of each member."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for position, _, numbers, members in gathered(batch):
                entries, errors = nearest(members, books[position])
                yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(np.full(len(numbers), position, np.int32)), pa.array(entries), pa.array(errors)],
                                                 names=["row", "position", "code", "error"])

    return resident.mapInArrow(run, "row long, position int, code int, error long")


def digest(books: list) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def held(total: Column) -> Column:
    return F.least(total, F.lit(MOST).cast("decimal(38,0)")).cast("long")


@scoped
def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list]:
    """((key, label, code, error, label_error), codebooks); a codebook lists its entries for each part position.

    Rows whose vector is null, or holds null or non-finite components, are dropped. Components become floor(scale * x);
    vectors of different lengths, or of a length that ``parts`` does not divide, are filled up with zeros. Codebooks start
    as the parts of the ``entries`` vectors with the least keys (null last, then by vector; all, if there are fewer). Codes
    are two hex digits for each part. Repeated rows are coded each; an empty table gives no row and empty codebooks.
    Errors beyond 64 bits are given as the largest long.
    """
    if not (0 < entries <= 256 and parts > 0 and rounds >= 0):
        raise ValueError("1 to 256 entries, at least one part")
    spark = vectors.sparkSession
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), vectors[key].alias("key"), vectors[label].alias("label"),
                          vectors[vector].cast("array<double>").alias("v")).where(usable("v"))
    rows = stored(rows, "codes-rows")
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    width = max(parts, -(-longest // parts) * parts)
    first = [r.v for r in rows.orderBy(F.col("key").asc_nulls_last(), "v").limit(entries).select("v").collect()]
    start = [[int(x) for x in whole(np.array([v + [0.0] * (width - len(v))]), scale)[0]] for v in first]
    part = width // parts
    books = [[v[p * part:(p + 1) * part] for v in start] for p in range(parts)]
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    owner = ["position", "entry", "salt"]
    resident = stored(placed(rows.select("row", "v"), books, width, scale, shuffles).repartition(shuffles, *owner), "codes-members") if rounds else None
    for turn in range(rounds):
        if turn:
            looked = stored(compared(resident, books, shuffles), "codes-compared")
            arrived = stored(looked.where("moved").drop("moved").repartition(shuffles, *owner), "codes-arrived")
            resident = looked.where("not moved").drop("moved").union(arrived)
        books = updated(resident, books)
    if resident is None:
        resident = placed(rows.select("row", "v"), books, width, scale, shuffles)
    mark = F.struct("position", F.lower(F.lpad(F.hex("code"), 2, "0")).alias("hex"))
    codes = coded(resident, books).groupBy("row").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(mark)), lambda x: x["hex"]), "").alias("code"), F.sum(F.col("error").cast("decimal(20,0)")).alias("e"))
    coded_rows = stored(rows.select("row", "key", "label").join(codes, "row").select("key", "label", "code", held(F.col("e")).alias("error")), "codes-coded", keep=True)
    totals = stored(coded_rows.groupBy("label").agg(held(F.sum(F.col("error").cast("decimal(20,0)"))).alias("label_error")), "codes-labels", keep=True)
    totals = totals.withColumnRenamed("label", "_label")
    joined = coded_rows.join(totals, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select(F.col("key").alias(key), F.col("label").alias(label), "code", "error", "label_error"), books


def decompress(coded_rows: DataFrame, books: list, scale: int = SCALE, code: str = "code", name: str = "approximation") -> DataFrame:
    """Adds the vector that a code stands for: the entries end to end, divided by ``scale``; null codes give null."""
    book = [[[x / scale for x in entry] for entry in positions] for positions in books]
    table = F.array(*[F.array(*[F.array(*map(F.lit, entry)) for entry in positions]) for positions in book])
    at = F.transform(F.sequence(F.lit(0), F.lit(len(book) - 1)), lambda p: F.get(F.get(table, p), F.conv(F.substring(F.col(code), 2 * p + 1, F.lit(2)), 16, 10).cast("int")))
    return coded_rows.withColumn(name, F.when(F.col(code).isNotNull(), F.flatten(at)))
