"""Sharding along a Hilbert curve over metadata dimensions.

Each dimension is quantised by approximate quantiles (a mergeable sketch), the codes of a row give its place on the
curve, rows are range-sorted by it and cut into runs of equal count. Neighbours on the curve are near in every
dimension, so the value ranges of a shard are narrow in several dimensions at once and ``prune`` skips shards by any.

Built from DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from shopflow.llm.base import stored


def _tables(dims: int) -> tuple[list[int], list[int], list[int]]:
    """By w in [0, 2^dims): the inverse Gray code, entry corner and direction of the w-th cell of the curve."""
    size = 1 << dims
    gray = [w ^ (w >> 1) for w in range(size)]
    inverse = [gray.index(g) for g in range(size)]
    trailing = lambda v: (~v & (v + 1)).bit_length() - 1  # noqa: E731  number of trailing one bits
    entry = [0 if w == 0 else gray[2 * ((w - 1) // 2)] for w in range(size)]
    direction = [0 if w == 0 else trailing(w - 1 if w % 2 == 0 else w) % dims for w in range(size)]
    return inverse, entry, direction


def hilbert_index(codes: list[Column], bits: int) -> Column:
    """Place on the curve of a cell given by one code of ``bits`` bits per dimension.

    One fold over the bit levels, high to low, that carries the entry corner and direction of the sub-cube.
    """
    n = len(codes)
    if n < 2 or n * bits > 62:
        raise ValueError("2 or more dimensions, 62 bits in all")
    inverse, entry, direction = (F.array(*map(F.lit, t)) for t in _tables(n))
    mask = F.lit((1 << n) - 1)
    point = F.array(*[c.cast("long") for c in codes])
    state = F.struct(F.lit(0).alias("e"), F.lit(0).alias("d"), F.lit(0).cast("long").alias("h"))

    def turn(value: Column, by: Column, left: bool) -> Column:
        up, down = (by, F.lit(n) - by) if left else (F.lit(n) - by, by)
        shift = lambda v, k, f: F.call_function(f, v, k)
        return shift(value, up, "shiftleft").bitwiseOR(shift(value, down, "shiftrightunsigned")).bitwiseAND(mask)

    def step(s: Column, level: Column) -> Column:
        digit = F.aggregate(point, F.lit(0), lambda acc, c: acc * 2 + F.call_function("shiftright", c, level).bitwiseAND(F.lit(1)).cast("int"))
        by = F.pmod(s["d"] + 1, F.lit(n))
        w = F.get(inverse, turn(digit.bitwiseXOR(s["e"]), by, left=False))
        # a one-element transform names w once instead of writing its definition five times
        return F.element_at(F.transform(F.array(w), lambda w: F.struct(
            s["e"].bitwiseXOR(turn(F.get(entry, w), by, left=True)).alias("e"),
            F.pmod(s["d"] + F.get(direction, w) + 1, F.lit(n)).alias("d"),
            (s["h"] * (1 << n) + w).alias("h"))), 1)

    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), state, step, lambda s: s["h"])


def sort_key(df: DataFrame, column: str) -> Column:
    """A number in the order of the column: itself if numeric (NaN counts as null), else its first seven UTF-8 bytes."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.NumericType):
        value = df[column].cast("double")
        return F.when(~F.isnan(value), value)
    if isinstance(kind, (T.TimestampType, T.DateType)):
        return F.unix_micros(df[column].cast("timestamp")).cast("double")
    head = F.substring(F.encode(df[column].cast("string"), "UTF-8"), 1, 7)
    return F.conv(F.rpad(F.hex(head), 14, "0"), 16, 10).cast("double")


def quantise(df: DataFrame, dims: dict[str, str], bits: int) -> DataFrame:
    """Adds, for each (name, sort key column), a code below 2^bits: 0 for null, else 1 + the bounds that lie below the value."""
    share = [i / ((1 << bits) - 1) for i in range(1, (1 << bits) - 1)]
    row = df.agg(*[F.percentile_approx(k, share, 10_000).alias(n) for n, k in dims.items()]).first()
    for name, key in dims.items():
        bounds = sorted(set(row[name] or []))
        below = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col(key))) if bounds else F.lit(0)
        df = df.withColumn(name, F.when(F.col(key).isNull(), 0).otherwise(1 + below).cast("int"))
    return df


def assign(docs: DataFrame, shards: int = 40, dims: tuple[str, ...] = ("source", "lang", "size"), bits: int = 5,
           keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """One row per document: ``keep``, size, text_crc32, the dimensions, their codes, hilbert, shard, slot, rows_before.

    Size is the UTF-8 length of the text plus 16 (null: 16, checksum of nothing) and may be named as a dimension. Rows of
    one cell are ordered by checksum, size and the kept columns, so equal texts of a cell lie together. The n-th row in
    this order goes to shard n * shards / rows: counts differ by one at most, with hot cells, ties and repeated rows too
    (rows equal in all of these are alike and take any order). Nulls have a code of their own; an empty table gives no
    row. Extra columns are not read.
    """
    raw = F.encode(docs[text].cast("string"), "UTF-8")
    names = [d for d in dims if d != "size"]
    narrow = docs.select(*[docs[k].alias(f"_k{i}") for i, k in enumerate(keep)], *[docs[d].alias(f"_v{i}") for i, d in enumerate(names)],
                         *[sort_key(docs, d).alias(f"_s{i}") for i, d in enumerate(names)],
                         (F.coalesce(F.octet_length(raw), F.lit(0)) + 16).cast("long").alias("size"),
                         F.coalesce(F.crc32(raw), F.lit(0)).cast("long").alias("text_crc32"))
    narrow = stored(narrow.withColumn("_size", F.col("size").cast("double")), "hilbert-rows")
    keys = {f"_c{i}": ("_size" if d == "size" else f"_s{names.index(d)}") for i, d in enumerate(dims)}
    coded = quantise(narrow, keys, bits).withColumn("hilbert", hilbert_index([F.col(c) for c in keys], bits))
    order = ["hilbert", "text_crc32", "size", *[f"_k{i}" for i in range(len(keep))], *[f"_v{i}" for i in range(len(names))]]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stored(coded.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                    .withColumn("_at", F.monotonically_increasing_id()), "hilbert-order")
    # the id holds the partition above bit 33 and the row within it below: places follow from one count per partition
    at = placed.withColumn("_part", F.shiftright("_at", 33))
    counts = at.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(counts.select("_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_start"),
                                  F.sum("_n").over(Window.partitionBy()).alias("_all")), "hilbert-starts")
    place = F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1)
    big, rest = F.floor(F.col("_all") / shards), F.col("_all") % shards
    first = rest * (big + 1)  # rows in the shards that hold one more
    shard = F.when(F.col("_p") < first, F.floor(F.col("_p") / (big + 1))).otherwise(rest + F.floor((F.col("_p") - first) / F.greatest(big, F.lit(1))))
    done = at.join(starts, "_part").withColumn("_p", place).withColumn("shard", shard.cast("int"))
    slot = F.col("_p") - F.col("shard") * big - F.least(F.col("shard").cast("long"), rest)
    return done.select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keep)], *[F.col(f"_v{i}").alias(d) for i, d in enumerate(names)],
                       "size", "text_crc32", *[F.col(f"_c{i}").alias(f"{d}_code") for i, d in enumerate(dims)], "hilbert", "shard",
                       slot.cast("long").alias("slot"))


def manifest(assigned: DataFrame, dims: tuple[str, ...] = ("source", "lang", "size")) -> DataFrame:
    """Per shard: rows, bytes and the least and greatest value and null count of each dimension; what ``prune`` reads."""
    return assigned.groupBy("shard").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("n_bytes"),
        *[f(d).alias(f"{label}_{d}") for d in dims for f, label in ((F.min, "min"), (F.max, "max"))],
        *[F.count_if(F.col(d).isNull()).alias(f"nulls_{d}") for d in dims])


def prune(shards: DataFrame, **wanted) -> DataFrame:
    """The shards that may hold a row with dimension = value, or in (low, high) for a pair."""
    for name, value in wanted.items():
        low, high = value if isinstance(value, tuple) else (value, value)
        shards = shards.where((F.col(f"max_{name}") >= F.lit(low)) & (F.col(f"min_{name}") <= F.lit(high)))
    return shards


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, on: tuple[str, ...] = ("doc_id",)) -> None:
    """The whole rows as one folder per shard, in curve order. Null-safe join on the kept columns, which must be unique."""
    keyed = assigned.select(*[F.col(c).alias(f"_{c}") for c in on], "shard", "slot")
    match = [docs[c].eqNullSafe(keyed[f"_{c}"]) for c in on]
    rows = docs.join(keyed, match).drop(*[f"_{c}" for c in on])
    n = assigned.agg(F.max("shard")).first()[0]
    (rows.repartitionByRange(1 + (n or 0), "shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
