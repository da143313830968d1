"""Ranking, numbering and joining that hold when one key owns a third of all rows.

* top-n per key: a ranking filter, which Spark applies before the shuffle as well, so at most n rows per key and
  input partition travel.
* numbering and look-back: rows of one key are cut into ranges of the order column, each range is a group of its own,
  and the ranges are tied together through a summary with one row per range.
* joins against a table with unique keys: the large side gets a salt, the other side is repeated once per salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shopflow.runtime import cut

_RANGE = "_range"


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key."""
    return (df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
            .where(F.col("_rank") <= n).drop("_rank"))


def dedupe_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key in ``order``."""
    return top_per_key(df, keys, [F.col(c).desc() for c in order])


def in_ranges(df: DataFrame, keys: list[str], order: list[str], ranges: int | None = None) -> DataFrame:
    """Adds ``_range``: contiguous ranges of (keys, order), about equal in rows and written once, whatever the keys' sizes."""
    ranges = ranges or 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c) for c in [*keys, *order]]
    return cut(df.repartitionByRange(ranges, *cols).withColumn(_RANGE, F.spark_partition_id()))


def look_back(df: DataFrame, keys: list[str], order: list[str], number: str | None = None, columns: list[str] | None = None,
              prev: str = "prev", ranges: int | None = None) -> DataFrame:
    """Adds a row's number within its keys (column ``number``, from 1) and what ``columns`` held in the row before it
    (struct ``prev``, null on the first row), both in one ranged pass over ``order``, which must be unique within a key.

    Keys must not be null. Ranges meet in a summary with one row per range and key.
    """
    ranged = in_ranges(df, keys, order, ranges)
    group = [_RANGE, *keys]
    value = F.struct(*columns) if columns else None
    parts = ranged.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), *([F.max_by(value, F.struct(*order)).alias("_end")] if columns else []))
    along = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(_RANGE)
    carried = parts.select(*group, F.coalesce(F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
                           *([F.lag("_end").over(along).alias("_carry")] if columns else []))
    window = Window.partitionBy(*group).orderBy(*order)
    out = ranged.join(carried, group, "left").withColumn("_local", F.row_number().over(window))
    if columns:
        out = out.withColumn(prev, F.when(F.col("_local") == 1, F.col("_carry")).otherwise(F.lag(value).over(window)))
    if number:
        out = out.withColumn(number, (F.col("_local") + F.coalesce("_before", F.lit(0))).cast("long"))
    return out.select(*df.columns, *[c for c in (number, prev if columns else None) if c])


def carry_forward(rows: DataFrame, order: list[str], value: str, name: str, ranges: int | None = None) -> DataFrame:
    """Adds the last ``value`` that is not null, up to and with each row in ``order``, over all rows.

    Rows are cut into ranges of ``order``, whatever their keys; a range starts with what the ranges before it left.
    """
    ranged = in_ranges(rows, [], order, ranges)
    local = Window.partitionBy(_RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ends = ranged.groupBy(_RANGE).agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order))).alias("_end"))
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(_RANGE, F.last("_end", ignorenulls=True).over(before).alias("_carry"))
    return ranged.join(carried, _RANGE).withColumn(name, F.coalesce(F.last(value, ignorenulls=True).over(local), "_carry")).select(*rows.columns, name)


def number_rows(df: DataFrame, keys: list[str], order: list[str], name: str = "row_no", ranges: int | None = None) -> DataFrame:
    """Consecutive numbers from 1 within each key (or over all rows without keys), in ``order``."""
    return look_back(df, keys, order, number=name, ranges=ranges)


def previous_row(df: DataFrame, keys: list[str], order: list[str], columns: list[str], name: str = "prev",
                 ranges: int | None = None) -> DataFrame:
    """Adds a struct with ``columns`` of the row before, in ``order`` within the keys; null on the first row."""
    return look_back(df, keys, order, columns=columns, prev=name, ranges=ranges)


def with_batch(df: DataFrame, n: int, order: list[str], keys: list[str] | None = None, name: str = "batch_no",
               **options) -> DataFrame:
    """Batches of exactly ``n`` rows in ``order`` (the last one may be shorter), numbered from 0."""
    if n < 1:
        raise ValueError("batch size must be positive")
    numbered = number_rows(df, keys or [], order, "_row", **options)
    return numbered.withColumn(name, F.floor((F.col("_row") - 1) / n).cast("long")).drop("_row")


def salted_join(left: DataFrame, right: DataFrame, on: list[str], spread: list[str], how: str = "left",
                salts: int = 16) -> DataFrame:
    """Join to ``right``, which is small per key but may be large in all; hot keys of ``left`` spread over ``salts``.

    No broadcast is forced: Spark still chooses one when the measured size of ``right`` is below its threshold.
    """
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.withColumn("_salt", salt).join(repeated, [*on, "_salt"], how).drop("_salt")
