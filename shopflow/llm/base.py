"""What the operators share: stored intermediate tables, Arrow passes, word rules, prefix sums."""

from __future__ import annotations

import functools
import pickle
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from shopflow.runtime import scope, written

#: A word: a maximal run of characters other than the six ASCII blanks. ``bytes.split()`` splits at the same six.
WORD = r"[^\x20\x09-\x0D]+"


#: The rows as a Parquet table in the shared folder, deleted with the innermost scope unless ``keep`` is set.
stored = written


def scoped(operator: Callable) -> Callable:
    """An operator whose first argument is a DataFrame and whose result reads inputs and tables stored with ``keep`` only."""
    @functools.wraps(operator)
    def run(df: DataFrame, *args, **options):
        with scope(df.sparkSession):
            return operator(df, *args, **options)

    return run


def by_batch(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply ``fn`` to each Arrow batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(batch)
            if out is not None and out.num_rows:
                yield out
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def kept_in_worker(name: str, make: Callable[[], object]):
    """An object that the tasks of one Python worker share; for caches of bounded size whose content follows from ``name``."""
    place = sys.modules.setdefault("_shopflow_kept", types.ModuleType("_shopflow_kept")).__dict__
    if name not in place:
        place[name] = make()
    return place[name]


def ship(spark: SparkSession, value: object) -> Broadcast:
    """A broadcast of objects of this package's classes, by value: executors need no copy of the package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def opened(shipped: Broadcast):
    return pickle.loads(shipped.value)


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ordered_hash(*columns: Column | str) -> Column:
    """A hash of the columns' texts in [0, 1), the same in every SQL engine: the first 52 bits of their MD5."""
    text = F.concat_ws("|", *[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def prefix_sums(df: DataFrame, keys: list[str], bucket: str, order: list[Column], values: dict[str, str]) -> DataFrame:
    """Adds, for each (name, value) of ``values``, the sum of value over the rows before this one within the keys.

    ``bucket`` cuts a key's order into consecutive parts that are windows of their own; the parts meet in a summary with
    one row per part, so that no window holds a hot key whole. Keys and bucket must not be null.
    """
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys, bucket).agg(*[F.sum(v).alias(f"_{n}") for n, v in values.items()])
    starts = totals.select(*keys, bucket, *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in values])
    local = df.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(n) for n, v in values.items()])
    return (local.join(starts, [*keys, bucket])
            .select(*df.columns, *[(F.col(n) + F.col(f"_{n}")).alias(n) for n in values]))
