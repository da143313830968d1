"""Keyed state of streams as tables in the shared folder: a log of puts that is folded, and a look-back built on it.

A micro-batch is a DataFrame, so what happens inside it is done by joins, windows and ranking filters. State holds one
row per key: what a later batch needs to know of the last row. It lies in a log of batch folders, which makes a replayed
batch harmless: it writes the same folder again, from the state before it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from shopflow.operators.skew import dedupe_last, previous_row
from shopflow.runtime import remove

FOLD_EVERY = 4
PUT = "put_batch"  # the batch of a put


@dataclass
class KeyedLog:
    """The last put of each key, over all batches.

    A batch's puts lie in ``batch=<id>``. Every ``fold_every`` batches the folders are folded into one, named by the negative
    of the first batch that it does not hold; what it replaces is deleted once the next fold stands, so a reader that has listed the older
    folders can finish. At most two folds and twice ``fold_every`` batches lie in the folder at a time. Columns named in
    ``keep`` hold their last value that is not null; all others are replaced as a whole. ``forget`` drops keys
    whose ``clock`` lies more than that interval before the latest one.
    """

    spark: SparkSession
    path: str
    keys: list[str]
    keep: tuple[str, ...] = ()
    clock: str | None = None
    forget: str | None = None
    fold_every: int = FOLD_EVERY

    def folders(self) -> list[int]:
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(self.path)
        files = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(place):
            return []
        found = [s.getPath() for s in files.listStatus(place)]
        whole = [p for p in found if p.getName().startswith("batch=") and files.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(p.getName().split("=")[1]) for p in whole)

    def rows(self, before: int | None = None) -> DataFrame | None:
        """The puts as stored, from the last fold on; None if there is none."""
        there = self.folders()
        fold = max((-b for b in there if b < 0 and (before is None or -b <= before)), default=0)
        named = [f"{self.path}/batch={b}" for b in there if b == -fold and fold or b >= fold and (before is None or b < before)]
        return self.spark.read.option("basePath", self.path).parquet(*named).drop("batch") if named else None

    def read(self, before: int | None = None) -> DataFrame | None:
        """The last put of each key, of the batches below ``before``."""
        rows = self.rows(before)
        return None if rows is None else self.live(last_put(rows, self.keys, self.keep))

    def live(self, rows: DataFrame) -> DataFrame:
        if self.forget is None:
            return rows
        at = F.unix_micros(F.col(self.clock).cast("timestamp"))
        latest = rows.agg(F.max(at)).first()[0]
        return rows if latest is None else rows.where(F.col(self.clock).cast("timestamp") >= F.timestamp_micros(F.lit(latest)) - F.expr(f"INTERVAL {self.forget}"))

    def write(self, batch_id: int, rows: DataFrame) -> None:
        """Add a batch's puts, one row per key at most."""
        if batch_id and batch_id % self.fold_every == 0:
            self.fold(batch_id)
        rows.withColumn(PUT, F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def fold(self, before: int) -> None:
        there = self.folders()
        if -before in there or not any(0 <= b < before for b in there):
            return
        self.read(before).write.mode("overwrite").parquet(f"{self.path}/batch=-{before}")
        older = max((-b for b in there if b < 0), default=0)
        for b in there:
            if (b < 0 and -b < older) or 0 <= b < older:
                remove(self.spark, f"{self.path}/batch={b}")


def last_put(rows: DataFrame, keys: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per key of stored puts: the last one, with the last value that is not null in the columns ``keep``."""
    values = [c for c in rows.columns if c not in keys]
    put = F.max_by(F.struct(*values), PUT).alias("_put")
    held = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(PUT))).alias(f"_{c}") for c in keep]
    return rows.groupBy(*keys).agg(put, *held).select(*keys, *[F.col(f"_{c}").alias(c) if c in keep else F.col(f"_put.{c}") for c in values])


@dataclass
class LookBack:
    """A stream whose rows meet their predecessor: the row before them of the same key, in this batch or an earlier one.

    Within a batch the predecessor comes from a ranged pass that holds no key whole, so one key may own any share of the
    rows; only a batch's last row of a key becomes state. ``clock`` orders the rows of a key, ``tie`` tells rows of equal
    clock apart. A row whose clock lies before its key's last one of an earlier batch is late. With ``once``
    rows that repeat a key and clock count once. ``emit`` makes the result of rows with ``prev`` (a struct of ``columns``,
    null on a key's first row), ``late`` that of late rows. Keys and clock must not be null.
    """

    rows: DataFrame
    keys: list[str]
    clock: list[str]
    columns: list[str]
    emit: Callable[[DataFrame], DataFrame]
    late: Callable[[DataFrame], DataFrame]
    tie: list[str] = field(default_factory=list)
    once: bool = False
    forget: str | None = None

    def handle(self, path: str, state: str) -> Callable[[DataFrame, int], None]:
        def run(batch: DataFrame, batch_id: int) -> None:
            log = KeyedLog(batch.sparkSession, state, self.keys, clock=self.clock[0], forget=self.forget)
            rows = joined = batch.persist()
            try:
                known = log.read(batch_id)
                at, before = F.struct(*self.clock), F.struct(*[F.col(c).alias(c) for c in self.columns])
                if known is None:
                    joined = rows.withColumn("_at", F.lit(None).cast(rows.select(at.alias("c")).schema["c"].dataType)).withColumn("_old", F.lit(None).cast(
                        rows.select(before.alias("c")).schema["c"].dataType))
                else:
                    own = known.join(rows.select(*self.keys).distinct(), self.keys, "left_semi").select(*self.keys, at.alias("_at"), before.alias("_old"))
                    joined = rows.join(own, self.keys, "left").persist()  # sampled, sorted and asked for late rows: joined once
                early = F.coalesce(at < F.col("_at"), F.lit(False))
                fresh = joined.where(~early)
                if self.once:
                    fresh = dedupe_last(fresh.where(~F.coalesce(at == F.col("_at"), F.lit(False))), [*self.keys, *self.clock], self.tie)
                met = previous_row(fresh, self.keys, [*self.clock, *self.tie], self.columns, "_lag").persist()
                try:
                    made = self.emit(met.withColumn("prev", F.coalesce("_lag", "_old")).drop("_at", "_old", "_lag"))
                    made.unionByName(self.late(joined.where(early).drop("_at", "_old"))).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
                    last = met.groupBy(*self.keys).agg(F.max(F.struct(*self.clock, *self.tie, *[F.col(c) for c in self.columns if c not in [*self.clock, *self.tie]])).alias("l"))
                    log.write(batch_id, last.select(*self.keys, *[F.col(f"l.{c}") for c in dict.fromkeys([*self.clock, *self.columns])]))
                finally:
                    met.unpersist()
            finally:
                joined.unpersist()
                rows.unpersist()

        return run
