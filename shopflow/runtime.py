"""Session helpers: shared checkpoint folder, lineage cuts, scratch paths."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_held = threading.local()  # .scopes: the paths written in each open scope
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint_root(spark: SparkSession) -> str:
    """Folder shared by driver and executors. A cluster names it in ``spark.checkpoint.dir``."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
            folder = tempfile.mkdtemp(prefix="shopflow-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and drop their lineage; survives lost executors."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


@contextmanager
def bucketed(df: DataFrame, keys: list[str], name: str, buckets: int | None = None):
    """The rows as a table in the shared folder, bucketed and sorted by ``keys``, for joins that do not shuffle it.

    The table goes at the end of the block; cut what was computed from it before.
    """
    with growing(df.sparkSession, keys, name, buckets) as table:
        table.add(df)
        yield table.rows()


class Growing:
    """A bucketed table that rows are added to; what it holds already is neither moved nor written again."""

    def __init__(self, spark: SparkSession, keys: list[str], name: str, buckets: int | None) -> None:
        self.spark, self.keys = spark, keys
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.table, self.path = f"{name}_{uuid.uuid4().hex}", scratch_path(spark, name)

    def add(self, df: DataFrame) -> None:
        (df.repartition(self.buckets, *self.keys).write.mode("append").format("parquet").bucketBy(self.buckets, *self.keys)
         .sortBy(*self.keys).option("path", self.path).saveAsTable(self.table))

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)


@contextmanager
def growing(spark: SparkSession, keys: list[str], name: str, buckets: int | None = None):
    made = Growing(spark, keys, name, buckets)
    try:
        yield made
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {made.table}")
        remove(spark, made.path)


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any store that Spark can write to."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scope(spark: SparkSession):
    """Deletes at its end the tables that were written inside, but for those written with ``keep``: they pass to the scope around it.

    What leaves the block must read kept tables and inputs only.
    """
    scopes = _held.__dict__.setdefault("scopes", [])
    scopes.append([])
    try:
        yield
    finally:
        for path in scopes.pop():
            remove(spark, path)


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """The rows as a Parquet table in the shared folder: computed once, lineage cut, size known to the join planner.

    The shuffle files of the computation go as soon as the table stands. With ``keep`` the table outlives the innermost scope.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    scopes = _held.__dict__.setdefault("scopes", [])
    if len(scopes) > keep:
        scopes[-1 - keep].append(path)
    before = spark.conf.get(CLEANUP, None)
    if before is not None:
        spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is not None:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
