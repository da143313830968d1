from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function of ``read`` (table name to DataFrame) under its name."""
    def add(fn):
        key = name or fn.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Reader(spark, sf_dir))

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return add


class Reader:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __call__(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{table}.parquet")

    def spread(self, table: str) -> DataFrame:
        """The table in as many parts as there are cores, for costly text work: its file has one row group, which Spark cannot split."""
        return self(table).repartition(self.spark.sparkContext.defaultParallelism)

    def stream(self, table: str) -> DataFrame:
        """The table as a stream with the schema of the stored one, whether it is a file or a folder of files or of partitions.

        A plain path is taken for a folder, and only then are the columns that its subfolders name read; the braces of a single
        file's path make it a pattern.
        """
        path = f"{self.dir}/{table}.parquet"
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory()
        return self.spark.readStream.schema(self(table).schema).parquet(path if folder else f"{self.dir}/{{{table}.parquet}}")
