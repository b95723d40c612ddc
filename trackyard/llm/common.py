"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackyard.session import bounded_batches, ensure_checkpoint_dir, map_batches, ship_package

__all__ = ["Scratch", "arrow_column", "batch_of", "drop_path", "map_batches", "read_table", "shared_path", "stored", "utf8"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def utf8(col: str | Column) -> Column:
    """The text as UTF-8 bytes; null is the empty text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit("")).cast("binary")


def arrow_column(spark: SparkSession, fn: Callable[[Iterator[pa.Array]], Iterator[pa.Array]], kind: str):
    """A function of one column that works on Arrow arrays; the other columns of a row stay in the JVM."""
    ship_package(spark)
    bounded_batches(spark)
    # nondeterministic, so that a filter on its result isn't pushed below it, where it would run a second time
    return F.arrow_udf(fn, kind).asNondeterministic()


def shared_path(spark: SparkSession, what: str) -> str:
    """A new path in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared checkpoint folder through Hadoop's file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    """Tables in the shared checkpoint folder that go when the block ends.

    What leaves the block must not read them any more: write it with ``stored`` inside the block.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self._paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_exc) -> None:
        for path in self._paths:
            drop_path(self.spark, path)
        # Spark deletes the shuffle files of plans that nobody holds any more when the driver collects its garbage
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def path(self, what: str) -> str:
        self._paths.append(shared_path(self.spark, what))
        return self._paths[-1]

    def stored(self, df: DataFrame, what: str) -> DataFrame:
        path = self.path(what)
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, what: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet in the shared checkpoint folder and read it back."""
    path = shared_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def batch_of(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], names=list(columns))
