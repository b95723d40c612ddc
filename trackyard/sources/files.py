"""Questions to the file system that a path belongs to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    """(path, file system) as Hadoop sees them."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there, as the file system it belongs to says.

    Only a real "not found" is False. A store that can't be asked (no connector,
    no permission, throttling) raises: an unreadable table is not an empty one.
    """
    target, fs = hadoop_path(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    target, fs = hadoop_path(spark, path)
    fs.delete(target, True)
