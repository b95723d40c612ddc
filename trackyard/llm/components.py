"""Connected components by alternating large-star and small-star rounds.

Edges stay a distributed table; each round is two groupings and two joins, and
writes its result to the shared folder, so a lost executor costs a part of one
round. Only the round's checksum reaches the driver. A vertex of very many
edges is aggregated map-side and split by AQE's skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackyard.llm.common import Scratch, drop_path, shared_path


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).filter("u <> v")


def connected_components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(u, v): each vertex of ``edges`` (u, v) but the smallest of its component, and that smallest vertex.

    Loops and repeated edges are harmless; edges with a null end are dropped. No edges, no rows.
    The result's table lives as long as ``scratch``, if there is one.
    """
    spark = edges.sparkSession

    def write(df: DataFrame):
        path = scratch.path("components") if scratch else shared_path(spark, "components")
        df.write.parquet(path)
        return path, spark.read.schema(schema).parquet(path)

    start = edges.filter("u is not null and v is not null and u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    schema = start.schema
    path, now = write(start.distinct())
    before = None
    while True:
        check = now.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if check == before or not check[0]:
            return now
        before = check
        old = path
        path, now = write(_small_star(_large_star(now).distinct()).distinct())
        drop_path(spark, old)
