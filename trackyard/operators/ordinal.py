"""Global row numbers without a single-partition window (G4 dense key, S9 _row_num).

``ROW_NUMBER() OVER (ORDER BY k)`` has no partition key, so Spark runs it in
one task. Here the rows are range-partitioned on the order key, numbered
inside each partition, frozen as a Parquet copy in the checkpoint folder
(range bounds are sampled, so a recomputation could move rows), and shifted
by the row counts of the preceding partitions. Only one row per partition ever reaches the driver
side of a join (the offset table), so the broadcast is bounded by the
partition count, not by the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackyard.session import freeze

_LOW33 = (1 << 33) - 1


def _cols(cs):
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def _by_range(df: DataFrame, num_partitions: int | None, order):
    return df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)


def global_ordinal_counted(df: DataFrame, order_by: Sequence[str | Column], out: str = "ordinal",
                           num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """Append ``out`` = 1..n (BIGINT) in ``order_by`` order; also return n.

    ``order_by`` must be a total order (unique), as for the surrogate key over
    the distinct imsi; equal keys would still get distinct but arbitrary
    numbers, exactly like ROW_NUMBER.
    """
    spark = df.sparkSession
    order = _cols(order_by)
    # monotonically_increasing_id = partition index << 33 | position in partition.
    # Without an explicit count AQE sizes the range partitions to the data by
    # merging neighbours, which keeps them contiguous and in key order.
    ranged = (_by_range(df, num_partitions, order)
                .sortWithinPartitions(*order)
                .withColumn("__pos", F.monotonically_increasing_id()))
    frozen = freeze(ranged)
    pid = F.shiftright(F.col("__pos"), 33)
    # one row per range partition: the only data that reaches the driver
    counts = sorted((r[0], r[1]) for r in frozen.groupBy(pid).agg(F.count(F.lit(1))).collect())
    offsets, running = [], 0
    for p, c in counts:
        offsets.append((int(p), running))
        running += int(c)
    off_df = spark.createDataFrame(offsets or [(0, 0)], "__pid bigint, __off bigint")
    numbered = (frozen.withColumn("__pid", pid)
                      .join(F.broadcast(off_df), "__pid")
                      .withColumn(out, (F.col("__off") + F.col("__pos").bitwiseAND(F.lit(_LOW33)) + 1)
                                  .cast("bigint"))
                      .drop("__pid", "__off", "__pos"))
    return numbered, running


def global_ordinal(df: DataFrame, order_by: Sequence[str | Column], out: str = "ordinal",
                   num_partitions: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY order_by)`` as BIGINT, without a single-task window."""
    return global_ordinal_counted(df, order_by, out, num_partitions)[0]


def grouped_ordinal(df: DataFrame, group_by: Sequence[str], order_by: Sequence[str | Column],
                    out: str = "ordinal", num_partitions: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY group_by ORDER BY order_by)`` for groups of any size.

    A plain window sends a whole group to one task; a group holding a third of
    all rows (one huge export file) would serialise the job. Range partitioning
    on (group, order) splits big groups over several partitions; per
    (partition, group) counts give the offsets.
    """
    order = _cols(list(group_by) + list(order_by))
    ranged = (_by_range(df, num_partitions, order)
                .sortWithinPartitions(*order)
                .withColumn("__pos", F.monotonically_increasing_id()))
    frozen = freeze(ranged)
    pid = F.shiftright(F.col("__pos"), 33)
    keyed = frozen.withColumn("__pid", pid)
    # one row per (range partition, group): bounded by partitions + groups,
    # and typically tiny; joined back by AQE (broadcast when its measured size allows)
    counts = keyed.groupBy("__pid", *group_by).agg(F.count(F.lit(1)).alias("__n"),
                                                    F.min("__pos").alias("__first"))
    w = Window.partitionBy(*group_by).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", *group_by, "__first",
                            F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    offsets = offsets.select(*[F.col(c).alias(f"__o_{c}") for c in ["__pid", *group_by]], "__first", "__off")
    # null-safe: a NULL group (rows of an unnamed file) is one group, as in a window
    cond = [keyed[c].eqNullSafe(offsets[f"__o_{c}"]) for c in ["__pid", *group_by]]
    return (keyed.join(offsets, cond, "inner")
                 .withColumn(out, (F.col("__off") + F.col("__pos") - F.col("__first") + 1).cast("bigint"))
                 .drop("__pid", "__off", "__pos", "__first", *[f"__o_{c}" for c in ["__pid", *group_by]]))
