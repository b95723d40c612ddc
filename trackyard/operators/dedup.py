"""Latest record per business key (silver D1-D7, upsert U2/T4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Winner inside one load: newest file first; rows of one file share
# _ingested_at, so the file hash and then the last row of the file decide.
def latest_first() -> list[Column]:
    return [F.col("_ingested_at").desc_nulls_last(), F.col("_file_hash").desc_nulls_last(),
            F.col("_row_num").desc_nulls_last()]


def dedup_latest(df: DataFrame, keys: Sequence[str | Column],
                 order: Sequence[Column] | None = None) -> DataFrame:
    """Keep row 1 of ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order)``.

    NULL keys form one group, as in SQL window partitions. Catalyst rewrites the
    ``rn = 1`` filter into a partial WindowGroupLimit *before* the hash
    exchange, so each map task forwards at most one row per key: a key holding
    a third of all rows (a file re-delivered many times, NULL imsi) costs one
    row per map task in the shuffle, not a third of the data in one reducer.
    """
    key_cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    w = Window.partitionBy(*key_cols).orderBy(*(order if order is not None else latest_first()))
    return (df.withColumn("__rn", F.row_number().over(w))
              .filter(F.col("__rn") == 1)
              .drop("__rn"))
