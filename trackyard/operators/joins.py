"""Fact-to-dimension left joins (gold G7-G12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# rows without a key are dealt over so many values that match nothing
NULL_SPREAD = 4096


def left_join_dim(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                  dim_cols: Sequence[str]) -> DataFrame:
    """``fact LEFT JOIN dim ON fact.fact_key = dim.dim_key`` adding ``dim_cols``; the fact is read once.

    * Rows whose key is NULL can never match. In a shuffle they would all go to
      the one reducer of hash(NULL) (up to about half of the transactions), so the
      join key is a pair (spread, key): spread is 0 for rows with a key and for the
      dimension, and one of many values that no dimension row has without one.
    * Nothing is hinted: Spark broadcasts the dimension if its measured size is
      below the threshold, and otherwise joins by shuffle, where AQE splits a hot
      fact key (the left side of a left join can be split).
    * A non-unique ``dim_key`` fans out, as the SQL join does.
    """
    kind = dim.schema[dim_key].dataType
    key = F.col(fact_key).cast(kind)
    spread = F.when(key.isNull(), F.pmod(F.xxhash64(*fact.columns), F.lit(NULL_SPREAD)).cast("int") + 1) \
              .otherwise(F.lit(0))
    keyed = fact.withColumn("__fk", F.struct(spread.alias("spread"),
                                             F.coalesce(key, F.lit(0).cast(kind)).alias("key")))
    right = dim.filter(F.col(dim_key).isNotNull()).select(
        F.struct(F.lit(0).alias("spread"), F.col(dim_key).alias("key")).alias("__dk"), *[F.col(c) for c in dim_cols])
    return keyed.join(right, keyed["__fk"] == right["__dk"], "left").drop("__fk", "__dk")
