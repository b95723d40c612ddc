"""Hot keys: one key holding a third of all rows."""

from pyspark.sql import functions as F

from tests.oracle import compare, duck
from trackyard.operators.dedup import dedup_latest
from trackyard.operators.joins import left_join_dim
from trackyard.plans.analogues import SQL_LINEAGE_ROWS, q_lineage_rows


def _hot(spark, n=30000):
    # a third of the rows share key 0; the rest are spread over 1000 keys
    return spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).cast("bigint").alias("k"),
        F.col("id").alias("seq"), F.lit("x" * 40).alias("pad"))


def test_dedup_hot_key(spark):
    df = _hot(spark).repartition(8)
    out = dedup_latest(df, ["k"], [F.col("seq").desc()])
    got = {r["k"]: r["seq"] for r in out.collect()}
    want = {r["k"]: r["m"] for r in df.groupBy("k").agg(F.max("seq").alias("m")).collect()}
    assert got == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_fact_join_hot_key_is_split(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.coalescePartitions.enabled")
    prev = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64k")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        fact = _hot(spark, 60000).repartition(8)
        dim = spark.range(0, 1001).select(F.col("id").alias("imsi"), (F.col("id") + 100).alias("subscriber_key"))
        joined = left_join_dim(fact, dim, "k", "imsi", ["subscriber_key"])
        rows = joined.collect()  # executes this plan, so its adaptive plan is final afterwards
        assert len(rows) == 60000 and all(r["subscriber_key"] == r["k"] + 100 for r in rows)
        final = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in final and "skew=true" in final, final
    finally:
        for k, v in prev.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_lineage_rows_of_one_status_are_written_by_several_tasks(spark):
    key, sf = "spark.sql.adaptive.coalescePartitions.enabled", "/root/testdata/sf0.001"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        out = q_lineage_rows(spark, sf)
        files = [f.split("o_orderstatus=")[1][0] for f in out.inputFiles()]
        assert min(files.count(s) for s in "FO") > 1
        ok, why = compare(out, duck(sf), SQL_LINEAGE_ROWS)
        assert ok, why
    finally:
        spark.conf.set(key, before)
