"""Properties of the relational operators (dedup, ordinals, fact joins, upsert)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from trackyard.operators.dedup import dedup_latest
from trackyard.operators.joins import left_join_dim
from trackyard.operators.merge import latest_state
from trackyard.operators.ordinal import global_ordinal, global_ordinal_counted, grouped_ordinal

EVENTS = "/root/testdata/sf0.001/events.parquet"


def srt(rows):
    return sorted((tuple(r) for r in rows), key=repr)

ORDERS = "/root/testdata/sf0.001/orders.parquet"


def test_dedup_unique_subset_idempotent(spark):
    ev = spark.read.parquet(EVENTS)
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    d = dedup_latest(ev, ["user_id", "event_type"], order)
    assert d.count() == ev.select("user_id", "event_type").distinct().count()
    assert d.join(ev, d.columns, "left_anti").count() == 0
    again = dedup_latest(d, ["user_id", "event_type"], order)
    assert sorted(again.collect()) == sorted(d.collect())
    # the winner is the latest row of its key
    latest = ev.groupBy("user_id", "event_type").agg(F.max("ts").alias("ts"))
    assert d.join(latest, ["user_id", "event_type", "ts"]).count() == d.count()


def test_dedup_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, 1, 10), (None, 1, 11), (None, 2, 12), (5, 1, 13)],
                               "imsi bigint, start int, v int")
    got = srt(dedup_latest(df, ["imsi", "start"], [F.col("v").desc()]).collect())
    assert got == srt([(None, 1, 11), (None, 2, 12), (5, 1, 13)])


def test_dedup_plan_limits_before_shuffle(spark):
    ev = spark.read.parquet(EVENTS)
    plan = dedup_latest(ev, ["user_id"], [F.col("ts").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_global_ordinal_matches_row_number(spark):
    o = spark.read.parquet(ORDERS).select("o_orderkey", "o_totalprice")
    got, n = global_ordinal_counted(o, [F.col("o_totalprice").desc(), "o_orderkey"], out="k", num_partitions=5)
    ref = o.withColumn("k", F.row_number().over(Window.orderBy(F.col("o_totalprice").desc(), "o_orderkey")))
    assert n == o.count()
    assert sorted(got.collect()) == sorted(ref.collect())
    assert got.schema["k"].dataType.typeName() == "long"


def test_grouped_ordinal_matches_window(spark):
    o = spark.read.parquet(ORDERS).select("o_orderkey", "o_orderstatus")
    o = o.withColumn("grp", F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")))  # NULL group too
    got = grouped_ordinal(o, ["grp"], ["o_orderkey"], out="rn", num_partitions=7)
    ref = o.withColumn("rn", F.row_number().over(Window.partitionBy("grp").orderBy("o_orderkey")))
    assert srt(got.select(*ref.columns).collect()) == srt(ref.collect())


def test_global_ordinal_empty(spark):
    df = spark.createDataFrame([], "k bigint")
    got, n = global_ordinal_counted(df, ["k"], out="o")
    assert n == 0 and got.count() == 0


def test_left_join_dim_null_split_and_fanout(spark):
    dim = spark.createDataFrame([(1, 100, 7), (2, 200, 7), (3, 300, 8)], "subscriber_key bigint, imsi bigint, msisdn bigint")
    fact = spark.createDataFrame([(100, 7, "a"), (None, 8, "b"), (999, None, "c")],
                                 "imsi bigint, calling bigint, tag string")
    by_imsi = srt(left_join_dim(fact, dim, "imsi", "imsi", ["subscriber_key"]).collect())
    assert by_imsi == srt([(100, 7, "a", 1), (None, 8, "b", None), (999, None, "c", None)])
    fan = left_join_dim(fact, dim, "calling", "msisdn", ["subscriber_key"])
    assert fan.count() == 4  # msisdn 7 is shared by two subscribers
    plan = fan._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 2 and "Union" not in plan  # the fact is read once


def test_latest_event_is_the_state(spark):
    log = spark.createDataFrame([(1, "old", 5), (2, "keep", 1), (1, "new", 6), (3, None, None)], "k int, v string, t int")
    got = sorted(tuple(r) for r in latest_state(log, ["k"], "t").collect())
    assert got == [(1, "new", 6), (2, "keep", 1), (3, None, None)]


def test_global_ordinal_plain(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "k").orderBy(F.rand(1))
    got = global_ordinal(df, ["k"], out="o", num_partitions=4)
    assert got.filter(F.col("o") != F.col("k") + 1).count() == 0


def test_global_ordinal_with_aqe_sized_ranges(spark):
    """Without an explicit count AQE merges neighbouring range partitions; numbering stays exact."""
    prev = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",
                                           "spark.sql.adaptive.coalescePartitions.minPartitionSize",
                                           "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        df = spark.range(0, 50000).select((F.col("id") * 7919 % 50000).alias("k"), F.lit("x").alias("pad"))
        ranges = df.repartitionByRange("k").select(F.spark_partition_id()).distinct().count()
        assert 1 < ranges < 64  # AQE merged neighbours, and more than one range remains
        got, n = global_ordinal_counted(df, ["k"], out="o")
        assert n == 50000 and got.filter(F.col("o") != F.col("k") + 1).count() == 0
    finally:
        for k, v in prev.items():
            spark.conf.set(k, v)
