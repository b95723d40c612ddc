"""Unit vectors of the scalar functions."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from trackyard.functions import names, parse
from trackyard.session import JIT_LIMIT, short_methods


def _eval(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_duration_original_semantics(spark):
    vals = ["43min 16s 695ms", "1h 13min 40s 49ms", "5min 874ms", "12min 25s", "0ms", "7s 55ms",
            "2s797ms", "12", "Call running...", "", None]
    assert _eval(spark, vals, parse.parse_duration_ms) == [
        2596695, 820049, 300874, 745000, 0, 7055, 2797, 0, None, None, None]


def test_duration_with_hours(spark):
    assert _eval(spark, ["1h 13min 40s 49ms", "43min 16s 695ms"],
                 lambda c: parse.parse_duration_ms(c, hours=True)) == [4420049, 2596695]


def test_success_rate_vectors(spark):
    vals = ["5 / 6", "0 / 0", "5 / ", " / 4", "1/2", "1 / 2 / 3", None]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    num, den, rate = parse.success_rate_parts("x")
    got = [tuple(r) for r in df.select(num, den, rate).collect()]
    assert got == [(5, 6, Decimal("0.8333")), (0, 0, None), (5, None, None), (None, 4, None),
                   (None, None, None), (1, 2, Decimal("0.5000")), (None, None, None)]


def test_success_rate_overflow_raises(spark):
    df = spark.createDataFrame([("20 / 1",)], "x string")
    with pytest.raises(Exception):
        df.select(parse.success_rate_parts("x")[2]).collect()


def test_sentinel_timestamp(spark):
    vals = ["2026-05-13 16:42:38.277", "Call running...", "  Call running... ", None]
    got = _eval(spark, vals, lambda c: parse.sentinel_timestamp(c, trim=True))
    assert got[0].isoformat() == "2026-05-13T16:42:38.277000" and got[1:] == [None, None, None]
    with pytest.raises(Exception):
        _eval(spark, ["  Call running... "], lambda c: parse.sentinel_timestamp(c, trim=False))


def test_guarded_int_and_decimal(spark):
    assert _eval(spark, ["12", " 7 ", "-5", "+5", "5a", "12\n", None], parse.guarded_int) == [
        12, 7, None, None, None, None, None]
    assert _eval(spark, ["12,5", "7", "7.25", "-1", "PK 12", None], parse.guarded_decimal) == [
        Decimal("12.500"), Decimal("7.000"), Decimal("7.250"), None, None, None]


def test_seconds_to_ms(spark):
    df = spark.createDataFrame([(Decimal("2.345"),), (Decimal("0.001"),)], "x decimal(10,3)")
    assert [r[0] for r in df.select(parse.seconds_to_ms("x")).collect()] == [2345, 1]


def test_integral_text(spark):
    vals = ["13042.0", "00212799997194", "12", "1.5", "abc"]
    whole = lambda *v: spark.createDataFrame([(x,) for x in v], "x string").agg(parse.all_whole("x")).first()[0]
    assert [whole(v) for v in vals] == [True, True, True, False, False]
    assert whole("1", None, "2.0") and not whole("1", "abc")
    assert _eval(spark, ["13042.0", "00212799997194", "604070051706194"], parse.integral_value) == [
        13042, 212799997194, 604070051706194]


def test_na_tokens(spark):
    assert _eval(spark, ["", "NA", "N/A", "null", "x", " nan "], parse.na_to_null) == [
        None, None, None, None, "x", None]


def test_header_names(spark):
    assert _eval(spark, ["7 derniers jours?", "_Traité par_"], names.sanitise_name) == ["7_derniers_jours", "trait__par"]
    assert _eval(spark, [" Call Setup Duration (ms)\t"], names.normalise_header) == ["call setup duration (ms)"]
    assert _eval(spark, ["__N° ordre__"], names.sanitise_name) == ["n__ordre"]


@pytest.mark.parametrize("name,table", [
    ("ETCS-Call-tracing_2026.csv", "exp_etcs_call"),
    ("Transaction-tracing.csv", "exp_transaction_tracing"),
    ("VGCS-_-VBS-_-REC-tracing.csv", "exp_vgcs_vbs_rec_tracing"),
    ("HO-tracing.csv", "exp_ho_tracing"),
    ("Subscriber-Matrix.csv", "exp_subscriber_matrix"),
    ("HDLC-Frame-Error-tracing.csv", "exp_hdlc_frame_errors"),
    ("Phone-Matrix.csv", "exp_ho_tracing"),  # any "ho" wins before the later tests
    ("cell-load.csv", None),
])
def test_routing(spark, name, table):
    assert _eval(spark, [name], names.route_source) == [table]


def test_success_rate_signs_and_halves(spark):
    vals = ["-5 / 6", "5 / -6", "1 / 3", "2 / 3", "1 / 32", "-1 / 32", "1 / 16", "9 / 1", "2147483647 / 2147483647"]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    got = [r[0] for r in df.select(parse.success_rate_parts("x")[2]).collect()]
    assert got == [Decimal(v) for v in ("-0.8333", "-0.8333", "0.3333", "0.6667", "0.0313", "-0.0313", "0.0625",
                                        "9.0000", "1.0000")]


def test_is_whole_equals_the_decimal_test(spark):
    texts = [None, "", " ", "7", " 7", "\t7", "+7", "-7", "7.0", "7.5", ".0", "1e3", "1.5e1", "a1", ":5", "~1", "NaN", "Infinity",
             "９", "٣", "é", "9" * 19, "9" * 25, "9" * 40, "14B36", "7 ", "_", "/3", " 7"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    exact = F.col("t").isNull() | F.coalesce(F.col("t").try_cast("decimal(38,10)") % 1 == 0, F.lit(False))
    assert df.filter(~parse.is_whole("t").eqNullSafe(exact)).collect() == []


def test_short_methods_restores_the_sessions_limit(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    with short_methods(spark):
        assert spark.conf.get(key) == JIT_LIMIT
    assert spark.conf.get(key) == before
    spark.conf.set(key, "100")
    try:
        with short_methods(spark):
            assert spark.conf.get(key) == "100"
        assert spark.conf.get(key) == "100"
    finally:
        spark.conf.unset(key)


def test_texts_that_are_no_numbers_are_not_cast(spark):
    texts = ["12", " 12 ", "-3", "+4", "12.0", "12.5", ".0", "1e3", "1E-1", "x1", "1x", "0.04", "", "-", "99999999999999999999", "1\t"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", parse.is_whole("t").alias("whole"), parse.try_integer("t").alias("i"), parse.try_decimal("t").alias("d"),
                    F.col("t").try_cast("bigint").alias("cast_i"), F.col("t").try_cast("decimal(38,10)").alias("cast_d"))
    for r in got.collect():
        assert (r.i, r.d) == (r.cast_i, r.cast_d) and r.whole == (r.cast_i is not None or (r.cast_d is not None and r.cast_d % 1 == 0))
    # a failing cast throws and catches an exception a text
    assert "RLIKE" in df.select(parse.is_whole("t"))._jdf.queryExecution().toString()
