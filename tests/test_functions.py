import datetime as dt

import pytest
from pyspark.sql import functions as F

from playcohort.functions import channel as ch
from playcohort.functions import device, festival, ladder, money, sqlfuncs, times


def one(spark, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}")


@pytest.mark.parametrize("raw, parts", [
    (None, ["21", "", ""]), ("", ["21", "", ""]), ("0", ["21", "", ""]), ("\\N", ["pyw", "", ""]), ("m1", ["m1", "", ""]),
    ("m1_s2", ["m1", "s2", ""]), ("m1_s2_p3", ["m1", "s2", "p3"]), ("_s2_p3", ["21", "s2", "p3"]), ("no_acc", ["no_acc", "", ""]),
    ("a_b_c_d", ["a", "b", "c"]),
])
def test_channel_parts(spark, raw, parts):
    assert list(ch.with_channel_parts(one(spark, raw), "x").select(*ch.CHANNEL_COLS).first()) == parts


def test_channel_length_guard(spark):
    rows = spark.createDataFrame([("p" * 10, "c", "k"), ("p" * 11, "c", "k"), ("p", "c", "k" * 16)], "parent_channel string, child_channel string, pkg_code string")
    assert [r[0] for r in rows.select(ch.channel_fits()).collect()] == [True, False, False]


@pytest.mark.parametrize("pkg, game", [("4151M19006", 4151), ("M1", None), ("12", None), ("xM1", None), (None, None)])
def test_game_of_pkg(spark, pkg, game):
    assert one(spark, pkg).select(ch.game_of_pkg(F.col("x"))).first()[0] == game


@pytest.mark.parametrize("imei, ok", [("0" * 32, False), ("0" * 15, False), ("", False), (None, False),
                                      ("00000000-0000-0000-0000-000000000000", False), ("123456789012345", True)])
def test_valid_device(spark, imei, ok):
    assert one(spark, imei).select(device.valid_device(F.col("x"))).first()[0] is ok


def test_null_hash_is_invalid_only_for_hashing_android_media(spark):
    rows = spark.createDataFrame([("android", 1), ("android", 2), ("ios", 1)], "os string, medium int")
    test = device.valid_click_device(F.lit("5284047f4ffb4e04824a2fd1d1f0cd62"), F.col("os"), F.col("medium"))
    assert [r[0] for r in rows.select(test).collect()] == [False, True, True]


def test_canonical_device(spark):
    plain = "0123456789abcdef0123456789abcdef"
    dashed = "01234567-89AB-CDEF-0123-456789ABCDEF"
    for given in (plain, dashed.lower(), dashed):
        assert one(spark, given).select(device.canonical_device(F.col("x"))).first()[0] == dashed
    assert one(spark, "123456789012345").select(device.canonical_device(F.col("x"))).first()[0] == "123456789012345"


def test_device_text(spark):
    assert one(spark, "a$b").select(device.pipe_device(F.col("x"))).first()[0] == "a|b"
    assert one(spark, "866&x&y").select(device.first_device(F.col("x"))).first()[0] == "866"


@pytest.mark.parametrize("tiers, amount, rate", [
    ("0=10|1000=20|5000=30", 999, "10"), ("0=10|1000=20|5000=30", 1000, "20"), ("5000=30|0=10|1000=20", 99999, "30"),
    ("100=10|200=20", 50, "10"), ("100=10|200=20", None, "10"), (None, 5, "0"), ("0=10|broken|7", 5, "10"),
    ("0=10|99999999999999999999=90|x1=2", 10**15, "10"), ("", 5, None),
])
def test_ladder(spark, tiers, amount, rate):
    sqlfuncs.register_sql_functions(spark)
    row = spark.createDataFrame([(tiers, amount)], "l string, a long")
    assert row.withColumn("t", ladder.ladder_tiers("l")).select(ladder.tier_rate("t", "a")).first()[0] == rate
    assert row.selectExpr("getdivideladder(l, cast(a AS string))").first()[0] == rate
    assert row.selectExpr("getdivideladder(l, 'no number')").first()[0] == row.selectExpr("getdivideladder(l, NULL)").first()[0]


@pytest.mark.parametrize("text, name", [("20161001", "国庆节"), ("2016-10-01", "国庆节"), ("2016-10-01 10:35:46", "国庆节"),
                                        ("20161009", "null"), ("nothing", "null"), (None, "null")])
def test_festival(spark, text, name):
    row = festival.with_festival(one(spark, text), F.col("x")).first()
    assert row.festival == name and row.is_festival == (name != "null")


def test_festival_from_number(spark):
    assert one(spark, 20161001.0, "double").select(festival.number_digits(F.col("x"))).first()[0] == "20161001"


@pytest.mark.parametrize("a, b, grain, before", [
    ("2024-01-01 10:00:00", "2024-01-01 10:00:01", "second", True), ("2024-01-01 10:00:00", "2024-01-01 10:59:59", "hour", False),
    ("2024-01-01 10:00:00", "2024-01-02 00:00:00", "day", True), ("bad", "2024-01-02 00:00:00", "day", False), (None, "2024-01-02 00:00:00", "day", False),
])
def test_time_compare(spark, a, b, grain, before):
    row = spark.createDataFrame([(a, b)], "a string, b string")
    assert row.select(times.is_before(F.col("a"), F.col("b"), grain)).first()[0] is before


def test_run_day(spark):
    row = one(spark, dt.datetime(2024, 1, 2, 0, 59), "timestamp")
    assert row.select(times.run_day(F.col("x"))).first()[0] == dt.date(2024, 1, 1)


@pytest.mark.parametrize("text, cents", [("30.00", 3000), ("", 0), (None, 0), ("x", 0)])
def test_amounts(spark, text, cents):
    assert one(spark, text).select(money.cents(money.zero_if_null(F.col("x")))).first()[0] == cents
