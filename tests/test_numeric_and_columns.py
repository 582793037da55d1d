"""F1-F18 and the exact-rounding rule, on the hand-made cases of FIXTURES.md."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from isobar.functions import columns as C
from isobar.functions.numeric import mean_half_up, round_div, round_ratio, scaled_int


def one(df):
    return [tuple(r) for r in df.collect()]


def test_round_div_half_away_from_zero(spark):
    df = spark.createDataFrame([(5, 2), (-5, 2), (-7, 2), (7, 3), (1, 0)], "n long, d long")
    got = [r[0] for r in df.select(round_div("n", "d")).collect()]
    assert got == [3, -3, -4, 2, None]


def test_exact_mean_does_not_round_twice(spark):
    # 2,000,001 zeros and 2,000,000 cents: true mean 0.00499999875 -> 0.00
    df = spark.range(4_000_001).select(
        F.when(F.col("id") < 2_000_000, F.lit(Decimal("0.01"))).otherwise(F.lit(Decimal("0.00"))).cast("decimal(18,6)").alias("v")
    )
    got = df.agg(mean_half_up(F.sum(scaled_int("v")), F.count("v"), 2).alias("m")).first()["m"]
    assert got == Decimal("0.00")
    # the trap the helper avoids: avg(decimal(18,2)) is already rounded to scale 6
    naive = df.agg(F.round(F.avg(F.col("v").cast("decimal(18,2)")), 2).alias("m")).first()["m"]
    assert naive == Decimal("0.01")


def test_celsius(spark):
    df = spark.createDataFrame([(x,) for x in ["71.3", "32", "-40", "50.09", "99.95"]], "t string")
    df = df.select(F.col("t").cast("decimal(18,6)").alias("f"))
    got = [r[0] for r in df.select(C.fahrenheit_to_celsius_1dp(scaled_int("f"))).collect()]
    assert got == [Decimal(x) for x in ["21.8", "0.0", "-40.0", "10.1", "37.8"]]


def test_midpoint_and_sun_ratios(spark):
    df = spark.createDataFrame([("80.5", "70.4"), ("-1.2", "-1.3")], "hi string, lo string").select(
        F.col("hi").cast("decimal(18,6)").alias("hi"), F.col("lo").cast("decimal(18,6)").alias("lo")
    )
    got = df.select(
        mean_half_up(scaled_int("hi") + scaled_int("lo"), F.lit(2), 1).alias("avg"),
        F.round(F.col("hi") - F.col("lo"), 1).alias("rng"),
    ).collect()
    assert [(r.avg, r.rng) for r in got] == [(Decimal("75.5"), Decimal("10.1")), (Decimal("-1.3"), Decimal("0.1"))]
    sun = spark.createDataFrame([("51840", "17280"), ("0", "0")], "d string, s string").select(
        scaled_int(F.col("d").cast("decimal(18,6)")).alias("d"), scaled_int(F.col("s").cast("decimal(18,6)")).alias("s")
    )
    got = sun.select(
        round_ratio("d", F.lit(3600 * 10**6), 2).alias("dh"),
        round_ratio("s", F.lit(3600 * 10**6), 2).alias("sh"),
        F.when(F.col("d") > 0, round_ratio(F.col("s") * 100, F.col("d"), 1)).alias("pct"),
    ).collect()
    assert [tuple(r) for r in got] == [
        (Decimal("14.40"), Decimal("4.80"), Decimal("33.3")),
        (Decimal("0.00"), Decimal("0.00"), None),
    ]


def test_surrogate_keys(spark):
    df = spark.createDataFrame(
        [("miami", dt.date(2026, 7, 5), dt.datetime(2026, 7, 5, 14, 0)), (None, dt.date(2026, 7, 5), None)],
        "name string, d date, h timestamp_ntz",
    )
    got = df.select(C.surrogate_key("name", "d").alias("kd"), C.surrogate_key("name", "h").alias("kh")).collect()
    assert got[0].kd == "5ba56347cd18b78f48766575b76d332b"
    assert got[0].kh == "bda2f9c530701ae672e62f4a7eded9e5"
    assert got[1].kd == "f13e8b45f9d0708246789427cddd8a7f"


def test_coordinate_label(spark):
    df = spark.createDataFrame([(34.0, -118.5), (None, 1.0)], "lat double, lon double")
    assert [r[0] for r in df.select(C.coordinate_label("lat", "lon")).collect()] == ["34_-118.5", None]


def test_calendar(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2026, 7, 5, 14, 0),), (dt.datetime(2026, 7, 4, 9, 0),), (None,)], "h timestamp_ntz"
    )
    got = df.select(C.hour_of_day("h"), C.day_of_week("h"), C.is_weekend("h")).collect()
    assert [tuple(r) for r in got] == [(14, 0, True), (9, 6, True), (None, None, None)]


def test_labels(spark):
    df = spark.createDataFrame([("1.3",), ("-0.4",), ("0",), (None,), ("1.25",)], "v string").select(
        F.col("v").cast("decimal(18,2)").alias("v")
    )
    got = df.select(C.signed_label("v"), C.signed_text("v")).collect()
    assert [tuple(r) for r in got] == [
        ("+1.3°F warmer", "+1.3°F"),
        ("-0.4°F", "-0.4°F"),
        ("0.0°F", "+0.0°F"),
        (None, None),
        ("+1.3°F warmer", "+1.3°F"),  # rounded half up before formatting
    ]
    names = spark.createDataFrame([("new_york",), ("los_angeles",)], "n string")
    assert [r[0] for r in names.select(C.title_label("n")).collect()] == ["New York", "Los Angeles"]


def test_zone_conversion(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 7, 1, 0, 0), "America/Denver")], "t timestamp_ntz, z string")
    assert df.select(C.utc_to_local("t", "z")).first()[0] == dt.datetime(2024, 6, 30, 18, 0)
    e = spark.createDataFrame([(0,), (3600,)], "s long")
    assert [r[0] for r in e.select(C.epoch_to_utc("s")).collect()] == [
        dt.datetime(1970, 1, 1, 0, 0),
        dt.datetime(1970, 1, 1, 1, 0),
    ]
