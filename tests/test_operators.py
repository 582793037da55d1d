"""N*, S9, D*, W*, T*, P4, A7, V* on the hand-made fixtures of FIXTURES.md."""

import datetime as dt
import json
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from conftest import T0, make_raw
from isobar.functions.numeric import mean_half_up, scaled_int
from isobar.operators import quality as Q
from isobar.operators.flatten import regular_axis, split_valid
from isobar.operators.windows import rolling_mean_3
from isobar.plans import models as M

MINIMAL = {
    "hourly": {
        "time": ["2026-07-05T00:00", "2026-07-05T01:00", "2026-07-05T02:00"],
        "temperature_2m": [70.1, 70.2, 70.4],
        "relative_humidity_2m": [50, 51, None],
    },
    "daily": {
        "time": ["2026-07-05"],
        "temperature_2m_max": [80.5],
        "temperature_2m_min": [70.4],
        "daylight_duration": [51840.0],
        "sunshine_duration": [17280.0],
        "sunrise": ["2026-07-05T06:34"],
        "sunset": ["2026-07-05T20:15"],
    },
}


def raw1(spark, body, fid=1, ts=T0, lat=40.0, lon=-105.0):
    return make_raw(spark, [(fid, ts, lat, lon, body if isinstance(body, str) else json.dumps(body))])


def test_flatten_minimal_document(spark):
    h = M.stg_hourly(raw1(spark, MINIMAL)).orderBy("hour_index").collect()
    assert [r.hour_index for r in h] == [1, 2, 3]
    assert [r.relative_humidity_pct for r in h] == [50, 51, None]
    assert h[0].observation_hour == dt.datetime(2026, 7, 5, 0, 0)
    assert h[2].temperature_2m_f == Decimal("70.4")
    assert h[0].showers_in is None  # absent array
    d = M.stg_daily(raw1(spark, MINIMAL)).collect()
    assert len(d) == 1 and d[0].forecast_date == dt.date(2026, 7, 5)
    assert d[0].sunrise_ts == dt.datetime(2026, 7, 5, 6, 34)


def test_ragged_and_long_arrays(spark):
    body = {"hourly": {"time": ["2026-07-05T00:00", "2026-07-05T01:00", "2026-07-05T02:00"], "temperature_2m": [1, 2]}}
    got = [r.temperature_2m_f for r in M.stg_hourly(raw1(spark, body)).orderBy("hour_index").collect()]
    assert got == [Decimal(1), Decimal(2), None]
    body = {"hourly": {"time": ["2026-07-05T00:00", "2026-07-05T01:00"], "temperature_2m": [1, 2, 3]}}
    assert M.stg_hourly(raw1(spark, body)).count() == 2


def test_absent_or_empty_section(spark):
    no_daily = {"hourly": MINIMAL["hourly"]}
    assert M.stg_daily(raw1(spark, no_daily)).count() == 0
    assert M.stg_hourly(raw1(spark, no_daily)).count() == 3
    empty = {"hourly": {"time": []}, "daily": None}
    assert M.stg_hourly(raw1(spark, empty)).count() == 0
    assert M.stg_daily(raw1(spark, empty)).count() == 0


def test_quarantine_keeps_the_batch(spark):
    docs = [
        (1, T0, 1.0, 1.0, json.dumps(MINIMAL)),
        (2, T0, 2.0, 2.0, json.dumps({"daily": {"time": "x"}})),
        (3, T0, 3.0, 3.0, "not json"),
    ]
    good, bad = split_valid(make_raw(spark, docs), ["hourly", "daily"])
    assert [r.forecast_id for r in good.collect()] == [1]
    assert sorted((r.forecast_id, r.reason) for r in bad.collect()) == [(2, "daily_time_not_array"), (3, "not_json")]
    assert M.stg_hourly(good).count() == 3


def test_strict_integer_cast_fails_on_decimal_token(spark):
    body = {"hourly": {"time": ["2026-07-05T00:00"], "relative_humidity_2m": [75.0]}}
    with pytest.raises(Exception):
        M.stg_hourly(raw1(spark, body)).collect()


def test_dedupe_rerun_and_repeated_hour(spark):
    later = T0 + dt.timedelta(hours=1)
    docs = [(1, T0, 1.0, 1.0, json.dumps(MINIMAL)), (2, later, 1.0, 1.0, json.dumps(MINIMAL))]
    d = M.dedupe_hourly(M.stg_hourly(make_raw(spark, docs)))
    assert d.count() == 3 and {r.forecast_id for r in d.collect()} == {2}
    rep = {"hourly": {"time": ["2026-11-01T00:00", "2026-11-01T01:00", "2026-11-01T01:00"], "temperature_2m": [1, 2, 3]}}
    d = M.dedupe_hourly(M.stg_hourly(raw1(spark, rep))).orderBy("observation_hour").collect()
    assert [(r.hour_index, r.temperature_2m_f) for r in d] == [(1, Decimal(1)), (3, Decimal(3))]


def _rolling(spark, rows):
    df = spark.createDataFrame(rows, "lat double, lon double, h timestamp_ntz, t string").withColumn(
        "t", F.col("t").cast("decimal(18,6)")
    )
    out = rolling_mean_3(df, ["lat", "lon"], "h", scaled_int("t"), "r")
    return [r.r for r in out.orderBy("lat", "lon", "h").collect()]


def test_rolling_mean_cases(spark):
    hours = [dt.datetime(2026, 7, 5, i) for i in range(4)]
    got = _rolling(spark, [(1.0, 1.0, h, t) for h, t in zip(hours, ["70.1", "70.2", "70.4", "70.7"])])
    assert got == [Decimal(x) for x in ["70.10", "70.15", "70.23", "70.43"]]
    got = _rolling(spark, [(1.0, 1.0, h, t) for h, t in zip(hours, ["70.1", None, "70.4"])])
    assert got == [Decimal(x) for x in ["70.10", "70.10", "70.25"]]
    gap = [dt.datetime(2026, 7, 5, 0), dt.datetime(2026, 7, 5, 1), dt.datetime(2026, 7, 5, 5)]
    got = _rolling(spark, [(1.0, 1.0, h, t) for h, t in zip(gap, ["1", "2", "4"])])
    assert got == [Decimal(x) for x in ["1.00", "1.50", "2.33"]]


def test_rolling_mean_equals_brute_force_across_gaps(spark):
    rnd = random.Random(7)
    rows, want = [], {}
    for loc in range(4):
        h, series = dt.datetime(2026, 1, 1), []
        for _ in range(120):
            h += dt.timedelta(hours=rnd.choice([1, 1, 2, 5, 23, 49]))
            t = None if rnd.random() < 0.1 else f"{rnd.randint(-4000, 9000) / 100:.2f}"
            rows.append((float(loc), 0.5, h, t))
            series.append(None if t is None else Decimal(t))
            seen = [v for v in series[-3:] if v is not None]
            want[float(loc), h] = (sum(seen) / len(seen)).quantize(Decimal("0.01"), ROUND_HALF_UP) if seen else None
    df = spark.createDataFrame(rows, "lat double, lon double, h timestamp_ntz, t string").withColumn(
        "t", F.col("t").cast("decimal(18,6)")
    )
    out = rolling_mean_3(df, ["lat", "lon"], "h", scaled_int("t"), "r")
    assert {(r.lat, r.h): r.r for r in out.collect()} == want


def test_summary_of_a_null_date_names_no_cities(spark):
    columns = {c: "decimal(18,6)" for _, c, _ in M.SUMMARY_MEANS} | {"wind_gusts_max_mph": "decimal(18,6)"}
    rows = [(None, "a", 70.0), (None, "b", 80.0), (dt.date(2026, 7, 5), "a", 70.0), (dt.date(2026, 7, 5), "b", None)]
    df = spark.createDataFrame(rows, "forecast_date date, location_name string, v double")
    df = df.withColumns({c: F.col("v").cast(t) for c, t in columns.items()})
    both = [{r.forecast_date: r for r in f(df).collect()} for f in (M.daily_summary, M.daily_summary_hash)]
    for got in both:
        assert got[None].location_count == 2 and got[None].hottest_city is None and got[None].wettest_city_precip_in is None
        day = got[dt.date(2026, 7, 5)]
        assert (day.hottest_city, day.hottest_city_high_f, day.coldest_city) == ("b", None, "a")  # NULL first when descending


def test_number_text_has_no_exponent(spark):
    from isobar.functions.columns import number_text

    values = [34.0, -89.75, 0.0005, 12345678.0, 100.0, 0.0, None, float("nan")]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(number_text("v")).collect()]
    assert got == ["34", "-89.75", "0.0005", "12345678", "100", "0", None, None]


def _daily(spark, rows):
    cols = "location_name string, forecast_date date, temperature_max_f string, temperature_min_f string, precipitation_sum_in string"
    df = spark.createDataFrame(rows, cols)
    for c in ["temperature_max_f", "temperature_min_f", "precipitation_sum_in"]:
        df = df.withColumn(c, F.col(c).cast("decimal(18,6)"))
    df = df.withColumn(
        "temperature_avg_f",
        mean_half_up(scaled_int("temperature_max_f") + scaled_int("temperature_min_f"), F.lit(2), 1),
    )
    for c in ["temperature_range_f", "wind_speed_max_mph", "wind_gusts_max_mph", "uv_index_max", "sunshine_hours", "daylight_hours"]:
        df = df.withColumn(c, F.lit(None).cast("decimal(18,6)"))
    return df.withColumns({"state": F.lit("S"), "city": F.lit("C"), "daily_weather_sk": F.lit("k"), "ingested_at": F.current_timestamp()})


def test_extremes_null_first_and_ties(spark):
    d = dt.date(2026, 7, 5)
    s = M.daily_summary(_daily(spark, [("x", d, None, "60", "0.1"), ("y", d, "90", "50", "0.3")])).first()
    assert (s.hottest_city, s.hottest_city_high_f, s.hottest_high_f) == ("x", None, Decimal("90"))
    assert (s.coldest_city, s.coldest_low_f) == ("y", Decimal("50"))
    assert s.wettest_city == "y" and s.location_count == 2
    s = M.daily_summary(_daily(spark, [("p", d, "88", "60", "0"), ("o", d, "88", "60", "0")])).first()
    assert s.hottest_city == "o" and s.coldest_city == "o"


def test_anomaly_categories(spark):
    def cats(pairs):
        rows = []
        for i, (date, avg) in enumerate(pairs):
            hi = None if avg is None else str(avg)
            rows.append((f"l{i}", date, hi, hi, "0"))
        a = M.temperature_anomalies(_daily(spark, rows)).orderBy("location_name").collect()
        return [(r.temperature_anomaly_category, r.avg_temp_anomaly_f, r.locations_on_date) for r in a]

    d1, d2, d3, d4 = (dt.date(2026, 7, i) for i in (1, 2, 3, 4))
    got = cats([(d1, 80.0), (d1, 70.0), (d2, 77.0), (d2, 73.0), (d3, 76.9), (d3, 73.1), (d4, 65.0), (d4, None)])
    assert [g[0] for g in got] == [
        "much_warmer", "much_cooler", "warmer", "cooler", "near_average", "near_average", "near_average", "near_average",
    ]
    assert got[6][1] == Decimal("0.00") and got[7][1] is None and got[7][2] == 2


def test_distinct_pair_and_load_check(spark):
    raw = make_raw(spark, [(i, T0, 1.0, float(i % 7), "{}") for i in range(7)])
    assert Q.load_check(raw, T0, 7) == {"rows_since": 7, "locations_since": 7}
    six = make_raw(spark, [(i, T0, 1.0, float(i % 6), "{}") for i in range(7)])
    with pytest.raises(Q.LoadCheckError, match="distinct locations"):
        Q.load_check(six, T0, 7)
    with pytest.raises(Q.LoadCheckError, match="rows"):
        Q.load_check(make_raw(spark, [(i, T0, 1.0, float(i), "{}") for i in range(6)]), T0, 7)
    pairs = spark.createDataFrame([(1, 2), (1, None)], "a int, b int")
    assert pairs.select(F.count_distinct(F.struct("a", "b"))).first()[0] == 2


def test_rules(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 1, 100.0), (2, 3, 101.0)], "a int, b int, pct double")
    rules = [Q.AcceptedRange("pct", 0, 100), Q.NotNull("pct"), Q.UniqueCombination(("a", "b")), Q.Unique("a")]
    got = {(r.rule, r.column): r.failures for r in Q.run_rules(df, "t", rules).collect()}
    assert got == {("accepted_range", "pct"): 1, ("not_null", "pct"): 1, ("unique_combination_of_columns", "a,b"): 1, ("unique", "a"): 1}


def test_regular_axis(spark):
    df = spark.createDataFrame([(1, 0, 10800), (2, 5, 5)], "id int, s long, e long")
    out = regular_axis(df, F.col("s"), F.col("e"), 3600, {"v": F.array(F.lit(1), F.lit(2))}, ["id"]).orderBy("id", "step_index")
    got = [(r.id, r.step_index, r.step_time_utc, r.v) for r in out.collect()]
    assert got == [
        (1, 1, dt.datetime(1970, 1, 1, 0), 1),
        (1, 2, dt.datetime(1970, 1, 1, 1), 2),
        (1, 3, dt.datetime(1970, 1, 1, 2), None),
    ]


def test_hash_summary_equals_one_pass_on_edge_cases(spark):
    d1, d2 = dt.date(2026, 7, 5), dt.date(2026, 7, 6)
    rows = [
        ("x", d1, None, "60", "0.1"), ("y", d1, "90", "50", None), ("a", d1, "90", "50", "0.3"),
        ("p", d2, "88", None, "0"), ("o", d2, "88", None, "0"),
    ]
    daily = _daily(spark, rows)
    a, b = M.daily_summary_hash(daily), M.daily_summary(daily)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_sorted_outputs_and_location_series(spark):
    from isobar.plans.bi import location_series

    d1, d2 = dt.date(2026, 7, 5), dt.date(2026, 7, 6)
    daily = _daily(spark, [("a", d2, "80", "70", "0"), ("b", d1, "90", "80", "0"), ("c", d1, None, None, "0"), ("d", d1, "60", "50", "0")])
    order = [(r.forecast_date, r.location_name) for r in M.sorted_anomalies(M.temperature_anomalies(daily)).collect()]
    assert order == [(d1, "c"), (d1, "b"), (d1, "d"), (d2, "a")]  # NULL anomaly first, then descending
    assert [r.forecast_date for r in M.sorted_summary(M.daily_summary(daily)).collect()] == [d1, d2]
    hourly = spark.createDataFrame(
        [("x", dt.datetime(2026, 7, 5, 2), "3"), ("x", dt.datetime(2026, 7, 5, 1), "2"), ("y", dt.datetime(2026, 7, 5, 0), "1")],
        "location_name string, observation_hour timestamp_ntz, temperature_2m_f string",
    )
    got = [r.observation_hour.hour for r in location_series(hourly, "x").collect()]
    assert got == [1, 2]
