"""Bad values, the hourly refresh, uniqueness in one scan, sorted output, bounded pivots."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from isobar.operators import quality as Q
from isobar.plans import bi
from isobar.plans import models as M
from isobar.plans.pipeline import build_relations
from isobar.session import materialize, release, run_folder
from isobar.sources import driver_tables as D
from isobar.sources.files import write_mart
from isobar.sources.raw import append_raw, read_raw
from isobar.streaming.ingest import hourly_halo, rebuild_hourly, refresh_hourly_mart
from tests.conftest import T0, make_raw

NO_LOCATIONS = "location_name string, latitude double, longitude double, timezone string, state string, city string"


def hourly_document(hours, temps, **other) -> str:
    return json.dumps({"hourly": {"time": hours, "temperature_2m": temps, **other}})


# ---------------------------------------------------------------- S9 for values
def test_bad_tokens_are_isolated_with_column_and_reason(spark):
    hours = [f"2026-07-05T0{h}:00" for h in range(4)]
    docs = [
        (1, T0, 1.0, 2.0, hourly_document(hours, ["abc", 70.5, None, 1e30], weather_code=[1, 2.5, 99999999999, {"a": 1}])),
        (2, T0, 1.5, 2.0, hourly_document(["2026-13-01T00:00", hours[1]], [1, 2])),
        (3, T0, 2.0, 2.0, hourly_document([None, hours[1]], [[], 2])),
        (4, T0, 2.0, 2.5, json.dumps({"daily": {"time": ["2026-07-05", "soon"], "sunrise": ["x", "2026-07-05T06:00"], "uv_index_max": [1, "-"]}})),
    ]
    hourly, daily, bad = M.isolated_staging(make_raw(spark, docs))
    told = {(r["forecast_id"], r["section"], r["position"], r["column"], r["reason"]) for r in bad.collect()}
    assert told == {
        (1, "hourly", 1, "temperature_2m_f", "not_a_number"),
        (1, "hourly", 2, "weather_code", "not_an_integer"),
        (1, "hourly", 3, "weather_code", "out_of_range"),
        (1, "hourly", 4, "temperature_2m_f", "out_of_range"),
        (1, "hourly", 4, "weather_code", "not_a_number"),
        (2, "hourly", 1, "observation_hour", "bad_time"),
        (3, "hourly", 1, "temperature_2m_f", "not_a_number"),
        (4, "daily", 1, "sunrise_ts", "bad_time"),
        (4, "daily", 2, "forecast_date", "bad_time"),
        (4, "daily", 2, "uv_index_max", "not_a_number"),
    }
    assert sorted((r["forecast_id"], r["hour_index"]) for r in hourly.collect()) == [(2, 2), (3, 2)] and daily.count() == 0
    assert hourly.columns == M.stg_hourly(make_raw(spark, docs)).columns
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|abc"):
        M.stg_hourly(make_raw(spark, docs)).collect()


def test_isolated_flatten_parses_each_document_once(spark):
    plan = M.stg_hourly(make_raw(spark, []), errors_col="errors")._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("from_json") <= 1


def test_isolated_rows_are_written_without_a_shuffle(spark):
    docs = [(i, T0, 1.0, 2.0, hourly_document([f"2026-07-05T0{i}:00"], ["abc" if i == 2 else 70.5])) for i in range(4)]
    hourly, _, bad = M.isolated_staging(make_raw(spark, docs).repartition(3))
    assert not [f for f in hourly.inputFiles() if "_bad=" in f]  # partitioned, all good rows went to one task
    assert sorted(r["forecast_id"] for r in hourly.collect()) == [0, 1, 3] and [r["forecast_id"] for r in bad.collect()] == [2]


# ---------------------------------------------------------------- X2 hourly
def staged_rows(spark, rows):
    """(forecast_id, ingested_at, latitude, time, temperature) -> staged rows with a date."""
    docs = [(i, at, lat, 5.0, hourly_document([t], [v])) for i, at, lat, t, v in rows]
    staged = M.stg_hourly(make_raw(spark, docs)).withColumn("observation_date", F.to_date("observation_hour"))
    return materialize(staged, "staged", ("observation_date",))


def test_hourly_refresh_equals_rebuild_across_gaps_and_range_ends(spark):
    rng, later = random.Random(2), T0 + dt.timedelta(days=1)
    rows, n = [], 0
    for lat in (1.0, 2.0, 3.0, 4.0):
        day = dt.datetime(2026, 7, 1)
        for _ in range(30):
            day += dt.timedelta(hours=rng.choice([1, 1, 1, 2, 40, 300]))  # gaps of days and weeks
            n += 1
            new = lat in (1.0, 3.0) and rng.random() < 0.2
            rows.append((n, later if new else T0, lat, day.strftime("%Y-%m-%dT%H:00"), rng.randrange(300) / 4))
            if rng.random() < 0.1:  # delivered again, newer or older than the first time
                n += 1
                rows.append((n, rng.choice([T0, later]) if lat in (1.0, 3.0) else T0, lat, rows[-1][3], rng.randrange(300) / 4))
    rows.append((n + 1, later, 1.0, "2027-01-01T00:00", 50.0))  # behind the last hour
    rows.append((n + 2, later, 3.0, "2026-06-01T00:00", 60.0))  # before the first one
    rows.append((n + 3, later, 9.0, "2026-08-01T00:00", 70.0))  # a new location
    staged, none = staged_rows(spark, rows), spark.createDataFrame([], NO_LOCATIONS)
    is_new = F.col("ingested_at") >= F.lit(later)
    path = f"{run_folder(spark)}/hourly-refresh"
    whole = M.fct_hourly(M.int_hourly(staged.drop("observation_date"), none))
    write_mart(M.fct_hourly(M.int_hourly(staged.where(~is_new).drop("observation_date"), none)), path, ["observation_date"])
    halo = refresh_hourly_mart(staged, is_new, none, path)
    got = spark.read.parquet(path).select(*whole.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))
    assert {r["latitude"] for r in halo.collect()} == {1.0, 3.0, 9.0}  # untouched locations aren't read
    assert 0 < halo.where("rewrite").count() < halo.count() < got.count()


def test_halo_is_two_rows_back_and_two_rows_on(spark):
    rows = [(i, T0 + dt.timedelta(days=i == 5), 1.0, f"2026-07-{1 + 2 * i:02d}T00:00", 1.0) for i in range(10)]
    halo = hourly_halo(staged_rows(spark, rows), F.col("ingested_at") > F.lit(T0)).collect()
    days = lambda rows: sorted((r["observation_hour"].day - 1) // 2 for r in rows)
    assert days(halo) == [3, 4, 5, 6, 7] and days(r for r in halo if r["rewrite"]) == [5, 6, 7]


def test_hours_of_a_refresh_are_not_broadcast(spark):
    rows = [(i, T0 + dt.timedelta(days=i == 5), 1.0, f"2026-07-{1 + 2 * i:02d}T00:00", 1.0) for i in range(10)]
    staged = staged_rows(spark, rows)
    halo = materialize(hourly_halo(staged, F.col("ingested_at") > F.lit(T0)), "halo")
    fresh = rebuild_hourly(staged, halo, spark.createDataFrame([], NO_LOCATIONS))
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    joins = [p.split("Join")[0] for p in plan.split("\n") if "Join " in p and "observation_hour" in p]
    assert [j.split()[-1] for j in joins] == ["SortMerge"]  # their files are small, however many they are
    assert sorted((r["observation_hour"].day - 1) // 2 for r in fresh.collect()) == [5, 6, 7]


# ---------------------------------------------------------------- V2, V5
def test_all_uniqueness_rules_take_one_shuffle_and_compare_values(spark):
    a = spark.createDataFrame([(1, "x", None), (1, "x", 2.0), (2, "y", 2.0), (None, "y", None), (None, "z", None), (None, "z", None)], "k long, s string, v double")
    b = spark.createDataFrame([("1", 1), ("1", 2), ("2", 2)], "k string, n int")
    rules = {"a": [Q.Unique("k"), Q.UniqueCombination(("k", "s")), Q.UniqueCombination(("s", "v")), Q.NotNull("v")], "b": [Q.Unique("k"), Q.UniqueCombination(("k", "n"))]}
    got = {(r["relation"], r["column"], r["rule"]): r["failures"] for r in Q.quality_report({"a": a, "b": b}, rules).collect()}
    assert got == {
        ("a", "k", "unique"): 1, ("a", "k,s", "unique_combination_of_columns"): 2, ("a", "s,v", "unique_combination_of_columns"): 1,
        ("a", "v", "not_null"): 4, ("b", "k", "unique"): 1, ("b", "k,n", "unique_combination_of_columns"): 0,
    }
    empty = Q.quality_report({"a": a.limit(0)}, rules).collect()
    assert len(empty) == 4 and all(r["failures"] == 0 and r["passed"] for r in empty)


# ---------------------------------------------------------------- O1-O3, R1
def test_positions_come_from_the_output(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v"), (F.col("id") % 3).alias("g")).repartition(7)
    got = {r["v"]: r["position"] for r in bi.positions(df.orderBy("v")).collect()}
    assert got == {v: v + 1 for v in range(1000)}
    within = bi.positions(df.orderBy("g", F.desc("v")), "g").collect()
    for g in range(3):
        ordered = [r["v"] for r in sorted((r for r in within if r["g"] == g), key=lambda r: r["position"])]
        assert ordered == sorted(ordered, reverse=True) and {r["position"] for r in within if r["g"] == g} == set(range(1, len(ordered) + 1))
    unsorted = {r["v"]: r["position"] for r in bi.positions(df).collect()}
    assert unsorted != got and set(unsorted.values()) == set(range(1, 1001))  # a missing sort shows
    assert bi.positions(df.limit(0).orderBy("v")).collect() == []


def test_heatmaps_have_bounded_width(spark):
    day = dt.date(2026, 1, 30)
    rows = [(f"l{i % 2}", day + dt.timedelta(days=i), float(i)) for i in range(40)]
    an = spark.createDataFrame(rows, "location_name string, forecast_date date, avg_temp_anomaly_f double")
    wide = bi.anomaly_heatmap(an, day, day + dt.timedelta(days=2))
    assert wide.columns == ["location_name", "2026-01-30", "2026-01-31", "2026-02-01", "location_label"]
    assert sorted(map(tuple, wide.drop("location_label").collect())) == [("l0", 0.0, None, 2.0), ("l1", None, 1.0, None)]
    for last in (day - dt.timedelta(days=1), day + dt.timedelta(days=400)):
        with pytest.raises(ValueError, match="heatmap"):
            bi.anomaly_heatmap(an, day, last)
    months = {(str(r["month"]), r["location_name"]): r for r in bi.anomaly_heatmap_months(an).collect()}
    assert len(months) == 6 and months["2026-02-01", "l0"]["d01"] == 2.0 and months["2026-02-01", "l0"]["d02"] is None


def test_tables_land_again_after_a_release(spark):
    first = D.raw_forecasts(spark, "/root/testdata/sf0.001").count()
    release(spark)
    assert D.raw_forecasts(spark, "/root/testdata/sf0.001").count() == first


# ------------------------------------------------- documents parsed once, at ingest
def test_typed_documents_give_the_rows_of_their_text(spark):
    hours = [f"2026-07-05T0{h}:00" for h in range(4)]
    odd = ["abc", 1e30, 1e-6, 70.5, None, {"a": 1}, [], True, 10**30, -0.0, 7]
    ints = ["abc", 2.5, 99999999999, 10**25, None, {"a": 1}, 75.0, -3, 1e2, 75, 12]
    rng = random.Random(5)
    docs = [
        (1, T0, 1.0, 2.0, '{"hourly":{"time":["2026-07-05T00:00"],"weather_code":[75.0]}}'),
        (2, T0, 1.0, 2.5, '{"a":1,"a":2,"hourly":{"time":["2026-07-05T00:00"],"temperature_2m":[1.50]}}'),
        (3, T0, 1.0, 3.0, "no json {"),
        (4, T0, 1.0, 3.5, "[1, 2]"),
        (5, T0, 1.0, 4.0, '{"hourly":{"time":"no","weather_code":[1]},"daily":null}'),
        (6, T0, 1.0, 4.5, json.dumps({"hourly": {"time": []}, "daily": {"time": ["2026-07-05"], "weather_code": [3], "sunrise": ["soon"]}})),
        (7, T0, 1.0, 5.0, '{"hourly":{"time":["2026-07-05T00:00"],"weather_code":{"0":1},"rain":7}}'),
    ]
    for i in range(8, 60):
        temps, codes = (rng.choices(values, k=rng.randint(0, 5)) for values in (odd, ints))
        docs.append((i, T0, 1.0, i / 2, hourly_document(hours, temps, weather_code=codes)))
    raw = make_raw(spark, docs)
    path = f"{run_folder(spark)}/typed-test"
    append_raw(raw, path, typed=True)
    typed = read_raw(spark, path, typed=True)
    by_text = {r["forecast_id"] for r in typed.where("NOT is_typed").collect()}
    assert {1, 2, 3} <= by_text and not by_text & {4, 5, 6, 7} and len(by_text) < 50
    for got, want in zip(M.isolated_staging(typed), M.isolated_staging(raw)):
        key = [c for c in ("forecast_id", "section", "position", "column", "hour_index", "day_index") if c in want.columns]
        rows = lambda df: sorted((tuple(r[k] for k in key), str(r)) for r in df.select(*want.columns).collect())  # noqa: E731, B023
        assert rows(got) == rows(want)


def test_typed_documents_are_read_as_arrays_and_not_parsed(spark):
    path = f"{run_folder(spark)}/typed-plan"
    append_raw(make_raw(spark, [(1, T0, 1.0, 2.0, hourly_document(["2026-07-05T00:00"], [70.5]))]), path, typed=True)
    staged = M.stg_hourly_typed(read_raw(spark, path, typed=True))
    assert staged.count() == 1
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") <= 1  # of the documents that go by their text
    of_typed, by_text = [line for line in plan.splitlines() if "FileScan" in line]
    assert "response_doc" in of_typed and "response_body" not in of_typed and "variant_get" not in plan  # read by the scan
    assert "response_body" in by_text and "NOT is_typed" in by_text.split("PartitionFilters")[1]
    assert "parse_json" not in plan


def test_run_from_a_typed_table_equals_that_from_text(spark):
    raw = D.with_repeated_keys(D.raw_forecasts(spark, "/root/testdata/sf0.001"))
    path = f"{run_folder(spark)}/typed-run"
    append_raw(raw, path, typed=True)
    locations = D.locations(spark, "/root/testdata/sf0.001")
    a, b = build_relations(read_raw(spark, path, typed=True), locations), build_relations(raw, locations)
    for name in ("fct_hourly_weather", "fct_daily_weather", "value_quarantine"):
        assert a[name].exceptAll(b[name]).isEmpty() and b[name].exceptAll(a[name]).isEmpty()
