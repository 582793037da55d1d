"""Invariants over the derived inputs of the driver tables."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from isobar.plans import models as M
from isobar.sources import driver_tables as D
from isobar.streaming.ingest import rebuild_daily, refresh_mart

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def inputs(spark):
    return D.raw_forecasts(spark, SF), D.locations(spark, SF)


def test_flatten_rows_equal_time_lengths(inputs):
    raw, _ = inputs
    lengths = raw.select(F.json_array_length(F.get_json_object("response_body", "$.hourly.time")).alias("n"))
    assert M.stg_hourly(raw).count() == lengths.agg(F.sum("n")).first()[0]


def test_dedupe_keys_are_unique(inputs):
    raw, _ = inputs
    d = M.dedupe_hourly(M.stg_hourly(raw))
    assert d.count() == d.select("latitude", "longitude", "observation_hour").distinct().count()
    assert d.count() < M.stg_hourly(raw).count()  # the derived runs do overlap


def test_anomalies_sum_to_zero_within_rounding(inputs):
    raw, loc = inputs
    a = M.temperature_anomalies(M.fct_daily(M.int_daily(M.stg_daily(raw), loc)))
    per = a.groupBy("forecast_date").agg(
        F.sum("avg_temp_anomaly_f").alias("s"), F.count("avg_temp_anomaly_f").alias("n")
    )
    bad = per.filter(F.abs(F.col("s")) > F.col("n") * F.lit(0.005) + F.lit(1e-9)).count()
    assert bad == 0


def test_incremental_refresh_equals_full_rebuild(spark, inputs, tmp_path):
    raw, loc = inputs
    first_days = raw.filter(F.col("ingest_date") < F.lit("2024-01-15").cast("date"))
    is_new = F.col("ingested_at") >= F.lit(dt.datetime(2024, 1, 15, tzinfo=dt.timezone.utc))
    path = str(tmp_path / "fct_daily")
    refresh_mart(M.fct_daily(M.int_daily(M.stg_daily(first_days), loc)), path)
    refresh_mart(rebuild_daily(M.stg_daily(raw), is_new, loc), path)
    full = M.fct_daily(M.int_daily(M.stg_daily(raw), loc))
    cols = ["daily_weather_sk", "forecast_id", "temperature_avg_f", "sunshine_pct"]
    got = spark.read.parquet(path).select(*cols)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, full.select(*cols).collect()))


def test_parse_once_equals_parse_per_section(inputs):
    raw, _ = inputs
    parsed = M.parse_documents(raw)
    for flat in (M.stg_hourly, M.stg_daily):
        a = flat(raw).exceptAll(flat(parsed, "_doc")).count()
        b = flat(parsed, "_doc").exceptAll(flat(raw)).count()
        assert a == 0 and b == 0
