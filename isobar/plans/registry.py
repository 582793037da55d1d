"""Registered queries: one per operator group of the survey, each ``(spark, sf_dir) ->
DataFrame`` over the benchmark tables (the raw forecast table is derived from
``events``, the location dimension from ``customer``; see ``sources.driver_tables``).

Output columns are cast to oracle-comparable types at the very end: integers to
bigint, exact decimals to double, instants to their UTC wall clock.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.functions import columns as C
from isobar.functions.numeric import cents
from isobar.operators import quality as Q
from isobar.operators.flatten import document_reason, regular_axis
from isobar.plans import bi
from isobar.plans import models as M
from isobar.plans.pipeline import published_marts, run_pipeline
from isobar.session import materialize, run_folder
from isobar.sources import driver_tables as D
from isobar.sources.files import read_locations_csv, read_mart, write_mart
from isobar.sources.raw import append_raw, read_raw
from isobar.streaming.ingest import ingest_landing, rebuild_daily, refresh_hourly_mart

# Fixed parameters of the registered queries.
LOAD_CHECK_SINCE = dt.datetime(2024, 1, 15, tzinfo=dt.timezone.utc)
EXPECTED_LOCATIONS = 7
REDELIVERY_ID_OFFSET = 10**12
ONE_LOCATION = "customer_000000011"
DISPLAYED = ["customer_000000013", "customer_000000001", "customer_000000011"]
REFRESH_SINCE = dt.datetime(2024, 1, 20, tzinfo=dt.timezone.utc)
HEATMAP_RANGE = (dt.date(2024, 1, 1), dt.date(2024, 1, 31))
FAILING_BATCH = 1
LANDING_FILES_PER_TASK = 500


# Integer outputs that hold NULLs (ragged arrays): pandas shows them as float on one
# engine and as nullable int on the other, so both sides emit them as DOUBLE.
NULLABLE_INT_OUTPUTS = ("relative_humidity_pct",)


def oracle_types(df: DataFrame) -> DataFrame:
    """Cast every column to a type both engines print the same way (one projection)."""
    exprs = []
    for f in df.schema.fields:
        c = f"`{f.name}`"
        t = f.dataType
        if f.name in NULLABLE_INT_OUTPUTS:
            c = f"CAST({c} AS DOUBLE)"
        elif isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = f"CAST({c} AS BIGINT)"
        elif isinstance(t, (T.DecimalType, T.FloatType)):
            c = f"CAST({c} AS DOUBLE)"
        elif isinstance(t, T.TimestampType):
            # instant -> UTC wall clock, zone-free (same as sources.driver_tables.utc_wall_clock)
            c = f"TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, CAST(unix_micros({c}) / 1000000 AS DECIMAL(18,6)))"
        exprs.append(f"{c} AS `{f.name}`")
    return df.selectExpr(*exprs)


def _raw(spark, sf):
    return D.raw_forecasts(spark, sf)


def _loc(spark, sf):
    return D.locations(spark, sf)


def _fct_daily(spark, sf):
    return M.fct_daily(M.int_daily(M.stg_daily(_raw(spark, sf)), _loc(spark, sf)))


def _fct_daily_shared(spark, sf):
    """``fct_daily`` for queries that read it more than once: written once, partitioned by
    its date like the mart, then read by every consumer."""
    return materialize(_fct_daily(spark, sf), "fct_daily", ("forecast_date",))


def _fct_hourly(spark, sf):
    return M.fct_hourly(M.int_hourly(M.stg_hourly(_raw(spark, sf)), _loc(spark, sf)))


# ------------------------------------------------------------------ nested JSON (N*)
def q_flatten_hourly(spark, sf):
    """Hourly flatten, all 20 columns."""
    return oracle_types(M.stg_hourly(_raw(spark, sf)))


def q_flatten_daily(spark, sf):
    """Daily flatten, all 24 columns."""
    return oracle_types(M.stg_daily(_raw(spark, sf)))


def q_flatten_ragged(spark, sf):
    """Short arrays give NULL past their end; absent arrays give NULL columns."""
    s = M.stg_hourly(_raw(spark, sf))
    return oracle_types(s.select("forecast_id", "hour_index", "relative_humidity_pct", "showers_in"))


def q_json_context(spark, sf):
    """N1 + N5: one path out of a JSON text column, ANSI cast to int."""
    ev = D.table(spark, sf, "events")
    k = F.from_json("props", "k string").getField("k").cast("int")
    return oracle_types(ev.select("event_id", k.alias("k")))


def q_regular_axis(spark, sf):
    """N8 + F18: values on a regular hourly axis [start, end) per event, with local time.

    start = the event's hour, end = start + (k % 4) hours (0 gives an empty axis);
    two values per run, so a third step has a NULL value.
    """
    ev = D.table(spark, sf, "events")
    h0 = F.concat(F.substring(F.col("ts").cast("string"), 1, 13), F.lit(":00:00")).cast("timestamp_ntz")
    start = C.ntz_epoch_micros(h0) / 1_000_000
    k = F.get_json_object("props", "$.k").cast("int")
    c = cents(F.col("value"))
    ev = ev.select("event_id", "user_id", start.alias("start_s"), k.alias("k"), c.alias("c"))
    out = regular_axis(
        ev,
        start_s=F.col("start_s"),
        end_s=F.col("start_s") + (F.col("k") % 4) * 3600,
        step_s=3600,
        values={"value_cents": F.array(F.col("c"), F.col("c") + 1)},
        keep=["event_id", "user_id"],
    )
    zone = D.zone_of(F.col("user_id"))
    return oracle_types(
        out.select(
            "event_id",
            "step_index",
            "step_time_utc",
            (F.col("value_cents") / 100).cast("double").alias("value"),
            zone.alias("timezone"),
            C.utc_to_local(F.col("step_time_utc"), zone).alias("step_time_local"),
        )
    )


def q_local_time(spark, sf):
    """UTC event time to the wall clock of the user's zone."""
    ev = D.table(spark, sf, "events")
    zone = D.zone_of(F.col("user_id"))
    return oracle_types(
        ev.select("event_id", zone.alias("timezone"), C.utc_to_local(F.col("ts"), zone).alias("local_ts"))
    )


def q_quarantine(spark, sf):
    """Malformed documents are split off with a reason; the batch never fails.

    Every 89th document is replaced by non-JSON text, every 97th gets a daily ``time``
    that is not an array."""
    raw = _raw(spark, sf)
    body = F.col("response_body")
    broken = (
        F.when(F.col("forecast_id") % 89 == 0, F.lit("not json {"))
        .when(
            F.col("forecast_id") % 97 == 0,
            F.regexp_replace(body, r'"daily":\{"time":\[[^\]]*\]', '"daily":{"time":"x"'),
        )
        .otherwise(body)
    )
    reason = F.coalesce(document_reason(broken, ["hourly", "daily"]), F.lit("ok"))
    return oracle_types(raw.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("documents")))


# --------------------------------------------------------------------- dedupe / join
def q_dedupe_latest(spark, sf):
    """Newest forecast per (latitude, longitude, observation_hour)."""
    d = M.dedupe_hourly(M.stg_hourly(_raw(spark, sf)))
    return oracle_types(
        d.select("latitude", "longitude", "observation_hour", "forecast_id", "hour_index", "ingested_at", "temperature_2m_f")
    )


def q_dedupe_daily(spark, sf):
    """Newest forecast per (latitude, longitude, forecast_date)."""
    d = M.dedupe_daily(M.stg_daily(_raw(spark, sf)))
    return oracle_types(
        d.select("latitude", "longitude", "forecast_date", "forecast_id", "day_index", "ingested_at", "temperature_max_f")
    )


def q_enrich_left_join(spark, sf):
    """J1 + P6 + F12: dimension join on exact coordinates, fallback names."""
    d = M.int_daily(M.stg_daily(_raw(spark, sf)), _loc(spark, sf))
    return oracle_types(
        d.select("forecast_id", "latitude", "longitude", "forecast_date", "location_name", "state", "city")
    )


def q_calendar(spark, sf):
    """Calendar columns of the hourly rows."""
    d = M.enrich_hourly(M.stg_hourly(_raw(spark, sf)), _loc(spark, sf))
    return oracle_types(
        d.select("location_name", "observation_hour", "observation_date", "hour_of_day", "day_of_week", "is_weekend")
    )


def q_unit_conversion(spark, sf):
    """°C, midpoint, range, hours, sunshine share (NULL without daylight)."""
    d = M.int_daily(M.stg_daily(_raw(spark, sf)), _loc(spark, sf))
    return oracle_types(
        d.select(
            "location_name", "forecast_date", "temperature_avg_f", "temperature_range_f",
            "daylight_hours", "sunshine_hours", "sunshine_pct",
        )
    )


def q_celsius(spark, sf):
    """exact °F -> °C at 1 dp over every hourly row."""
    d = M.enrich_hourly(M.stg_hourly(_raw(spark, sf)), _loc(spark, sf))
    return oracle_types(d.select("location_name", "observation_hour", "temperature_2m_f", "temperature_2m_c"))


def q_rolling_mean_3(spark, sf):
    """3-row rolling mean per location after dedupe."""
    d = M.int_hourly(M.stg_hourly(_raw(spark, sf)), _loc(spark, sf))
    return oracle_types(
        d.select("latitude", "longitude", "observation_hour", "temperature_2m_f", "temp_3hr_rolling_avg_f")
    )


# ---------------------------------------------------------------------------- marts
def q_fct_hourly(spark, sf):
    return oracle_types(_fct_hourly(spark, sf))


def q_fct_daily(spark, sf):
    return oracle_types(_fct_daily(spark, sf))


def q_daily_summary(spark, sf):
    """A1-A4, T3-T5, J2."""
    return oracle_types(M.daily_summary(_fct_daily(spark, sf)))


def q_daily_summary_hash(spark, sf):
    """A1-A4, T3-T5 without a sort-based aggregate, over the materialised daily fact."""
    return oracle_types(M.daily_summary_hash(_fct_daily_shared(spark, sf)))


def q_temperature_anomalies(spark, sf):
    """W2, W3, F7, P4."""
    return oracle_types(M.temperature_anomalies(_fct_daily_shared(spark, sf)))


def q_append_idempotent(spark, sf):
    """S2 + D2: re-delivering every document an hour later changes only lineage."""
    raw = _raw(spark, sf)
    again = raw.withColumns(
        {
            "forecast_id": F.col("forecast_id") + REDELIVERY_ID_OFFSET,
            "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 HOUR"),
        }
    )
    both = raw.unionByName(again)
    fd = M.fct_daily(M.int_daily(M.stg_daily(both), _loc(spark, sf)))
    return oracle_types(fd.drop("forecast_id", "load_id", "ingested_at"))


def q_incremental_refresh(spark, sf):
    """The daily fact rows rebuilt for the dates that the runs ingested from
    ``REFRESH_SINCE`` on touch, from the staged rows of those dates."""
    staged = materialize(M.stg_daily(_raw(spark, sf)), "stg_daily", ("forecast_date",))
    is_new = F.col("ingested_at") >= F.lit(REFRESH_SINCE)
    return oracle_types(rebuild_daily(staged, is_new, _loc(spark, sf)))


def q_incremental_refresh_hourly(spark, sf):
    """The hourly fact of the runs before ``REFRESH_SINCE``, published as a mart and
    refreshed by the later runs: as a whole it equals a full build. Runs hold three hours,
    so the hours of a location have gaps."""
    raw, loc = _raw(spark, sf), _loc(spark, sf)
    staged = M.stg_hourly(raw).withColumn("observation_date", F.to_date("observation_hour"))
    staged = materialize(staged, "stg_hourly", ("observation_date",))
    is_new = F.col("ingested_at") >= F.lit(REFRESH_SINCE)
    path = f"{run_folder(spark)}/mart-{uuid.uuid4().hex}"
    before = M.fct_hourly(M.int_hourly(staged.where(~is_new).drop("observation_date"), loc))
    write_mart(before, path, ["observation_date"], ["location_name", "observation_hour"])
    refresh_hourly_mart(staged, is_new, loc, path)
    return oracle_types(spark.read.parquet(path).select(*before.columns))


def q_landing_ingest(spark, sf):
    """S1 + X1 + S2 + S9: one landing file per supplier, ingested in several batches, one of
    which fails after it was written and is taken again: every file is in the raw table or,
    with its reason, in the quarantine, once."""
    folder = f"{run_folder(spark)}/landing-{uuid.uuid4().hex}"
    files = D.landing_files(D.table(spark, sf, "supplier"))
    n = files.count()
    # a small table is one task's, but its files are many: a fixed number per task
    spread = files.repartition(n // LANDING_FILES_PER_TASK + 1, "landing")
    spread.write.partitionBy("landing").text(f"{folder}/files")
    failed = []

    def fail_once(batch_id: int) -> None:
        if batch_id == FAILING_BATCH and not failed:
            failed.append(batch_id)
            raise RuntimeError("the batch was written, but not committed")

    def run():
        return ingest_landing(
            spark, f"{folder}/files", _loc(spark, sf), f"{folder}/raw", f"{folder}/checkpoint", f"{folder}/quarantine",
            max_files_per_batch=n // 3 + 1, after_batch=fail_once,
        )

    try:
        run()
    except Exception:
        if not failed:
            raise
    run()  # takes up where the failed run stopped
    raw = read_raw(spark, f"{folder}/raw").select(F.regexp_extract("source_url", r"([^/]+)$", 1).alias("file_name"), F.lit("raw").alias("outcome"))
    bad = spark.read.parquet(f"{folder}/quarantine").select("file_name", F.col("reason").alias("outcome"))
    return oracle_types(raw.unionByName(bad).groupBy("file_name", "outcome").agg(F.count("*").alias("times")))


def q_value_quarantine(spark, sf):
    """Rows with a token that its column can't take go to the quarantine with column and
    reason; the good rows of either section are counted beside."""
    hourly, daily, bad = M.isolated_staging(D.with_bad_values(_raw(spark, sf)))
    counts = bad.groupBy("section", "column", "reason").agg(F.count("*").alias("values"))
    good = lambda rows, section: rows.agg(F.count("*").alias("values")).select(
        F.lit(section).alias("section"), F.lit("").alias("column"), F.lit("good").alias("reason"), "values"
    )
    return oracle_types(counts.unionByName(good(hourly, "hourly")).unionByName(good(daily, "daily")))


def q_flatten_isolated(spark, sf):
    """N1-N6 + S9: the hourly rows that have no bad token, with all columns."""
    return oracle_types(M.isolated_staging(D.with_bad_values(_raw(spark, sf)))[0])


def _typed(spark, raw):
    """``raw`` landed in a typed table, some documents of which no VARIANT takes."""
    path = f"{run_folder(spark)}/typed-{uuid.uuid4().hex}"
    append_raw(D.with_repeated_keys(raw), path, typed=True)
    return read_raw(spark, path, typed=True)


def q_flatten_hourly_typed(spark, sf):
    """N1-N6 over documents parsed once, at ingest: all rows of the hourly flatten."""
    return oracle_types(M.stg_hourly_typed(_typed(spark, _raw(spark, sf))))


def q_flatten_daily_typed(spark, sf):
    """N7 over documents parsed once, at ingest: all rows of the daily flatten."""
    return oracle_types(M.stg_daily_typed(_typed(spark, _raw(spark, sf))))


def q_flatten_isolated_typed(spark, sf):
    """S9 over documents parsed once: the hourly rows that have no bad token."""
    return oracle_types(M.isolated_staging(_typed(spark, D.with_bad_values(_raw(spark, sf))))[0])


def q_gated_run(spark, sf):
    """V7: a whole gated run over the landed documents. Its report has all 78 rules; as some
    fail on these inputs, no mart may be published (``published`` counts their files)."""
    out = f"{run_folder(spark)}/run-{uuid.uuid4().hex}"
    raw_path = f"{out}/raw"
    append_raw(_raw(spark, sf), raw_path)
    passed, report = run_pipeline(spark, raw_path, materialize(_loc(spark, sf), "locations"), f"{out}/marts", LOAD_CHECK_SINCE, EXPECTED_LOCATIONS)
    published = published_marts(spark, f"{out}/marts")
    return oracle_types(report.withColumns({"run_passed": F.lit(passed), "published": F.lit(len(published))}))


# ------------------------------------------------------------------------ checks (V*)
def q_load_check(spark, sf):
    """Rows and distinct locations since a date, with the verdict."""
    c = Q.load_check_counts(_raw(spark, sf), LOAD_CHECK_SINCE)
    ok = (F.col("rows_since") >= EXPECTED_LOCATIONS) & (F.col("locations_since") >= EXPECTED_LOCATIONS)
    return oracle_types(c.withColumn("passed", ok))


def q_freshness(spark, sf):
    """Raw row count and newest ingest."""
    return oracle_types(bi.freshness(_raw(spark, sf)))


def q_dq_report(spark, sf):
    """V1-V5: the reference's rule set over the raw table, dimension and daily marts."""
    raw, loc = _raw(spark, sf), _loc(spark, sf)
    fd = materialize(_fct_daily(spark, sf), "fct_daily")
    rel = {
        "raw_forecast": raw,
        "locations": loc,
        "fct_daily_weather": fd,
        "daily_temperature_summary": materialize(M.daily_summary_hash(fd), "summary"),
        "temperature_anomalies": materialize(M.temperature_anomalies(fd), "anomalies"),
    }
    return oracle_types(Q.quality_report(rel))


def q_dq_report_hourly(spark, sf):
    """V1-V5: the rule sets of the staging, intermediate and hourly-fact relations.
    Each relation is written once (several rules scan it) before the rules run."""
    raw, loc = _raw(spark, sf), _loc(spark, sf)
    stg_h = materialize(M.stg_hourly(raw), "stg_hourly")
    stg_d = materialize(M.stg_daily(raw), "stg_daily")
    rel = {
        "stg_hourly": stg_h,
        "stg_daily": stg_d,
        "int_hourly": M.enrich_hourly(stg_h, loc),
        "int_daily": M.int_daily(stg_d, loc),
        "fct_hourly_weather": materialize(M.fct_hourly(M.int_hourly(stg_h, loc)), "fct_hourly"),
    }
    return oracle_types(Q.quality_report(rel))


LINEITEM_RULES = [
    Q.NotNull("l_orderkey"),
    Q.AcceptedRange("l_discount", 0, 0.1),
    Q.AcceptedRange("l_quantity", 1, 50),
    Q.AcceptedValues("l_returnflag", ("A", "N", "R")),
    Q.Unique("l_orderkey"),
    Q.UniqueCombination(("l_orderkey", "l_linenumber")),
]


def q_dq_unique_combo(spark, sf):
    """V1-V5 on a benchmark table; (l_orderkey, l_linenumber) really has duplicates."""
    return oracle_types(Q.run_rules(D.table(spark, sf, "lineitem"), "lineitem", LINEITEM_RULES))


# ------------------------------------------------------------------------------- BI
def q_hourly_trend(spark, sf):
    """A8 over the deduplicated, enriched hourly rows (the columns of the hourly mart it
    reads; the rolling mean, which the trend does not use, is not computed)."""
    return oracle_types(bi.hourly_trend(M.enrich_hourly(M.stg_hourly(_raw(spark, sf)), _loc(spark, sf))))


def q_precip_by_location(spark, sf):
    return oracle_types(bi.precipitation_by_location(_fct_daily(spark, sf)))


def q_anomaly_bars(spark, sf):
    return oracle_types(bi.anomaly_bars(_fct_daily_shared(spark, sf)))


def q_latest_kpis(spark, sf):
    return oracle_types(bi.kpi_cards(_fct_daily_shared(spark, sf)))


def q_heatmap_pivot(spark, sf):
    """Location x date pivot over a range of dates."""
    fd = _fct_daily_shared(spark, sf)
    out = bi.anomaly_heatmap(M.temperature_anomalies(fd), *HEATMAP_RANGE)
    renamed = out.select(*[F.col(f"`{c}`").alias(str(c)) for c in out.columns])
    return oracle_types(renamed)


def q_heatmap_months(spark, sf):
    """R1 in bounded width: (month, location) x day of the month, over all dates."""
    return oracle_types(bi.anomaly_heatmap_months(M.temperature_anomalies(_fct_daily_shared(spark, sf))))


def q_sorted_summary(spark, sf):
    """O1: the summary by date, with the positions of the sorted output."""
    s = M.sorted_summary(M.daily_summary_hash(_fct_daily_shared(spark, sf))).select("forecast_date", "location_count")
    return oracle_types(bi.positions(s))


def q_sorted_anomalies(spark, sf):
    """O2: date, then anomaly descending with NULLs first; names break ties."""
    a = M.sorted_anomalies(M.temperature_anomalies(_fct_daily_shared(spark, sf)))
    a = a.select("forecast_date", "location_name", "avg_temp_anomaly_f")
    return oracle_types(bi.positions(a, "forecast_date"))


def q_sorted_bars(spark, sf):
    """O3: the latest date's bars, ascending."""
    b = bi.sorted_bars(bi.anomaly_bars(_fct_daily_shared(spark, sf))).select("forecast_date", "location_name", "avg_temp_anomaly_f")
    return oracle_types(bi.positions(b))


def q_location_series(spark, sf):
    """P10 + O3: one location's hours in order."""
    rows = bi.location_series(M.enrich_hourly(M.stg_hourly(_raw(spark, sf)), _loc(spark, sf)), ONE_LOCATION)
    return oracle_types(bi.positions(rows))


def q_display_order(spark, sf):
    """O4 + R2: rows of the listed locations, numbered by the list."""
    return oracle_types(bi.ordered_locations(bi.precipitation_by_location(_fct_daily(spark, sf)), DISPLAYED))


def q_csv_dimension(spark, sf):
    """The dimension written as CSV with a header and read by its fixed schema."""
    path = f"{run_folder(spark)}/locations-{uuid.uuid4().hex}.csv"
    _loc(spark, sf).write.option("header", True).csv(path)
    return oracle_types(read_locations_csv(spark, path))


def q_mart_round_trip(spark, sf):
    """S7 + S8: the daily fact written as a mart, four columns of it read back."""
    path = f"{run_folder(spark)}/mart-{uuid.uuid4().hex}"
    write_mart(_fct_daily(spark, sf), path, ["forecast_date"], ["location_name"])
    return oracle_types(read_mart(spark, path, ["forecast_date", "location_name", "temperature_max_f", "temperature_min_f"]))


def q_mart_preview(spark, sf):
    """``SELECT * ... LIMIT 5`` in key order."""
    return oracle_types(bi.mart_preview(_fct_daily(spark, sf), "daily_weather_sk", 5))


def q_anomaly_labels(spark, sf):
    """F14-F16 over every anomaly row."""
    an = M.temperature_anomalies(_fct_daily_shared(spark, sf))
    return oracle_types(
        an.select(
            "location_name", "forecast_date",
            C.title_label("location_name").alias("location_label"),
            C.signed_text("avg_temp_anomaly_f").alias("bar_text"),
            C.signed_label("avg_temp_anomaly_f").alias("anomaly_label"),
        )
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "flatten_hourly": q_flatten_hourly,
    "flatten_daily": q_flatten_daily,
    "flatten_ragged": q_flatten_ragged,
    "json_context": q_json_context,
    "regular_axis": q_regular_axis,
    "local_time": q_local_time,
    "quarantine": q_quarantine,
    "dedupe_latest": q_dedupe_latest,
    "dedupe_daily": q_dedupe_daily,
    "enrich_left_join": q_enrich_left_join,
    "calendar": q_calendar,
    "unit_conversion": q_unit_conversion,
    "celsius": q_celsius,
    "rolling_mean_3": q_rolling_mean_3,
    "fct_hourly": q_fct_hourly,
    "fct_daily": q_fct_daily,
    "daily_summary": q_daily_summary,
    "daily_summary_hash": q_daily_summary_hash,
    "temperature_anomalies": q_temperature_anomalies,
    "append_idempotent": q_append_idempotent,
    "incremental_refresh": q_incremental_refresh,
    "incremental_refresh_hourly": q_incremental_refresh_hourly,
    "landing_ingest": q_landing_ingest,
    "value_quarantine": q_value_quarantine,
    "flatten_isolated": q_flatten_isolated,
    "flatten_hourly_typed": q_flatten_hourly_typed,
    "flatten_daily_typed": q_flatten_daily_typed,
    "flatten_isolated_typed": q_flatten_isolated_typed,
    "gated_run": q_gated_run,
    "load_check": q_load_check,
    "freshness": q_freshness,
    "dq_report": q_dq_report,
    "dq_report_hourly": q_dq_report_hourly,
    "dq_unique_combo": q_dq_unique_combo,
    "hourly_trend": q_hourly_trend,
    "precip_by_location": q_precip_by_location,
    "anomaly_bars": q_anomaly_bars,
    "latest_kpis": q_latest_kpis,
    "heatmap_pivot": q_heatmap_pivot,
    "heatmap_months": q_heatmap_months,
    "sorted_summary": q_sorted_summary,
    "sorted_anomalies": q_sorted_anomalies,
    "sorted_bars": q_sorted_bars,
    "location_series": q_location_series,
    "display_order": q_display_order,
    "csv_dimension": q_csv_dimension,
    "mart_round_trip": q_mart_round_trip,
    "mart_preview": q_mart_preview,
    "anomaly_labels": q_anomaly_labels,
}
