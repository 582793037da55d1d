"""The mart models, each a plain ``DataFrame -> DataFrame`` function.

Graph: raw -> stg_hourly -> int_hourly -> fct_hourly;
raw -> stg_daily -> int_daily -> fct_daily -> {daily_summary, temperature_anomalies};
locations -> both intermediate models.

Measures stay ``decimal(18,6)`` (exact, like SQL numeric); every derived value is
rounded once, half away from zero, through ``functions.numeric``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.functions import columns as C
from isobar.functions.numeric import mean_half_up, round_ratio, round_ratio_sql, scaled_int, scaled_sql
from isobar.operators.dedupe import first_in_order, latest_per_key, order_keys
from isobar.operators.enrich import attach_locations
from isobar.operators.flatten import flatten_section, isolate, parse_sections, typed_sections
from isobar.operators.windows import rolling_mean_3, with_group_means
from isobar.schemas import DAILY_VARIABLES, DATE, HOURLY_VARIABLES, TS_LOCAL
from isobar.sources.raw import TYPED

LOCATION_KEY = ["latitude", "longitude"]


# --------------------------------------------------------------------------- staging
def stg_hourly(raw: DataFrame, parsed_col: str | None = None, errors_col: str | None = None) -> DataFrame:
    """One row per hourly array position (``hour_index`` 1-based); no dedupe."""
    return flatten_section(
        raw, "hourly", HOURLY_VARIABLES, "hour_index", "observation_hour", TS_LOCAL, parsed_col=parsed_col, errors_col=errors_col
    )


def stg_daily(raw: DataFrame, parsed_col: str | None = None, errors_col: str | None = None) -> DataFrame:
    """One row per daily array position (``day_index`` 1-based); no dedupe."""
    return flatten_section(
        raw, "daily", DAILY_VARIABLES, "day_index", "forecast_date", DATE, parsed_col=parsed_col, errors_col=errors_col
    )


def stg_hourly_typed(raw: DataFrame, errors_col: str | None = None) -> DataFrame:
    """N6 over a typed landing table: the rows of :func:`stg_hourly`, without parsing any
    document but those that have no VARIANT."""
    return _stg_typed(stg_hourly, "hourly", HOURLY_VARIABLES, raw, errors_col)


def stg_daily_typed(raw: DataFrame, errors_col: str | None = None) -> DataFrame:
    """N7 over a typed landing table, like :func:`stg_hourly_typed`."""
    return _stg_typed(stg_daily, "daily", DAILY_VARIABLES, raw, errors_col)


def _stg_typed(stage, section: str, variables, raw: DataFrame, errors_col: str | None) -> DataFrame:
    # a partition filter on either side: where all documents are typed, no text is read
    typed = stage(typed_sections(raw.where(TYPED), {section: variables}), "_doc", errors_col)
    return typed.unionByName(stage(raw.where(f"NOT {TYPED}"), None, errors_col))


def isolated_staging(raw: DataFrame, parsed_col: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(hourly rows, daily rows, quarantine): both flattens without the rows that have a
    token their columns can't take. The quarantine names section, position, column, token
    and reason of each such token. A typed landing table is read as such."""
    lineage = ["forecast_id", "load_id"]
    if TYPED in raw.columns:
        staged_h, staged_d = stg_hourly_typed(raw, "errors"), stg_daily_typed(raw, "errors")
    else:
        staged_h, staged_d = stg_hourly(raw, parsed_col, "errors"), stg_daily(raw, parsed_col, "errors")
    hourly, bad_h = isolate(staged_h, [*lineage, "hour_index"])
    daily, bad_d = isolate(staged_d, [*lineage, "day_index"])
    named = lambda bad, section, index: bad.select(*lineage, F.lit(section).alias("section"), F.col(index).alias("position"), "column", "token", "reason")
    return hourly, daily, named(bad_h, "hourly", "hour_index").unionByName(named(bad_d, "daily", "day_index"))


def parse_documents(raw: DataFrame) -> DataFrame:
    """Both payload sections parsed in one pass (column ``_doc``), for builds that need
    both flattens: ``stg_hourly(parsed, "_doc")`` and ``stg_daily(parsed, "_doc")``."""
    return parse_sections(raw, {"hourly": HOURLY_VARIABLES, "daily": DAILY_VARIABLES})


# ---------------------------------------------------------------------- intermediate
def dedupe_hourly(stg: DataFrame) -> DataFrame:
    """Newest ingest per (latitude, longitude, observation_hour).

    Ties: newest forecast_id, then the higher index (a payload that repeats a local hour
    at the autumn clock change keeps its later position).
    """
    return latest_per_key(
        stg,
        LOCATION_KEY + ["observation_hour"],
        [F.desc("ingested_at"), F.desc("forecast_id"), F.desc("hour_index")],
    )


def dedupe_daily(stg: DataFrame) -> DataFrame:
    """Newest ingest per (latitude, longitude, forecast_date)."""
    return latest_per_key(
        stg,
        LOCATION_KEY + ["forecast_date"],
        [F.desc("ingested_at"), F.desc("forecast_id"), F.desc("day_index")],
    )


def enrich_hourly(stg: DataFrame, locations: DataFrame) -> DataFrame:
    """D1 -> J1 -> P6, F8-F12, F2 (everything of int_hourly except the rolling mean)."""
    d = attach_locations(dedupe_hourly(stg), locations)
    ts = F.col("observation_hour")
    return d.withColumns(
        {
            "observation_date": C.observation_date(ts),
            "hour_of_day": C.hour_of_day(ts),
            "day_of_week": C.day_of_week(ts),
            "is_weekend": C.is_weekend(ts),
            "temperature_2m_c": C.fahrenheit_to_celsius_1dp(scaled_sql("temperature_2m_f")),
        }
    )


def int_hourly(stg: DataFrame, locations: DataFrame) -> DataFrame:
    """D1 -> J1 -> P6, F8-F12, F2, W1 (rolling mean over the deduplicated rows)."""
    return rolling_mean_3(
        enrich_hourly(stg, locations),
        part=LOCATION_KEY,
        order="observation_hour",
        value_scaled=scaled_int("temperature_2m_f"),
        out="temp_3hr_rolling_avg_f",
    )


def int_daily(stg: DataFrame, locations: DataFrame) -> DataFrame:
    """D2 -> J1 -> P6, F3-F6, P5."""
    d = attach_locations(dedupe_daily(stg), locations)
    hi, lo = scaled_sql("temperature_max_f"), scaled_sql("temperature_min_f")
    day, sun = scaled_sql("daylight_duration_s"), scaled_sql("sunshine_duration_s")
    hour = str(3600 * 10**6)
    return d.withColumns(
        {
            # (max + min) / 2.0 at 1 dp; F4: max - min at 1 dp
            "temperature_avg_f": mean_half_up(f"{hi} + {lo}", "2", 1),
            "temperature_range_f": F.round(F.col("temperature_max_f") - F.col("temperature_min_f"), 1),
            # seconds -> hours at 2 dp
            "daylight_hours": round_ratio(day, hour, 2),
            "sunshine_hours": round_ratio(sun, hour, 2),
            # F6 + P5: percent of daylight at 1 dp, NULL unless daylight > 0
            "sunshine_pct": F.expr(f"CASE WHEN {day} > 0 THEN {round_ratio_sql(f'{sun} * 100', day, 1)} END"),
        }
    )


# ------------------------------------------------------------------------------ marts
# The mart's columns, in order.
FCT_HOURLY_COLUMNS = [
    "hourly_weather_sk", "location_name", "state", "city", "latitude", "longitude",
    "timezone", "weather_model", "observation_hour", "observation_date", "hour_of_day",
    "day_of_week", "is_weekend", "temperature_2m_f", "temperature_2m_c",
    "temp_3hr_rolling_avg_f", "relative_humidity_pct", "precipitation_in",
    "precipitation_probability_pct", "rain_in", "showers_in", "weather_code",
    "cloud_cover_pct", "wind_speed_mph", "wind_direction_deg", "wind_gusts_mph",
    "forecast_id", "load_id", "ingested_at",
]

# The mart's columns, in order.
FCT_DAILY_COLUMNS = [
    "daily_weather_sk", "location_name", "state", "city", "latitude", "longitude",
    "timezone", "weather_model", "forecast_date", "weather_code", "temperature_max_f",
    "temperature_min_f", "temperature_avg_f", "temperature_range_f", "apparent_temp_max_f",
    "apparent_temp_min_f", "precipitation_sum_in", "precipitation_hours",
    "precipitation_probability_max_pct", "wind_speed_max_mph", "wind_gusts_max_mph",
    "sunrise_ts", "sunset_ts", "uv_index_max", "daylight_hours", "sunshine_hours",
    "sunshine_pct", "forecast_id", "load_id", "ingested_at",
]


def fct_hourly(enriched: DataFrame) -> DataFrame:
    """F13 + P1: hourly fact, grain (location_name, observation_hour)."""
    return enriched.withColumn(
        "hourly_weather_sk", C.surrogate_key("location_name", "observation_hour")
    ).select(*FCT_HOURLY_COLUMNS)


def fct_daily(enriched: DataFrame) -> DataFrame:
    """F13 + P1: daily fact, grain (location_name, forecast_date)."""
    return enriched.withColumn(
        "daily_weather_sk", C.surrogate_key("location_name", "forecast_date")
    ).select(*FCT_DAILY_COLUMNS)


# The mart's columns, in order.
SUMMARY_COLUMNS = [
    "forecast_date", "location_count", "avg_temp_f", "avg_high_f", "avg_low_f",
    "hottest_high_f", "hottest_city", "hottest_city_high_f", "coldest_low_f",
    "coldest_city", "coldest_city_low_f", "avg_temp_range_f", "avg_precipitation_in",
    "max_precipitation_in", "wettest_city", "wettest_city_precip_in", "avg_max_wind_mph",
    "peak_gust_mph", "avg_uv_index", "avg_sunshine_hours", "avg_daylight_hours",
]

# (output, input column, digits) for the rounded means of the summary (A3).
SUMMARY_MEANS = [
    ("avg_temp_f", "temperature_avg_f", 1),
    ("avg_high_f", "temperature_max_f", 1),
    ("avg_low_f", "temperature_min_f", 1),
    ("avg_temp_range_f", "temperature_range_f", 1),
    ("avg_precipitation_in", "precipitation_sum_in", 3),
    ("avg_max_wind_mph", "wind_speed_max_mph", 1),
    ("avg_uv_index", "uv_index_max", 1),
    ("avg_sunshine_hours", "sunshine_hours", 2),
    ("avg_daylight_hours", "daylight_hours", 2),
]


def daily_summary_hash(daily: DataFrame) -> DataFrame:
    """A1-A4 + T3-T5 (+J2): one row per forecast_date, without sorting the fact.

    For a materialised daily fact (two reads): one hash aggregation per date finds every
    measure, the extreme values and whether a NULL wins; a second pass keeps only the
    rows holding an extreme (joined to the small per-date table), takes the smallest
    name per (date, kind) with a partial group limit, and pivots the three names back.
    Same result as :func:`daily_summary`, whose struct-valued ``min`` makes Spark sort
    the fact for a ``SortAggregate``; this one uses hash aggregation only and suits a
    large, materialised fact (the pipeline's). Locally it is a little slower (more
    stages).
    """
    name = F.col("location_name")
    aggs = [F.count_distinct(name).alias("location_count")]
    for out, col, _ in SUMMARY_MEANS:
        aggs.append(F.sum(scaled_int(col)).alias(f"_s_{out}"))
        aggs.append(F.count(col).alias(f"_n_{out}"))
    aggs += [
        F.max("temperature_max_f").alias("hottest_high_f"),
        F.min("temperature_min_f").alias("coldest_low_f"),
        F.max("precipitation_sum_in").alias("max_precipitation_in"),
        F.max("wind_gusts_max_mph").alias("peak_gust_mph"),
        # desc puts NULLs first: a NULL anywhere on the date wins hottest / wettest
        F.max(F.col("temperature_max_f").isNull().cast("int")).alias("_hot_null"),
        F.max(F.col("precipitation_sum_in").isNull().cast("int")).alias("_wet_null"),
    ]
    g = daily.groupBy("forecast_date").agg(*aggs)
    g = g.withColumns({out: mean_half_up(f"_s_{out}", f"_n_{out}", d) for out, _, d in SUMMARY_MEANS})
    # one row per date, read by both branches below: written once so the fact is
    # aggregated once (Catalyst would otherwise plan a second, pruned aggregation)
    from isobar.session import materialize

    g = materialize(g, "summary_per_date")

    t = g.select(
        F.col("forecast_date").alias("_d"),
        F.col("_hot_null"), F.col("_wet_null"),
        F.col("hottest_high_f").alias("_hot_v"),
        F.col("coldest_low_f").alias("_cold_v"),
        F.col("max_precipitation_in").alias("_wet_v"),
    )
    hi, lo, wet = F.col("temperature_max_f"), F.col("temperature_min_f"), F.col("precipitation_sum_in")
    is_hot = F.when(F.col("_hot_null") == 1, hi.isNull()).otherwise(hi == F.col("_hot_v"))
    # asc puts NULLs last: the minimum wins, or NULL when the date has no value at all
    is_cold = F.when(F.col("_cold_v").isNull(), lo.isNull()).otherwise(lo == F.col("_cold_v"))
    is_wet = F.when(F.col("_wet_null") == 1, wet.isNull()).otherwise(wet == F.col("_wet_v"))
    cand = daily.select("forecast_date", "location_name", hi, lo, wet).join(
        t, F.col("forecast_date") == F.col("_d")
    )
    kinds = F.array(
        F.when(is_hot, F.struct(F.lit("hot").alias("kind"), hi.alias("value"))),
        F.when(is_cold, F.struct(F.lit("cold").alias("kind"), lo.alias("value"))),
        F.when(is_wet, F.struct(F.lit("wet").alias("kind"), wet.alias("value"))),
    )
    cand = cand.filter(is_hot | is_cold | is_wet)  # a few rows per date; the join key drops NULL dates
    picks = cand.select("forecast_date", "location_name", F.explode(kinds).alias("_k")).filter(
        F.col("_k").isNotNull()
    ).select("forecast_date", "location_name", F.col("_k.kind").alias("kind"), F.col("_k.value").alias("value"))
    top = latest_per_key(picks, ["forecast_date", "kind"], [F.asc("location_name")])
    names = (
        top.groupBy(F.col("forecast_date").alias("_d"))
        .pivot("kind", ["hot", "cold", "wet"])
        .agg(F.first("location_name"), F.first("value"))
    )
    out = g.join(names, F.col("forecast_date") == F.col("_d"), "left")
    return out.select(
        *[
            {
                "hottest_city": F.col("hot_first(location_name)"),
                "hottest_city_high_f": F.col("hot_first(value)"),
                "coldest_city": F.col("cold_first(location_name)"),
                "coldest_city_low_f": F.col("cold_first(value)"),
                "wettest_city": F.col("wet_first(location_name)"),
                "wettest_city_precip_in": F.col("wet_first(value)"),
            }.get(c, F.col(c)).alias(c)
            for c in SUMMARY_COLUMNS
        ]
    )


def daily_summary(daily: DataFrame) -> DataFrame:
    """A1-A4 + T3-T5 (+J2 folded in): one row per forecast_date, one aggregation (one
    read of ``daily``; see :func:`daily_summary_hash` for the sort-free variant).

    Extremes follow the reference's NULL order: ``desc`` puts NULLs first, so a NULL
    high "wins" hottest while ``max`` beside it ignores it; ties go to the smaller name.
    The row of a NULL date has no extremes (the reference joins them by equality).
    """
    name = F.col("location_name")

    def pick(col: str, descending: bool) -> F.Column:
        c = F.col(col)
        keys = order_keys(c, descending=descending, nulls_first=descending) + [name]
        return F.min(first_in_order(keys, {"name": name, "value": c}))

    aggs = [F.count_distinct(name).alias("location_count")]
    for out, col, digits in SUMMARY_MEANS:
        aggs.append(F.sum(scaled_int(col)).alias(f"_s_{out}"))
        aggs.append(F.count(col).alias(f"_n_{out}"))
    aggs += [
        F.max("temperature_max_f").alias("hottest_high_f"),
        F.min("temperature_min_f").alias("coldest_low_f"),
        F.max("precipitation_sum_in").alias("max_precipitation_in"),
        F.max("wind_gusts_max_mph").alias("peak_gust_mph"),
        pick("temperature_max_f", True).alias("_hot"),
        pick("temperature_min_f", False).alias("_cold"),
        pick("precipitation_sum_in", True).alias("_wet"),
    ]
    of_date = lambda column: F.when(F.col("forecast_date").isNotNull(), F.col(column))
    g = daily.groupBy("forecast_date").agg(*aggs)
    g = g.withColumns({out: mean_half_up(f"_s_{out}", f"_n_{out}", d) for out, _, d in SUMMARY_MEANS}).withColumns(
        {
            "hottest_city": of_date("_hot.name"),
            "hottest_city_high_f": of_date("_hot.value"),
            "coldest_city": of_date("_cold.name"),
            "coldest_city_low_f": of_date("_cold.value"),
            "wettest_city": of_date("_wet.name"),
            "wettest_city_precip_in": of_date("_wet.value"),
        }
    )
    return g.select(*SUMMARY_COLUMNS)


# The mart's columns, in order.
ANOMALY_COLUMNS = [
    "location_name", "state", "city", "forecast_date", "temperature_avg_f",
    "temperature_max_f", "temperature_min_f", "cross_avg_temp_f", "cross_avg_high_f",
    "cross_avg_low_f", "avg_temp_anomaly_f", "high_temp_anomaly_f", "low_temp_anomaly_f",
    "temperature_anomaly_category", "locations_on_date", "daily_weather_sk", "ingested_at",
]

# Anomaly thresholds in °F and category labels.
MUCH_DELTA, DELTA = 5, 2
CATEGORIES = ["much_warmer", "warmer", "much_cooler", "cooler", "near_average"]


def anomaly_category(actual: F.Column, mean: F.Column) -> F.Column:
    """Ordered, inclusive thresholds on the rounded mean; NULL -> near_average."""
    return (
        F.when(actual >= mean + MUCH_DELTA, "much_warmer")
        .when(actual >= mean + DELTA, "warmer")
        .when(actual <= mean - MUCH_DELTA, "much_cooler")
        .when(actual <= mean - DELTA, "cooler")
        .otherwise("near_average")
    )


def temperature_anomalies(daily: DataFrame) -> DataFrame:
    """Each location-date against the cross-location mean of its date."""
    d = with_group_means(
        daily,
        ["forecast_date"],
        {
            "cross_avg_temp_f": (scaled_int("temperature_avg_f"), 2),
            "cross_avg_high_f": (scaled_int("temperature_max_f"), 2),
            "cross_avg_low_f": (scaled_int("temperature_min_f"), 2),
        },
        count_name="locations_on_date",
    )
    d = d.withColumns(
        {
            "avg_temp_anomaly_f": F.round(F.col("temperature_avg_f") - F.col("cross_avg_temp_f"), 2),
            "high_temp_anomaly_f": F.round(F.col("temperature_max_f") - F.col("cross_avg_high_f"), 2),
            "low_temp_anomaly_f": F.round(F.col("temperature_min_f") - F.col("cross_avg_low_f"), 2),
            "temperature_anomaly_category": anomaly_category(
                F.col("temperature_avg_f"), F.col("cross_avg_temp_f")
            ),
        }
    )
    return d.select(*ANOMALY_COLUMNS)


def sorted_summary(summary: DataFrame) -> DataFrame:
    """O1: the summary in date order (sort at read; table order is no guarantee)."""
    return summary.orderBy("forecast_date")


def sorted_anomalies(anomalies: DataFrame) -> DataFrame:
    """O2: date, then anomaly descending with NULLs first; names break ties."""
    return anomalies.orderBy("forecast_date", F.desc_nulls_first("avg_temp_anomaly_f"), "location_name")


__all__ = [
    "stg_hourly", "stg_daily", "stg_hourly_typed", "stg_daily_typed", "dedupe_hourly", "dedupe_daily", "enrich_hourly", "int_hourly", "int_daily",
    "fct_hourly", "fct_daily", "daily_summary", "daily_summary_hash", "temperature_anomalies",
]
