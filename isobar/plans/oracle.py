"""DuckDB oracle SQL for every registered query.

Independent of the Spark code path: the oracle never builds or parses JSON. It derives
the forecast rows straight from ``events`` with the documented integer formulas (see
``sources.driver_tables``), dedupes with ``QUALIFY``, computes the rolling mean and the
per-date means with plain SQL windows, and the extremes with ``DISTINCT ON``-style
row numbers. All means and roundings are half away from zero on integers.
"""

from __future__ import annotations

from isobar.functions.columns import SURROGATE_NULL_TOKEN as NULL_TOKEN  # the one fixed value


def rdiv(n: str, d: str) -> str:
    """Integer n/d rounded half away from zero (NULL if d is 0 or NULL)."""
    return (
        f"(CASE WHEN ({n}) < 0 THEN -((2 * abs({n}) + nullif({d}, 0)) // (2 * nullif({d}, 0))) "
        f"ELSE (2 * ({n}) + nullif({d}, 0)) // (2 * nullif({d}, 0)) END)"
    )


def num(x: str, digits: int) -> str:
    """Integer scaled by 10^digits -> DOUBLE."""
    return f"(CAST({x} AS DOUBLE) / {10 ** digits})"


def coord_text(c: str) -> str:
    return f"regexp_replace(CAST({c} AS VARCHAR), '\\.0$', '')"


def sk(a: str, b: str) -> str:
    return (
        f"md5(coalesce(CAST({a} AS VARCHAR), '{NULL_TOKEN}') || '-' || "
        f"coalesce(CAST({b} AS VARCHAR), '{NULL_TOKEN}'))"
    )


# Runs: the location's coordinates, or some that no location has.
RUN_LATITUDE = (
    "CAST(CASE WHEN user_id % 35 = 7 THEN user_id / 2000.0::DOUBLE "
    "WHEN user_id % 6 = 0 THEN -90 + (user_id % 720) * 0.25 + 0.125 ELSE -90 + (user_id % 720) * 0.25 END AS DOUBLE)"
)

EV = f"""
ev AS (
  SELECT event_id AS e, ts, user_id, event_type, value,
         CAST(round(value * 100) AS BIGINT) AS c,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         date_trunc('hour', ts) AS h0,
         CAST(ts AS DATE) AS d0,
         {RUN_LATITUDE} AS latitude,
         CAST(-180 + (user_id // 720) * 0.25 AS DOUBLE) AS longitude,
         ['America/New_York', 'America/Chicago', 'America/Denver', 'America/Los_Angeles'][user_id % 4 + 1] AS timezone
  FROM events
)"""

LOC = """
loc AS (
  SELECT lower(replace(c_name, '#', '_')) AS location_name,
         CAST(-90 + (c_custkey % 720) * 0.25 AS DOUBLE) AS latitude,
         CAST(-180 + (c_custkey // 720) * 0.25 AS DOUBLE) AS longitude,
         ['America/New_York', 'America/Chicago', 'America/Denver', 'America/Los_Angeles'][c_custkey % 4 + 1] AS timezone,
         c_mktsegment AS state, c_name AS city
  FROM customer
)"""

# hourly rows, measures as integers: t_c, precip_c, wind_c, gust_c in cents; rain_m in 1/1000
STG_H = """
stg_h AS (
  SELECT e AS forecast_id, ts AS ingested_at, latitude, longitude, timezone,
         'gfs_seamless' AS weather_model, CAST(d0 AS VARCHAR) AS load_id,
         i + 1 AS hour_index,
         h0 + to_hours(i) AS observation_hour,
         CASE WHEN e % 17 = 0 AND i = 1 THEN NULL ELSE 2000 + (c + 37 * i * k) % 10000 END AS t_c,
         CASE WHEN e % 5 = 0 AND i = 2 THEN NULL ELSE (k + 7 * i) % 101 END AS relative_humidity_pct,
         (c * (i + 1)) % 300 AS precip_c,
         (3 * k + i) % 101 AS precipitation_probability_pct,
         ((c * (i + 1)) % 300) * 5 AS rain_m,
         (k + i) % 100 AS weather_code,
         (c + i) % 101 AS cloud_cover_pct,
         (c + 11 * i) % 4000 AS wind_c,
         (c + 45 * i) % 360 AS wind_direction_deg,
         (c + 11 * i) % 4000 + (k % 10) * 100 AS gust_c
  FROM ev CROSS JOIN range(3) AS r(i)
)"""

# daily rows: hi_c, lo_c, ahi_c, alo_c, wmax_c, gmax_c in cents; psum_m in 1/1000;
# uv_d in 1/10; day_s whole seconds; sun_h sunshine in 1/100 s
STG_D = """
stg_d AS (
  SELECT e AS forecast_id, ts AS ingested_at, latitude, longitude, timezone,
         'gfs_seamless' AS weather_model, CAST(d0 AS VARCHAR) AS load_id,
         j + 1 AS day_index,
         CAST(d0 + CAST(j AS INTEGER) AS DATE) AS forecast_date,
         (k + j) % 100 AS weather_code,
         CASE WHEN e % 170 = 0 AND j = 0 THEN NULL ELSE 5000 + (c + 13 * j * k) % 5000 END AS hi_c,
         5000 + (c + 13 * j * k) % 5000 - (7 * k + 100 * j) % 3000 AS lo_c,
         5000 + (c + 13 * j * k) % 5000 + (k % 5) * 10 AS ahi_c,
         5000 + (c + 13 * j * k) % 5000 - (7 * k + 100 * j) % 3000 - (k % 3) * 10 AS alo_c,
         (c * (j + 1) * 7) % 5000 AS psum_m,
         (k + j) % 24 AS precipitation_hours,
         (2 * k + j) % 101 AS precipitation_probability_max_pct,
         (c + 17 * j) % 5000 AS wmax_c,
         (c + 17 * j) % 5000 + (k % 7) * 100 AS gmax_c,
         CAST(d0 + CAST(j AS INTEGER) AS TIMESTAMP) + INTERVAL 6 HOUR + to_minutes((k + j) % 60) AS sunrise_ts,
         CAST(d0 + CAST(j AS INTEGER) AS TIMESTAMP) + INTERVAL 19 HOUR + to_minutes((c + j) % 60) AS sunset_ts,
         (3 * k + j) % 120 AS uv_d,
         CASE WHEN k % 13 = 0 THEN 0 ELSE 36000 + (c * 5 + j) % 14400 END AS day_s,
         (CASE WHEN k % 13 = 0 THEN 0 ELSE 36000 + (c * 5 + j) % 14400 END) * ((k + j) % 100) AS sun_h
  FROM ev CROSS JOIN range(2) AS r(j)
)"""

DED_H = """
ded_h AS (
  SELECT * FROM stg_h
  QUALIFY row_number() OVER (PARTITION BY latitude, longitude, observation_hour
                             ORDER BY ingested_at DESC, forecast_id DESC, hour_index DESC) = 1
)"""

DED_D = """
ded_d AS (
  SELECT * FROM stg_d
  QUALIFY row_number() OVER (PARTITION BY latitude, longitude, forecast_date
                             ORDER BY ingested_at DESC, forecast_id DESC, day_index DESC) = 1
)"""

LABEL = f"{coord_text('d.latitude')} || '_' || {coord_text('d.longitude')}"

ENR_H = f"""
enr_h AS (
  SELECT d.*,
         coalesce(l.location_name, {LABEL}) AS location_name,
         coalesce(l.state, 'UNKNOWN') AS state,
         coalesce(l.city, {LABEL}) AS city,
         CAST(d.observation_hour AS DATE) AS observation_date,
         extract(hour FROM d.observation_hour) AS hour_of_day,
         extract(dow FROM d.observation_hour) AS day_of_week,
         extract(dow FROM d.observation_hour) IN (0, 6) AS is_weekend,
         {rdiv('d.t_c - 3200', '18')} AS t_c10,
         sum(d.t_c) OVER w AS roll_s, count(d.t_c) OVER w AS roll_n
  FROM ded_h d LEFT JOIN loc l ON d.latitude = l.latitude AND d.longitude = l.longitude
  WINDOW w AS (PARTITION BY d.latitude, d.longitude ORDER BY d.observation_hour
               ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
)"""

ENR_D = f"""
enr_d AS (
  SELECT d.*,
         coalesce(l.location_name, {LABEL}) AS location_name,
         coalesce(l.state, 'UNKNOWN') AS state,
         coalesce(l.city, {LABEL}) AS city,
         {rdiv('d.hi_c + d.lo_c', '20')} AS avg_t,
         {rdiv('d.hi_c - d.lo_c', '10')} AS range_t,
         {rdiv('d.day_s * 100', '3600')} AS dayl_h,
         {rdiv('d.sun_h', '3600')} AS sun_hh,
         CASE WHEN d.day_s > 0 THEN {rdiv('d.sun_h * 10', 'd.day_s')} END AS sun_pct_t
  FROM ded_d d LEFT JOIN loc l ON d.latitude = l.latitude AND d.longitude = l.longitude
)"""

FCT_H_SELECT = f"""
  SELECT {sk('location_name', 'observation_hour')} AS hourly_weather_sk,
         location_name, state, city, latitude, longitude, timezone, weather_model,
         observation_hour, observation_date,
         CAST(hour_of_day AS BIGINT) AS hour_of_day, CAST(day_of_week AS BIGINT) AS day_of_week, is_weekend,
         {num('t_c', 2)} AS temperature_2m_f,
         {num('t_c10', 1)} AS temperature_2m_c,
         {num(rdiv('roll_s', 'roll_n'), 2)} AS temp_3hr_rolling_avg_f,
         CAST(relative_humidity_pct AS DOUBLE) AS relative_humidity_pct,
         {num('precip_c', 2)} AS precipitation_in,
         CAST(precipitation_probability_pct AS BIGINT) AS precipitation_probability_pct,
         {num('rain_m', 3)} AS rain_in,
         CAST(NULL AS DOUBLE) AS showers_in,
         CAST(weather_code AS BIGINT) AS weather_code,
         CAST(cloud_cover_pct AS BIGINT) AS cloud_cover_pct,
         {num('wind_c', 2)} AS wind_speed_mph,
         CAST(wind_direction_deg AS BIGINT) AS wind_direction_deg,
         {num('gust_c', 2)} AS wind_gusts_mph,
         CAST(forecast_id AS BIGINT) AS forecast_id, load_id, ingested_at
  FROM enr_h"""

FCT_D = f"""
fct_d AS (
  SELECT {sk('location_name', 'forecast_date')} AS daily_weather_sk,
         location_name, state, city, latitude, longitude, timezone, weather_model,
         forecast_date, weather_code, hi_c, lo_c, avg_t, range_t, ahi_c, alo_c, psum_m,
         precipitation_hours, precipitation_probability_max_pct, wmax_c, gmax_c,
         sunrise_ts, sunset_ts, uv_d, dayl_h, sun_hh, sun_pct_t,
         forecast_id, load_id, ingested_at
  FROM enr_d
)"""

FCT_D_COLS = f"""
         daily_weather_sk, location_name, state, city, latitude, longitude, timezone, weather_model,
         forecast_date, CAST(weather_code AS BIGINT) AS weather_code,
         {num('hi_c', 2)} AS temperature_max_f, {num('lo_c', 2)} AS temperature_min_f,
         {num('avg_t', 1)} AS temperature_avg_f, {num('range_t', 1)} AS temperature_range_f,
         {num('ahi_c', 2)} AS apparent_temp_max_f, {num('alo_c', 2)} AS apparent_temp_min_f,
         {num('psum_m', 3)} AS precipitation_sum_in,
         CAST(precipitation_hours AS DOUBLE) AS precipitation_hours,
         CAST(precipitation_probability_max_pct AS BIGINT) AS precipitation_probability_max_pct,
         {num('wmax_c', 2)} AS wind_speed_max_mph, {num('gmax_c', 2)} AS wind_gusts_max_mph,
         sunrise_ts, sunset_ts, {num('uv_d', 1)} AS uv_index_max,
         {num('dayl_h', 2)} AS daylight_hours, {num('sun_hh', 2)} AS sunshine_hours,
         {num('sun_pct_t', 1)} AS sunshine_pct"""

LINEAGE = "CAST(forecast_id AS BIGINT) AS forecast_id, load_id, ingested_at"


def _summary_cte() -> str:
    def mean(s: str, n_scale: int) -> str:
        # mean of an integer column, in the column's own units divided by n_scale
        return rdiv(f"sum({s})", f"{n_scale} * count({s})")

    def top(order: str, alias: str, value: str) -> str:
        return f"""
{alias} AS (
  SELECT forecast_date, location_name AS {alias}_name, {value} AS {alias}_value
  FROM fct_d
  QUALIFY row_number() OVER (PARTITION BY forecast_date ORDER BY {order}, location_name) = 1
)"""

    return f"""
agg AS (
  SELECT forecast_date,
         count(DISTINCT location_name) AS location_count,
         {mean('avg_t', 1)} AS avg_temp_t,
         {mean('hi_c', 10)} AS avg_high_t,
         {mean('lo_c', 10)} AS avg_low_t,
         max(hi_c) AS hottest_c, min(lo_c) AS coldest_c,
         {mean('range_t', 1)} AS avg_range_t,
         {mean('psum_m', 1)} AS avg_psum_m,
         max(psum_m) AS max_psum_m,
         {mean('wmax_c', 10)} AS avg_wind_t,
         max(gmax_c) AS peak_gust_c,
         {mean('uv_d', 1)} AS avg_uv_t,
         {mean('sun_hh', 1)} AS avg_sun_h,
         {mean('dayl_h', 1)} AS avg_day_h
  FROM fct_d GROUP BY forecast_date
),
{top('hi_c DESC NULLS FIRST', 'hot', 'hi_c')},
{top('lo_c ASC NULLS LAST', 'cold', 'lo_c')},
{top('psum_m DESC NULLS FIRST', 'wet', 'psum_m')},
summary AS (
  SELECT a.forecast_date, a.location_count,
         {num('a.avg_temp_t', 1)} AS avg_temp_f, {num('a.avg_high_t', 1)} AS avg_high_f,
         {num('a.avg_low_t', 1)} AS avg_low_f, {num('a.hottest_c', 2)} AS hottest_high_f,
         h.hot_name AS hottest_city, {num('h.hot_value', 2)} AS hottest_city_high_f,
         {num('a.coldest_c', 2)} AS coldest_low_f,
         c.cold_name AS coldest_city, {num('c.cold_value', 2)} AS coldest_city_low_f,
         {num('a.avg_range_t', 1)} AS avg_temp_range_f,
         {num('a.avg_psum_m', 3)} AS avg_precipitation_in, {num('a.max_psum_m', 3)} AS max_precipitation_in,
         w.wet_name AS wettest_city, {num('w.wet_value', 3)} AS wettest_city_precip_in,
         {num('a.avg_wind_t', 1)} AS avg_max_wind_mph, {num('a.peak_gust_c', 2)} AS peak_gust_mph,
         {num('a.avg_uv_t', 1)} AS avg_uv_index,
         {num('a.avg_sun_h', 2)} AS avg_sunshine_hours, {num('a.avg_day_h', 2)} AS avg_daylight_hours
  FROM agg a
  LEFT JOIN hot h ON a.forecast_date = h.forecast_date
  LEFT JOIN cold c ON a.forecast_date = c.forecast_date
  LEFT JOIN wet w ON a.forecast_date = w.forecast_date
)"""


SUMMARY = _summary_cte()

ANOM = f"""
cross_avg AS (
  SELECT *,
         {rdiv('sum(avg_t) OVER p * 10', 'count(avg_t) OVER p')} AS cross_t_h,
         {rdiv('sum(hi_c) OVER p', 'count(hi_c) OVER p')} AS cross_hi_c,
         {rdiv('sum(lo_c) OVER p', 'count(lo_c) OVER p')} AS cross_lo_c,
         count(*) OVER p AS locations_on_date
  FROM fct_d
  WINDOW p AS (PARTITION BY forecast_date)
),
anomalies AS (
  SELECT location_name, state, city, forecast_date,
         {num('avg_t', 1)} AS temperature_avg_f, {num('hi_c', 2)} AS temperature_max_f,
         {num('lo_c', 2)} AS temperature_min_f,
         {num('cross_t_h', 2)} AS cross_avg_temp_f, {num('cross_hi_c', 2)} AS cross_avg_high_f,
         {num('cross_lo_c', 2)} AS cross_avg_low_f,
         {num('avg_t * 10 - cross_t_h', 2)} AS avg_temp_anomaly_f,
         {num('hi_c - cross_hi_c', 2)} AS high_temp_anomaly_f,
         {num('lo_c - cross_lo_c', 2)} AS low_temp_anomaly_f,
         avg_t * 10 - cross_t_h AS anomaly_h,
         CASE WHEN avg_t * 10 >= cross_t_h + 500 THEN 'much_warmer'
              WHEN avg_t * 10 >= cross_t_h + 200 THEN 'warmer'
              WHEN avg_t * 10 <= cross_t_h - 500 THEN 'much_cooler'
              WHEN avg_t * 10 <= cross_t_h - 200 THEN 'cooler'
              ELSE 'near_average' END AS temperature_anomaly_category,
         CAST(locations_on_date AS BIGINT) AS locations_on_date,
         daily_weather_sk, ingested_at
  FROM cross_avg
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


HOURLY_CHAIN = (EV, LOC, STG_H, DED_H, ENR_H)
DAILY_CHAIN = (EV, LOC, STG_D, DED_D, ENR_D, FCT_D)

STG_H_COLS = f"""
  CAST(forecast_id AS BIGINT) AS forecast_id, ingested_at, latitude, longitude, timezone, weather_model, load_id,
  CAST(hour_index AS BIGINT) AS hour_index, observation_hour,
  {num('t_c', 2)} AS temperature_2m_f, CAST(relative_humidity_pct AS DOUBLE) AS relative_humidity_pct,
  {num('precip_c', 2)} AS precipitation_in,
  CAST(precipitation_probability_pct AS BIGINT) AS precipitation_probability_pct,
  {num('rain_m', 3)} AS rain_in, CAST(NULL AS DOUBLE) AS showers_in,
  CAST(weather_code AS BIGINT) AS weather_code, CAST(cloud_cover_pct AS BIGINT) AS cloud_cover_pct,
  {num('wind_c', 2)} AS wind_speed_mph, CAST(wind_direction_deg AS BIGINT) AS wind_direction_deg,
  {num('gust_c', 2)} AS wind_gusts_mph"""

STG_D_COLS = f"""
  CAST(forecast_id AS BIGINT) AS forecast_id, ingested_at, latitude, longitude, timezone, weather_model, load_id,
  CAST(day_index AS BIGINT) AS day_index, forecast_date, CAST(weather_code AS BIGINT) AS weather_code,
  {num('hi_c', 2)} AS temperature_max_f, {num('lo_c', 2)} AS temperature_min_f,
  {num('ahi_c', 2)} AS apparent_temp_max_f, {num('alo_c', 2)} AS apparent_temp_min_f,
  {num('psum_m', 3)} AS precipitation_sum_in, CAST(precipitation_hours AS DOUBLE) AS precipitation_hours,
  CAST(precipitation_probability_max_pct AS BIGINT) AS precipitation_probability_max_pct,
  {num('wmax_c', 2)} AS wind_speed_max_mph, {num('gmax_c', 2)} AS wind_gusts_max_mph,
  sunrise_ts, sunset_ts, {num('uv_d', 1)} AS uv_index_max,
  CAST(day_s AS DOUBLE) AS daylight_duration_s, {num('sun_h', 2)} AS sunshine_duration_s"""


def _signed_text(v_h: str) -> str:
    """F15 text of a value in 1/100, rounded to 1 dp first: ``+1.3°F``."""
    t = rdiv(v_h, "10")
    return (
        f"(CASE WHEN {t} >= 0 THEN '+' ELSE '' END || printf('%.1f', CAST({t} AS DOUBLE) / 10) || '°F')"
    )


def _signed_label(v_h: str) -> str:
    t = rdiv(v_h, "10")
    return (
        f"(CASE WHEN {t} > 0 THEN '+' || printf('%.1f', CAST({t} AS DOUBLE) / 10) || '°F warmer' "
        f"WHEN {t} IS NOT NULL THEN printf('%.1f', CAST({t} AS DOUBLE) / 10) || '°F' END)"
    )


def _title(c: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(replace({c}, '_', ' '), ' '), "
        f"lambda x: upper(x[1]) || lower(x[2:])), ' ')"
    )


# The expected rules of each relation, written out apart from the code under
# test. not_null and unique columns, inclusive ranges, accepted values, unique combinations.
TEMPERATURE, SHARE, WIND, UV, RAIN = (-40, 135), (0, 100), (0, 250), (0, 20), (0, 50)
EXPECTED_RULES = {
    "raw_forecast": {
        "not_null": "forecast_id ingested_at latitude longitude response_body request_params",
        "unique": "forecast_id",
    },
    "locations": {"not_null": "location_name latitude longitude state", "unique": "location_name"},
    "stg_hourly": {
        "not_null": "forecast_id observation_hour hour_index latitude longitude temperature_2m_f",
        "range": {
            "temperature_2m_f": TEMPERATURE, "relative_humidity_pct": SHARE, "precipitation_probability_pct": SHARE,
            "cloud_cover_pct": SHARE, "wind_speed_mph": WIND,
        },
        "combination": "forecast_id,hour_index",
    },
    "stg_daily": {
        "not_null": "forecast_id forecast_date day_index latitude longitude temperature_max_f temperature_min_f",
        "range": {
            "temperature_max_f": TEMPERATURE, "temperature_min_f": TEMPERATURE, "uv_index_max": UV,
            "precipitation_sum_in": RAIN, "precipitation_probability_max_pct": SHARE,
        },
        "combination": "forecast_id,day_index",
    },
    "int_hourly": {"not_null": "location_name observation_hour temperature_2m_f"},
    "int_daily": {"not_null": "location_name forecast_date temperature_max_f temperature_min_f"},
    "fct_hourly_weather": {
        "not_null": "hourly_weather_sk location_name observation_hour temperature_2m_f",
        "unique": "hourly_weather_sk",
        "range": {
            "temperature_2m_f": TEMPERATURE, "temperature_2m_c": (-40, 57), "relative_humidity_pct": SHARE,
            "cloud_cover_pct": SHARE, "wind_speed_mph": WIND,
        },
        "combination": "location_name,observation_hour",
    },
    "fct_daily_weather": {
        "not_null": "daily_weather_sk location_name forecast_date temperature_max_f temperature_min_f temperature_avg_f",
        "unique": "daily_weather_sk",
        "range": {
            "temperature_max_f": TEMPERATURE, "temperature_min_f": TEMPERATURE, "temperature_range_f": (0, 80),
            "uv_index_max": UV, "precipitation_sum_in": RAIN, "sunshine_pct": SHARE,
        },
        "combination": "location_name,forecast_date",
    },
    "daily_temperature_summary": {"not_null": "forecast_date location_count avg_temp_f", "unique": "forecast_date"},
    "temperature_anomalies": {
        "not_null": "location_name forecast_date temperature_anomaly_category",
        "values": {"temperature_anomaly_category": "much_warmer warmer near_average cooler much_cooler"},
        "combination": "location_name,forecast_date",
    },
    "lineitem": {
        "not_null": "l_orderkey",
        "range": {"l_discount": (0, 0.1), "l_quantity": (1, 50)},
        "values": {"l_returnflag": "A N R"},
        "unique": "l_orderkey",
        "combination": "l_orderkey,l_linenumber",
    },
}


def _rules_sql(relation: str, source: str) -> list[str]:
    """One SELECT per expected rule, in the report's long shape."""
    rules = EXPECTED_RULES[relation]

    def line(rule: str, column: str, failures: str) -> str:
        return f"SELECT '{relation}' AS relation, '{rule}' AS rule, '{column}' AS \"column\", (SELECT count(*) FROM {failures}) AS failures"

    def repeated(columns: str, condition: str) -> str:
        return f"(SELECT {columns} FROM {source} WHERE {condition} GROUP BY {columns} HAVING count(*) > 1)"

    out = [line("not_null", c, f"{source} WHERE {c} IS NULL") for c in rules.get("not_null", "").split()]
    out += [line("accepted_range", c, f"{source} WHERE {c} < {lo} OR {c} > {hi}") for c, (lo, hi) in rules.get("range", {}).items()]
    for c, values in rules.get("values", {}).items():
        listed = ", ".join(f"'{v}'" for v in values.split())
        out.append(line("accepted_values", c, f"{source} WHERE {c} NOT IN ({listed})"))
    out += [line("unique", c, repeated(c, f"{c} IS NOT NULL")) for c in rules.get("unique", "").split()]
    out += [line("unique_combination_of_columns", c, repeated(c, "TRUE")) for c in rules.get("combination", "").split()]
    return out


def _report(selects: list[str]) -> str:
    body = "\nUNION ALL\n".join(selects)
    return f"SELECT relation, rule, \"column\", CAST(failures AS BIGINT) AS failures, failures = 0 AS passed FROM (\n{body}\n)"


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["flatten_hourly"] = f"{with_(EV, STG_H)} SELECT {STG_H_COLS} FROM stg_h"
    q["flatten_daily"] = f"{with_(EV, STG_D)} SELECT {STG_D_COLS} FROM stg_d"
    q["flatten_ragged"] = (
        f"{with_(EV, STG_H)} SELECT CAST(forecast_id AS BIGINT) AS forecast_id, CAST(hour_index AS BIGINT) AS hour_index, "
        "CAST(relative_humidity_pct AS DOUBLE) AS relative_humidity_pct, CAST(NULL AS DOUBLE) AS showers_in FROM stg_h"
    )
    q["json_context"] = (
        "SELECT event_id, CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS BIGINT) AS k FROM events"
    )
    q["regular_axis"] = f"""{with_(EV)},
ax AS (
  SELECT e, timezone, c, CAST(epoch(h0) AS BIGINT) AS start_s, unnest(range(k % 4)) AS s FROM ev
),
st AS (
  SELECT *, TIMESTAMP '1970-01-01 00:00:00' + to_seconds(start_s + s * 3600) AS t FROM ax
)
SELECT e AS event_id, CAST(s + 1 AS BIGINT) AS step_index, t AS step_time_utc,
       CASE WHEN s < 2 THEN CAST(c + s AS DOUBLE) / 100 END AS value,
       timezone, timezone(timezone, timezone('UTC', t)) AS step_time_local
FROM st"""
    q["local_time"] = f"""{with_(EV)}
SELECT e AS event_id, timezone, timezone(timezone, timezone('UTC', ts)) AS local_ts FROM ev"""
    q["quarantine"] = """
SELECT reason, count(*) AS documents FROM (
  SELECT CASE WHEN event_id % 89 = 0 THEN 'not_json'
              WHEN event_id % 97 = 0 THEN 'daily_time_not_array'
              ELSE 'ok' END AS reason
  FROM events) GROUP BY reason"""
    q["dedupe_latest"] = (
        f"{with_(EV, STG_H, DED_H)} SELECT latitude, longitude, observation_hour, CAST(forecast_id AS BIGINT) AS forecast_id, "
        f"CAST(hour_index AS BIGINT) AS hour_index, ingested_at, {num('t_c', 2)} AS temperature_2m_f FROM ded_h"
    )
    q["dedupe_daily"] = (
        f"{with_(EV, STG_D, DED_D)} SELECT latitude, longitude, forecast_date, CAST(forecast_id AS BIGINT) AS forecast_id, "
        f"CAST(day_index AS BIGINT) AS day_index, ingested_at, {num('hi_c', 2)} AS temperature_max_f FROM ded_d"
    )
    q["enrich_left_join"] = (
        f"{with_(EV, LOC, STG_D, DED_D, ENR_D)} SELECT CAST(forecast_id AS BIGINT) AS forecast_id, latitude, longitude, "
        "forecast_date, location_name, state, city FROM enr_d"
    )
    q["calendar"] = (
        f"{with_(*HOURLY_CHAIN)} SELECT location_name, observation_hour, observation_date, "
        "CAST(hour_of_day AS BIGINT) AS hour_of_day, CAST(day_of_week AS BIGINT) AS day_of_week, is_weekend FROM enr_h"
    )
    q["unit_conversion"] = (
        f"{with_(EV, LOC, STG_D, DED_D, ENR_D)} SELECT location_name, forecast_date, {num('avg_t', 1)} AS temperature_avg_f, "
        f"{num('range_t', 1)} AS temperature_range_f, {num('dayl_h', 2)} AS daylight_hours, "
        f"{num('sun_hh', 2)} AS sunshine_hours, {num('sun_pct_t', 1)} AS sunshine_pct FROM enr_d"
    )
    q["celsius"] = (
        f"{with_(*HOURLY_CHAIN)} SELECT location_name, observation_hour, {num('t_c', 2)} AS temperature_2m_f, "
        f"{num('t_c10', 1)} AS temperature_2m_c FROM enr_h"
    )
    q["rolling_mean_3"] = (
        f"{with_(*HOURLY_CHAIN)} SELECT latitude, longitude, observation_hour, {num('t_c', 2)} AS temperature_2m_f, "
        f"{num(rdiv('roll_s', 'roll_n'), 2)} AS temp_3hr_rolling_avg_f FROM enr_h"
    )
    q["fct_hourly"] = f"{with_(*HOURLY_CHAIN)} {FCT_H_SELECT}"
    q["fct_daily"] = f"{with_(*DAILY_CHAIN)} SELECT {FCT_D_COLS}, {LINEAGE} FROM fct_d"
    q["daily_summary"] = f"{with_(*DAILY_CHAIN, SUMMARY)} SELECT * REPLACE (CAST(location_count AS BIGINT) AS location_count) FROM summary"
    q["daily_summary_hash"] = q["daily_summary"]
    q["temperature_anomalies"] = f"{with_(*DAILY_CHAIN, ANOM)} SELECT * EXCLUDE (anomaly_h) FROM anomalies"
    q["append_idempotent"] = f"{with_(*DAILY_CHAIN)} SELECT {FCT_D_COLS} FROM fct_d"
    q["incremental_refresh"] = (
        f"{with_(*DAILY_CHAIN)} SELECT {FCT_D_COLS}, {LINEAGE} FROM fct_d "
        "WHERE forecast_date IN (SELECT DISTINCT CAST(CAST(ts AS DATE) + CAST(j AS INTEGER) AS DATE) "
        "FROM events CROSS JOIN range(2) AS r(j) WHERE CAST(ts AS DATE) >= DATE '2024-01-20')"
    )
    q["incremental_refresh_hourly"] = q["fct_hourly"]
    bad_h = "(e % 53 = 1 OR e % 59 = 2 OR e % 61 = 3 OR e % 67 = 4)"
    q["flatten_isolated"] = f"""{with_(EV, STG_H)} SELECT {STG_H_COLS}
FROM stg_h WHERE NOT (hour_index = 1 AND {bad_h.replace("e %", "forecast_id %")})"""
    q["flatten_hourly_typed"], q["flatten_daily_typed"] = q["flatten_hourly"], q["flatten_daily"]
    q["flatten_isolated_typed"] = q["flatten_isolated"]
    q["value_quarantine"] = f"""
WITH ev AS (SELECT event_id AS e FROM events),
v AS (SELECT * FROM (VALUES ('hourly', 'temperature_2m_f', 'not_a_number', 53, 1), ('hourly', 'cloud_cover_pct', 'out_of_range', 59, 2),
      ('hourly', 'observation_hour', 'bad_time', 61, 3), ('hourly', 'wind_direction_deg', 'not_an_integer', 67, 4),
      ('daily', 'uv_index_max', 'out_of_range', 71, 5), ('daily', 'sunrise_ts', 'bad_time', 73, 6)) t(section, "column", reason, m, r))
SELECT section, "column", reason, count(*) AS "values" FROM v JOIN ev ON e % m = r GROUP BY ALL
UNION ALL SELECT 'hourly', '', 'good', 3 * count(*) - count(*) FILTER ({bad_h}) FROM ev
UNION ALL SELECT 'daily', '', 'good', 2 * count(*) - count(*) FILTER (e % 71 = 5) - count(*) FILTER (e % 73 = 6) FROM ev"""
    q["landing_ingest"] = """
WITH f AS (SELECT s_suppkey AS k, CAST(DATE '2024-01-01' + CAST(s_suppkey % 28 AS INTEGER) AS DATE) AS d FROM supplier)
SELECT CASE WHEN k % 11 = 0 THEN 'report_' || k || '.json'
            ELSE 'weather_' || CASE WHEN k % 13 = 0 THEN 'nowhere_' || k ELSE 'customer_' || lpad(CAST(k AS VARCHAR), 9, '0') END || '_' || d || '.json' END AS file_name,
       CASE WHEN k % 11 = 0 THEN 'bad_file_name' WHEN k % 13 = 0 OR c_custkey IS NULL THEN 'unknown_location'
            WHEN k % 17 = 0 THEN 'not_json' ELSE 'raw' END AS outcome, CAST(1 AS BIGINT) AS times
FROM f LEFT JOIN customer ON c_custkey = k"""
    q["load_check"] = f"""
SELECT count(*) AS rows_since, count(DISTINCT (latitude, longitude)) AS locations_since,
       count(*) >= 7 AND count(DISTINCT (latitude, longitude)) >= 7 AS passed
FROM (SELECT ts, {RUN_LATITUDE} AS latitude,
             CAST(-180 + (user_id // 720) * 0.25 AS DOUBLE) AS longitude
      FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00')"""
    q["freshness"] = "SELECT count(*) AS raw_rows, max(ts) AS last_ingested_at FROM events"

    fct_daily_view = f"(SELECT {FCT_D_COLS}, {LINEAGE} FROM fct_d)"
    raw_view = (
        "(SELECT e AS forecast_id, ts AS ingested_at, latitude, longitude, "
        "CAST(c AS VARCHAR) || '/' || CAST(k AS VARCHAR) AS response_body, CAST(latitude AS VARCHAR) AS request_params FROM ev)"
    )
    selects = []
    selects += _rules_sql("raw_forecast", raw_view)
    selects += _rules_sql("locations", "loc")
    selects += _rules_sql("fct_daily_weather", fct_daily_view)
    selects += _rules_sql("daily_temperature_summary", "summary")
    selects += _rules_sql("temperature_anomalies", "anomalies")
    q["dq_report"] = f"{with_(*DAILY_CHAIN, SUMMARY, ANOM)} {_report(selects)}"
    hourly = []
    hourly += _rules_sql("stg_hourly", f"(SELECT {STG_H_COLS} FROM stg_h)")
    hourly += _rules_sql("stg_daily", f"(SELECT {STG_D_COLS} FROM stg_d)")
    hourly += _rules_sql(
        "int_hourly",
        f"(SELECT location_name, observation_hour, {num('t_c', 2)} AS temperature_2m_f FROM enr_h)")
    hourly += _rules_sql(
        "int_daily",
        f"(SELECT location_name, forecast_date, {num('hi_c', 2)} AS temperature_max_f, "
        f"{num('lo_c', 2)} AS temperature_min_f FROM enr_d)")
    hourly += _rules_sql("fct_hourly_weather", f"({FCT_H_SELECT})")
    q["dq_report_hourly"] = f"{with_(EV, LOC, STG_H, DED_H, ENR_H, STG_D, DED_D, ENR_D)} {_report(hourly)}"
    run = with_(EV, LOC, STG_D, DED_D, ENR_D, FCT_D, SUMMARY, ANOM, STG_H, DED_H, ENR_H)
    q["gated_run"] = f"{run} SELECT *, false AS run_passed, CAST(0 AS BIGINT) AS published FROM ({_report(selects + hourly)})"
    q["dq_unique_combo"] = _report(_rules_sql("lineitem", "lineitem"))

    q["hourly_trend"] = f"""{with_(*HOURLY_CHAIN)}
SELECT observation_hour, location_name, {_title('location_name')} AS location_label,
       {num(rdiv('sum(t_c)', 'count(t_c)'), 2)} AS avg_temperature_f
FROM enr_h GROUP BY observation_hour, location_name"""
    q["precip_by_location"] = f"""{with_(*DAILY_CHAIN)},
per AS (SELECT location_name, forecast_date, sum(psum_m) AS p FROM fct_d GROUP BY location_name, forecast_date)
SELECT location_name, {_title('location_name')} AS location_label, forecast_date,
       {num('p', 3)} AS precipitation_in, {num('sum(p) OVER (PARTITION BY location_name)', 3)} AS location_total_in
FROM per"""
    q["anomaly_bars"] = f"""{with_(*DAILY_CHAIN, ANOM)}
SELECT location_name, {_title('location_name')} AS location_label, forecast_date, avg_temp_anomaly_f,
       temperature_anomaly_category, {_signed_text('anomaly_h')} AS bar_text,
       {_signed_label('anomaly_h')} AS anomaly_label, temperature_avg_f, cross_avg_temp_f
FROM anomalies WHERE forecast_date = (SELECT max(forecast_date) FROM anomalies)"""
    q["latest_kpis"] = f"""{with_(*DAILY_CHAIN, SUMMARY)}
SELECT s.forecast_date AS latest_forecast_date, (SELECT count(*) FROM summary) AS forecast_dates,
       CAST(s.location_count AS BIGINT) AS locations_tracked, s.avg_temp_f AS network_avg_temp_f,
       printf('%.1f', s.avg_temp_f) || '°F' AS network_avg_temp_card,
       {_title('s.hottest_city')} AS hottest_city_label,
       {num(rdiv('h.hot_value', '100'), 0)} AS hottest_city_high_f,
       {_title('s.hottest_city')} || ' (' || {rdiv('h.hot_value', '100')} || '°F)' AS hottest_city_card,
       {_title('s.wettest_city')} AS wettest_city_label,
       {num(rdiv('w.wet_value', '10'), 2)} AS wettest_city_precip_in,
       {_title('s.wettest_city')} || ' (' || printf('%.2f', {num(rdiv('w.wet_value', '10'), 2)}) || '")' AS wettest_city_card,
       printf('%.2f', {num(rdiv('(SELECT sum(psum_m) FROM fct_d f WHERE f.forecast_date = s.forecast_date)', '10'), 2)}) || '"' AS total_precip_card,
       {num(rdiv('(SELECT sum(psum_m) FROM fct_d f WHERE f.forecast_date = s.forecast_date)', '10'), 2)} AS total_precip_in
FROM summary s JOIN hot h ON h.forecast_date = s.forecast_date JOIN wet w ON w.forecast_date = s.forecast_date
WHERE s.forecast_date = (SELECT max(forecast_date) FROM summary)"""
    days = ", ".join(f"DATE '2024-01-{d:02d}'" for d in range(1, 32))
    q["heatmap_pivot"] = f"""
SELECT *, {_title('location_name')} AS location_label FROM (
  PIVOT ({with_(*DAILY_CHAIN, ANOM)} SELECT location_name, forecast_date, avg_temp_anomaly_f FROM anomalies)
  ON forecast_date IN ({days}) USING max(avg_temp_anomaly_f) GROUP BY location_name
)"""
    cells = ", ".join(f"max(avg_temp_anomaly_f) FILTER (day(forecast_date) = {d}) AS d{d:02d}" for d in range(1, 32))
    q["heatmap_months"] = (
        f"{with_(*DAILY_CHAIN, ANOM)} SELECT CAST(date_trunc('month', forecast_date) AS DATE) AS month, location_name, {cells}, "
        f"{_title('location_name')} AS location_label FROM anomalies GROUP BY ALL"
    )
    q["sorted_summary"] = (
        f"{with_(*DAILY_CHAIN, SUMMARY)} SELECT forecast_date, CAST(location_count AS BIGINT) AS location_count, "
        "row_number() OVER (ORDER BY forecast_date) AS position FROM summary"
    )
    q["sorted_anomalies"] = (
        f"{with_(*DAILY_CHAIN, ANOM)} SELECT forecast_date, location_name, avg_temp_anomaly_f, row_number() OVER "
        "(PARTITION BY forecast_date ORDER BY avg_temp_anomaly_f DESC NULLS FIRST, location_name) AS position FROM anomalies"
    )
    q["sorted_bars"] = (
        f"{with_(*DAILY_CHAIN, ANOM)} SELECT forecast_date, location_name, avg_temp_anomaly_f, row_number() OVER "
        "(ORDER BY avg_temp_anomaly_f ASC NULLS FIRST, location_name) AS position FROM anomalies "
        "WHERE forecast_date = (SELECT max(forecast_date) FROM anomalies)"
    )
    q["location_series"] = (
        f"{with_(*HOURLY_CHAIN)} SELECT observation_hour, {num('t_c', 2)} AS temperature_2m_f, "
        "row_number() OVER (ORDER BY observation_hour) AS position FROM enr_h WHERE location_name = 'customer_000000011'"
    )
    q["display_order"] = f"""{with_(*DAILY_CHAIN)},
per AS (SELECT location_name, forecast_date, sum(psum_m) AS p FROM fct_d GROUP BY location_name, forecast_date),
pos AS (SELECT * FROM (VALUES ('customer_000000013', 1), ('customer_000000001', 2), ('customer_000000011', 3)) v(name, n))
SELECT location_name, {_title('location_name')} AS location_label, forecast_date,
       {num('p', 3)} AS precipitation_in, {num('sum(p) OVER (PARTITION BY location_name)', 3)} AS location_total_in,
       CAST(n AS BIGINT) AS display_order
FROM per JOIN pos ON name = location_name"""
    q["csv_dimension"] = f"{with_(LOC)} SELECT location_name, latitude, longitude, timezone, state, city FROM loc"
    q["mart_round_trip"] = (
        f"{with_(*DAILY_CHAIN)} SELECT forecast_date, location_name, {num('hi_c', 2)} AS temperature_max_f, "
        f"{num('lo_c', 2)} AS temperature_min_f FROM fct_d"
    )
    q["mart_preview"] = (
        f"{with_(*DAILY_CHAIN)} SELECT {FCT_D_COLS}, {LINEAGE} FROM fct_d ORDER BY daily_weather_sk LIMIT 5"
    )
    q["anomaly_labels"] = f"""{with_(*DAILY_CHAIN, ANOM)}
SELECT location_name, forecast_date, {_title('location_name')} AS location_label,
       {_signed_text('anomaly_h')} AS bar_text, {_signed_label('anomaly_h')} AS anomaly_label
FROM anomalies"""
    return q
