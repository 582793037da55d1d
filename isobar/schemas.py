"""Table and payload schemas.

The raw landing table keeps the JSON document verbatim (``StringType``); typed
columns appear only after a flatten, which parses with an explicit schema holding
the one payload section it needs (see ``operators.flatten``).
"""

from __future__ import annotations

from pyspark.sql import types as T

# Raw landing table: one row per (run, location) API call.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("forecast_id", T.LongType(), False),
        T.StructField("ingested_at", T.TimestampType(), False),
        T.StructField("latitude", T.DoubleType(), False),
        T.StructField("longitude", T.DoubleType(), False),
        T.StructField("timezone", T.StringType(), True),
        T.StructField("weather_model", T.StringType(), True),
        T.StructField("source_url", T.StringType(), False),
        T.StructField("request_params", T.StringType(), False),
        T.StructField("response_body", T.StringType(), False),
        T.StructField("load_id", T.StringType(), True),
        T.StructField("ingest_source", T.StringType(), False),
    ]
)

# Location dimension (seed); coordinates are read as doubles, never inferred.
LOCATION_SCHEMA = T.StructType(
    [
        T.StructField("location_name", T.StringType(), False),
        T.StructField("latitude", T.DoubleType(), False),
        T.StructField("longitude", T.DoubleType(), False),
        T.StructField("timezone", T.StringType(), True),
        T.StructField("state", T.StringType(), False),
        T.StructField("city", T.StringType(), True),
    ]
)

# Every measure is carried as an exact decimal until the very end.
MEASURE = T.DecimalType(18, 6)
INT = T.IntegerType()
TS_LOCAL = T.TimestampNTZType()  # local wall clock: no session zone may shift it
DATE = T.DateType()

# Forecast API variable names -> output column and type.
# The order is the request order of the reference pipeline.
HOURLY_VARIABLES: list[tuple[str, str, T.DataType]] = [
    ("temperature_2m", "temperature_2m_f", MEASURE),
    ("relative_humidity_2m", "relative_humidity_pct", INT),
    ("precipitation", "precipitation_in", MEASURE),
    ("precipitation_probability", "precipitation_probability_pct", INT),
    ("rain", "rain_in", MEASURE),
    ("showers", "showers_in", MEASURE),
    ("weather_code", "weather_code", INT),
    ("cloud_cover", "cloud_cover_pct", INT),
    ("wind_speed_10m", "wind_speed_mph", MEASURE),
    ("wind_direction_10m", "wind_direction_deg", INT),
    ("wind_gusts_10m", "wind_gusts_mph", MEASURE),
]

DAILY_VARIABLES: list[tuple[str, str, T.DataType]] = [
    ("weather_code", "weather_code", INT),
    ("temperature_2m_max", "temperature_max_f", MEASURE),
    ("temperature_2m_min", "temperature_min_f", MEASURE),
    ("apparent_temperature_max", "apparent_temp_max_f", MEASURE),
    ("apparent_temperature_min", "apparent_temp_min_f", MEASURE),
    ("precipitation_sum", "precipitation_sum_in", MEASURE),
    ("precipitation_hours", "precipitation_hours", MEASURE),
    ("precipitation_probability_max", "precipitation_probability_max_pct", INT),
    ("wind_speed_10m_max", "wind_speed_max_mph", MEASURE),
    ("wind_gusts_10m_max", "wind_gusts_max_mph", MEASURE),
    ("sunrise", "sunrise_ts", TS_LOCAL),
    ("sunset", "sunset_ts", TS_LOCAL),
    ("uv_index_max", "uv_index_max", MEASURE),
    ("daylight_duration", "daylight_duration_s", MEASURE),
    ("sunshine_duration", "sunshine_duration_s", MEASURE),
]

# Columns copied from the raw row onto every flattened row.
PASSTHROUGH = [
    "forecast_id",
    "ingested_at",
    "latitude",
    "longitude",
    "timezone",
    "weather_model",
    "load_id",
]


def section_schema(section: str, variables: list[tuple[str, str, T.DataType]]) -> T.StructType:
    """Parse schema for one payload section only: ``{section: {time: [..], var: [..]}}``.

    Every array is parsed as ``array<string>`` so the number token text survives and the
    typed cast happens afterwards with ANSI semantics (a ``75.0`` in an integer array
    fails that one cast instead of nulling the whole array).
    """
    arr = T.ArrayType(T.StringType())
    fields = [T.StructField("time", arr)] + [T.StructField(k, arr) for k, _, _ in variables]
    return T.StructType([T.StructField(section, T.StructType(fields))])
