"""Reference-shaped inputs derived from the shared benchmark tables.

No weather tables exist among the test tables, so the raw landing table is *derived*
from ``events`` — one forecast run per event row — and the location dimension from
``customer``. The work therefore grows with the tables: every event becomes one JSON
document (a forecast of 3 hours and 2 days), and reruns arise naturally where a user's
events overlap in time, which is what the dedupe step exists for.

Mapping (all arithmetic in integers; ``c`` = cents of ``value``, ``k`` = ``props.k``,
``e`` = ``event_id``, ``i`` = hour position 0..2, ``j`` = day position 0..1):

* run: forecast_id = e, ingested_at = ts (UTC), load_id = date of ts, location = user_id
* coordinates: latitude = -90 + 0.25 * (id % 720), longitude = -180 + 0.25 * (id div 720);
  of the runs, latitude is id / 2000 where id % 35 = 7, and 0.125 more where id % 6 = 0
* hourly time = hour of ts + i hours; daily time = date of ts + j days
* temperature_2m = (2000 + (c + 37*i*k) % 10000) / 100, JSON null when e % 17 = 0 and i = 1
* temperature_2m_max: JSON null when e % 170 = 0 and j = 0
* relative_humidity_2m = (k + 7*i) % 101, only 2 elements when e % 5 = 0 (ragged)
* other variables: see :func:`forecast_documents`; ``showers`` is never sent (absent)

The dimension has all customers; the shifted latitudes of some runs match none of them and
exercise the fallback naming, small ones that of numbers below 1e-2.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.functions.columns import ntz_epoch_micros
from isobar.functions.numeric import cents, int_div, to_decimal
from isobar.session import path_exists, run_folder
from isobar.sources.raw import append_raw, read_raw

# Fixed values for the derived inputs.
ZONES = ["America/New_York", "America/Chicago", "America/Denver", "America/Los_Angeles"]
WEATHER_MODEL = "gfs_seamless"
HOURS_PER_RUN = 3
DAYS_PER_RUN = 2
EVENTS_PER_TASK = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def coordinates(id_col: Column) -> tuple[Column, Column]:
    lat = F.lit(-90.0) + (id_col % 720).cast("double") * F.lit(0.25)
    lon = F.lit(-180.0) + int_div(id_col, F.lit(720)).cast("double") * F.lit(0.25)
    return lat, lon


def run_coordinates(id_col: Column) -> tuple[Column, Column]:
    """Coordinates of a run: those of the location, or some that no location has."""
    lat, lon = coordinates(id_col)
    small, shifted = id_col.cast("double") / F.lit(2000.0), lat + F.lit(0.125)
    return F.when(id_col % 35 == 7, small).when(id_col % 6 == 0, shifted).otherwise(lat), lon


def zone_of(id_col: Column) -> Column:
    return F.element_at(F.array(*[F.lit(z) for z in ZONES]), (id_col % len(ZONES)).cast("int") + 1)


def utc_instant(ts_ntz: Column) -> Column:
    """UTC wall clock (``timestamp_ntz``) -> instant (``timestamp``), zone-free."""
    return F.timestamp_micros(ntz_epoch_micros(ts_ntz))


def utc_wall_clock(ts: Column) -> Column:
    """Instant -> UTC wall clock as ``timestamp_ntz``, zone-free (inverse of utc_instant)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=(F.unix_micros(ts).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)"))


def _minute_text(ts_ntz: Column) -> Column:
    """``2024-01-01T05:00`` from a ``timestamp_ntz`` (string cast is zone-free)."""
    return F.regexp_replace(F.substring(ts_ntz.cast("string"), 1, 16), " ", "T")


def forecast_documents(events: DataFrame) -> DataFrame:
    """S2-shaped raw rows (``RAW_SCHEMA`` plus ``ingest_date``) from ``events``."""
    c = cents(F.col("value"))
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    e = F.col("event_id")
    base = events.select(
        "event_id", "ts", "user_id", "event_type",
        c.alias("c"), k.alias("k"),
        F.concat(F.substring(F.col("ts").cast("string"), 1, 13), F.lit(":00:00")).cast("timestamp_ntz").alias("h0"),
        F.to_date("ts").alias("d0"),
    )
    c, k, e = F.col("c"), F.col("k"), F.col("event_id")
    hours = range(HOURS_PER_RUN)
    days = range(DAYS_PER_RUN)

    def dec(v: Column, digits: int) -> Column:
        return to_decimal(v, digits).cast(f"decimal(18,{digits})")

    def wind(i: int) -> Column:
        return (c + 11 * i) % 4000

    # The document text is one ``format_string`` over the element values: ``%s`` prints
    # a decimal's plain text and a NULL as ``null``, which is JSON. (A ``to_json`` over
    # nested structs of ~30 derived arrays is too large for whole-stage codegen.)
    pieces: list[str] = []
    args: list[Column] = []

    def arr(key: str, values: list[Column], quoted: bool = False) -> None:
        fmt = '"%s"' if quoted else "%s"
        pieces.append(f'"{key}":[' + ",".join([fmt] * len(values)) + "]")
        args.extend(values)

    def raw_piece(key: str, text: Column) -> None:
        pieces.append(f'"{key}":%s')
        args.append(text)

    def tmax(j: int) -> Column:
        return 5000 + (c + 13 * j * k) % 5000

    def tmin(j: int) -> Column:
        return tmax(j) - (7 * k + 100 * j) % 3000

    def daylight(j: int) -> Column:  # seconds
        return F.when(k % 13 == 0, F.lit(0)).otherwise(36000 + (c * 5 + j) % 14400)

    def day_text(j: int) -> Column:
        return F.date_add(F.col("d0"), j).cast("string")

    def hum(i: int) -> Column:
        return ((k + 7 * i) % 101).cast("string")

    arr("time", [_minute_text(F.col("h0") + F.make_dt_interval(hours=F.lit(i))) for i in hours], quoted=True)
    arr(
        "temperature_2m",
        [F.when((e % 17 == 0) & F.lit(i == 1), F.lit(None)).otherwise(dec(2000 + (c + 37 * i * k) % 10000, 2)) for i in hours],
    )
    raw_piece(
        "relative_humidity_2m",
        F.when(e % 5 == 0, F.concat(F.lit("["), hum(0), F.lit(","), hum(1), F.lit("]"))).otherwise(
            F.concat(F.lit("["), hum(0), F.lit(","), hum(1), F.lit(","), hum(2), F.lit("]"))
        ),
    )
    arr("precipitation", [dec((c * (i + 1)) % 300, 2) for i in hours])
    arr("precipitation_probability", [(3 * k + i) % 101 for i in hours])
    arr("rain", [dec(((c * (i + 1)) % 300) * 5, 3) for i in hours])
    arr("weather_code", [(k + i) % 100 for i in hours])
    arr("cloud_cover", [(c + i) % 101 for i in hours])
    arr("wind_speed_10m", [dec(wind(i), 2) for i in hours])
    arr("wind_direction_10m", [(c + 45 * i) % 360 for i in hours])
    arr("wind_gusts_10m", [dec(wind(i) + (k % 10) * 100, 2) for i in hours])
    n_hourly = len(pieces)
    arr("time", [day_text(j) for j in days], quoted=True)
    arr("weather_code", [(k + j) % 100 for j in days])
    arr(
        "temperature_2m_max",
        [F.when((e % 170 == 0) & F.lit(j == 0), F.lit(None)).otherwise(dec(tmax(j), 2)) for j in days],
    )
    arr("temperature_2m_min", [dec(tmin(j), 2) for j in days])
    arr("apparent_temperature_max", [dec(tmax(j) + (k % 5) * 10, 2) for j in days])
    arr("apparent_temperature_min", [dec(tmin(j) - (k % 3) * 10, 2) for j in days])
    arr("precipitation_sum", [dec((c * (j + 1) * 7) % 5000, 3) for j in days])
    arr("precipitation_hours", [dec(((k + j) % 24) * 10, 1) for j in days])
    arr("precipitation_probability_max", [(2 * k + j) % 101 for j in days])
    arr("wind_speed_10m_max", [dec((c + 17 * j) % 5000, 2) for j in days])
    arr("wind_gusts_10m_max", [dec((c + 17 * j) % 5000 + (k % 7) * 100, 2) for j in days])
    arr("sunrise", [F.concat(day_text(j), F.lit("T06:"), F.lpad(((k + j) % 60).cast("string"), 2, "0")) for j in days], quoted=True)
    arr("sunset", [F.concat(day_text(j), F.lit("T19:"), F.lpad(((c + j) % 60).cast("string"), 2, "0")) for j in days], quoted=True)
    arr("uv_index_max", [dec((3 * k + j) % 120, 1) for j in days])
    arr("daylight_duration", [dec(daylight(j) * 100, 2) for j in days])
    arr("sunshine_duration", [dec(daylight(j) * ((k + j) % 100), 2) for j in days])
    template = '{"hourly":{' + ",".join(pieces[:n_hourly]) + '},"daily":{' + ",".join(pieces[n_hourly:]) + "}}"
    body = F.format_string(template, *args)
    lat, lon = run_coordinates(F.col("user_id"))
    zone = zone_of(F.col("user_id"))
    return base.select(
        e.alias("forecast_id"),
        utc_instant(F.col("ts")).alias("ingested_at"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        zone.alias("timezone"),
        F.lit(WEATHER_MODEL).alias("weather_model"),
        F.concat(F.lit("events/"), F.col("event_type")).alias("source_url"),
        F.to_json(F.struct(lat.alias("latitude"), lon.alias("longitude"), zone.alias("timezone"))).alias("request_params"),
        body.alias("response_body"),
        F.col("d0").cast("string").alias("load_id"),
        F.lit("events").alias("ingest_source"),
        F.col("d0").alias("ingest_date"),
    )


def with_bad_values(raw: DataFrame) -> DataFrame:
    """The documents with tokens in some that no column takes, by ``forecast_id`` modulo: 53
    text for a number, 59 an integer beyond 32 bits, 61 a time that doesn't exist, 67 a
    fraction for an integer, 71 a decimal beyond its range, 73 text for a time."""
    swaps = [
        (53, 1, r'"temperature_2m":\[[^,]*', '"temperature_2m":["abc"'),
        (59, 2, r'"cloud_cover":\[[^,]*', '"cloud_cover":[99999999999'),
        (61, 3, r'"hourly":\{"time":\["[^"]*"', '"hourly":{"time":["2024-13-45T99:00"'),
        (67, 4, r'"wind_direction_10m":\[[^,]*', '"wind_direction_10m":[12.5'),
        (71, 5, r'"uv_index_max":\[([^,]*),[^\]]*', '"uv_index_max":[$1,1e20'),
        (73, 6, r'"sunrise":\["[^"]*"', '"sunrise":["soon"'),
    ]
    body = F.col("response_body")
    for modulus, rest, found, put in swaps:
        body = F.when(F.col("forecast_id") % modulus == rest, F.regexp_replace(body, found, put)).otherwise(body)
    return raw.withColumn("response_body", body)


def with_repeated_keys(raw: DataFrame) -> DataFrame:
    """The documents, of which every 19th has an (unused) key twice: no VARIANT takes it."""
    twice = F.concat(F.lit('{"run":1,"run":2,'), F.expr("substring(response_body, 2)"))
    return raw.withColumn("response_body", F.when(F.col("forecast_id") % 19 == 3, twice).otherwise(F.col("response_body")))


def landing_files(supplier: DataFrame) -> DataFrame:
    """One landing file per supplier (``landing`` its name, ``value`` its text), for the
    location of the customer with the supplier's key: every 11th has a bad name, every 13th
    an unknown location, every 17th no JSON."""
    k = F.col("s_suppkey")
    place = F.when(k % 13 == 0, F.format_string("nowhere_%d", k)).otherwise(F.format_string("customer_%09d", k))
    day = F.date_add(F.lit("2024-01-01").cast("date"), (k % 28).cast("int")).cast("string")
    name = F.concat(F.lit("weather_"), place, F.lit("_"), day, F.lit(".json"))
    body = F.concat(
        F.lit('{"hourly":{"time":["'), day, F.lit('T00:00"],"temperature_2m":['), (k % 100).cast("string"), F.lit("]},"),
        F.lit('"daily":{"time":["'), day, F.lit('"],"temperature_2m_max":['), (k % 100).cast("string"), F.lit("]}}"),
    )
    return supplier.select(
        F.when(k % 11 == 0, F.format_string("report_%d.json", k)).otherwise(name).alias("landing"),
        F.when(k % 17 == 0, F.lit("no json {")).otherwise(body).alias("value"),
    )


def locations_from_customers(customer: DataFrame) -> DataFrame:
    """``LOCATION_SCHEMA`` rows: one per customer."""
    lat, lon = coordinates(F.col("c_custkey"))
    return customer.select(
        F.lower(F.regexp_replace("c_name", "#", "_")).alias("location_name"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        zone_of(F.col("c_custkey")).alias("timezone"),
        F.col("c_mktsegment").alias("state"),
        F.col("c_name").alias("city"),
    )


_landed: dict[tuple[str, str], str] = {}


def raw_forecasts(spark: SparkSession, sf_dir: str, refresh: bool = False) -> DataFrame:
    """The raw landing table for ``sf_dir``: documents derived from ``events``, landed
    through the append sink (S2) once per application, into its run folder, then scanned
    (S3) by every model. Nothing is reused across applications. ``refresh`` lands a fresh
    copy, for callers that change the events in between."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if refresh or key not in _landed or not path_exists(spark, _landed[key]):  # it may have been released
        out = f"{run_folder(spark)}/raw_forecast-{uuid.uuid4().hex}"
        append_raw(forecast_documents(_by_day(table(spark, sf_dir, "events"))), out, spread=True)
        _landed[key] = out
    return read_raw(spark, _landed[key])


def _by_day(events: DataFrame) -> DataFrame:
    """The events in ranges of their time and id, a fixed number per task: what is shuffled
    are the events, not the documents built from them."""
    spark = events.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, events.count() // EVENTS_PER_TASK + 1)
    return events.repartitionByRange(tasks, F.to_date("ts"), "event_id")


def raw_forecasts_unlanded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents as a lazy plan straight over ``events`` (no landing)."""
    return forecast_documents(table(spark, sf_dir, "events"))


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return locations_from_customers(table(spark, sf_dir, "customer"))
