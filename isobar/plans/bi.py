"""Dashboard queries over the marts.

Each returns a DataFrame; ``toPandas()`` for a chart is the caller's business. The
"latest date" filters (P9) compare with a scalar subquery, never a driver round trip.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isobar.functions import columns as C
from isobar.functions.numeric import mean_half_up, scaled_int
from isobar.plans.models import daily_summary, temperature_anomalies
from isobar.session import materialize


def latest(df: DataFrame, date_col: str = "forecast_date") -> DataFrame:
    """Rows on the latest date (``WHERE d = (SELECT max(d) ...)``). On a mart that is
    partitioned by the date the scan reads that partition only."""
    return df.where(F.col(date_col) == df.agg(F.max(date_col)).scalar())


def hourly_trend(fct_hourly: DataFrame, digits: int = 2) -> DataFrame:
    """Mean temperature per (observation_hour, location_name), exact, rounded."""
    g = fct_hourly.groupBy("observation_hour", "location_name").agg(
        F.sum(scaled_int("temperature_2m_f")).alias("_s"), F.count("temperature_2m_f").alias("_n")
    )
    return g.select(
        "observation_hour",
        "location_name",
        C.title_label("location_name").alias("location_label"),
        mean_half_up("_s", "_n", digits).alias("avg_temperature_f"),
    )


def precipitation_by_location(fct_daily: DataFrame) -> DataFrame:
    """A9 + O4: precipitation per (location, date) with the location's total, the key of
    the chart's category order (sort by ``location_total_in`` desc, then name, at output:
    a distributed range sort, not a single-partition window).

    The total is a window over the per-(location, date) aggregate: one row per date
    for each location, so a window partition is bounded by the time span, and the
    fact is read once (a join with a separate total would read it twice)."""
    per = fct_daily.groupBy("location_name", "forecast_date").agg(
        F.sum("precipitation_sum_in").alias("precipitation_in")
    )
    total = F.sum("precipitation_in").over(Window.partitionBy("location_name"))
    return per.withColumn("location_total_in", total).select(
        "location_name",
        C.title_label("location_name").alias("location_label"),
        "forecast_date",
        "precipitation_in",
        "location_total_in",
    )


#: Most columns of a heatmap.
HEATMAP_DAYS = 92


def anomaly_heatmap(anomalies: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """rows = location, columns = the dates from ``first`` to ``last`` (required, so the
    width is the caller's and no job discovers it; ``HEATMAP_DAYS`` at most), value =
    avg_temp_anomaly_f. The mart is unique on (location, date), so ``max`` only ever sees one
    value. Only the dates of the range are read; a location without any of them has no row.
    Longer spans: :func:`anomaly_heatmap_months`."""
    days = (last - first).days + 1
    if not 1 <= days <= HEATMAP_DAYS:
        raise ValueError(f"a heatmap has 1 to {HEATMAP_DAYS} days, not {days}")
    return (
        anomalies.where(F.col("forecast_date").between(first, last))
        .groupBy("location_name")
        .pivot("forecast_date", [first + dt.timedelta(days=k) for k in range(days)])
        .agg(F.max("avg_temp_anomaly_f"))
        .withColumn("location_label", C.title_label("location_name"))
    )


def anomaly_heatmap_months(anomalies: DataFrame) -> DataFrame:
    """R1 for any span: rows = (month, location), columns = the days ``d01`` to ``d31``."""
    day = F.dayofmonth("forecast_date")
    cells = [F.max(F.when(day == d, F.col("avg_temp_anomaly_f"))).alias(f"d{d:02d}") for d in range(1, 32)]
    month = F.trunc("forecast_date", "month").alias("month")
    return anomalies.groupBy(month, "location_name").agg(*cells).withColumn("location_label", C.title_label("location_name"))


def positions(rows: DataFrame, within: str | None = None) -> DataFrame:
    """O1-O3: the position that each row of a sorted result has, from 1, taken from the
    output itself: its partitions are ranges in order, so a row's position is its place in
    the partition plus the rows of the partitions before. ``within`` counts from the first
    row of each value. A result that isn't sorted gets the positions it really has."""
    place = F.monotonically_increasing_id()  # partition << 33, plus the place in it
    told = materialize(rows.select("*", place.alias("_at")), "sorted_rows").withColumn("_part", F.shiftright("_at", 33))
    sizes = told.groupBy("_part").agg(F.count("*").alias("_n"))  # one row per partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    position = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    out = told.join(F.broadcast(offsets), "_part").withColumn("position", position).drop("_part", "_at", "_before")
    if within:
        first = out.groupBy(F.col(within).alias("_w")).agg(F.min("position").alias("_first"))
        out = out.join(first, F.col(within).eqNullSafe(F.col("_w"))).withColumn("position", F.col("position") - F.col("_first") + 1).drop("_w", "_first")
    return out


def ordered_locations(df: DataFrame, order: list[str], name_col: str = "location_name") -> DataFrame:
    """Keep rows whose name is in ``order`` and number them by that order."""
    pos = F.array_position(F.array(*[F.lit(x) for x in order]), F.col(name_col))
    return df.withColumn("display_order", pos).filter(F.col("display_order") > 0)


def anomaly_bars(fct_daily: DataFrame) -> DataFrame:
    """P9 + F14 + F16: latest date's anomaly per location, labelled. An anomaly needs the
    rows of its own date only, so the date is cut before the means (sort by
    ``avg_temp_anomaly_f`` for the chart: :func:`sorted_bars`)."""
    return temperature_anomalies(latest(fct_daily)).select(
        "location_name",
        C.title_label("location_name").alias("location_label"),
        "forecast_date",
        "avg_temp_anomaly_f",
        "temperature_anomaly_category",
        C.signed_text("avg_temp_anomaly_f").alias("bar_text"),
        C.signed_label("avg_temp_anomaly_f").alias("anomaly_label"),
        "temperature_avg_f",
        "cross_avg_temp_f",
    )


def sorted_bars(bars: DataFrame) -> DataFrame:
    """O3: bars ascending by anomaly, names break ties."""
    return bars.orderBy("avg_temp_anomaly_f", "location_name")


def sorted_series(rows: DataFrame) -> DataFrame:
    """O3: rows by date and name."""
    return rows.orderBy("forecast_date", "location_name")


def kpi_cards(fct_daily: DataFrame) -> DataFrame:
    """One row of dashboard cards for the latest date, with the
    numbers and their texts. Only that date is aggregated; the dates are counted from the
    date column alone."""
    day = latest(fct_daily)
    dates = fct_daily.select("forecast_date").distinct().agg(F.count(F.lit(1))).scalar()
    precip = day.groupBy(F.col("forecast_date").alias("_d")).agg(F.sum("precipitation_sum_in").alias("total_precip_in"))
    hottest, wettest = C.title_label("hottest_city"), C.title_label("wettest_city")
    out = daily_summary(day).join(precip, F.col("forecast_date") == F.col("_d"))
    return out.select(
        F.col("forecast_date").alias("latest_forecast_date"),
        dates.alias("forecast_dates"),
        F.col("location_count").alias("locations_tracked"),
        F.col("avg_temp_f").alias("network_avg_temp_f"),
        F.concat(C.plain_text("avg_temp_f", 1), F.lit("°F")).alias("network_avg_temp_card"),
        hottest.alias("hottest_city_label"),
        F.round(F.col("hottest_city_high_f"), 0).alias("hottest_city_high_f"),
        F.concat(hottest, F.lit(" ("), C.plain_text("hottest_city_high_f", 0), F.lit("°F)")).alias("hottest_city_card"),
        wettest.alias("wettest_city_label"),
        F.round(F.col("wettest_city_precip_in"), 2).alias("wettest_city_precip_in"),
        F.concat(wettest, F.lit(" ("), C.plain_text("wettest_city_precip_in", 2), F.lit('")')).alias("wettest_city_card"),
        F.round(F.col("total_precip_in"), 2).alias("total_precip_in"),
        F.concat(C.plain_text("total_precip_in", 2), F.lit('"')).alias("total_precip_card"),
    )


def location_series(fct_hourly: DataFrame, location_name: str) -> DataFrame:
    """P10 + O3: one location's hourly series in hour order."""
    return (
        fct_hourly.filter(F.col("location_name") == location_name)
        .select("observation_hour", "temperature_2m_f")
        .orderBy("observation_hour")
    )


def mart_preview(mart: DataFrame, order_by: str, n: int = 5) -> DataFrame:
    """``SELECT * ... LIMIT n`` with a total order so the preview is stable."""
    return mart.orderBy(order_by).limit(n)


def freshness(raw: DataFrame) -> DataFrame:
    """``count(*)``, ``max(ingested_at)`` of the raw table."""
    return raw.agg(F.count(F.lit(1)).alias("raw_rows"), F.max("ingested_at").alias("last_ingested_at"))


__all__ = [
    "hourly_trend", "precipitation_by_location", "anomaly_heatmap", "anomaly_heatmap_months", "positions", "ordered_locations",
    "anomaly_bars", "kpi_cards", "latest", "location_series", "sorted_bars", "sorted_series", "mart_preview", "freshness",
]
