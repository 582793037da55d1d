"""The scheduled run (V7): load check -> models -> all data tests -> publish.

Gate order follows the reference: the load is checked before any transform, and the whole
rule set runs after the build. The marts are built in the run's folder and published only
if every rule passes, so a failing run leaves the published marts as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.operators import quality as Q
from isobar.plans import models as M
from isobar.session import materialize, path_exists
from isobar.sources.files import write_mart
from isobar.sources.raw import TYPED, read_raw

#: Published marts: partition column and sort columns within it.
LAYOUT = {
    "fct_hourly_weather": ("observation_date", ["location_name", "observation_hour"]),
    "fct_daily_weather": ("forecast_date", ["location_name"]),
    "daily_temperature_summary": ("forecast_date", []),
    "temperature_anomalies": ("forecast_date", ["location_name"]),
}


def build_relations(raw: DataFrame, locations: DataFrame) -> dict[str, DataFrame]:
    """Every relation that has data tests, the marts among them. Each document is parsed
    once, a typed landing table's not at all, and each relation that several others or
    several rules read is written once."""
    if TYPED in raw.columns:
        stg_h, stg_d, quarantine = M.isolated_staging(raw)
    else:
        stg_h, stg_d, quarantine = M.isolated_staging(materialize(M.parse_documents(raw), "parsed_documents"), "_doc")
    int_h = materialize(M.int_hourly(stg_h, locations), "int_hourly")
    int_d = materialize(M.int_daily(stg_d, locations), "int_daily")
    daily = materialize(M.fct_daily(int_d), "fct_daily")
    return {
        "raw_forecast": raw,
        "locations": locations,
        "stg_hourly": stg_h,
        "stg_daily": stg_d,
        "int_hourly": int_h,
        "int_daily": int_d,
        "fct_hourly_weather": materialize(M.fct_hourly(int_h), "fct_hourly"),
        "fct_daily_weather": daily,
        "daily_temperature_summary": materialize(M.daily_summary_hash(daily), "summary"),
        "temperature_anomalies": materialize(M.temperature_anomalies(daily), "anomalies"),
        "value_quarantine": quarantine,
    }


def published_marts(spark: SparkSession, out_dir: str) -> list[str]:
    """The marts that a run has published at ``out_dir``."""
    return [name for name in LAYOUT if path_exists(spark, f"{out_dir}/{name}")]


def run_pipeline(
    spark: SparkSession,
    raw_path: str,
    locations: DataFrame,
    out_dir: str,
    since,
    expected_locations: int = 7,
    typed: bool = False,
) -> tuple[bool, DataFrame]:
    """Run one build from the landing table, ``typed`` or not. Raises ``LoadCheckError`` before any transform if the load is short.

    Returns ``(passed, report)`` where ``report`` is the long V1-V5 table over all
    relations, one row per rule. It is written whether the run passes or not, and so is the
    quarantine of tokens that no column takes, whose rows are in no mart; the marts are
    written only if it passes.
    """
    raw = read_raw(spark, raw_path, typed)
    Q.load_check(raw, since, expected_locations)  # V6: stop the chain on a short load
    relations = build_relations(raw, locations)
    report = materialize(Q.quality_report(relations), "quality_report")
    write_mart(report, f"{out_dir}/_quality_report")
    write_mart(relations["value_quarantine"], f"{out_dir}/_quality_quarantine")
    passed = report.filter(~F.col("passed")).isEmpty()
    if passed:
        for name, (date, order) in LAYOUT.items():
            write_mart(relations[name], f"{out_dir}/{name}", [date], order)
    return passed, report
