"""Declarative data-quality rules (V1-V7).

All row-level rules of one relation (not_null, accepted_range, accepted_values) compile
to **one** aggregation, a single scan. All ``unique`` and ``unique_combination`` rules of
all relations share one Expand per relation and one partial-aggregated shuffle. A failure count follows the test convention: rows
returned by the failing query (rows for V1/V3/V4, duplicated key values for V2/V5).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.session import materialize


@dataclass(frozen=True)
class NotNull:
    """V1: fails once per NULL."""

    column: str
    rule = "not_null"

    def failing(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class AcceptedRange:
    """V3: inclusive bounds; NULL passes."""

    column: str
    min_value: float | None = None
    max_value: float | None = None
    rule = "accepted_range"

    def failing(self) -> Column:
        c = F.col(self.column)
        conds = []
        if self.min_value is not None:
            conds.append(c < F.lit(self.min_value))
        if self.max_value is not None:
            conds.append(c > F.lit(self.max_value))
        return F.coalesce(reduce(lambda a, b: a | b, conds), F.lit(False))


@dataclass(frozen=True)
class AcceptedValues:
    """V4: NULL passes."""

    column: str
    values: tuple
    rule = "accepted_values"

    def failing(self) -> Column:
        return F.coalesce(~F.col(self.column).isin(*self.values), F.lit(False))


@dataclass(frozen=True)
class Unique:
    """V2: one failure per value occurring more than once; NULLs ignored."""

    column: str
    rule = "unique"

    @property
    def columns(self) -> list[str]:
        return [self.column]


@dataclass(frozen=True)
class UniqueCombination:
    """V5: one failure per duplicated combination of ``columns``."""

    columns_: tuple
    rule = "unique_combination_of_columns"

    @property
    def column(self) -> str:
        return ",".join(self.columns_)

    @property
    def columns(self) -> list[str]:
        return list(self.columns_)


ROW_RULES = (NotNull, AcceptedRange, AcceptedValues)


UNIQUE_RULES = (Unique, UniqueCombination)

REPORT = "relation string, rule string, column string, failures bigint, passed boolean"


def _row_failures(df: DataFrame, relation: str, rules: list) -> DataFrame:
    """(relation, rule, column, failures) of the row rules, one aggregation."""
    counts = df.agg(*[F.count_if(r.failing()).alias(f"_r{i}") for i, r in enumerate(rules)])
    stack = ", ".join(f"'{r.rule}', '{r.column}', _r{i}" for i, r in enumerate(rules))
    out = counts.selectExpr(f"stack({len(rules)}, {stack}) as (rule, column, failures)")
    return out.select(F.lit(relation).alias("relation"), "rule", "column", "failures")


def _keys(df: DataFrame, rules: list, by_value: bool) -> DataFrame:
    """One row per row of ``df`` and uniqueness rule (one Expand): the rule's place and two
    hashes of its key, with ``by_value`` also the key as text. V2 ignores NULLs, V5 takes
    them as values."""
    entries = []
    for place, r in rules:
        key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(r.columns)])
        held = [F.lit(place).alias("place"), F.xxhash64(key).alias("h"), F.hash(key, F.lit(place)).alias("g")]
        entry = F.struct(*held, *([F.to_json(key, {"ignoreNullFields": "false"}).alias("key")] if by_value else []))
        entries.append(F.when(F.col(r.column).isNotNull(), entry) if isinstance(r, Unique) else entry)
    return df.select(F.explode(F.array(*entries)).alias("x")).where("x IS NOT NULL").select("x.*")


def _duplicated(relations: dict[str, DataFrame], named: list[tuple]) -> dict[int, int]:
    """Failures of the uniqueness rules by place, all relations in one shuffle: keys are
    counted by their hashes, and only those that occur more than once compared by value."""
    per_relation = {n: [(i, r) for i, (m, r) in enumerate(named) if m == n] for n in {n for n, _ in named}}
    union = lambda by_value: reduce(
        lambda a, b: a.unionByName(b), [_keys(relations[n], rules, by_value) for n, rules in sorted(per_relation.items())]
    )
    counted = union(False).groupBy("place", "h", "g").agg(F.count("*").alias("n")).where("n > 1")
    suspects = materialize(counted.select("place", "h", "g"), "repeated_keys")
    if suspects.isEmpty():
        return {}
    again = union(True).join(suspects, ["place", "h", "g"], "left_semi").groupBy("place", "key").agg(F.count("*").alias("n"))
    found = again.where("n > 1").groupBy("place").agg(F.count("*").alias("failures"))
    return {r["place"]: r["failures"] for r in found.collect()}  # one row per rule


def quality_report(relations: dict[str, DataFrame], rules: dict[str, list] | None = None) -> DataFrame:
    """V1-V5 over several relations as one long table, one row per rule: relation, rule,
    column, failures, passed. Row rules take one scan per relation, all uniqueness rules
    together one scan per relation and one shuffle."""
    rules = MART_RULES if rules is None else rules
    names = [n for n in relations if n in rules]
    rows = [(n, [r for r in rules[n] if isinstance(r, ROW_RULES)]) for n in names]
    named = [(n, r) for n in names for r in rules[n] if isinstance(r, UNIQUE_RULES)]
    parts = [_row_failures(relations[n], n, rs) for n, rs in rows if rs]
    if named:
        failures = _duplicated(relations, named)
        listed = [(n, r.rule, r.column, failures.get(i, 0)) for i, (n, r) in enumerate(named)]
        spark = next(iter(relations.values())).sparkSession
        parts.append(spark.createDataFrame(listed, "relation string, rule string, column string, failures bigint"))
    if not parts:
        return next(iter(relations.values())).sparkSession.createDataFrame([], REPORT)
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.withColumns({"failures": F.col("failures").cast("bigint"), "passed": F.col("failures") == 0})


def run_rules(df: DataFrame, relation: str, rules: list) -> DataFrame:
    """``quality_report`` of one relation."""
    return quality_report({relation: df}, {relation: rules})


def load_check_counts(raw: DataFrame, since) -> DataFrame:
    """A6 + A7 + P8: rows ingested since ``since`` and distinct (lat, lon) pairs, one scan.

    ``count(distinct struct(...))`` counts a pair with a NULL member (bare
    ``count(distinct a, b)`` would skip it).
    """
    recent = raw.filter(F.col("ingested_at") >= F.lit(since))
    if "ingest_date" in raw.columns:
        # redundant bound on the partition column so the scan skips old partitions; one
        # day of slack keeps it a superset whatever zone the partition dates were cut in
        recent = recent.filter(F.col("ingest_date") >= F.date_sub(F.to_date(F.lit(since)), 1))
    return recent.agg(
        F.count(F.lit(1)).alias("rows_since"),
        F.count_distinct(F.struct("latitude", "longitude")).alias("locations_since"),
    )


class LoadCheckError(ValueError):
    pass


def load_check(raw: DataFrame, since, expected: int) -> dict:
    """V6: raise unless at least ``expected`` rows and ``expected`` distinct locations
    arrived since ``since``. Returns the two counts (one small row to the driver)."""
    row = load_check_counts(raw, since).first()
    rows, locs = int(row["rows_since"]), int(row["locations_since"])
    if rows < expected:
        raise LoadCheckError(f"Expected at least {expected} rows ingested since {since}, found {rows}")
    if locs < expected:
        raise LoadCheckError(f"Expected {expected} distinct locations since {since}, found {locs}")
    return {"rows_since": rows, "locations_since": locs}


# The reference's rule set for its relations (V1-V5).
TEMP_F = (-40, 135)
TEMP_C = (-40, 57)
PCT = (0, 100)
WIND = (0, 250)
UV = (0, 20)
PRECIP_SUM = (0, 50)
TEMP_RANGE = (0, 80)

MART_RULES: dict[str, list] = {
    "raw_forecast": [
        NotNull("forecast_id"), Unique("forecast_id"), NotNull("ingested_at"),
        NotNull("latitude"), NotNull("longitude"), NotNull("response_body"),
        NotNull("request_params"),
    ],
    "locations": [
        NotNull("location_name"), Unique("location_name"), NotNull("latitude"),
        NotNull("longitude"), NotNull("state"),
    ],
    "stg_hourly": [
        NotNull("forecast_id"), NotNull("observation_hour"), NotNull("hour_index"),
        NotNull("latitude"), NotNull("longitude"), NotNull("temperature_2m_f"),
        AcceptedRange("temperature_2m_f", *TEMP_F),
        AcceptedRange("relative_humidity_pct", *PCT),
        AcceptedRange("precipitation_probability_pct", *PCT),
        AcceptedRange("cloud_cover_pct", *PCT),
        AcceptedRange("wind_speed_mph", *WIND),
        UniqueCombination(("forecast_id", "hour_index")),
    ],
    "stg_daily": [
        NotNull("forecast_id"), NotNull("forecast_date"), NotNull("day_index"),
        NotNull("latitude"), NotNull("longitude"), NotNull("temperature_max_f"),
        NotNull("temperature_min_f"),
        AcceptedRange("temperature_max_f", *TEMP_F),
        AcceptedRange("temperature_min_f", *TEMP_F),
        AcceptedRange("uv_index_max", *UV),
        AcceptedRange("precipitation_sum_in", *PRECIP_SUM),
        AcceptedRange("precipitation_probability_max_pct", *PCT),
        UniqueCombination(("forecast_id", "day_index")),
    ],
    "int_hourly": [NotNull("location_name"), NotNull("observation_hour"), NotNull("temperature_2m_f")],
    "int_daily": [
        NotNull("location_name"), NotNull("forecast_date"), NotNull("temperature_max_f"),
        NotNull("temperature_min_f"),
    ],
    "fct_hourly_weather": [
        NotNull("hourly_weather_sk"), Unique("hourly_weather_sk"), NotNull("location_name"),
        NotNull("observation_hour"), NotNull("temperature_2m_f"),
        AcceptedRange("temperature_2m_f", *TEMP_F),
        AcceptedRange("temperature_2m_c", *TEMP_C),
        AcceptedRange("relative_humidity_pct", *PCT),
        AcceptedRange("cloud_cover_pct", *PCT),
        AcceptedRange("wind_speed_mph", *WIND),
        UniqueCombination(("location_name", "observation_hour")),
    ],
    "fct_daily_weather": [
        NotNull("daily_weather_sk"), Unique("daily_weather_sk"), NotNull("location_name"),
        NotNull("forecast_date"), NotNull("temperature_max_f"), NotNull("temperature_min_f"),
        NotNull("temperature_avg_f"),
        AcceptedRange("temperature_max_f", *TEMP_F),
        AcceptedRange("temperature_min_f", *TEMP_F),
        AcceptedRange("temperature_range_f", *TEMP_RANGE),
        AcceptedRange("uv_index_max", *UV),
        AcceptedRange("precipitation_sum_in", *PRECIP_SUM),
        AcceptedRange("sunshine_pct", *PCT),
        UniqueCombination(("location_name", "forecast_date")),
    ],
    "daily_temperature_summary": [
        NotNull("forecast_date"), Unique("forecast_date"), NotNull("location_count"),
        NotNull("avg_temp_f"),
    ],
    "temperature_anomalies": [
        NotNull("location_name"), NotNull("forecast_date"),
        NotNull("temperature_anomaly_category"),
        AcceptedValues(
            "temperature_anomaly_category",
            ("much_warmer", "warmer", "near_average", "cooler", "much_cooler"),
        ),
        UniqueCombination(("location_name", "forecast_date")),
    ],
}

