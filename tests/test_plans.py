"""Plan properties that the scale design relies on (checked on the physical plan)."""

import os
import re

import pytest

from isobar.plans import models as M
from isobar.sources import driver_tables as D

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_limits_copies_before_the_shuffle(spark):
    p = plan(M.dedupe_hourly(M.stg_hourly(D.raw_forecasts(spark, SF))))
    lines = p.splitlines()
    limits = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line]
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert len(limits) == 2 and limits[0] < exchange < limits[1]  # final above, partial below


def test_each_document_is_parsed_once(spark):
    p = plan(M.stg_daily(D.raw_forecasts(spark, SF)))
    assert len(re.findall(r"from_json\(", p)) == 1
    assert "response_body" in p and "request_params" not in p  # pruned scan


def test_dimension_join_is_broadcast_and_summary_aggregates_partially(spark):
    raw, loc = D.raw_forecasts(spark, SF), D.locations(spark, SF)
    fd = M.fct_daily(M.int_daily(M.stg_daily(raw), loc))
    assert "BroadcastHashJoin" in plan(fd)
    s = plan(M.daily_summary(fd))
    assert "partial_sum" in s and "Expand" not in s


def test_hash_summary_has_no_sort_aggregate_over_the_fact(spark):
    from isobar.session import materialize

    raw, loc = D.raw_forecasts(spark, SF), D.locations(spark, SF)
    fd = materialize(M.fct_daily(M.int_daily(M.stg_daily(raw), loc)), "fd_test")
    p = plan(M.daily_summary_hash(fd))
    # the only sort-based aggregate left is the pivot of at most three picks per date
    sort_aggs = [line for line in p.splitlines() if "SortAggregate" in line]
    assert all("pivotfirst" in line.lower() or "first(" in line for line in sort_aggs)
    assert "WindowGroupLimit" in p


def test_latest_date_queries_read_one_partition(spark):
    from isobar.plans import bi
    from isobar.session import materialize

    raw, loc = D.raw_forecasts(spark, SF), D.locations(spark, SF)
    fd = materialize(M.fct_daily(M.int_daily(M.stg_daily(raw), loc)), "fd_dates", ("forecast_date",))
    for df in (bi.anomaly_bars(fd), bi.kpi_cards(fd)):
        assert re.search(r"PartitionFilters: \[[^\]]*forecast_date#\d+ = .*[Ss]ubquery", plan(df))


def test_refresh_prunes_the_staged_dates_at_run_time(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from isobar.session import materialize
    from isobar.streaming.ingest import rebuild_daily

    raw, loc = D.raw_forecasts(spark, SF), D.locations(spark, SF)
    staged = materialize(M.stg_daily(raw), "stg_dates", ("forecast_date",))
    p = plan(rebuild_daily(staged, F.col("ingested_at") >= F.lit(dt.datetime(2024, 1, 28, tzinfo=dt.timezone.utc)), loc))
    assert "dynamicpruning" in p and "from_json" not in p


def test_rolling_mean_is_one_window(spark):
    raw, loc = D.raw_forecasts(spark, SF), D.locations(spark, SF)
    p = plan(M.int_hourly(M.stg_hourly(raw), loc))
    assert p.count("Window [") <= 2 and "SortMergeJoin" not in p  # the dedupe's and the mean's
