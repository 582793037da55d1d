"""S1, S2, S4, S7, X1, V6-V7 on small landing fixtures written to a scratch folder."""

import datetime as dt
import glob
import json
import tempfile

import pytest
from pyspark.sql import functions as F

from test_operators import MINIMAL
from isobar.operators.quality import LoadCheckError
from isobar.plans.pipeline import run_pipeline
from isobar.plans import models as M
from isobar.plans import registry
from isobar.session import run_folder, setting
from isobar.sources import driver_tables as D
from isobar.sources.files import read_landing, read_locations_csv, read_mart, write_mart
from isobar.sources.raw import append_raw, read_raw, with_lineage
from isobar.streaming import ingest
from isobar.streaming.ingest import ingest_landing, refresh_daily_marts

DOCS = "latitude double, longitude double, timezone string, source_url string, request_params string, response_body string"

LOCATIONS_CSV = """location_name,latitude,longitude,timezone,state,city
north_ford,40.5,-74.25,America/New_York,NF,North Ford
whole_town,34.0,-118.0,America/Los_Angeles,CA,Whole Town
"""


def _landing(tmp, files):
    for name, body in files.items():
        with open(f"{tmp}/{name}", "w") as f:
            json.dump(body, f, indent=2)  # indented, multi-line like the extract writes


def test_landing_file_names_and_csv_dimension(spark):
    tmp = tempfile.mkdtemp(prefix="isobar-landing-")
    _landing(tmp, {"weather_north_ford_2026-07-05.json": MINIMAL, "notes.json": {}})
    got = {(r.location_name, r.file_date) for r in read_landing(spark, tmp).collect()}
    assert got == {("north_ford", dt.date(2026, 7, 5)), (None, None)}
    with open(f"{tmp}/locations.csv", "w") as f:
        f.write(LOCATIONS_CSV)
    loc = read_locations_csv(spark, f"{tmp}/locations.csv")
    assert dict(loc.dtypes)["latitude"] == "double"
    assert loc.filter(F.col("location_name") == "whole_town").first().latitude == 34.0


@pytest.fixture
def landing(spark, tmp_path):
    """Folders of one ingest and a function that runs it."""
    (tmp_path / "landing").mkdir()
    (tmp_path / "locations.csv").write_text(LOCATIONS_CSV)
    loc = read_locations_csv(spark, str(tmp_path / "locations.csv"))

    def run(**options):
        return ingest_landing(spark, str(tmp_path / "landing"), loc, str(tmp_path / "raw"), str(tmp_path / "ckpt"), str(tmp_path / "quarantine"), **options)

    return tmp_path, loc, run


def forecast(hour0, temperatures):
    hours = [f"{hour0[:11]}{int(hour0[11:13]) + i:02d}:00" for i in range(len(temperatures))]
    return {"hourly": {"time": hours, "temperature_2m": temperatures}, "daily": MINIMAL["daily"]}


@pytest.mark.parametrize("options", [{}, {"max_files_per_batch": 1}])
def test_newer_run_wins_however_files_are_batched(spark, landing, options):
    tmp, loc, run = landing
    _landing(tmp / "landing", {"weather_whole_town_2026-07-06.json": forecast("2026-07-06T00:00", [90, 91]), "weather_whole_town_2026-07-05.json": forecast("2026-07-06T00:00", [70, 71, 72])})
    got = run(**options)
    assert (got.documents, got.quarantined, got.failed) == (2, {}, False)
    raw = read_raw(spark, str(tmp / "raw"))
    assert raw.select("forecast_id").distinct().count() == 2
    staged = M.stg_hourly(raw)
    assert staged.groupBy("forecast_id", "hour_index").count().where("count > 1").isEmpty()
    newest = {r["observation_hour"].hour: float(r["temperature_2m_f"]) for r in M.dedupe_hourly(staged).collect()}
    assert newest == {0: 90, 1: 91, 2: 72}
    assert run(**options).batches == 0  # nothing new


def test_every_file_ends_in_raw_or_quarantine(spark, landing):
    tmp, loc, run = landing
    _landing(tmp / "landing", {"weather_whole_town_2026-07-06.json": MINIMAL, "weather_nowhere_2026-07-06.json": MINIMAL, "notes.json": {}, "weather_whole_town_2026-13-06.json": MINIMAL, "weather_north_ford_2026-07-07.json": {"hourly": {"time": "x"}}})
    (tmp / "landing" / "weather_north_ford_2026-07-06.json").write_text("not json {")
    got = run()
    assert got.documents == 1 and got.failed
    assert got.quarantined == {"unknown_location": 1, "bad_file_name": 2, "not_json": 1, "hourly_time_not_array": 1}
    kept = {r["file_name"]: r["reason"] for r in spark.read.parquet(str(tmp / "quarantine")).collect()}
    assert len(kept) == 5 and kept["weather_nowhere_2026-07-06.json"] == "unknown_location"
    assert read_raw(spark, str(tmp / "raw")).count() == 1


def test_a_load_written_again_replaces_itself(spark, tmp_path):
    docs = spark.createDataFrame([(1.0, 2.0, "UTC", "u", "{}", "{}")], DOCS)
    for _ in range(2):
        append_raw(with_lineage(docs, load_id="a"), str(tmp_path / "raw"))
    append_raw(with_lineage(docs, load_id="b"), str(tmp_path / "raw"))
    assert sorted(r["load_id"] for r in read_raw(spark, str(tmp_path / "raw")).collect()) == ["a", "b"]


def test_pipeline_gates_on_all_rules_before_it_publishes(spark, landing):
    tmp, loc, run = landing
    _landing(tmp / "landing", {"weather_north_ford_2026-07-05.json": MINIMAL, "weather_whole_town_2026-07-05.json": MINIMAL, "weather_whole_town_2026-07-06.json": MINIMAL})
    run()
    raw_path, out = str(tmp / "raw"), str(tmp / "marts")
    since = dt.datetime(2000, 1, 1, tzinfo=dt.timezone.utc)
    with pytest.raises(LoadCheckError):
        run_pipeline(spark, raw_path, loc, out, since, expected_locations=7)
    passed, report = run_pipeline(spark, raw_path, loc, out, since, expected_locations=2)
    assert passed, [r.asDict() for r in report.filter("not passed").collect()]
    assert report.count() == 78  # the whole rule set
    fh = spark.read.parquet(f"{out}/fct_hourly_weather")
    assert fh.count() == 6
    assert {r.location_name for r in fh.select("location_name").distinct().collect()} == {"north_ford", "whole_town"}
    s = spark.read.parquet(f"{out}/daily_temperature_summary").first()
    assert s.location_count == 2 and float(s.avg_temp_f) == 75.5
    before = sorted(p.name for p in (tmp / "marts").rglob("*.parquet") if "_quality" not in str(p))
    _landing(tmp / "landing", {"weather_north_ford_2026-07-08.json": forecast("2026-07-08T00:00", [500])})  # out of range
    run()
    passed, report = run_pipeline(spark, raw_path, loc, out, since, expected_locations=2)
    assert not passed and "stg_hourly" in {r["relation"] for r in report.filter("not passed").collect()}
    assert sorted(p.name for p in (tmp / "marts").rglob("*.parquet") if "_quality" not in str(p)) == before


def test_refresh_of_all_daily_marts_equals_a_rebuild(spark, landing):
    tmp, loc, run = landing
    day = lambda d, hi: {"daily": {"time": [f"2026-07-{d:02d}", f"2026-07-{d + 1:02d}"], "temperature_2m_max": [hi, hi + 1], "temperature_2m_min": [50, 51]}}
    _landing(tmp / "landing", {"weather_north_ford_2026-07-01.json": day(1, 80), "weather_whole_town_2026-07-01.json": day(1, 90), "weather_whole_town_2026-07-02.json": day(2, 70), "weather_whole_town_2026-07-08.json": day(8, 60)})
    run()
    staged = M.stg_daily(read_raw(spark, str(tmp / "raw")))
    everything = F.lit(True)
    refresh_daily_marts(staged.filter("ingested_at < '2026-07-02'"), everything, loc, str(tmp / "marts"))
    refresh_daily_marts(staged, F.col("ingested_at") >= F.lit(dt.datetime(2026, 7, 2, tzinfo=dt.timezone.utc)), loc, str(tmp / "marts"))
    refresh_daily_marts(staged, everything, loc, str(tmp / "whole"))
    for mart in ("fct_daily_weather", "daily_temperature_summary", "temperature_anomalies"):
        got, want = (sorted(map(str, spark.read.parquet(str(tmp / d / mart)).collect())) for d in ("marts", "whole"))
        assert got == want and got, mart


def test_mart_files_are_few_and_sorted(spark, tmp_path):
    import pyarrow.parquet as pq

    rows = spark.range(4000).select((F.col("id") % 4).cast("int").alias("k"), F.date_add(F.lit(dt.date(2026, 7, 1)), (F.col("id") % 5).cast("int")).alias("d"), F.xxhash64("id").alias("v"))
    write_mart(rows.repartition(16), str(tmp_path / "m"), ["d"], ["v"])
    files = [p for p in (tmp_path / "m").rglob("*.parquet")]
    assert 5 <= len(files) <= 10
    for f in files:
        v = pq.ParquetFile(f).read(columns=["v"]).column("v").to_pylist()
        assert v == sorted(v)
    assert read_mart(spark, str(tmp_path / "m"), ["d", "v"]).columns == ["d", "v"]


def test_category_order(spark):
    from isobar.plans.bi import ordered_locations

    names = spark.createDataFrame([("chicago",), ("miami",), ("nowhere",)], "location_name string")
    out = ordered_locations(names, ["miami", "chicago"]).orderBy("display_order").collect()
    assert [(r.location_name, r.display_order) for r in out] == [("miami", 1), ("chicago", 2)]


def test_append_sink_lineage(spark):
    from isobar.sources.raw import append_raw, read_raw, with_lineage

    tmp = tempfile.mkdtemp(prefix="isobar-append-")
    docs = spark.createDataFrame(
        [(40.71, -74.01, "America/New_York", "u1", "{}", json.dumps(MINIMAL)), (34.0, -118.0, "America/Los_Angeles", "u2", "{}", "{}")],
        "latitude double, longitude double, timezone string, source_url string, request_params string, response_body string",
    )
    run1 = with_lineage(docs, load_id="run-1")
    append_raw(run1, f"{tmp}/raw")
    append_raw(with_lineage(docs, load_id="run-2"), f"{tmp}/raw")
    raw = read_raw(spark, f"{tmp}/raw")
    rows = raw.collect()
    assert len(rows) == 4 and {r.load_id for r in rows} == {"run-1", "run-2"}
    assert {r.weather_model for r in rows} == {"gfs_seamless"} and {r.ingest_source for r in rows} == {"python"}
    assert raw.select("forecast_id").distinct().count() == 4  # one id per (run, location)
    again = {r.forecast_id for r in with_lineage(docs, load_id="run-1").collect()}
    assert again == {r.forecast_id for r in run1.collect()}  # deterministic per run
    assert all(r.ingest_date is not None for r in rows)


def test_landing_files_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    suppliers = spark.range(1, 41).select(F.col("id").alias("s_suppkey"))
    suppliers.coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    customer = "id AS c_custkey", "format_string('Customer#%09d', id) AS c_name", "'A' AS c_mktsegment"
    spark.range(1, 41).selectExpr(*customer).write.parquet(f"{tmp_path}/customer.parquet")
    monkeypatch.setattr(registry, "LANDING_FILES_PER_TASK", 5)
    before = set(glob.glob(f"{run_folder(spark)}/landing-*"))
    rows = registry.q_landing_ingest(spark, str(tmp_path)).collect()
    assert len(rows) == 40 and {r["times"] for r in rows} == {1}
    (folder,) = set(glob.glob(f"{run_folder(spark)}/landing-*")) - before
    files = glob.glob(f"{folder}/files/*/part-*")
    assert len(files) == 40 and len({f.rsplit("/", 1)[1].split("-")[1] for f in files}) > 4


def test_landing_files_are_read_many_to_a_task_and_listed_without_partition_values(spark, landing, monkeypatch):
    tmp, loc, run = landing
    for k in range(60):
        folder = tmp / "landing" / f"landing=weather_{'whole_town' if k % 2 else 'nowhere'}_2026-07-{k % 28 + 1:02d}.json"
        folder.mkdir(exist_ok=True)
        (folder / f"part-{k}.txt").write_text(json.dumps(MINIMAL))
    assert "landing#" not in ingest.landing_stream(spark, str(tmp / "landing"))._jdf.queryExecution().analyzed().toString()
    tasks, materialize = [], ingest.materialize
    monkeypatch.setattr(ingest, "materialize", lambda df, name: tasks.append(df.rdd.getNumPartitions()) or materialize(df, name))
    with setting(spark, "spark.sql.files.maxPartitionBytes", "1m"):
        got = run()
    assert (got.documents, got.quarantined) == (30, {"unknown_location": 30}) and tasks == [tasks[0]] and tasks[0] < 10  # 60 before


def test_files_in_other_folders_are_left_alone(spark, landing):
    tmp, loc, run = landing
    _landing(tmp / "landing", {"weather_whole_town_2026-07-06.json": MINIMAL})
    (tmp / "landing" / "done").mkdir()
    _landing(tmp / "landing" / "done", {"weather_whole_town_2026-07-07.json": MINIMAL})
    assert run().documents == 1


def test_landed_events_are_shuffled_instead_of_their_documents(spark, tmp_path):
    k, t = "format_string('{\"k\": %d}', id % 90) AS props", "TIMESTAMP_NTZ'2024-01-01 00:30:00' + make_dt_interval(0, CAST(id % 60 AS INT)) AS ts"
    events = spark.range(200).selectExpr("id AS event_id", t, "id % 9 AS user_id", "'view' AS event_type", "CAST(id AS DOUBLE) AS value", k)
    events.union(events.limit(20)).write.parquet(f"{tmp_path}/events.parquet")  # some rows twice
    built = D.raw_forecasts_unlanded(spark, str(tmp_path))
    landed = D.raw_forecasts(spark, str(tmp_path), refresh=True).select(*built.columns)
    assert sorted(map(str, landed.collect())) == sorted(map(str, built.collect()))
    files = landed.inputFiles()
    assert len(files) <= 3 + 2 * spark.sparkContext.defaultParallelism and all(".zstd." in f for f in files)
    plan = D.forecast_documents(D._by_day(D.table(spark, str(tmp_path), "events")))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("format_string") < plan.index("Exchange rangepartitioning") and plan.count("Exchange") == 1
