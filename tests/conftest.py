import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

from isobar.schemas import RAW_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]")
        .appName("isobar-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    yield s


def make_raw(spark, docs):
    """Raw rows from ``(forecast_id, ingested_at, latitude, longitude, body)`` tuples."""
    rows = [
        (fid, ts, lat, lon, "America/Denver", "gfs_seamless", "test://", "{}", body, "L1", "test")
        for fid, ts, lat, lon, body in docs
    ]
    return spark.createDataFrame(rows, RAW_SCHEMA)


T0 = dt.datetime(2026, 7, 5, 6, 0, tzinfo=dt.timezone.utc)
