"""Raw landing table: append sink (S2) and scan (S3).

The raw table is Parquet partitioned by ``ingest_date`` and load and only ever added to; the
JSON documents stay verbatim in ``response_body``. Models read it with the fixed
schema and project only the columns they need (the JSON text column is the only wide
one, and each flatten parses only its own section).

A typed landing table holds each document as a VARIANT, too: it is parsed once, when it
lands, and a flatten's scan reads the arrays it needs out of that column. Documents that a
VARIANT doesn't stand for are in partitions of their own, whose text is parsed as before.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.schemas import DAILY_VARIABLES, HOURLY_VARIABLES, INT, RAW_SCHEMA

DEFAULT_WEATHER_MODEL = "gfs_seamless"
DEFAULT_INGEST_SOURCE = "python"
LOAD_PARTITIONS = ["ingest_date", "load_id"]
#: Of a typed table: the parsed document, and the partition column that says there is one.
DOCUMENT, TYPED = "response_doc", "is_typed"


def with_lineage(
    docs: DataFrame,
    load_id: str | None = None,
    ingest_source: str = DEFAULT_INGEST_SOURCE,
    weather_model: str = DEFAULT_WEATHER_MODEL,
) -> DataFrame:
    """S2 lineage: one ``load_id`` shared by the run, ``ingested_at``, ``ingest_source``,
    default ``weather_model`` and a ``forecast_id``.

    ``docs`` needs latitude, longitude, timezone, source_url, request_params and
    response_body. Documents from files also have ``file_name`` and ``file_date``: then the
    file's date is the run's time, so that of several files of a location the newer run
    wins whenever they are ingested, and the name is part of the id. Other documents get
    the batch's time. ``forecast_id`` is a 64-bit hash of load, coordinates and file name:
    Spark has no dense sequence, and the id is only lineage and a uniqueness key.
    """
    load_id = load_id or str(uuid.uuid4())
    out = docs
    if "weather_model" not in docs.columns:
        out = out.withColumn("weather_model", F.lit(weather_model))
    from_files = "file_name" in docs.columns
    run_time = F.timestamp_seconds(F.unix_date("file_date").cast("long") * 86_400) if from_files else F.current_timestamp()
    out = out.withColumns({"load_id": F.lit(load_id), "ingest_source": F.lit(ingest_source), "ingested_at": run_time})
    key = ["load_id", "latitude", "longitude"] + (["file_name"] if from_files else [])
    out = out.withColumn("forecast_id", F.xxhash64(*key))
    return out.select(*[f.name for f in RAW_SCHEMA.fields])


def ingest_date(ts: Column) -> Column:
    """The UTC day of an instant, whatever the session zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts) / 86_400).cast("int"))


def typed_documents(raw_rows: DataFrame) -> DataFrame:
    """``raw_rows`` with each document as a VARIANT, and whether that stands for its text.

    Text that is no JSON, or has an object with a key twice, gives no VARIANT. A VARIANT does
    not keep how a whole number was written, and an integer column must refuse ``75.0``: so
    documents with such a number among integers (or one beyond 64 bits, which looks the
    same) go by their text."""
    parsed = raw_rows.withColumn(DOCUMENT, F.try_parse_json("response_body"))
    lossy = "exists(try_variant_get({doc}, '$.{section}.{key}', 'array<variant>'), v -> schema_of_variant(v) LIKE 'DECIMAL%' AND NOT contains(CAST(v AS STRING), '.'))"
    holds = F.col(DOCUMENT).isNotNull()
    for section, variables in (("hourly", HOURLY_VARIABLES), ("daily", DAILY_VARIABLES)):
        for key, _, dtype in variables:
            if dtype == INT:
                holds = holds & ~F.coalesce(F.expr(lossy.format(doc=DOCUMENT, section=section, key=key)), F.lit(False))
    return parsed.withColumn(TYPED, holds)


def append_raw(raw_rows: DataFrame, path: str, typed: bool = False, spread: bool = False) -> None:
    """Add loads (``RAW_SCHEMA`` columns) to the landing table at ``path``, with
    ``typed`` to a typed one (always or never, for one table).

    A load is a partition of its day. Writing the same load again, as a retried batch does,
    replaces it, so the table holds every load once. Rebalanced by partition: a load is a
    few files, however many tasks write. With ``spread`` the rows come so already: each task
    holds rows of few loads, and the documents are not shuffled. The files are Zstandard's,
    which takes documents that share their keys far better than the default."""
    out = raw_rows.select(*[f.name for f in RAW_SCHEMA.fields], *(["ingest_date"] if "ingest_date" in raw_rows.columns else []))
    if "ingest_date" not in raw_rows.columns:
        out = out.withColumn("ingest_date", ingest_date(F.col("ingested_at")))
    # Rebalanced before the documents are parsed: the text is smaller than text and VARIANT.
    out = out if spread else out.hint("rebalance", *LOAD_PARTITIONS)
    (
        (typed_documents(out) if typed else out)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*LOAD_PARTITIONS, *([TYPED] if typed else []))
        .option("compression", "zstd")
        .parquet(path)
    )


def read_raw(spark: SparkSession, path: str, typed: bool = False) -> DataFrame:
    """S3: scan the landing table with its fixed schema (no inference)."""
    schema = T.StructType(RAW_SCHEMA.fields + [T.StructField("ingest_date", T.DateType())])
    if typed:
        schema.add(DOCUMENT, T.VariantType()).add(TYPED, T.BooleanType())
    return spark.read.schema(schema).parquet(path).select(*schema.names)
