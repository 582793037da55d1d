"""Session defaults, the shared checkpoint folder and tables written for one run."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Lets Spark delete the shuffle files of a finished SQL execution at once.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Most tasks of one listing of many folders; by default each folder has its own.
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

#: What opening a file counts when a scan deals files to tasks; by default 4 MB.
OPEN_COST = "spark.sql.files.openCostInBytes"

#: Checkpoint folders of local applications that name none.
_private: dict[str, str] = {}


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "isobar") -> SparkSession:
    """A session with AQE, UTC session zone and no web UI.

    On a cluster both arguments stay None and the cluster's own settings hold: the number
    of shuffle partitions is set only when the caller passes one.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (
        b.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster has to name it. Only a ``local`` master, where driver and executors are one
    machine, gets a private folder when it is unset.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        # one private folder per application; the key itself can't be set on a session
        d = _private.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="isobar-ckpt-")
        _private[spark.sparkContext.applicationId] = d
    return d


def file_system(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = file_system(spark, path)
    return fs.exists(jpath)


def run_folder(spark: SparkSession) -> str:
    """This application's own folder below the checkpoint folder, deleted at its end."""
    path = f"{checkpoint_dir(spark)}/isobar-{spark.sparkContext.applicationId}"
    fs, jpath = file_system(spark, path)
    if not fs.exists(jpath):
        fs.mkdirs(jpath)
        fs.deleteOnExit(jpath)
    return path


def release(spark: SparkSession) -> None:
    """Delete all that ``materialize`` has written for this application so far. Results
    that still read those tables must have been written or collected before."""
    fs, jpath = file_system(spark, run_folder(spark))
    fs.delete(jpath, True)


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once as a Parquet table in the run's folder and read it back.

    Cuts lineage (a lost executor re-reads files instead of recomputing the plan) and lets
    several branches share one computation. The shuffle files of the write are deleted as
    soon as it is done; the table goes when the application ends, or by ``release``."""
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with setting(spark, SHUFFLE_CLEANUP, "true"):
        (df.hint("rebalance", *partition_by) if partition_by else df).write.partitionBy(*partition_by).parquet(path)
    table = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    table.written_to = path
    return table


def discard(table: DataFrame) -> None:
    """Delete a table that ``materialize`` returned, once nothing reads it any more."""
    fs, jpath = file_system(table.sparkSession, table.written_to)
    fs.delete(jpath, True)
