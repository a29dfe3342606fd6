"""Session set-up and the shared working folder."""

from __future__ import annotations

import atexit
import contextlib
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folder: dict[str, str] = {}
_swept: set[str] = set()


def build_session(app: str = "tallyworks", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution, skew handling and UTC timestamps.

    ``conf`` keys use ``__`` for dots: ``spark__sql__shuffle__partitions="8"``.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local master may fall back to a temporary folder.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None)
    local = spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master
    if named:
        base = named.rstrip("/")
    elif local:
        app = spark.sparkContext.applicationId
        if app not in _local_folder:
            _local_folder[app] = tempfile.mkdtemp(prefix="tallyworks-")
        base = _local_folder[app]
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return f"{base}/tallyworks/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """Hadoop's path object and the file system that holds it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def materialize(df: DataFrame, label: str = "table", **options) -> DataFrame:
    """Write ``df`` to the shared folder, with options of the writer, and read it back.

    Cuts lineage, survives lost executors, and fixes values such as row
    positions that would differ if the plan ran a second time. ``discard`` frees a
    table that no later step reads; what is left goes when the session ends.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.options(**options).parquet(path)
    if spark.sparkContext.applicationId not in _swept:
        _swept.add(spark.sparkContext.applicationId)
        atexit.register(_sweep, spark, shared_dir(spark))
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_path = path
    return stored


def discard(stored: DataFrame) -> None:
    """Delete a materialized table that nothing will read again."""
    path, files = file_system(stored.sparkSession, stored.stored_path)
    files.delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more.

    Spark does so when the driver's objects are collected, which may be long after; a job in
    several passes calls this between them, so that their files do not add up.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _sweep(spark: SparkSession, folder: str) -> None:
    """Delete this application's folder; a session that is already stopped leaves it to its owner."""
    with contextlib.suppress(Exception):
        path, files = file_system(spark, folder)
        files.delete(path, True)
