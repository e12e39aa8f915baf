"""Spark session settings and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session defaults. Cluster sizing (executors, memory, shuffle partitions) is left to spark-submit.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Rows of events take some thirty times the bytes of their files; this bounds what a task holds to shuffle them.
    # As many small files as before go to a task.
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.files.openCostInBytes": "512k",
    # The JVM never compiles methods above 8000 bytes, so wide projections must not fuse into one.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
}

_local_scratch: dict[str, str] = {}
_working_roots: set[str] = set()


def build_session(app: str = "tourlytics", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def bound_reads(spark: SparkSession) -> None:
    """The bounds on what a task reads, for a session that was not built here; lower ones stay."""
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        if size(spark.conf.get(name)) > size(DEFAULTS[name]):
            spark.conf.set(name, DEFAULTS[name])


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only for a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        folder = tempfile.mkdtemp(prefix="tourlytics-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_scratch[app] = folder
    return _local_scratch[app]


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder or file, wherever Spark can reach it; one that is not there is fine."""
    files, place = file_system(spark, path)
    files.delete(place, True)


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as that system takes it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def working_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; no two calls return the same one.

    Working folders belong to their application and go when its driver process ends; a driver that is
    killed leaves ``tourlytics/<application id>`` to be deleted by hand.
    """
    app = spark.sparkContext.applicationId
    root = f"{shared_folder(spark)}/tourlytics/{app}"
    if root not in _working_roots:
        _working_roots.add(root)
        atexit.register(_drop_at_end, spark, root)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def _drop_at_end(spark: SparkSession, root: str) -> None:
    if getattr(spark.sparkContext, "_jsc", None) is not None:  # not stopped yet
        drop_path(spark, root)
