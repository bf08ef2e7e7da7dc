"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Settings that can be changed in a running session.
RUNTIME_SETTINGS = {
    # A hot key is split even where the split costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles methods above 8000 bytes. Rows of 200 columns with a cleaning rule each
    # make longer ones; below this limit Spark generates one small method per expression instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Tables are written more often than any is read.
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(app: str = "aforo", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is designed for.

    ``master`` is left to spark-submit on a cluster. Conf keys use ``__`` for dots.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(RUNTIME_SETTINGS)
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that was made elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: the cluster's checkpoint setting.

    Only where nothing is set and all tasks run on this machine (tests, a laptop) a temporary folder is made,
    once per application; on a cluster a missing setting is an error.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    master = spark.sparkContext.master
    if not configured and not (master == "local" or master.startswith("local[")):
        raise ValueError(f"{CHECKPOINT_KEY} must name a folder that all executors share")
    return (configured or _own_folder(spark.sparkContext.applicationId)).rstrip("/")


@cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"aforo-{application}-")


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write the frame below the shared folder and read it back.

    For a small result that several parts of one plan use: it is computed once, later writes cannot
    change it, and a lost executor costs nothing but its own tasks.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _located(spark: SparkSession, path: str):
    """A path and the file system that Spark itself uses for it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder or file, if it is there."""
    target, system = _located(spark, path)
    system.delete(target, True)


def move_path(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder or file; fails where the new name is taken."""
    target, system = _located(spark, path)
    place, _ = _located(spark, to)
    if system.exists(place) or not system.rename(target, place):
        raise OSError(f"cannot move {path} to {to}")
