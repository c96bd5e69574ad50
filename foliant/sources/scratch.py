"""Intermediate tables that several parts of a job read: written once, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession

BROADCAST, MEASURED = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Only a session of one machine gets a folder of its own where none is set."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set: intermediate tables need a folder that all executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="foliant-"))
        where = spark.sparkContext.getCheckpointDir()
    return where.rstrip("/")


_KEPT: set[str] = set()


def run_dir(spark: SparkSession) -> str:
    """The application's own folder in the shared one. It goes when the driver ends: results that are read lazily need its tables until then."""
    path = f"{shared_dir(spark)}/foliant-{spark.sparkContext.applicationId}"
    if path not in _KEPT:
        _KEPT.add(path)
        atexit.register(_drop, spark, path)
    return path


def _drop(spark: SparkSession, path: str) -> None:
    with suppress(Exception):  # the JVM may have ended before
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jvm.org.apache.hadoop.conf.Configuration()).delete(folder, True)


def new_folder(spark: SparkSession, name: str) -> str:
    """The path of a folder that nothing else uses, below run_dir; it is not made."""
    return f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"


def measured_broadcasts(spark: SparkSession) -> None:
    """Joins broadcast a side for the bytes of its rows, which AQE measures, and never for the size of its files. The settings stay in the session.

    Keys that repeat take a byte or less in Parquet, and some hundred in a broadcast, which the driver holds.
    """
    if (limit := spark.conf.get(BROADCAST)) != "-1":
        if spark.conf.get(MEASURED, None) is None:
            spark.conf.set(MEASURED, limit)
        spark.conf.set(BROADCAST, "-1")


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What queries inside shuffle goes from the disks when they end, not when the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet and read again: lineage ends here, and a lost executor costs a re-read."""
    spark = df.sparkSession
    measured_broadcasts(spark)
    path = new_folder(spark, name)
    with _shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


def release(*tables: DataFrame) -> None:
    """Deletes saved tables that nothing reads any more."""
    for t in tables:
        _drop(t.sparkSession, t._saved_at)
