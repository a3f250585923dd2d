"""Shared scratch tables.

Intermediate tables go to the folder named in ``spark.checkpoint.dir``, so that they survive the loss
of executors; where that is unset, below ``spark.sql.warehouse.dir``, which on a cluster must not be a local folder.
They are deleted when the driver's Python ends.
"""

from __future__ import annotations

import atexit
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

SETTING, WAREHOUSE = "spark.checkpoint.dir", "spark.sql.warehouse.dir"

_written: dict[str, SparkSession] = {}  # folder of an application -> its session


def shared_folder(spark: SparkSession) -> str:
    base = spark.conf.get(SETTING, None)
    if not base:
        base = spark.conf.get(WAREHOUSE, None)
        local = spark.sparkContext.master.startswith("local")
        if not base or (not local and urlparse(base).scheme in ("", "file")):
            raise ValueError(f"intermediate tables need a shared folder: set {SETTING}")
    return f"{base.rstrip('/')}/tidemill/{spark.sparkContext.applicationId}"


def _delete(folder: str, spark: SparkSession) -> None:
    context = spark.sparkContext
    if context._jsc is None:  # the session has ended before
        return
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    _delete(path, spark)


def clean_up() -> None:
    """Delete the scratch tables of all sessions that still run."""
    while _written:
        _delete(*_written.popitem())


atexit.register(clean_up)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    folder = shared_folder(spark)
    _written[folder] = spark
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    Used where a plan reads the same aggregate several times; the written table also cuts lineage.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
