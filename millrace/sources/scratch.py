"""Working folders for tables that a job writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"
_local_base: str | None = None


def _base(spark: SparkSession) -> str:
    """The shared folder named by the session; a local one only in local mode."""
    global _local_base
    base = spark.conf.get(_SETTING, None)
    if base:
        return base
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(
            f"{_SETTING} is not set: on a cluster it must name a folder that "
            "every executor can read and write"
        )
    if _local_base is None:
        _local_base = tempfile.mkdtemp(prefix="millrace-")
    return _local_base


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, removed when the application ends.

    Results read these tables lazily, so nothing is deleted earlier.
    """
    root = f"{_base(spark).rstrip('/')}/millrace/{spark.sparkContext.applicationId}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.mkdirs(folder):
        fs.deleteOnExit(folder)
    return f"{root}/{label}-{uuid.uuid4().hex}"
