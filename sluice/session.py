"""Session settings the library relies on, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_base: str | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Pin the two settings results depend on.

    All clocks are UTC.  The split size of file scans must not follow the
    number of executors that happen to be alive: line numbers join two scans
    of the same files on their split starts, so both have to plan alike even
    when executors come and go in between.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        parallelism = spark.sparkContext.defaultParallelism
        spark.conf.set("spark.sql.files.minPartitionNum", str(parallelism))
    return spark


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the cluster's shared ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        if _local_base is None:
            _local_base = tempfile.mkdtemp(prefix="sluice-")
        base = _local_base
    return f"{base.rstrip('/')}/sluice/{label}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, folder: str) -> None:
    """Delete a folder that ``work_dir`` named, on whatever file system holds it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
