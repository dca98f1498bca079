"""Table sinks: load log, slices, CSV exports and the access table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.loadlog import export_form, instance_entries


LOG = "log_index bigint, level string, message string, ts timestamp, assoc_day timestamp, instance_id string, job_id string"
QUARANTINE = (
    "path string, file_name string, block_start bigint, row_id bigint, raw string, column_index int, fault string, "
    "policy string, line bigint, instance_id string, job_id string"
)


def append_log(log: DataFrame, path: str) -> None:
    """Add the entries of jobs; the table is laid out by instance, the key of
    every lookup, and by job.  A job that runs again replaces its own entries."""
    (
        log.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("instance_id", "job_id")
        .parquet(path)
    )


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The log under its declared schema: names of instances and jobs stay text."""
    return spark.read.schema(LOG).parquet(path)


def write_quarantine(rows: DataFrame, path: str, instance: str, job: str) -> None:
    """Keep rejected lines for good; a job that runs again replaces its own."""
    kept = rows.withColumns({"instance_id": F.lit(instance), "job_id": F.lit(job)})
    append_log(kept, path)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Rejected lines of all jobs, with their line numbers."""
    return spark.read.schema(QUARANTINE).parquet(path)


def export_instance(log: DataFrame, instance: str, path: str) -> None:
    """CSV of one instance log in index order, with standard quoting."""
    entries = instance_entries(log, instance).orderBy("job_id", "log_index")
    write_csv(export_form(entries), path)


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("errorifexists").option("header", header).option("escape", '"').csv(path)


def write_slices(
    df: DataFrame,
    path: str,
    slice_end: str,
    fmt: str = "parquet",
    keep: Sequence[str] | None = None,
) -> None:
    """Write rows below ``slice_date=/slice_time=`` folders, replacing only the
    slices present.  The rebalance hint gathers rows of a slice into few files
    and still splits a slice too large for one task."""
    ts = F.col(slice_end)
    laid = df.withColumn("slice_date", F.date_format(ts, "yyyyMMdd")).withColumn(
        "slice_time", F.date_format(ts, "HHmm")
    )
    if keep is not None:
        laid = laid.select(*keep, "slice_date", "slice_time")
    (
        laid.hint("rebalance", "slice_date", "slice_time")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("slice_date", "slice_time")
        .format(fmt)
        .save(path)
    )


def read_slices(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """Rows that ``write_slices`` wrote, under ``schema``; slice_date and slice_time stay text."""
    return spark.read.schema(f"{schema}, slice_date string, slice_time string").format(fmt).load(path)


def write_buckets(df: DataFrame, table: str, path: str, buckets: int, *keys: str) -> DataFrame:
    """Store rows as a catalog table in ``buckets`` buckets of the keys, sorted by them, and return the table.

    Tables of equal buckets join on the keys without moving rows again.  Rows
    of one key lie in one bucket, read by one task, so this suits keys of which
    none holds a large share of the rows.
    """
    # Dealt out as the buckets are, each bucket becomes one file.
    dealt = df.repartition(buckets, *keys)
    first, *more = keys
    dealt.write.bucketBy(buckets, first, *more).sortBy(first, *more).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def append_access(rows: DataFrame, path: str) -> None:
    """Record assignments; ``operators.access.current`` resolves the latest."""
    rows.write.mode("append").parquet(path)
