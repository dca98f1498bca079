"""Status counts kept per day of slices and counted again only where runs arrived."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.monitor import status_counts

RUNS = "dataset string, slice_start timestamp, id bigint, status string, slice_date string, batch bigint"
COUNTS = "dataset string, success bigint, running bigint, failure bigint, slice_date string"


def _replaced(rows: DataFrame, path: str, *folders: str) -> None:
    (
        rows.hint("rebalance", *folders)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*folders)
        .parquet(path)
    )


def add_runs(runs: DataFrame, path: str, batch: int) -> None:
    """Store a batch of run states below the days of their slices.

    A batch that is stored again replaces its own rows in the days it holds.
    Runs without slice_start lie in a day of their own.
    """
    day = F.date_format("slice_start", "yyyyMMdd").alias("slice_date")
    number = F.lit(batch).cast("bigint").alias("batch")
    _replaced(runs.select("dataset", "slice_start", "id", "status", day, number), path, "slice_date", "batch")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(path)


def refresh(spark: SparkSession, runs_path: str, counts_path: str, batch: int) -> list[str | None]:
    """Count the days that a batch touched again, from all batches, and return them.

    A run sent more than once counts in the state of its last batch.  Days are
    chosen by folder, so files of other days are not opened; the driver sees
    one short text a touched day.  A refresh that broke off is run again.
    """
    runs = read_runs(spark, runs_path)
    arrived = runs.where(F.col("batch") == batch).select("slice_date").distinct().collect()
    days = sorted((r["slice_date"] for r in arrived), key=lambda day: (day is None, day))
    chosen = F.col("slice_date").isin(*(d for d in days if d is not None))
    if None in days:
        chosen = chosen | F.col("slice_date").isNull()
    if not days:
        return days
    last = (
        runs.where(chosen)
        .groupBy("slice_date", "dataset", "slice_start", "id")
        .agg(F.max_by("status", "batch").alias("status"))
    )
    _replaced(status_counts(last, "slice_date", "dataset"), counts_path, "slice_date")
    return days


def dataset_counts(spark: SparkSession, counts_path: str) -> DataFrame:
    """Success, running and failure counts per dataset, from the stored counts of all days."""
    stored = spark.read.schema(COUNTS).parquet(counts_path)
    return stored.groupBy("dataset").agg(*(F.sum(c).alias(c) for c in ("success", "running", "failure")))
