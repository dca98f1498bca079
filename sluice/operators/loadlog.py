"""The load log: what each run found, read, skipped and failed on."""

from __future__ import annotations

import uuid
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.functions.dates import day_key
from sluice.functions.text import log_key
from sluice.operators.running import running_total
from sluice.operators.validate import LINE_CHUNK_BYTES, Checked, fault_message
from sluice.session import work_dir
from sluice.sources.lines import Located

# Skipped rows detailed per file, and the log texts.
SKIPS_DETAILED = 21
MORE_SKIPPED = "More rows were skipped, but will not be logged to keep the logs from being flooded."
STARTED = "Started reading from file: %s."
COMPLETED = "Completed reading from file: %s; %d row(s) read; %d row(s) skipped."
FOUND = "%s found to contain file(s)."
NOT_FOUND = "%s does not exist or is empty; using %s."

_ENTRY = ["path", "position", "level", "message"]


def _first_skips(checked: Checked, detailed: int | None) -> DataFrame:
    """The first skipped lines of each file, one more than are detailed; all for None.

    The rank filter turns into a group limit before the shuffle, so a file
    with any number of bad lines sends only a few per task.  With all of them,
    ranks come from running totals over splits.
    """
    if detailed is None:
        skipped = checked.quarantine.where("policy = 'skip'")
        counts = skipped.groupBy("path", "block_start").agg(F.count("*").alias("_n"))
        chunk = F.expr(f"block_start div {LINE_CHUNK_BYTES}")
        begins = running_total(counts, ["path"], "block_start", "_n", "_begin", chunk).select("path", "block_start", "_begin")
        inside = Window.partitionBy("path", "block_start").orderBy("row_id")
        ranked = skipped.withColumn("_inside", F.row_number().over(inside)).join(begins, ["path", "block_start"])
        return ranked.withColumn("rank", F.col("_begin") + F.col("_inside")).drop("_begin", "_inside")
    in_order = Window.partitionBy("path").orderBy("block_start", "row_id")
    return (
        checked.quarantine.where("policy = 'skip'")
        .withColumn("rank", F.row_number().over(in_order))
        .where(F.col("rank") <= detailed + 1)
    )


def capped_skips(checked: Checked, detailed: int | None = SKIPS_DETAILED) -> DataFrame:
    """Skip entries per file: the detailed ones, then one notice; None details all.

    The quarantine holds every rejected line in any case.
    """
    numbered = checked.with_line(_first_skips(checked, detailed))
    detail = fault_message(F.col("fault"), F.col("file_name"), F.col("line"), F.col("column_index"))
    return numbered.select(
        "path",
        "file_name",
        "block_start",
        "row_id",
        F.col("rank").alias("position"),
        F.lit("SKIP").alias("level"),
        (detail if detailed is None else F.when(F.col("rank") <= detailed, detail).otherwise(MORE_SKIPPED)).alias("message"),
    )


def first_failures(checked: Checked) -> DataFrame:
    """The first line of each file that its policy does not forgive."""
    fails = checked.quarantine.where("policy = 'fail'")
    # Width faults carry no column, so the struct keeps only comparable fields first.
    known = [c for c in ("line",) if c in fails.columns]
    first = fails.groupBy("path").agg(
        F.min_by(
            F.struct("file_name", "block_start", "row_id", "column_index", "fault", *known),
            F.struct("block_start", "row_id"),
        ).alias("first")
    )
    numbered = checked.with_line(first.select("path", "first.*"))
    return numbered.select(
        "path",
        "block_start",
        "row_id",
        "line",
        fault_message(F.col("fault"), F.col("file_name"), F.col("line"), F.col("column_index")).alias("message"),
    )


class LoadFailed(RuntimeError):
    """A line broke a rule whose policy is ``fail``."""


def raise_on_failure(checked: Checked) -> None:
    """Stop a run at the first failing line; reads one row."""
    if checked.spec.can_fail:
        failed = first_failures(checked).orderBy("path", "line").take(1)
        if failed:
            raise LoadFailed(failed[0]["message"])


def file_entries(checked: Checked, detailed: int | None = SKIPS_DETAILED) -> DataFrame:
    """Entries per file in reading order: start, skips, then completion or failure."""
    files = checked.file_stats
    skips = capped_skips(checked, detailed)
    if checked.spec.can_fail:
        fails = first_failures(checked).alias("f")
        at_fail = fails.select("path", F.struct("block_start", "row_id").alias("_fail_at"))
        skips = (
            skips.join(at_fail, "path", "left")
            .where(F.col("_fail_at").isNull() | (F.struct("block_start", "row_id") < F.col("_fail_at")))
            .select(*_ENTRY)
        )
        kept = skips.groupBy("path").agg(F.count("*").alias("_kept"))
        files = files.join(kept, "path", "left").fillna(0, ["_kept"])
        files = files.join(fails.select("path", F.col("message").alias("_failure")), "path", "left")
    else:
        skips = skips.select(*_ENTRY)
        most = F.col("rows_skipped") if detailed is None else F.least(F.col("rows_skipped"), F.lit(detailed + 1))
        files = files.withColumn("_kept", most)
        files = files.withColumn("_failure", F.lit(None).cast("string"))
    started = files.select(
        "path",
        F.lit(0).alias("position"),
        F.lit("INFO").alias("level"),
        F.format_string(STARTED, "file_name").alias("message"),
    )
    ended = files.select(
        "path",
        (F.col("_kept") + 1).cast("int").alias("position"),
        F.when(F.col("_failure").isNull(), "INFO").otherwise("FAIL").alias("level"),
        F.coalesce("_failure", F.format_string(COMPLETED, "file_name", "rows_read", "rows_skipped")).alias(
            "message"
        ),
    )
    sizes = files.select("path", (F.col("_kept") + 2).alias("_entries"))
    begins = _begins(sizes, checked.lines.sparkSession, checked.staged_folder)
    entries = started.unionByName(skips).unionByName(ended)
    return entries.join(begins, "path").select(
        "path", (F.col("_begin") + F.col("position")).alias("sequence"), "level", "message"
    )


def _begins(sizes: DataFrame, spark: SparkSession, staged: str | None) -> DataFrame:
    """Where each file's entries begin in the job's log, files in order of path.

    Files are dealt into ranges of the path, as many as the session has
    shuffle partitions.  The ranges' totals are added up by the driver, the
    files of each range in a window; neither a folder nor the job is one.
    """
    sizes = sizes.repartitionByRange("path").withColumn("_range", F.spark_partition_id())
    # Written, so that both uses see the same ranges even if a task runs again.
    folder = f"{staged}/file-ranges-{uuid.uuid4().hex}" if staged else work_dir(spark, "file-ranges")
    sizes.write.parquet(folder)
    sizes = spark.read.schema(sizes.schema).parquet(folder)
    totals = {r["_range"]: r["n"] for r in sizes.groupBy("_range").agg(F.sum("_entries").alias("n")).collect()}
    ranges = sorted(totals)
    begins = accumulate((totals[r] for r in ranges), initial=0)
    bases = spark.createDataFrame(list(zip(ranges, begins, strict=False)), "_range int, _base bigint")
    inside = Window.partitionBy("_range").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    inner = sizes.withColumn("_inner", F.coalesce(F.sum("_entries").over(inside), F.lit(0)))
    return inner.join(F.broadcast(bases), "_range").select("path", (F.col("_base") + F.col("_inner")).alias("_begin"))


def load_log(
    checked: Checked,
    instance: str,
    job: str,
    ts: Column,
    opening: DataFrame | None = None,
    opening_rows: int = 0,
    detailed: int | None = SKIPS_DETAILED,
) -> DataFrame:
    """The whole log of one job; ``opening`` holds entries before any file.

    ``detailed`` skips are listed per file, all of them for None.
    """
    entries = file_entries(checked, detailed).select(
        (F.col("sequence") + opening_rows).alias("log_index"), "level", "message"
    )
    if opening is not None:
        entries = opening.select("log_index", "level", "message").unionByName(entries)
    return entries.select(
        F.lit(instance).alias("instance_id"),
        F.lit(job).alias("job_id"),
        F.col("log_index").cast("bigint").alias("log_index"),
        "level",
        "message",
        ts.alias("ts"),
        day_key(ts).alias("assoc_day"),
    )


def opening_entries(spark: SparkSession, located: Located, run_id: str, empty: str | None = None) -> DataFrame:
    """The two entries every job starts with: its run, and whether the target held files."""
    target = "/" + located.target.lstrip("/")
    fallback = located.root if not (empty or "").strip() else "/" + empty.lstrip("/")
    text = FOUND % target if located.found else NOT_FOUND % (target, fallback)
    rows = [(0, "INFO", f"run id = {run_id}"), (1, "INFO", text)]
    return spark.createDataFrame(rows, "log_index bigint, level string, message string")


def instance_entries(log: DataFrame, instance: str) -> DataFrame:
    """All entries of one instance; prunes to its partition of the log table."""
    return log.where(F.col("instance_id") == instance)


def export_form(log: DataFrame) -> DataFrame:
    """The columns and names of the CSV export of an instance log."""
    return log.select(
        log_key(F.col("job_id"), F.col("log_index")).alias("index"),
        F.col("ts").alias("timestamp"),
        "level",
        "message",
    )


def next_index(log: DataFrame, index: str = "log_index") -> DataFrame:
    """One higher than the last index, per instance."""
    return log.groupBy("instance_id").agg((F.max(index) + 1).alias("next_index"))
