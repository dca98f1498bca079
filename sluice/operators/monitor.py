"""Questions about pipelines, slices, runs and log files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.dates import display
from sluice.functions.text import file_url, flag_text, from_list

# How slice states count; other states are not counted.
SUCCESS = ("Ready",)
RUNNING = ("PendingExecution", "InProgress")
FAILURE = ("Failed",)

LOOK_BACK_HOURS = 96
PAGE_SIZES = (10, 25, 50, 100)


# --- pipelines -------------------------------------------------------------


def accessible(pipelines: DataFrame, allowed: DataFrame, name: str = "name") -> DataFrame:
    """Pipelines named in the caller's list."""
    return pipelines.join(allowed.select(name), name, "left_semi")


def activities(pipelines: DataFrame) -> DataFrame:
    """One row per activity in order, with the activity that follows it.  Order
    lives inside the document, so no rows are sorted or shuffled."""
    steps = F.transform(
        "activities",
        lambda a, i: F.struct(
            (i + 1).alias("position"),
            a.alias("activity"),
            F.get(F.col("activities"), i + 1).getField("name").alias("next_activity"),
        ),
    )
    return pipelines.select(F.col("name").alias("pipeline"), F.inline(steps)).select(
        "pipeline",
        "position",
        F.col("activity.name").alias("activity"),
        F.col("activity.type").alias("type"),
        F.col("activity.inputs").alias("inputs"),
        F.col("activity.outputs").alias("outputs"),
        "next_activity",
    )


def activity_outputs(steps: DataFrame) -> DataFrame:
    """One row per activity and output dataset."""
    return steps.select("pipeline", "position", "activity", F.explode("outputs").alias("dataset"))


def dataset_members(outputs: DataFrame) -> DataFrame:
    """The activities that feed each dataset, with how often they name it."""
    return outputs.groupBy("dataset", "pipeline", "activity").agg(F.count("*").alias("times"))


def drill_link(steps: DataFrame) -> DataFrame:
    """Link parameters of an activity: its outputs as comma text."""
    return steps.select("pipeline", "activity", from_list(F.col("outputs")).alias("datasets"))


# --- slices ----------------------------------------------------------------


def look_back(slices: DataFrame, ts: str, now: Column, hours: int = LOOK_BACK_HOURS) -> DataFrame:
    """Rows of the last hours up to now.

    The bounds take the column's type, not the other way round, so with a
    literal ``now`` they are pushed down to the scan.
    """
    kind = slices.schema[ts].dataType
    since = now - F.make_dt_interval(hours=F.lit(hours))
    return slices.where((F.col(ts) >= since.cast(kind)) & (F.col(ts) <= now.cast(kind)))


def of_datasets(slices: DataFrame, datasets: Sequence[str], column: str = "dataset") -> DataFrame:
    return slices.where(F.col(column).isin(*datasets))


def tagged_datasets(slices: DataFrame, datasets: Sequence[str], column: str = "dataset") -> DataFrame:
    """Slices of several datasets that lie in one table, tagged with their dataset, in one scan."""
    return of_datasets(slices, datasets, column).withColumn("dataset", F.col(column))


def tagged_union(by_dataset: dict[str, DataFrame]) -> DataFrame:
    """Slices of sources that are tables of their own, each tagged with its dataset."""
    tagged = [df.withColumn("dataset", F.lit(name)) for name, df in by_dataset.items()]
    return reduce(DataFrame.unionByName, tagged)


def status_counts(slices: DataFrame, *keys: str, status: str = "status") -> DataFrame:
    """Success, running and failure counts per key."""
    state = F.col(status)
    return slices.groupBy(*keys).agg(
        F.count_if(state.isin(*SUCCESS)).alias("success"),
        F.count_if(state.isin(*RUNNING)).alias("running"),
        F.count_if(state.isin(*FAILURE)).alias("failure"),
    )


def activity_counts(outputs: DataFrame, slices: DataFrame) -> DataFrame:
    """Counts per activity over all its outputs.  Slices shrink to one row per
    dataset first; an output without slices counts nothing."""
    return activity_totals(outputs, status_counts(slices, "dataset"))


def activity_totals(outputs: DataFrame, per_dataset: DataFrame) -> DataFrame:
    """Counts per activity from counts per dataset."""
    counts = ("success", "running", "failure")
    return (
        outputs.join(per_dataset, "dataset", "left")
        .groupBy("pipeline", "position", "activity")
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts])
    )


# --- runs ------------------------------------------------------------------

_SLICE = ("dataset", "slice_start")


def slice_runs(slices: DataFrame, runs: DataFrame) -> DataFrame:
    """Every slice with its runs, or without any."""
    return slices.join(runs, list(_SLICE), "left")


def runs_of(runs: DataFrame, dataset: Column, start: Column) -> DataFrame:
    """Runs of one dataset at one slice start."""
    return runs.where((F.col("dataset") == dataset) & (F.col("slice_start") == start))


def last_execution(runs: DataFrame, *keep: str) -> DataFrame:
    """The newest run per slice and whether there were several."""
    newest = F.max_by(F.struct(*keep), F.struct("processing_start", "id"))
    return (
        runs.groupBy(*_SLICE)
        .agg(newest.alias("_r"), F.count("*").alias("executions"))
        .select(*_SLICE, "_r.*", "executions", (F.col("executions") > 1).alias("view_all"))
    )


def run_detail(runs: DataFrame) -> DataFrame:
    """Display form of a run: optional fields only where they apply."""
    message = F.col("error_message")
    return runs.select(
        "id",
        "dataset",
        "status",
        "type",
        display(F.col("processing_start")).alias("started"),
        display(F.col("processing_end")).alias("ended"),
        "percent_complete",
        "retry_attempt",
        flag_text(F.col("has_logs")).alias("has_logs"),
        F.when(F.length(message) > 0, message).alias("error_message"),
        F.when(F.col("has_logs"), F.concat(F.lit("logs/"), F.col("id").cast("string"))).alias("logs_link"),
    )


def newest_first(df: DataFrame, ts: str, *tie: str) -> DataFrame:
    return df.orderBy(F.desc(ts), *tie)


def page_after(df: DataFrame, ts: str, tie: str, seen: tuple | None = None, size: int = 10) -> DataFrame:
    """The page that follows the last row seen, newest first, then by ``tie``.

    A deep page costs what the first costs: the bound reaches the scan, and no
    task keeps the rows of earlier pages.
    """
    if size not in PAGE_SIZES:
        raise ValueError(f"page size must be one of {PAGE_SIZES}")
    if seen is not None:
        last, key = F.lit(seen[0]), F.lit(seen[1])
        df = df.where((F.col(ts) <= last) & ((F.col(ts) < last) | (F.col(tie) > key)))
    return newest_first(df, ts, tie).limit(size)


def page(ordered: DataFrame, size: int = 10, number: int = 1) -> DataFrame:
    """One page of an ordered result; the order must be unique."""
    if size not in PAGE_SIZES:
        raise ValueError(f"page size must be one of {PAGE_SIZES}")
    return ordered.offset(size * (number - 1)).limit(size)


# --- log files -------------------------------------------------------------


def listed_files(
    files: DataFrame, host: Column, container: Column, token: Column, most: int | None = None, after: str | None = None
) -> DataFrame:
    """The files of a listing that hold data, with links.

    With ``most`` a page of them by name, which starts behind ``after``.
    """
    held = files.where("length > 0")
    if after is not None:
        held = held.where(F.col("name") > after)
    if most is not None:
        held = held.orderBy("name").limit(most)
    return held.select("name", file_url(host, container, F.col("name"), token).alias("url"))


def run_files(runs: DataFrame, files: DataFrame) -> DataFrame:
    """Non-empty log files of each run."""
    held = files.where("length > 0")
    return runs.join(held, runs["id"] == held["run_id"]).select("run_id", "name", "url")


def instance_links(runs: DataFrame) -> DataFrame:
    """A link to the load log of each run's instance."""
    return runs.select(
        F.col("id").alias("run_id"),
        F.col("instance_id").alias("name"),
        F.concat(F.lit("/instance?instanceId="), F.col("instance_id")).alias("url"),
    )


def run_log_files(runs: DataFrame, files: DataFrame) -> DataFrame:
    """Everything to download for a run: its files and its instance log."""
    return run_files(runs, files).unionByName(instance_links(runs))
