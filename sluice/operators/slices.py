"""Time slices: assignment, calendar, gaps, readiness and state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.dates import as_timestamp, round_slice, slice_end

SLICE_MINUTES = 30


def assign(df: DataFrame, ts: str, minutes: int = SLICE_MINUTES, name: str = "slice_end") -> DataFrame:
    """Add the end of the slice each row belongs to."""
    return df.withColumn(name, slice_end(F.col(ts), minutes))


def arrival_slices(files: DataFrame, round_to: int, offset: int = 0) -> DataFrame:
    """Slice of each listed file by its arrival time; files stay where they are."""
    return files.withColumn("slice_end", round_slice(F.col("modified"), round_to, offset))


def calendar(bounds: DataFrame, start: str, end: str, minutes: int = SLICE_MINUTES) -> DataFrame:
    """Slice ends between start (inclusive) and end (exclusive), per row of bounds."""
    step = F.make_dt_interval(mins=F.lit(minutes))
    first, last = as_timestamp(F.col(start)), as_timestamp(F.col(end))
    starts = F.when(first < last, F.sequence(first, last - F.make_dt_interval(secs=F.lit(0.000001)), step))
    rest = [c for c in bounds.columns if c not in (start, end)]
    return bounds.select(*rest, F.explode(starts).alias("slice_start")).select(
        *rest, "slice_start", (F.col("slice_start") + step).alias("slice_end")
    )


def calendar_of(df: DataFrame, ts: str, minutes: int = SLICE_MINUTES) -> DataFrame:
    """Slices from the first to the last one seen in the data."""
    step = F.make_dt_interval(mins=F.lit(minutes))
    bounds = df.agg(
        (slice_end(F.min(ts), minutes) - step).alias("start"), slice_end(F.max(ts), minutes).alias("end")
    )
    return calendar(bounds, "start", "end", minutes)


def arrivals(df: DataFrame, ts: str, minutes: int = SLICE_MINUTES) -> DataFrame:
    """Rows per slice."""
    return assign(df, ts, minutes).groupBy("slice_end").agg(F.count("*").alias("n"))


def gap_report(slices: DataFrame, arrived: DataFrame) -> DataFrame:
    """Every slice of a calendar with its row count and whether it is missing."""
    return slices.join(arrived, "slice_end", "left").select(
        "slice_end", F.coalesce("n", F.lit(0)).alias("n"), F.col("n").isNull().alias("missing")
    )


def readiness(
    slices: DataFrame, arrived: DataFrame, dataset: str, required: Sequence[str]
) -> DataFrame:
    """Whether all required datasets have arrived, and which have not, per slice.

    Datasets outside the list are optional and never hold a slice back.  One
    flag per required dataset is combined before the shuffle, so slices and
    datasets are never multiplied out.
    """
    flags = [F.coalesce(F.bool_or(F.col(dataset) == r), F.lit(False)).alias(f"_has{i}") for i, r in enumerate(required)]
    present = arrived.where(F.col(dataset).isin(*required)).groupBy("slice_end").agg(*flags)
    has = [F.coalesce(F.col(f"_has{i}"), F.lit(False)) for i in range(len(required))]
    missing = F.array_compact(F.array(*[F.when(~h, F.lit(r)) for h, r in zip(has, required, strict=True)]))
    return (
        slices.join(present, "slice_end", "left")
        .select("slice_end", missing.alias("missing"))
        .withColumn("ready", F.size("missing") == 0)
    )


def oldest_first(slices: DataFrame) -> DataFrame:
    return slices.orderBy("slice_end")


def latest_state(updates: DataFrame, keys: Sequence[str], order: Column, *state: str) -> DataFrame:
    """The newest state per key; combined before the shuffle, so hot keys stay cheap."""
    newest = F.max_by(F.struct(*state), order)
    return updates.groupBy(*keys).agg(newest.alias("_s")).select(*keys, "_s.*")
