"""The status page: what a caller's pipelines did lately."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import pad_count
from sluice.operators.monitor import (
    accessible,
    activities,
    activity_counts,
    activity_outputs,
    look_back,
)


def pipeline_status(pipelines: DataFrame, allowed: DataFrame, slices: DataFrame, now: Column) -> DataFrame:
    """Padded counters per activity of the pipelines a caller may see."""
    outputs = activity_outputs(activities(accessible(pipelines, allowed)))
    counted = activity_counts(outputs, look_back(slices, "slice_start", now))
    return counted.select(
        "pipeline",
        "position",
        "activity",
        *[pad_count(F.col(c)).alias(c) for c in ("success", "running", "failure")],
    )
