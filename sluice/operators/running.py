"""Running totals whose windows stay small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_total(
    df: DataFrame, group: Sequence[str], order: str, value: str, name: str, chunk: Column
) -> DataFrame:
    """Add the total of ``value`` over earlier rows of the group.

    Rows are ordered by chunk, then by ``order``.  Totals are first taken per
    chunk, then within each chunk, so a large group never meets in one window.
    """
    before = (Window.unboundedPreceding, -1)
    keyed = df.withColumn("_chunk", chunk)
    keys = [*group, "_chunk"]
    sums = keyed.groupBy(*keys).agg(F.sum(value).alias("_sum"))
    across = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(*before)
    bases = sums.select(*keys, F.coalesce(F.sum("_sum").over(across), F.lit(0)).alias("_base"))
    within = Window.partitionBy(*keys).orderBy(order).rowsBetween(*before)
    inner = keyed.withColumn("_inner", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return (
        inner.join(bases, keys)
        .withColumn(name, F.col("_base") + F.col("_inner"))
        .drop("_chunk", "_base", "_inner")
    )
