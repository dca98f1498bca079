"""Log entries around an entry: five minutes before through five minutes after."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.dates import as_timestamp

WINDOW_SECONDS = 300


def around(logs: DataFrame, ts: str, at: Column, seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Entries around one moment: a literal or a scalar subquery.  A plain range
    filter, so it reaches the scan."""
    gap = F.make_dt_interval(secs=F.lit(seconds))
    return logs.where((F.col(ts) >= at - gap) & (F.col(ts) <= at + gap))


def around_any(logs: DataFrame, anchors: DataFrame, ts: str, seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Entries with at least one anchor in their window, each once.

    Time is cut into buckets as wide as the window.  An anchor in the entry's
    own bucket is always near enough; in the bucket before only the last
    anchor matters, in the bucket after only the first.  So anchors shrink to
    one row per bucket before the join, whatever their number, and no pairs
    are formed.
    """
    width = seconds * 1_000_000
    micros = F.unix_micros(as_timestamp(F.col(ts)))
    edges = (
        anchors.select(micros.alias("_t"))
        .groupBy(F.expr(f"(_t - pmod(_t, {width})) div {width}").alias("_bucket"))
        .agg(F.min("_t").alias("_first"), F.max("_t").alias("_last"))
    )
    # What a bucket's anchors say to the entries of a bucket: own, one later, one earlier.
    nothing = F.lit(None).cast("bigint")

    def offer(bucket: Column, own: bool, before: Column, after: Column) -> Column:
        return F.struct(
            bucket.alias("_bucket"), F.lit(own).alias("_own"), before.alias("_before"), after.alias("_after")
        )

    offers = edges.select(
        F.inline(
            F.array(
                offer(F.col("_bucket"), True, nothing, nothing),
                offer(F.col("_bucket") + 1, False, F.col("_last"), nothing),
                offer(F.col("_bucket") - 1, False, nothing, F.col("_first")),
            )
        )
    )
    near = offers.groupBy("_bucket").agg(
        F.bool_or("_own").alias("_own"), F.max("_before").alias("_before"), F.min("_after").alias("_after")
    )
    hit = F.col("_own") | (F.col("_t") - F.col("_before") <= width) | (F.col("_after") - F.col("_t") <= width)
    return (
        logs.withColumn("_t", micros)
        .withColumn("_bucket", F.expr(f"(_t - pmod(_t, {width})) div {width}"))
        .join(near, "_bucket")
        .where(hit)
        .select(*logs.columns)
    )


def nearest(
    logs: DataFrame, ts: str, entry: str, anchor: Column, seconds: int = WINDOW_SECONDS
) -> DataFrame:
    """``logs`` with the nearest anchor before and after each entry, at most ``seconds`` away.

    Adds ``before`` and ``after``: the anchor's id in ``entry`` and its
    distance in microseconds, null where there is none.  Entries are ordered by
    time, then by id; an anchor is not its own neighbour.  Entries without a
    time have none.

    Time is cut into chunks as wide as the reach.  Within a chunk a window
    carries the last anchor on and the next one back; from the chunks on either
    side only the last and the first anchor can be near enough, one small row a
    chunk.  So no pairs are formed, and no window is wider than a chunk.
    """
    width = seconds * 1_000_000
    micros = F.unix_micros(as_timestamp(F.col(ts)))
    bucket = F.expr(f"(_t - pmod(_t, {width})) div {width}")
    timed = logs.withColumn("_t", micros).withColumn("_chunk", bucket)
    mark = F.when(anchor, F.struct(F.col("_t").alias("t"), F.col(entry).alias("id")))
    marked = timed.withColumn("_mark", mark)
    edges = marked.where(F.col("_mark").isNotNull() & F.col("_t").isNotNull()).groupBy("_chunk").agg(
        F.min("_mark").alias("_first"), F.max("_mark").alias("_last")
    )
    earlier = edges.select((F.col("_chunk") + 1).alias("_chunk"), F.col("_last").alias("_carried"))
    later = edges.select((F.col("_chunk") - 1).alias("_chunk"), F.col("_first").alias("_ahead"))
    # Entries without a time have no neighbours and need not meet.
    apart = F.when(F.col("_t").isNull(), F.xxhash64(entry))
    own = Window.partitionBy("_chunk", apart).orderBy("_t", entry)
    inside = marked.withColumn(
        "_before", F.last("_mark", ignorenulls=True).over(own.rowsBetween(Window.unboundedPreceding, -1))
    ).withColumn("_after", F.first("_mark", ignorenulls=True).over(own.rowsBetween(1, Window.unboundedFollowing)))
    near = inside.join(earlier, "_chunk", "left").join(later, "_chunk", "left")
    before, after = F.coalesce("_before", "_carried"), F.coalesce("_after", "_ahead")

    def found(at: Column, gap: Column) -> Column:
        return F.when(gap <= width, F.struct(at["id"].alias("id"), gap.alias("gap")))

    return near.select(
        *logs.columns,
        found(before, F.col("_t") - before["t"]).alias("before"),
        found(after, after["t"] - F.col("_t")).alias("after"),
    )
