"""Event-time slices of a stream, with rows that come too late kept apart and counted.

The watermark of a batch is the newest event time of all batches before it,
less the allowed delay.  A slice whose end it has passed is closed: rows of it
that still arrive are late.  They never change a count that was final.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.functions.dates import as_timestamp
from sluice.operators.slices import SLICE_MINUTES, assign
from sluice.session import configure
from sluice.streaming.ingest import start_batches

DELAY_SECONDS = 3600

_COUNTS = "slice_end timestamp, n bigint, late bigint, batch int"
_MARK = "watermark timestamp, newest timestamp"


def closed_slices(
    stream: DataFrame, ts: str, minutes: int = SLICE_MINUTES, delay: int = DELAY_SECONDS
) -> DataFrame:
    """slice_end and n of each slice, once, when the watermark has passed its end.

    Counts are kept in the query's state until then, combined before the
    shuffle.  Late rows are dropped; ``count_slices`` keeps them.
    """
    timed = stream.withColumn("_at", as_timestamp(F.col(ts))).withWatermark("_at", f"{delay} seconds")
    counts = timed.groupBy(F.window("_at", f"{minutes} minutes").alias("_w")).agg(F.count("*").alias("n"))
    return counts.select(F.col("_w.end").alias("slice_end"), "n")


def _mark(spark: SparkSession, out: str, batch_id: int) -> tuple:
    """Watermark and newest time as the batch before this one left them."""
    if batch_id == 0:
        return None, None
    row = spark.read.schema(_MARK).parquet(f"{out}/marks/batch={batch_id - 1}").first()
    return row["watermark"], row["newest"]


def count_slices(
    stream: DataFrame,
    ts: str,
    out: str,
    checkpoint: str,
    minutes: int = SLICE_MINUTES,
    delay: int = DELAY_SECONDS,
    once: bool = False,
) -> StreamingQuery:
    """Count the rows of each slice batch by batch; late rows go whole to a table of their own.

    Below ``out``: ``counts`` (slice_end, n, late; one row per batch and slice,
    combined before the shuffle), ``late`` (all columns of late rows, with
    their slice and the watermark they missed) and ``marks`` (the watermark
    after each batch).  Every batch overwrites its own folders and takes its
    watermark from the batch before it, so one that runs again after a failure
    comes to the same verdicts.  Rows without a time belong to no slice and are
    kept with the late ones.  The batch is read again for late rows only when
    its counts say that there are any.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = configure(batch.sparkSession)
        watermark, newest = _mark(spark, out, batch_id)
        mark = F.lit(watermark).cast("timestamp")
        timed = assign(batch, ts, minutes).withColumn("_at", as_timestamp(F.col(ts)))
        late = F.coalesce(F.col("slice_end") <= mark, F.col("slice_end").isNull())
        counts = timed.groupBy("slice_end").agg(
            F.count_if(~late).alias("n"), F.count_if(late).alias("late"), F.max("_at").alias("newest")
        )
        counts.write.mode("overwrite").parquet(f"{out}/counts/batch={batch_id}")
        written = spark.read.schema("late bigint, newest timestamp").parquet(f"{out}/counts/batch={batch_id}")
        facts = written.agg(F.sum("late").alias("late"), F.max("newest").alias("newest")).first()
        if facts["late"]:
            kept = timed.where(late).drop("_at").withColumn("watermark", mark)
            kept.write.mode("overwrite").parquet(f"{out}/late/batch={batch_id}")
        newest = max((t for t in (newest, facts["newest"]) if t is not None), default=None)
        at = F.lit(newest).cast("timestamp")
        after = spark.range(1).select((at - F.make_dt_interval(secs=F.lit(delay))).alias("watermark"), at.alias("newest"))
        after.coalesce(1).write.mode("overwrite").parquet(f"{out}/marks/batch={batch_id}")

    return start_batches(stream, handle, checkpoint, once)


def slice_counts(spark: SparkSession, out: str) -> DataFrame:
    """slice_end, n, late, closed of every slice seen so far, from what ``count_slices`` wrote.

    A slice is closed once the newest watermark has passed it; its ``n`` is final then.
    """
    marks = spark.read.schema("watermark timestamp, batch int").parquet(f"{out}/marks")
    last = marks.agg(F.max_by("watermark", "batch")).first()[0]
    counts = spark.read.schema(_COUNTS).parquet(f"{out}/counts").groupBy("slice_end")
    sums = counts.agg(F.sum("n").alias("n"), F.sum("late").alias("late"))
    closed = F.coalesce(F.col("slice_end") <= F.lit(last).cast("timestamp"), F.lit(False))
    return sums.withColumn("closed", closed)
