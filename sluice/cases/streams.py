"""File streams that run until their input is used up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.cases import case
from sluice.cases.feeds import RUNS, customer_lines, customer_spec, run_records, stamp, table
from sluice.operators.slices import assign
from sluice.session import work_dir
from sluice.streaming.ingest import ingest, line_stream, table_stream, write_batches
from sluice.streaming.late import closed_slices, count_slices, slice_counts
from sluice.streaming.state import current_states, slice_states, use_state_store, write_states


@case(
    "stream_slices",
    """select strftime(time_bucket(interval 30 minutes, ts) + interval 30 minutes, '%Y-%m-%d %H:%M:%S') as slice_end,
      count(*) as n from events group by 1""",
)
def stream_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events assigned to slices batch by batch; counts add up over batches."""
    where = work_dir(spark, "stream")
    events = table(spark, sf_dir, "events")
    stream = table_stream(spark, f"{sf_dir}/events.parquet", events.schema)

    def counts(batch: DataFrame) -> DataFrame:
        return assign(batch, "ts").groupBy("slice_end").agg(F.count("*").alias("n"))

    write_batches(stream, counts, f"{where}/out", f"{where}/checkpoint", once=True).awaitTermination()
    written = spark.read.schema("slice_end timestamp, n bigint, batch int").parquet(f"{where}/out")
    return written.groupBy(stamp(F.col("slice_end")).alias("slice_end")).agg(F.sum("n").alias("n"))


@case(
    "stream_ingest",
    """select c_mktsegment as segment, count(*) filter (c_acctbal >= 0) as good,
      count(*) filter (c_acctbal < 0) as rejected from customer group by c_mktsegment""",
)
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faulty customer files through the stream: good rows and quarantine per segment."""
    where = work_dir(spark, "ingest")
    faulty = customer_lines(spark, sf_dir, width_faults=True, type_faults=True)
    # Blank lines carry no segment; they stand for the automobile customers.
    faulty.select("value").write.text(f"{where}/in")
    query = ingest(
        line_stream(spark, f"{where}/in"), customer_spec(), lambda good: good, f"{where}/out", f"{where}/cp", once=True
    )
    query.awaitTermination()
    good = spark.read.parquet(f"{where}/out/good").groupBy("segment").agg(F.count("*").alias("good"))
    raw = F.col("raw")
    segment = F.when(raw == "", "AUTOMOBILE").otherwise(F.regexp_extract(raw, r', ""([A-Z]+)"""', 1))
    rejected = (
        spark.read.parquet(f"{where}/out/quarantine")
        .groupBy(segment.alias("segment"))
        .agg(F.count("*").alias("rejected"))
    )
    return good.join(rejected, "segment", "full").select(
        "segment", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("rejected", F.lit(0)).alias("rejected")
    )


# --- events fed out of order --------------------------------------------------------

# Events come in waves of eight days; every seventh comes one wave later.
WAVES = """
fed as (
  select *, time_bucket(interval 30 minutes, ts) + interval 30 minutes as slice_end,
    (epoch_us(ts) - epoch_us(timestamp '2024-01-01')) // 691200000000 + case when event_id % 7 = 0 then 1 else 0 end as wave
  from events),
marks as (
  select wave, max(max(ts)) over (order by wave rows between unbounded preceding and 1 preceding) - interval 1 hour as mark
  from fed group by wave),
judged as (
  select fed.*, coalesce(slice_end <= mark, false) as is_late,
    slice_end <= (select max(ts) from events) - interval 1 hour as closed from fed join marks using (wave))
"""


def waves(events: DataFrame) -> DataFrame:
    days = F.expr("(unix_micros(cast(ts as timestamp)) - unix_micros(timestamp'2024-01-01 00:00:00Z')) div 691200000000")
    return events.withColumn("wave", (days + F.when(F.col("event_id") % 7 == 0, 1).otherwise(0)).cast("int"))


def feed_waves(events: DataFrame, folder: str) -> list[int]:
    """Each wave as files below a staging folder; returns the waves in order."""
    waves(events).write.partitionBy("wave").parquet(folder)
    return sorted(r["wave"] for r in events.sparkSession.read.parquet(folder).select("wave").distinct().collect())


@case(
    "late_slices",
    f"""with {WAVES}
    select strftime(slice_end, '%Y-%m-%d %H:%M:%S') as slice_end, count(*) filter (not is_late) as n,
      count(*) filter (is_late) as late, bool_or(closed) as closed from judged group by 1""",
)
def late_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events fed out of order: on-time and late rows of each slice; the query starts anew for every wave."""
    where = work_dir(spark, "late")
    events = table(spark, sf_dir, "events")
    for wave in feed_waves(events, f"{where}/staged"):
        spark.read.parquet(f"{where}/staged/wave={wave}").write.mode("append").parquet(f"{where}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{where}/in")
        count_slices(stream, "ts", f"{where}/out", f"{where}/checkpoint", once=True).awaitTermination()
    counted = slice_counts(spark, f"{where}/out")
    return counted.select(stamp(F.col("slice_end")).alias("slice_end"), "n", "late", "closed")


@case(
    "late_rows",
    f"""with {WAVES} select event_id, strftime(slice_end, '%Y-%m-%d %H:%M:%S') as slice_end,
      strftime(mark, '%Y-%m-%d %H:%M:%S') as watermark from judged join marks using (wave) where is_late""",
)
def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The late events themselves, with the watermark each of them missed."""
    where = work_dir(spark, "late-rows")
    events = table(spark, sf_dir, "events")
    for wave in feed_waves(events, f"{where}/staged"):
        spark.read.parquet(f"{where}/staged/wave={wave}").write.mode("append").parquet(f"{where}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{where}/in")
        count_slices(stream, "ts", f"{where}/out", f"{where}/checkpoint", once=True).awaitTermination()
    late = spark.read.parquet(f"{where}/out/late")
    return late.select("event_id", stamp(F.col("slice_end")).alias("slice_end"), stamp(F.col("watermark")).alias("watermark"))


@case(
    "closed_slices",
    f"""with {WAVES}
    select strftime(slice_end, '%Y-%m-%d %H:%M:%S') as slice_end, count(*) as n
    from judged where closed and not is_late group by 1""",
)
def watermarked_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same feed through a watermark: each slice once, when it is closed, without its late rows."""
    where = work_dir(spark, "closed")
    events = table(spark, sf_dir, "events")
    for wave in feed_waves(events, f"{where}/staged"):
        spark.read.parquet(f"{where}/staged/wave={wave}").write.mode("append").parquet(f"{where}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{where}/in")
        closed = closed_slices(stream, "ts")
        write_batches(closed, lambda batch: batch, f"{where}/out", f"{where}/checkpoint", once=True).awaitTermination()
    found = spark.read.schema("slice_end timestamp, n bigint").parquet(f"{where}/out")
    return found.select(stamp(F.col("slice_end")).alias("slice_end"), "n")


@case(
    "slice_state_stream",
    f"""with {RUNS}
    select dataset, strftime(date_trunc('day', slice_start), '%Y-%m-%d %H:%M:%S') as day,
      arg_max(status, (processing_start, id)) as status, count(*) - 1 as retries,
      strftime(max(processing_start), '%Y-%m-%d %H:%M:%S') as updated
    from runs group by 1, 2""",
)
def slice_state_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs in three batches, newest first, over two starts of the query: the state each daily slice ends in."""
    where = work_dir(spark, "state")
    use_state_store(spark)
    runs = run_records(spark, sf_dir).withColumn("day", F.date_trunc("day", "slice_start"))
    wave = F.when(F.dayofmonth("day") > 10, F.col("id") % 3).otherwise(F.lit(2)).cast("int")
    runs.withColumn("wave", wave).write.partitionBy("wave").parquet(f"{where}/staged")
    keys = ["dataset", "day"]
    for started in ((2,), (1, 0)):
        for wave in started:
            spark.read.parquet(f"{where}/staged/wave={wave}").write.mode("append").parquet(f"{where}/in")
        stream = spark.readStream.schema(runs.schema).option("maxFilesPerTrigger", 16).parquet(f"{where}/in")
        states = slice_states(stream, keys, "status", "processing_start", "id")
        write_states(states, f"{where}/out", f"{where}/checkpoint", once=True).awaitTermination()
    found = current_states(spark, f"{where}/out", states.schema, keys)
    return found.select("dataset", stamp(F.col("day")).alias("day"), "status", "retries", stamp(F.col("updated")).alias("updated"))
