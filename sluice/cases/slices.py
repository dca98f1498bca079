"""Time slices: assignment, rounding, calendar, gaps, readiness and state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.cases import case
from sluice.cases.feeds import stamp, table
from sluice.functions.dates import (
    INSTANCE_PATTERN,
    display,
    instance_id,
    iso_from_millis,
    millis_from_iso,
    newest_first_key,
    round_slice,
    slice_folder,
)
from sluice.functions.text import log_key, pad_count, path_join
from sluice.operators.slices import (
    arrivals,
    assign,
    calendar_of,
    gap_report,
    latest_state,
    oldest_first,
    readiness,
)

_STAMP = "'%Y-%m-%d %H:%M:%S'"
_END = "time_bucket(interval 30 minutes, ts) + interval 30 minutes"


@case("slice_assign", f"select event_id, strftime({_END}, {_STAMP}) as slice_end from events")
def slice_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    slices = assign(table(spark, sf_dir, "events"), "ts")
    return slices.select("event_id", stamp(F.col("slice_end")).alias("slice_end"))


def _rounding(name: str, round_to: int, offset: int, sql: str) -> None:
    @case(name, f"select event_id, strftime({sql}, {_STAMP}) as slice from events")
    def rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
        return table(spark, sf_dir, "events").select(
            "event_id", stamp(round_slice(F.col("ts"), round_to, offset)).alias("slice")
        )


_MINUTE = "date_trunc('minute', ts)"
_rounding(
    "slice_round_up",
    15,
    0,
    f"{_MINUTE} + to_minutes((15 - cast(minute({_MINUTE}) as integer) % 15) % 15)",
)
_rounding("slice_round_down", -30, 0, "time_bucket(interval 30 minutes, ts)")
_rounding(
    "slice_round_hour",
    60,
    20,
    "date_trunc('hour', date_trunc('minute', ts + interval 20 minutes) + interval 59 minutes)",
)
_rounding("slice_round_none", 0, -5, "date_trunc('minute', ts - interval 5 minutes)")

_GAPS = f"""
arrived as (select {_END} as slice_end from events),
calendar as (
  select unnest(generate_series(min(s), max(s), interval 30 minutes)) as slice_end
  from (select {_END} as s from events))
"""


@case(
    "slice_gaps",
    f"""with {_GAPS}, counted as (select slice_end, count(*) as n from arrived group by slice_end)
    select strftime(c.slice_end, {_STAMP}) as slice_end, coalesce(n, 0) as n, n is null as missing
    from calendar c left join counted using (slice_end)""",
)
def slice_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices of the whole period, with and without events."""
    events = table(spark, sf_dir, "events")
    seen = arrivals(events, "ts")
    report = gap_report(calendar_of(events, "ts"), seen)
    return report.withColumn("slice_end", stamp(F.col("slice_end")))


@case(
    "slice_ready",
    f"""with {_GAPS}, present as (
      select {_END} as slice_end, bool_or(event_type = 'purchase') as p, bool_or(event_type = 'click') as c,
        bool_or(event_type = 'view') as v
      from events group by 1)
    select strftime(k.slice_end, {_STAMP}) as slice_end,
      array_to_string(list_filter([case when not coalesce(p, false) then 'purchase' end,
        case when not coalesce(c, false) then 'click' end,
        case when not coalesce(v, false) then 'view' end], lambda x: x is not null), ',') as missing,
      coalesce(p and c and v, false) as ready
    from calendar k left join present using (slice_end)""",
)
def slice_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices that have purchases, clicks and views; the other types are optional."""
    events = table(spark, sf_dir, "events")
    ready = readiness(
        calendar_of(events, "ts"), assign(events, "ts"), "event_type", ("purchase", "click", "view")
    )
    return ready.select(
        stamp(F.col("slice_end")).alias("slice_end"), F.array_join("missing", ",").alias("missing"), "ready"
    )


@case(
    "oldest_slice",
    f"""with s as (select {_END} as slice_end, count(*) as n from events group by 1)
    select strftime(slice_end, {_STAMP}) as slice_end, n from s""",
)
def oldest_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All slices, those due first in front."""
    due = oldest_first(arrivals(table(spark, sf_dir, "events"), "ts"))
    return due.select(stamp(F.col("slice_end")).alias("slice_end"), "n")


@case(
    "latest_state",
    f"""select user_id, strftime(time_bucket(interval 30 minutes, ts), {_STAMP}) as slice_start,
      arg_max(event_type, (ts, event_id)) as state, arg_max(value, (ts, event_id)) as value
    from events group by user_id, time_bucket(interval 30 minutes, ts)""",
)
def latest_slice_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = assign(table(spark, sf_dir, "events"), "ts").withColumnRenamed("event_type", "state")
    newest = latest_state(
        events, ["user_id", "slice_end"], F.struct("ts", "event_id"), "state", "value"
    )
    start = F.col("slice_end") - F.expr("interval 30 minutes")
    return newest.select("user_id", stamp(start).alias("slice_start"), "state", "value")


@case(
    "instance_id",
    """select event_id, 'C' || user_id || '-' || event_type || '-' || strftime(ts, '%Y%m%dT%H%M') as instance_id,
      'input-' || strftime(ts, '%Y%m%d%H%M') as folder, 'hourly/hourly-' || strftime(ts, '%Y%m%dT%H%M') as path
    from events""",
)
def instance_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    customer = F.concat(F.lit("C"), F.col("user_id").cast("string"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        instance_id(customer, F.col("event_type"), ts).alias("instance_id"),
        slice_folder("input-", ts).alias("folder"),
        path_join(F.lit("hourly/"), slice_folder("/hourly-", ts, INSTANCE_PATTERN)).alias("path"),
    )


@case(
    "log_keys",
    """select event_id, printf('job%d-%04d', user_id, event_id) as log_key,
      strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') as assoc_day,
      9223372036854775807 - epoch_us(ts) // 1000 as newest_first,
      case when length(cast(event_id as varchar)) >= 2 then cast(event_id as varchar)
           else lpad(cast(event_id as varchar), 2, '0') end as padded
    from events""",
)
def log_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = F.concat(F.lit("job"), F.col("user_id").cast("string"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        log_key(job, F.col("event_id")).alias("log_key"),
        stamp(F.date_trunc("day", "ts")).alias("assoc_day"),
        newest_first_key(F.col("ts")).alias("newest_first"),
        pad_count(F.col("event_id")).alias("padded"),
    )


@case(
    "display_dates",
    """select event_id, strftime(ts, '%-m-%-d-%y %-H:%M:%S') || ' UTC' as shown,
      strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.0000000' as iso, epoch_us(ts) // 1000 as millis
    from events""",
)
def display_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    iso7 = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("7Z"))
    millis = millis_from_iso(iso7)
    return events.select(
        "event_id", display(F.col("ts")).alias("shown"), iso_from_millis(millis).alias("iso"), millis.alias("millis")
    )
