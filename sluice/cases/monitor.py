"""Pipelines, slices, runs and log files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.cases import ORACLES, case
from sluice.cases.feeds import OUTPUTS, RUNS, pipeline_records, run_records, stamp, table
from sluice.functions.dates import instance_id
from sluice.functions.text import file_url, pad_count, url_container, url_host, url_token
from sluice.operators.associate import around, around_any, nearest
from sluice.operators.monitor import (
    activities,
    activity_counts,
    activity_outputs,
    activity_totals,
    dataset_members,
    drill_link,
    last_execution,
    listed_files,
    look_back,
    newest_first,
    of_datasets,
    page,
    page_after,
    run_detail,
    run_log_files,
    runs_of,
    slice_runs,
    status_counts,
    tagged_datasets,
)
from sluice.operators.rollup import add_runs, dataset_counts, refresh
from sluice.plans.status import pipeline_status
from sluice.session import work_dir
from sluice.sinks.tables import write_buckets
from sluice.sources.records import RUNS as RUN_SCHEMA
from sluice.sources.records import read_json, read_pipelines, read_slices_of

_STAMP = "'%Y-%m-%d %H:%M:%S'"
_COUNTS = """count(*) filter (status = 'Ready') as success,
  count(*) filter (status in ('PendingExecution', 'InProgress')) as running,
  count(*) filter (status = 'Failed') as failure"""


@case("status_rollup", f"with {RUNS} select dataset, {_COUNTS} from runs group by dataset")
def status_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_counts(run_records(spark, sf_dir), "dataset")


@case(
    "activity_rollup",
    f"""with {RUNS}, {OUTPUTS}, counts as (select dataset, {_COUNTS} from runs group by dataset)
    select pipeline, position, activity, cast(coalesce(sum(success), 0) as bigint) as success,
      cast(coalesce(sum(running), 0) as bigint) as running, cast(coalesce(sum(failure), 0) as bigint) as failure
    from outputs left join counts using (dataset) group by pipeline, position, activity""",
)
def activity_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    outputs = activity_outputs(activities(pipeline_records(spark, sf_dir)))
    return activity_counts(outputs, run_records(spark, sf_dir))


@case("activity_rollup_incremental", ORACLES["activity_rollup"])
def activity_rollup_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of runs: in the second, runs of the last ten days come again with what became of them."""
    stored, counts = work_dir(spark, "run-store"), work_dir(spark, "run-counts")
    runs = run_records(spark, sf_dir)
    recent = F.col("slice_start") >= _now(spark, sf_dir) - F.make_dt_interval(days=F.lit(10))
    status = F.when(recent, "PendingExecution").otherwise(F.col("status"))
    for batch, rows in enumerate((runs.withColumn("status", status), runs.where(recent))):
        add_runs(rows, stored, batch)
        refresh(spark, stored, counts, batch)
    outputs = activity_outputs(activities(pipeline_records(spark, sf_dir)))
    return activity_totals(outputs, dataset_counts(spark, counts))


def _padded(name: str) -> str:
    text = f"cast(cast(coalesce(sum({name}), 0) as bigint) as varchar)"
    return f"case when length({text}) >= 2 then {text} else lpad({text}, 2, '0') end as {name}"


@case(
    "pipeline_status",
    f"""with {RUNS}, {OUTPUTS}, recent as (
      select * from runs where slice_start >= (select max(ts) - interval 96 hours from events)
        and slice_start <= (select max(ts) from events)),
    counts as (select dataset, {_COUNTS} from recent group by dataset)
    select pipeline, position, activity, {_padded('success')}, {_padded('running')}, {_padded('failure')}
    from outputs left join counts using (dataset)
    where pipeline in (select 'pl-' || c_custkey from customer where c_mktsegment = 'BUILDING')
    group by pipeline, position, activity""",
)
def status_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of the pipelines of one market segment over the last 96 hours."""
    pipelines = pipeline_records(spark, sf_dir)
    allowed = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(
        F.concat(F.lit("pl-"), F.col("c_custkey").cast("string")).alias("name")
    )
    return pipeline_status(pipelines, allowed, run_records(spark, sf_dir), _now(spark, sf_dir))


def _now(spark: SparkSession, sf_dir: str):
    return table(spark, sf_dir, "events").select(F.max("ts").cast("timestamp")).scalar()


@case(
    "pipeline_catalog",
    """select 'pl-' || c_custkey as name, 'Copy,Normalize' as activities, 'ftp-' || c_custkey as input,
      'ds-' || (c_custkey + 1) || ',ds-' || c_nationkey as outputs from customer""",
)
def pipeline_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested pipeline documents written as JSON and read under their schema."""
    named = "transform({0}, d -> named_struct('name', d))"
    documents = pipeline_records(spark, sf_dir).selectExpr(
        "name",
        "named_struct('activities', transform(activities, a -> named_struct('name', a.name, 'type', a.type, "
        f"'inputs', {named.format('a.inputs')}, 'outputs', {named.format('a.outputs')}))) as properties",
    )
    where = work_dir(spark, "pipelines")
    documents.write.json(where)
    return read_pipelines(spark, where).select(
        "name",
        F.array_join("activities.name", ",").alias("activities"),
        F.col("activities")[0]["inputs"][0].alias("input"),
        F.array_join(F.col("activities")[1]["outputs"], ",").alias("outputs"),
    )


@case(
    "run_documents",
    f"""with {RUNS} select cast(id as varchar) as id, dataset, strftime(slice_start, {_STAMP}) as slice_start, status,
      has_logs from runs
    where slice_start >= timestamp '2024-01-10 00:00:00' and slice_start < timestamp '2024-01-20 00:00:00'""",
)
def run_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records as JSON lines, read under their schema and bounded by slice start."""
    where = work_dir(spark, "runs")
    run_records(spark, sf_dir).select(
        F.col("id").cast("string").alias("id"),
        "dataset",
        F.date_format("slice_start", "yyyy-MM-dd'T'HH:mm:ss.SSS'0000Z'").alias("dataSliceStart"),
        "status",
        F.col("has_logs").alias("hasLogs"),
    ).write.json(where)
    start = F.col("dataSliceStart")
    bounded = read_json(spark, where, RUN_SCHEMA).where(
        (start >= F.lit(datetime(2024, 1, 10))) & (start < F.lit(datetime(2024, 1, 20)))
    )
    return bounded.select(
        "id", "dataset", stamp(start).alias("slice_start"), "status", F.col("hasLogs").alias("has_logs")
    )


@case(
    "activity_edges",
    """select 'pl-' || c_custkey as pipeline, 1 as position, 'Copy' as activity, 'Normalize' as next_activity from customer
    union all select 'pl-' || c_custkey, 2, 'Normalize', null from customer""",
)
def activity_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = activities(pipeline_records(spark, sf_dir))
    return steps.select("pipeline", "position", "activity", "next_activity")


@case(
    "dataset_members",
    f"""with {OUTPUTS} select dataset, pipeline, activity, count(*) as times from outputs
    group by dataset, pipeline, activity""",
)
def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset_members(activity_outputs(activities(pipeline_records(spark, sf_dir))))


@case(
    "drill_links",
    """select 'pl-' || c_custkey as pipeline, 'Copy' as activity, 'ds-' || c_custkey as datasets from customer
    union all
    select 'pl-' || c_custkey, 'Normalize', 'ds-' || (c_custkey + 1) || ',ds-' || c_nationkey from customer""",
)
def drill_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drill_link(activities(pipeline_records(spark, sf_dir)))


@case(
    "padded_counts",
    "select o_custkey, case when count(*) >= 10 then cast(count(*) as varchar) "
    "else '0' || cast(count(*) as varchar) end as orders from orders group by o_custkey",
)
def padded_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return counted.select("o_custkey", pad_count(F.col("n")).alias("orders"))


@case(
    "lookback_96h",
    """select event_id, user_id, event_type from events
    where ts >= (select max(ts) - interval 96 hours from events) and ts <= (select max(ts) from events)""",
)
def lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    # The clock is a value of the request, so the bounds reach the scan.
    now = events.select(F.max("ts").cast("timestamp")).first()[0]
    recent = look_back(events, "ts", F.lit(now))
    return recent.select("event_id", "user_id", "event_type")


@case(
    "dataset_filter",
    "select event_id, event_type from events where event_type in ('purchase', 'error')",
)
def dataset_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = [name.strip() for name in "purchase, error".split(",")]
    return of_datasets(table(spark, sf_dir, "events"), wanted, "event_type").select("event_id", "event_type")


@case(
    "parameter_query",
    """select event_id, user_id, value from events
    where event_type = 'purchase' and ts >= timestamp '2024-01-10 12:00:00' and value >= 50.0""",
)
def parameter_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text with named parameters bound to values, not pasted in."""
    return spark.sql(
        "select event_id, user_id, value from {events} where event_type = :kind and ts >= :since and value >= :least",
        args={"kind": "purchase", "since": datetime(2024, 1, 10, 12), "least": 50.0},
        events=table(spark, sf_dir, "events"),
    )


@case(
    "tagged_union",
    "select event_id, event_type as dataset from events where event_type in ('click', 'view', 'signup', 'purchase', 'error')",
)
def union_of_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices of five datasets that share a table, in one scan."""
    kinds = ("click", "view", "signup", "purchase", "error")
    return tagged_datasets(table(spark, sf_dir, "events"), kinds, "event_type").select("event_id", "dataset")


@case(
    "last_execution",
    f"""with {RUNS} select dataset, strftime(slice_start, {_STAMP}) as slice_start,
      arg_max(id, (processing_start, id)) as id, arg_max(status, (processing_start, id)) as status,
      count(*) as executions, count(*) > 1 as view_all
    from runs group by dataset, runs.slice_start""",
)
def last_executions(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = last_execution(run_records(spark, sf_dir), "id", "status")
    return last.withColumn("slice_start", stamp(F.col("slice_start")))


@case(
    "multi_execution",
    f"""with {RUNS} select dataset, strftime(slice_start, {_STAMP}) as slice_start, count(*) as executions
    from runs group by dataset, runs.slice_start having count(*) > 1""",
)
def multi_execution(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = last_execution(run_records(spark, sf_dir), "id").where("view_all")
    return last.select("dataset", stamp(F.col("slice_start")).alias("slice_start"), "executions")


@case(
    "slice_runs",
    f"""with {RUNS}, slices as (select distinct dataset, slice_start from runs)
    select s.dataset, strftime(s.slice_start, {_STAMP}) as slice_start, coalesce(r.id, -1) as id, coalesce(r.status, 'none') as status
    from slices s left join runs r
      on r.dataset = s.dataset and r.slice_start = s.slice_start""",
)
def drill_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every slice with all its runs."""
    runs = run_records(spark, sf_dir)
    slices = runs.select("dataset", "slice_start").distinct()
    joined = slice_runs(slices, runs.select("dataset", "slice_start", "id", "status"))
    return joined.select(
        "dataset",
        stamp(F.col("slice_start")).alias("slice_start"),
        F.coalesce("id", F.lit(-1)).alias("id"),
        F.coalesce("status", F.lit("none")).alias("status"),
    )


@case("slice_runs_stored", ORACLES["slice_runs"])
def stored_drill_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices and runs laid out alike, so that drilling down moves no rows."""
    runs = run_records(spark, sf_dir).select("dataset", "slice_start", "id", "status")
    keys = ("dataset", "slice_start")
    tables = []
    for label, rows in (("slices", runs.select(*keys).distinct()), ("runs", runs)):
        where = work_dir(spark, label)
        tables.append(write_buckets(rows, where.rsplit("/", 1)[1].replace("-", "_"), where, 16, *keys))
    return slice_runs(*tables).select(
        "dataset",
        stamp(F.col("slice_start")).alias("slice_start"),
        F.coalesce("id", F.lit(-1)).alias("id"),
        F.coalesce("status", F.lit("none")).alias("status"),
    )


@case(
    "runs_of_slice",
    f"""with {RUNS}, latest as (select dataset, slice_start from runs order by processing_start desc, id desc limit 1)
    select id, status from runs
    where dataset = (select dataset from latest) and slice_start = (select slice_start from latest)""",
)
def runs_of_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the slice that ran last."""
    runs = run_records(spark, sf_dir)
    last = runs.agg(F.max_by(F.struct("dataset", "slice_start"), F.struct("processing_start", "id")).alias("at"))
    return runs_of(runs, last.select("at.dataset").scalar(), last.select("at.slice_start").scalar()).select(
        "id", "status"
    )


@case(
    "run_detail",
    f"""with {RUNS} select id, dataset, status, strftime(processing_start, '%-m-%-d-%y %-H:%M:%S') || ' UTC' as started,
      type, strftime(processing_end, '%-m-%-d-%y %-H:%M:%S') || ' UTC' as ended, percent_complete, retry_attempt,
      cast(has_logs as varchar) as has_logs, nullif(error_message, '') as error_message,
      case when has_logs then 'logs/' || id end as logs_link
    from runs""",
)
def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_detail(run_records(spark, sf_dir))


@case(
    "newest_runs_page",
    f"with {RUNS} select id, dataset from runs order by processing_start desc, id limit 50 offset 50",
)
def newest_runs_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = newest_first(run_records(spark, sf_dir), "processing_start", "id")
    return page(ordered, size=50, number=2).select("id", "dataset")


@case(
    "top_slices_page",
    f"""with {RUNS} select strftime(slice_start, {_STAMP}) as slice_start, count(*) as n
    from runs group by runs.slice_start order by runs.slice_start desc limit 25""",
)
def top_slices_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = run_records(spark, sf_dir).groupBy("slice_start").agg(F.count("*").alias("n"))
    first = page(newest_first(counted, "slice_start"), size=25)
    return first.select(stamp(F.col("slice_start")).alias("slice_start"), "n")


@case(
    "associated_logs",
    """select distinct e.event_id, e.event_type from events e join (select ts from events where event_type = 'error') a
      on e.ts between a.ts - interval 5 minutes and a.ts + interval 5 minutes""",
)
def associated_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events within five minutes of any error."""
    events = table(spark, sf_dir, "events")
    near = around_any(events, events.where("event_type = 'error'"), "ts")
    return near.select("event_id", "event_type")


@case(
    "associated_entry",
    """with a as (select max(ts) as latest from events where event_type = 'error')
    select event_id, event_type from events, a
    where ts between latest - interval 5 minutes and latest + interval 5 minutes""",
)
def associated_entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events around the latest error."""
    events = table(spark, sf_dir, "events")
    at = events.where("event_type = 'error'").select(F.max("ts")).scalar()
    return around(events, "ts", at).select("event_id", "event_type")


@case(
    "url_parts",
    """select page_id, 'https://' || split_part(split_part(url, '?', 1), '/', 3) as host,
      nullif(split_part(split_part(url, '?', 1), '/', 4), '') as container,
      nullif(split_part(url || '?v=' || page_id, '?', 2), '') as token,
      'https://' || split_part(split_part(url, '?', 1), '/', 3) || '/logs/page-' || page_id || '?v=' || page_id as link
    from pages""",
)
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("page_id").cast("string")
    signed = table(spark, sf_dir, "pages").withColumn("signed", F.concat("url", F.lit("?v="), key))
    address = F.col("signed")
    return signed.select(
        "page_id",
        url_host(address).alias("host"),
        F.nullif(url_container(address), F.lit("")).alias("container"),
        F.nullif(url_token(address), F.lit("")).alias("token"),
        file_url(
            url_host(address), F.lit("logs"), F.concat(F.lit("page-"), key), F.concat(F.lit("v="), key)
        ).alias("link"),
    )


@case(
    "log_listing",
    """with listed as (select 'page-' || lpad(cast(page_id as varchar), 8, '0') as name, length(html) as n from pages)
    select name, 'https://store/logs/' || name || '?t=1' as url from listed where n > 0""",
)
def log_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links to all log files that hold data."""
    files = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("page-"), F.lpad(F.col("page_id").cast("string"), 8, "0")).alias("name"),
        F.length("html").alias("length"),
    )
    return listed_files(files, F.lit("https://store"), F.lit("logs"), F.lit("t=1"))


@case(
    "log_listing_page",
    """with listed as (select 'page-' || lpad(cast(page_id as varchar), 8, '0') as name, length(html) as n from pages)
    select name, 'https://store/logs/' || name || '?t=1' as url from listed where n > 0 and name > 'page-00000020'
    order by name limit 100""",
)
def log_listing_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hundred files that follow the last one seen."""
    files = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("page-"), F.lpad(F.col("page_id").cast("string"), 8, "0")).alias("name"),
        F.length("html").alias("length"),
    )
    return listed_files(files, F.lit("https://store"), F.lit("logs"), F.lit("t=1"), most=100, after="page-00000020")


@case(
    "newest_runs_after",
    f"""with {RUNS}, seen as (select processing_start as s, id as i from runs order by processing_start desc, id limit 1 offset 49)
    select id, dataset from runs, seen where processing_start < s or (processing_start = s and id > i)
    order by processing_start desc, id limit 50""",
)
def newest_runs_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page behind the last row of the first page."""
    runs = run_records(spark, sf_dir)
    last = page_after(runs, "processing_start", "id", size=50).select("processing_start", "id").tail(1)[0]
    return page_after(runs, "processing_start", "id", tuple(last), size=50).select("id", "dataset")


@case(
    "slice_documents",
    f"""with {RUNS} select dataset, strftime(slice_start, {_STAMP}) as slice_start, status, retry_attempt as retries from runs
    where slice_start >= timestamp '2024-01-10 00:00:00' and slice_start < timestamp '2024-01-20 00:00:00'""",
)
def slice_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slice documents as JSON lines, read under their schema and bounded by start."""
    where = work_dir(spark, "slices")
    run_records(spark, sf_dir).select(
        "dataset",
        F.date_format("slice_start", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("start"),
        "status",
        F.col("retry_attempt").alias("retryCount"),
    ).write.json(where)
    read = read_slices_of(spark, where, F.lit(datetime(2024, 1, 10)), F.lit(datetime(2024, 1, 20)))
    return read.select("dataset", stamp(F.col("start")).alias("slice_start"), "status", F.col("retryCount").alias("retries"))


@case(
    "run_log_files",
    """with r as (select event_id as id, 'C' || user_id || '-Normalize-' || strftime(ts, '%Y%m%dT%H%M') as instance_id
      from events)
    select p.page_id as run_id, 'stderr' as name, p.url from pages p join r on r.id = p.page_id where length(p.html) > 0
    union all select id, instance_id, '/instance?instanceId=' || instance_id from r""",
)
def run_files_and_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All runs with their log files and a link to their instance log."""
    runs = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        instance_id(
            F.concat(F.lit("C"), F.col("user_id").cast("string")), F.lit("Normalize"), F.col("ts")
        ).alias("instance_id"),
    )
    files = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("run_id"), F.lit("stderr").alias("name"), "url", F.length("html").alias("length")
    )
    return run_log_files(runs, files)


@case(
    "nearest_errors",
    """with e as (select event_id, ts, case when event_type = 'error' then {'id': event_id, 'ts': ts} end as mark from events),
    n as (select event_id, ts,
        last_value(mark ignore nulls) over (order by ts, event_id rows between unbounded preceding and 1 preceding) as b,
        first_value(mark ignore nulls) over (order by ts, event_id rows between 1 following and unbounded following) as a from e)
    select event_id, case when ts - b.ts <= interval 5 minutes then b.id else -1 end as error_before,
      case when ts - b.ts <= interval 5 minutes then epoch_us(ts) - epoch_us(b.ts) else -1 end as micros_since,
      case when a.ts - ts <= interval 5 minutes then a.id else -1 end as error_after,
      case when a.ts - ts <= interval 5 minutes then epoch_us(a.ts) - epoch_us(ts) else -1 end as micros_until from n""",
)
def nearest_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each event the nearest error before and after it, within five minutes."""
    found = nearest(table(spark, sf_dir, "events"), "ts", "event_id", F.col("event_type") == "error")
    none = F.lit(-1).cast("bigint")
    return found.select(
        "event_id",
        F.coalesce("before.id", none).alias("error_before"),
        F.coalesce("before.gap", none).alias("micros_since"),
        F.coalesce("after.id", none).alias("error_after"),
        F.coalesce("after.gap", none).alias("micros_until"),
    )
