"""Checked loads, quarantine, statistics, the load log and normalization."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.cases import case
from sluice.cases.feeds import (
    CUSTOMER_COLUMNS,
    CUSTOMER_FAULTS,
    FEED_ROWS,
    customer_lines,
    customer_spec,
    as_feed,
    feed_lines,
    feed_text,
    table,
)
from sluice.functions.scale import build_scale, parse_scale
from sluice.functions.text import log_key
from sluice.operators.loadlog import (
    capped_skips,
    export_form,
    first_failures,
    instance_entries,
    load_log,
    next_index,
)
from sluice.operators.validate import Checked, check, fault_message
from sluice.plans.normalize import (
    FEED_SPEC,
    normalize_feed,
    normalize_local,
    without_sentinel,
)
from sluice.session import work_dir
from sluice.sinks.tables import append_log, export_instance, read_log, write_csv
from sluice.sources.lines import entity_of, read_declared, read_lines
from sluice.sources.quoted import quoted_records
from sluice.spec import LoadSpec

NOW = datetime(2024, 2, 1, 13, 30)
NOW_SQL = "timestamp '2024-02-01 13:30:00'"


@case("csv_load_typed", f"select {CUSTOMER_COLUMNS} from customer")
def csv_load_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check(customer_lines(spark, sf_dir), customer_spec()).good


@case(
    "csv_skip_width",
    f"""select {CUSTOMER_COLUMNS} from customer
    where not (c_acctbal < 0 and c_mktsegment in ('MACHINERY', 'FURNITURE', 'AUTOMOBILE'))""",
)
def csv_skip_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check(customer_lines(spark, sf_dir, width_faults=True), customer_spec()).good


@case(
    "csv_skip_type",
    f"""select {CUSTOMER_COLUMNS} from customer
    where not (c_acctbal < 0 and c_mktsegment in ('HOUSEHOLD', 'BUILDING'))""",
)
def csv_skip_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check(customer_lines(spark, sf_dir, type_faults=True), customer_spec()).good


def _faulty(spark: SparkSession, sf_dir: str, policy: str = "skip") -> Checked:
    """The faulty feed, checked once; log and line numbers read the staged result."""
    return check(customer_lines(spark, sf_dir, width_faults=True, type_faults=True), customer_spec(policy)).stage(spark)


@case(
    "csv_quarantine_reason",
    f"""with {CUSTOMER_FAULTS}
    select c_custkey as customer_id, coalesce(column_index, -1) as column_index, fault, 'skip' as policy,
      '[' || file_name || ', line:' || line ||
        case when column_index is null then '' else ', column:' || column_index end || ']: ' || fault as message
    from faults where fault is not null""",
)
def csv_quarantine_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = _faulty(spark, sf_dir)
    rows = checked.with_line(checked.quarantine)
    message = fault_message(F.col("fault"), F.col("file_name"), F.col("line"), F.col("column_index"))
    return rows.select(
        F.col("row_id").alias("customer_id"),
        F.coalesce("column_index", F.lit(-1)).alias("column_index"),
        "fault",
        "policy",
        message.alias("message"),
    )


@case(
    "load_stats",
    f"""with {CUSTOMER_FAULTS}
    select file_name, count(*) as rows_read, count(fault) as rows_skipped, cast(0 as bigint) as rows_failed
    from faults group by file_name""",
)
def load_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = customer_lines(spark, sf_dir, width_faults=True, type_faults=True)
    return check(lines, customer_spec()).file_stats.drop("path")


_SKIPS = f"""
{CUSTOMER_FAULTS},
ranked as (
  select *, row_number() over (partition by file_name order by line) as position from faults where fault is not null),
skips as (
  select file_name, position, 'SKIP' as level,
    case when position = 22
         then 'More rows were skipped, but will not be logged to keep the logs from being flooded.'
         else '[' || file_name || ', line:' || line ||
           case when column_index is null then '' else ', column:' || column_index end || ']: ' || fault
    end as message
  from ranked where position <= 22)
"""


@case(
    "skip_log_capped",
    f"with {_SKIPS} select file_name, cast(position as integer) as position, level, message from skips",
)
def skip_log_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capped_skips(_faulty(spark, sf_dir)).select("file_name", "position", "level", "message")


_LOG = f"""
{_SKIPS},
stats as (select file_name, count(*) as n, count(fault) as bad from faults group by file_name),
entries as (
  select file_name, 0 as position, 'INFO' as level, 'Started reading from file: ' || file_name || '.' as message
  from stats
  union all select * from skips
  union all
  select file_name, 23, 'INFO', 'Completed reading from file: ' || file_name || '; ' || n || ' row(s) read; ' ||
    bad || ' row(s) skipped.' from stats),
log as (
  select 'ACME-Normalize-20240201T1330' as instance_id, 'job' as job_id,
    row_number() over (order by file_name, position) - 1 as log_index, level, message
  from entries)
"""
_INSTANCE = "ACME-Normalize-20240201T1330"


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_log(_faulty(spark, sf_dir), _INSTANCE, "job", F.lit(NOW))


@case(
    "load_log",
    f"""with {_LOG} select instance_id, job_id, log_index, level, message, '2024-02-01 13:30:00' as ts,
    '2024-02-01 00:00:00' as assoc_day, printf('%s-%04d', job_id, log_index) as log_key from log""",
)
def load_log_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    stamps = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("ts", "assoc_day")}
    return log.withColumns({**stamps, "log_key": log_key(F.col("job_id"), F.col("log_index"))})


@case(
    "instance_log",
    f"""with {_LOG} select printf('%s-%04d', job_id, log_index) as index,
    '2024-02-01T13:30:00.000Z' as timestamp, level, message from log""",
)
def instance_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append two runs to a log table, export one instance as CSV, read it back."""
    where = work_dir(spark, "log")
    log = _log(spark, sf_dir)
    append_log(log, f"{where}/table")
    append_log(log.withColumn("instance_id", F.lit("other-instance")), f"{where}/table")
    export_instance(read_log(spark, f"{where}/table"), _INSTANCE, f"{where}/csv")
    columns = "index string, timestamp string, level string, message string"
    return spark.read.schema(columns).option("header", True).option("escape", '"').csv(f"{where}/csv")


@case(
    "instance_scan",
    f"with {_LOG} select printf('%s-%04d', job_id, log_index) as index, level, message from log",
)
def instance_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = instance_entries(_log(spark, sf_dir), _INSTANCE)
    return export_form(entries).select("index", "level", "message")


@case(
    "next_index",
    f"with {_LOG} select instance_id, max(log_index) + 1 as next_index from log group by instance_id",
)
def next_log_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return next_index(_log(spark, sf_dir))


@case(
    "fail_policy",
    f"""with {CUSTOMER_FAULTS}
    select file_name, min(line) as line,
      arg_min('[' || file_name || ', line:' || line || ', column:' || column_index || ']: ' || fault, line) as message
    from faults where column_index is not null group by file_name""",
)
def fail_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    failures = first_failures(_faulty(spark, sf_dir, "fail"))
    return failures.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "line", "message")


@case(
    "line_numbers",
    "select l_orderkey, l_partkey, l_linenumber, true as right_line from lineitem",
)
def line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write line items as text, each with its place in its file, and compare
    that place with the line number found when reading back in small splits."""
    where = work_dir(spark, "numbered")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", place.alias("place"))
    items.select(F.concat_ws(",", *items.columns)).write.text(where)
    spec = LoadSpec.of({"columns": [{"name": n, "type": "int"} for n in items.columns]})
    checked = check(read_lines(spark, where), spec)
    rows = checked.with_line(checked.good_with("path", "block_start", "row_id"))
    return rows.select(
        F.col("l_orderkey").cast("bigint").alias("l_orderkey"),
        F.col("l_partkey").cast("bigint").alias("l_partkey"),
        "l_linenumber",
        (F.col("place") == F.col("line")).alias("right_line"),
    )


@case("sentinel_filter", FEED_ROWS)
def sentinel_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filler row joins the feed and is dropped again before the reshape."""
    filler = spark.createDataFrame([tuple([-1] + [None] * 11)], FEED_SPEC.schema)
    feed = check(feed_lines(spark, sf_dir), FEED_SPEC).good.unionByName(filler)
    return normalize_feed(without_sentinel(feed))


@case("normalize_feed", FEED_ROWS)
def normalize_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_feed(check(feed_lines(spark, sf_dir), FEED_SPEC).good)


@case(
    "local_script",
    f"""select 'PP01' as ppa, 'PP02' as ppb, o_custkey || '/' || o_orderpriority as cp,
      strftime(date_trunc('day', o_orderdate), '%Y-%m-%d %H:%M:%S') as start, cast(null as varchar) as "end",
      strftime({NOW_SQL}, '%Y-%m-%d %H:%M:%S') as current, '(4,4.54;6,7894.00;3,479.79)' as scale
    from orders""",
)
def local_script(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the small five-column feed, whose end dates lack a digit."""
    orders = table(spark, sf_dir, "orders")
    where = work_dir(spark, "local")
    feed = orders.select(
        F.col("o_custkey").cast("string").alias("customer"),
        F.col("o_orderpriority").alias("product"),
        (F.col("o_totalprice") / 1000).cast("float").alias("discount"),
        F.date_format("o_orderdate", "MMddyyyy").alias("startdate"),
        F.substring(F.date_format("o_orderdate", "MMddyyyy"), 2, 7).alias("enddate"),
    )
    write_csv(feed, where, header=False)
    rows = read_declared(spark, where, feed.schema)
    return normalize_local(rows, F.lit(NOW))


@case(
    "declared_load",
    "select * replace (strftime(o_orderdate, '%Y-%m-%d') as o_orderdate) from orders",
)
def declared_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A semicolon-separated feed under a declared schema."""
    where = work_dir(spark, "declared")
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    orders.write.option("sep", ";").csv(where)
    return read_declared(spark, where, orders.schema, sep=";")


@case("csv_round_trip", "select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = work_dir(spark, "csv")
    customer = table(spark, sf_dir, "customer")
    write_csv(customer, where)
    return spark.read.schema(customer.schema).option("header", True).option("escape", '"').csv(where)


@case(
    "scale_build",
    """select l_orderkey, l_linenumber, '(' || cast(l_quantity as varchar) || ',' || cast(l_extendedprice as varchar)
      || ';' || cast(l_discount as varchar) || ',' || cast(l_tax as varchar) || ')' as scale from lineitem""",
)
def scale_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", _scale().alias("scale"))


def _scale():
    return build_scale(
        (F.col("l_quantity"), F.col("l_extendedprice")), (F.col("l_discount"), F.col("l_tax"))
    )


@case(
    "scale_explode",
    """select l_orderkey, l_linenumber, 0 as segment, cast(l_quantity as varchar) as q,
         cast(l_extendedprice as varchar) as v from lineitem
       union all
       select l_orderkey, l_linenumber, 1, cast(l_discount as varchar), cast(l_tax as varchar) from lineitem""",
)
def scale_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    built = items.select("l_orderkey", "l_linenumber", _scale().alias("scale"))
    return built.select(
        "l_orderkey", "l_linenumber", F.posexplode(parse_scale(F.col("scale"), ["q", "v"])).alias("segment", "s")
    ).select("l_orderkey", "l_linenumber", "segment", "s.q", "s.v")




@case(
    "feed_line_numbers",
    "select cast(1 as bigint) as first, count(*) as last, count(*) as different, count(*) as n from lineitem",
)
def feed_line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of a feed that never was a file, numbered over seven partitions."""
    lines = as_feed(feed_text(table(spark, sf_dir, "lineitem").repartition(7, "l_orderkey")))
    # The ids of partitions hold for one run of them; written, both scans see the same.
    where = work_dir(spark, "numbered")
    lines.write.parquet(where)
    checked = check(spark.read.schema(lines.schema).parquet(where), FEED_SPEC)
    line = checked.with_line(checked.lines).select("line")
    return line.agg(
        F.min("line").alias("first"), F.max("line").alias("last"), F.count_distinct("line").alias("different"), F.count("*").alias("n")
    )


QUOTED = """
fed as (select *, date_trunc('day', ts) as day, event_id % 3 as feeds from events),
records as (
  select event_id, 'a "' || event_type || '"' || repeat(chr(10) || 'more, text', feeds::int) as note,
    case when event_id % 11 = 0 then 'many' else user_id::varchar end as user_text, 'day=' || strftime(day, '%Y-%m-%d') as file,
    1 + coalesce(sum(feeds + 1) over (file rows between unbounded preceding and 1 preceding), 0)::bigint as line,
    row_number() over file - 1 as record
  from fed window file as (partition by day order by ts, event_id))
"""


def quoted_lines(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """Events as CSV, a file a day, whose quoted notes hold up to two line feeds."""
    where = work_dir(spark, label)
    e = table(spark, sf_dir, "events")
    more = F.repeat(F.lit("\nmore, text"), (F.col("event_id") % 3).cast("int"))
    note = F.concat(F.lit('"a ""'), "event_type", F.lit('""'), more, F.lit('"'))
    user = F.when(F.col("event_id") % 11 == 0, "many").otherwise(F.col("user_id").cast("string"))
    value = F.concat_ws(",", F.col("event_id").cast("string"), note, user)
    text = e.select("ts", "event_id", F.to_date("ts").alias("day"), value.alias("value"))
    ordered = text.repartition("day").sortWithinPartitions("day", "ts", "event_id")
    ordered.select("day", "value").write.partitionBy("day").text(where)
    lines = read_lines(spark, where)
    return lines.withColumn("file_name", entity_of(F.col("path")))


NOTE_SPEC = LoadSpec.of(
    {
        "onWrongColumnCount": "skip",
        "columns": [
            {"name": "event_id", "type": "int", "onWrongType": "skip"},
            {"name": "note", "type": "string", "onWrongType": "skip"},
            {"name": "user_id", "type": "int", "onWrongType": "skip"},
        ],
    }
)


@case(
    "quoted_records",
    f"with {QUOTED} select file, line, record, event_id, note, user_text from records",
)
def quoted_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of several lines, put together again over splits, with their place in the file."""
    records = quoted_records(quoted_lines(spark, sf_dir, "quoted"))
    fields = F.from_csv("value", F.lit("event_id bigint, note string, user_text string"), {"escape": '"'})
    place = [F.col("file_name").alias("file"), "line", "record"]
    return records.select(*place, fields.alias("f")).select("file", "line", "record", "f.*")


@case(
    "quoted_rejects",
    f"""with {QUOTED} select event_id, line,
      '[' || file || ', line:' || line || ', column:2]: an integer was expected, but the value was ''many''.' as message
    from records where event_id % 11 = 0""",
)
def quoted_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected records of the same feed under the number of their first line."""
    records = quoted_records(quoted_lines(spark, sf_dir, "quoted-rejects"))
    checked = check(records, NOTE_SPEC)
    rejected = checked.with_line(checked.quarantine)
    message = fault_message(F.col("fault"), F.col("file_name"), F.col("line"), F.col("column_index"))
    return rejected.select(F.split("raw", ",")[0].cast("bigint").alias("event_id"), "line", message.alias("message"))
