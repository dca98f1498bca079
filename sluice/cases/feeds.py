"""Inputs that the registered queries derive from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.dates import FEED_PATTERN, as_timestamp, slice_start
from sluice.session import configure
from sluice.sources.lines import lines_from
from sluice.spec import LoadSpec

ROWS_PER_FILE = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stamp(ts: Column) -> Column:
    return F.date_format(as_timestamp(ts), "yyyy-MM-dd HH:mm:ss")


# --- customers as a CSV feed -------------------------------------------------

_CUSTOMER = (
    ("customer_id", "int"),
    ("customer_name", "string"),
    ("nation_id", "integer"),
    ("balance", "double"),
    ("in_credit", "bool"),
    ("segment", "chararray"),
)


def customer_spec(policy: str = "skip") -> LoadSpec:
    columns = [{"name": n, "type": t, "onWrongType": policy} for n, t in _CUSTOMER]
    return LoadSpec.of({"onWrongColumnCount": "skip", "columns": columns})


def customer_lines(spark: SparkSession, sf_dir: str, width_faults: bool = False, type_faults: bool = False) -> DataFrame:
    """Customers as CSV lines, in files of 500 consecutive customers.

    Names are quoted and hold commas and quotes.  Customers in debt get a
    fault that depends on their segment: a lost field, a surplus field, a blank
    line, text in an int, or an overflow followed by a second wrong column.
    """
    c = table(spark, sf_dir, "customer")
    debt = F.col("c_acctbal") < 0
    segment = F.col("c_mktsegment")
    name = F.concat(F.lit('"'), "c_name", F.lit(', ""'), segment, F.lit('"""'))
    nation, credit = F.col("c_nationkey").cast("string"), F.when(F.col("c_acctbal") > 5000, "TRUE").otherwise("false")
    if type_faults:
        nation = (
            F.when(debt & (segment == "HOUSEHOLD"), "abc")
            .when(debt & (segment == "BUILDING"), "99999999999")
            .otherwise(nation)
        )
        credit = F.when(debt & (segment == "BUILDING"), "maybe").otherwise(credit)
    fields = [F.col("c_custkey").cast("string"), name, nation, F.col("c_acctbal").cast("string"), credit]
    whole = F.concat_ws(",", *fields, segment)
    value = whole
    if width_faults:
        value = (
            F.when(debt & (segment == "MACHINERY"), F.concat_ws(",", *fields))
            .when(debt & (segment == "FURNITURE"), F.concat_ws(",", whole, F.lit("extra")))
            .when(debt & (segment == "AUTOMOBILE"), F.lit(""))
            .otherwise(whole)
        )
    path = F.concat(F.lit("feed/part-"), F.expr(f"lpad(c_custkey div {ROWS_PER_FILE}, 6, '0')"), F.lit(".csv"))
    return lines_from(c, value, path, F.col("c_custkey"))


# The same feed in SQL: faults, files and lines.
CUSTOMER_FAULTS = f"""
faults as (
  select c_custkey,
    'part-' || lpad(cast(c_custkey // {ROWS_PER_FILE} as varchar), 6, '0') || '.csv' as file_name,
    c_custkey % {ROWS_PER_FILE} + 1 as line,
    case when c_acctbal >= 0 then null
         when c_mktsegment = 'MACHINERY' then 'expected 6 columns, but found 5.'
         when c_mktsegment = 'FURNITURE' then 'expected 6 columns, but found 7.'
         when c_mktsegment = 'AUTOMOBILE' then 'expected 6 columns, but found 1.'
         when c_mktsegment = 'HOUSEHOLD' then 'an integer was expected, but the value was ''abc''.'
         when c_mktsegment = 'BUILDING' then 'an integer was expected, but the value was ''99999999999''.'
    end as fault,
    case when c_acctbal < 0 and c_mktsegment in ('HOUSEHOLD', 'BUILDING') then 2 end as column_index
  from customer)
"""
CUSTOMER_COLUMNS = """
  cast(c_custkey as integer) as customer_id,
  c_name || ', "' || c_mktsegment || '"' as customer_name,
  c_nationkey as nation_id, c_acctbal as balance, c_acctbal > 5000 as in_credit, c_mktsegment as segment
"""


# --- line items as the twelve-column feed -------------------------------------


def feed_text(lineitem: DataFrame) -> DataFrame:
    """Line items as lines of the twelve-column feed."""
    columns = [
        "l_suppkey",
        "l_returnflag",
        "l_orderkey",
        F.concat(F.lit("order <"), F.col("l_orderkey").cast("string"), F.lit("> & co")),
        "l_linestatus",
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")),
        F.concat(F.lit("rep-"), F.col("l_linenumber").cast("string")),
        F.date_format("l_shipdate", FEED_PATTERN),
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
    ]
    return lineitem.select(F.concat_ws(",", *columns).alias("value"))


def feed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_feed(feed_text(table(spark, sf_dir, "lineitem")))


def as_feed(text: DataFrame) -> DataFrame:
    """Lines of one file whose splits are the partitions of ``text``."""
    where = F.lit("feed/lineitem.csv")
    return lines_from(text, F.col("value"), where, F.monotonically_increasing_id(), F.spark_partition_id())


FEED_ROWS = """
select 'order <' || l_orderkey || '> & co' as CUSTOMER_DESC, l_linestatus as CUSTOMER_DEST_LOC,
  'part ' || l_partkey as CUSTOMER_DEST_LOC_DESC, cast(l_orderkey as integer) as CUSTOMER_ID,
  l_returnflag as CUSTOMER_SEGMENT_DESC, cast(l_suppkey as integer) as CUSTOMER_SEGMENT_ID,
  strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as Extraction_Time, 'rep-' || l_linenumber as SALES_REP,
  '(' || cast(l_quantity as varchar) || ',' || cast(l_extendedprice as varchar) || ';' ||
    cast(l_discount as varchar) || ',' || cast(l_tax as varchar) || ')' as scale
from lineitem
"""


# --- events as slices and runs ------------------------------------------------


def run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as one run of a slice of its user's dataset."""
    e = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    ts = as_timestamp(F.col("ts"))
    return e.select(
        F.col("event_id").alias("id"),
        F.concat(F.lit("ds-"), F.col("user_id").cast("string")).alias("dataset"),
        slice_start(ts).alias("slice_start"),
        F.when(kind == "purchase", "Ready")
        .when(kind == "click", "InProgress")
        .when(kind == "view", "PendingExecution")
        .when(kind == "error", "Failed")
        .otherwise("Skipped")
        .alias("status"),
        ts.alias("processing_start"),
        (ts + F.make_dt_interval(secs=F.lit(90))).alias("processing_end"),
        kind.alias("type"),
        F.when(kind == "purchase", 100).when(kind == "click", 50).otherwise(0).alias("percent_complete"),
        (F.col("user_id") % 3).cast("int").alias("retry_attempt"),
        kind.isin("purchase", "error").alias("has_logs"),
        F.when(kind == "error", F.concat(F.lit("failed: "), "props")).otherwise("").alias("error_message"),
    )


RUNS = """
runs as (
  select event_id as id, 'ds-' || user_id as dataset, time_bucket(interval 30 minutes, ts) as slice_start,
    case event_type when 'purchase' then 'Ready' when 'click' then 'InProgress'
      when 'view' then 'PendingExecution' when 'error' then 'Failed' else 'Skipped' end as status,
    ts as processing_start, ts + interval 90 seconds as processing_end, event_type as type,
    case event_type when 'purchase' then 100 when 'click' then 50 else 0 end as percent_complete,
    cast(user_id % 3 as integer) as retry_attempt, event_type in ('purchase', 'error') as has_logs,
    case when event_type = 'error' then 'failed: ' || props else '' end as error_message
  from events)
"""


def pipeline_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer as one pipeline of two activities."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")

    def names(*parts: Column) -> Column:
        return F.array(*[F.concat(F.lit("ds-"), p.cast("string")) for p in parts])

    def activity(name: str, kind: str, inputs: Column, outputs: Column) -> Column:
        return F.struct(
            F.lit(name).alias("name"), F.lit(kind).alias("type"), inputs.alias("inputs"), outputs.alias("outputs")
        )

    return c.select(
        F.concat(F.lit("pl-"), key).alias("name"),
        F.array(
            activity("Copy", "Copy", F.array(F.concat(F.lit("ftp-"), key)), names(F.col("c_custkey"))),
            activity(
                "Normalize",
                "Transform",
                names(F.col("c_custkey")),
                names(F.col("c_custkey") + 1, F.col("c_nationkey")),
            ),
        ).alias("activities"),
        "c_nationkey",
    )


OUTPUTS = """
outputs as (
  select 'pl-' || c_custkey as pipeline, 1 as position, 'Copy' as activity, 'ds-' || c_custkey as dataset
  from customer
  union all
  select 'pl-' || c_custkey, 2, 'Normalize', 'ds-' || (c_custkey + 1) from customer
  union all
  select 'pl-' || c_custkey, 2, 'Normalize', 'ds-' || c_nationkey from customer)
"""


# --- customers and nations as accounts ------------------------------------------


def assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Access rows: one per nation for its mail domain, one per customer in debt for
    their user, and one per other customer for a service account."""
    n = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("@"), F.lower("n_name"), F.lit(".example")).alias("account"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("customer_id"),
        F.lit("view").alias("rights"),
        F.lit("rg-domain").alias("resource_group"),
        F.concat(F.lit("df-"), F.col("n_regionkey").cast("string")).alias("data_factory"),
        F.concat(F.lit("pl-"), "n_nationkey", F.lit(", pl-"), F.col("n_nationkey") + 1).alias("pipelines"),
        F.lit(0).cast("bigint").alias("sequence"),
    )
    svc = F.when(F.col("c_acctbal") < 0, F.lit("")).otherwise(F.lit("svc-"))
    c = table(spark, sf_dir, "customer").select(
        F.concat(svc, user_account()).alias("account"),
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("customer_id"),
        F.lit("view,  admin").alias("rights"),
        F.lit("rg-user").alias("resource_group"),
        F.lit("df-user").alias("data_factory"),
        F.concat(F.lit("pl-"), F.col("c_custkey").cast("string")).alias("pipelines"),
        F.lit(0).cast("bigint").alias("sequence"),
    )
    return n.unionByName(c)


def user_account() -> Column:
    return F.concat(
        F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@nation_"), F.col("c_nationkey"), F.lit(".example")
    )


USER_ACCOUNT = "lower(replace(c_name, '#', '.')) || '@nation_' || c_nationkey || '.example'"
ASSIGNMENTS = f"""
assignments as (
  select '@' || lower(n_name) || '.example' as account, 'N' || n_nationkey as customer_id, 'view' as rights,
    'rg-domain' as resource_group, 'df-' || n_regionkey as data_factory,
    'pl-' || n_nationkey || ', pl-' || (n_nationkey + 1) as pipelines
  from nation
  union all
  select case when c_acctbal < 0 then '' else 'svc-' end || {USER_ACCOUNT}, 'C' || c_custkey, 'view,  admin', 'rg-user',
    'df-user', 'pl-' || c_custkey
  from customer)
"""
