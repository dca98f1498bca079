"""Folders and files: optional targets, slices, listings, several outputs, delivery."""

from __future__ import annotations

import hashlib
import shutil
from contextlib import nullcontext
from dataclasses import replace
from datetime import datetime
from urllib.request import Request

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.cases import case
from sluice.cases.feeds import (
    CUSTOMER_COLUMNS,
    CUSTOMER_FAULTS,
    customer_lines,
    customer_spec,
    feed_text,
    stamp,
    table,
)
from sluice.operators.slices import arrival_slices, assign
from sluice.operators.validate import check
from sluice.plans.normalize import FEED_SPEC, FEED_STORE, Run, egress, normalize_feed, store_slice
from sluice.session import remove_dir, work_dir
from sluice.sinks.deliver import deliver, manifest, post_xml, sending
from sluice.sinks.tables import read_log, read_quarantine, read_slices, write_slices
from sluice.sinks.xmlfiles import part_rows, write_xml
from sluice.sources import snapshots
from sluice.sources.files import changed_files, list_files, non_empty
from sluice.sources.lines import entity_of, locate, read_lines, slice_of
from sluice.sources.xml import is_entry, read_entries
from sluice.spec import StoreSpec


def dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their date as text, since XML output takes no dates."""
    return table(spark, sf_dir, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@case("optional_folder", f"select {CUSTOMER_COLUMNS}, 'customers' as entity from customer")
def optional_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entity folder with files and one that is missing, under one root."""
    root = work_dir(spark, "slice")
    customer_lines(spark, sf_dir).select("value").write.text(f"{root}/customers")
    loaded = None
    for entity in ("customers", "products"):
        rows = check(locate(spark, root, entity).lines, customer_spec()).good
        rows = rows.withColumn("entity", F.lit(entity))
        loaded = rows if loaded is None else loaded.unionByName(rows)
    return loaded


@case(
    "multi_folder_load",
    f"select {CUSTOMER_COLUMNS}, 'entity=' || lower(c_mktsegment) as entity from customer",
)
def multi_folder_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder tree with one folder per segment, loaded in one scan."""
    root = work_dir(spark, "entities")
    lines = customer_lines(spark, sf_dir)
    segment = F.lower(F.element_at(F.split("value", ","), -1))
    lines.select("value", segment.alias("entity")).write.partitionBy("entity").text(root)
    checked = check(read_lines(spark, root, "part-*"), customer_spec())
    return checked.good_with("path").withColumn("entity", entity_of(F.col("path"))).drop("path")


@case(
    "slice_folders",
    """select strftime(date_trunc('day', ts) + interval 1 day, '%Y-%m-%d %H:%M:%S') as slice_end, count(*) as n,
      cast(sum(event_id) as bigint) as ids
    from events group by 1""",
)
def slice_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily folders named by their end; the slice comes back from the path."""
    root = work_dir(spark, "slices")
    events = assign(table(spark, sf_dir, "events"), "ts", minutes=1440)
    folder = F.concat(F.lit("input-"), F.date_format("slice_end", "yyyyMMddHHmm"))
    lines = events.select(F.col("event_id").cast("string").alias("value"), folder.alias("folder"))
    lines.write.partitionBy("folder").text(root)
    found = read_lines(spark, root).withColumn("slice_end", slice_of(F.col("path")))
    return found.groupBy(stamp(F.col("slice_end")).alias("slice_end")).agg(
        F.count("*").alias("n"), F.sum(F.col("value").cast("bigint")).alias("ids")
    )


@case(
    "slice_folders_half_hour",
    """select strftime(time_bucket(interval 30 minute, ts) + interval 30 minute, '%Y-%m-%d %H:%M:%S') as slice_end,
      count(*) as n, cast(sum(event_id) as bigint) as ids
    from events group by 1""",
)
def slice_folders_half_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders of the configured thirty minutes, named by their end and read back."""
    root = work_dir(spark, "half-hours")
    events = assign(table(spark, sf_dir, "events"), "ts", minutes=30)
    folder = F.concat(F.lit("input-"), F.date_format("slice_end", "yyyyMMddHHmm"))
    lines = events.select(F.col("event_id").cast("string").alias("value"), folder.alias("folder"))
    lines.hint("rebalance", "folder").write.partitionBy("folder").text(root)
    found = read_lines(spark, root).withColumn("slice_end", slice_of(F.col("path")))
    return found.groupBy(stamp(F.col("slice_end")).alias("slice_end")).agg(
        F.count("*").alias("n"), F.sum(F.col("value").cast("bigint")).alias("ids")
    )


@case("name_filter", f"select {CUSTOMER_COLUMNS} from customer")
def name_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two kinds of files in one folder, told apart by name."""
    root = work_dir(spark, "mixed")
    lines = customer_lines(spark, sf_dir).select("value")
    lines.write.text(root)
    lines.write.mode("append").json(root)
    return check(read_lines(spark, root, "*.txt"), customer_spec()).good


@case(
    "changed_files",
    """with f as (select 'team-app-dev-' || case event_type when 'click' then 'ls' when 'view' then 'ds'
        when 'error' then 'PL' else 'zz' end || '-' || event_id ||
        case when event_type = 'view' and value < 5 then '.txt' else '.json' end as name, ts as modified from events)
    select name, lower(split_part(name, '-', 4)) as kind from f
    where name like '%.json' and lower(split_part(name, '-', 4)) in ('ls', 'ds', 'pl')
      and modified >= timestamp '2024-01-15 00:00:00'""",
)
def changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing made of events: definition files changed since mid-January."""
    kind = (
        F.when(F.col("event_type") == "click", "ls")
        .when(F.col("event_type") == "view", "ds")
        .when(F.col("event_type") == "error", "PL")
        .otherwise("zz")
    )
    suffix = F.when((F.col("event_type") == "view") & (F.col("value") < 5), ".txt").otherwise(".json")
    listing = table(spark, sf_dir, "events").select(
        F.concat(F.lit("team-app-dev-"), kind, F.lit("-"), F.col("event_id").cast("string"), suffix).alias("name"),
        F.col("ts").cast("timestamp").alias("modified"),
    )
    since = F.lit(datetime(2024, 1, 15))
    return changed_files(listing, since).select("name", "kind")


@case(
    "listing_diff",
    """select 'nation=' || c_nationkey as folder,
      case when c_nationkey < 5 then 'removed' when c_nationkey < 20 then 'changed' else 'new' end as change,
      count(*) filter (c_nationkey >= 5) as rows_to_load
    from customer
    where c_nationkey < 5 or c_nationkey >= 20 or (c_nationkey between 10 and 14 and c_acctbal < 0)
    group by c_nationkey""",
)
def listing_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders that went, came or got more files between two listings, with the rows of new files."""
    root, store = work_dir(spark, "landing"), work_dir(spark, "listings")
    nation = F.col("nation")
    rows = table(spark, sf_dir, "customer").select("c_name", F.col("c_nationkey").alias("nation"), "c_acctbal")

    def land(arrived: DataFrame) -> DataFrame:
        arrived.select("c_name", "nation").write.mode("append").partitionBy("nation").text(root)
        return snapshots.read(spark, store, snapshots.take(spark, root, store, "part-*"))

    before = land(rows.where(nation < 20))
    for gone in range(5):
        remove_dir(spark, f"{root}/nation={gone}")
    after = land(rows.where((nation >= 20) | (nation.between(10, 14) & (F.col("c_acctbal") < 0))))
    folders = snapshots.diff(
        snapshots.by_folder(before), snapshots.by_folder(after), "folder", snapshots.FOLDER_FACTS
    )
    # Older files are left out by their time, before any of them is opened.
    changed_at, path = F.col("_metadata.file_modification_time"), F.col("_metadata.file_path")
    lines = spark.read.text(root).where(changed_at >= snapshots.high_water(before)).select("nation", path.alias("path"))
    fresh = lines.join(snapshots.past_mark(after, before).select("path"), "path", "left_semi")
    counted = fresh.groupBy(F.concat(F.lit("nation="), "nation").alias("folder")).agg(F.count("*").alias("n"))
    folder = F.regexp_extract("folder", "[^/]*$", 0).alias("folder")
    return folders.select(folder, "change").join(counted, "folder", "left").select(
        "folder", "change", F.coalesce("n", F.lit(0)).alias("rows_to_load")
    )


@case("multi_root_files", "select count(*) * 2 as rows, true as all_listed from customer")
def multi_root_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two folders, and a missing third, in one listing."""
    root = work_dir(spark, "roots")
    names = table(spark, sf_dir, "customer").select("c_name")
    for part in ("a", "b"):
        names.write.text(f"{root}/{part}")
    listed = non_empty(list_files(spark, [f"{root}/{p}" for p in ("a", "b", "missing")], "part-*"))
    lines = read_lines(spark, [f"{root}/a", f"{root}/b"])
    counted = lines.groupBy("path").agg(F.count("*").alias("n"))
    return listed.join(counted, "path", "full").agg(
        F.sum("n").alias("rows"), F.bool_and(F.col("n").isNotNull() & F.col("length").isNotNull()).alias("all_listed")
    )


@case("arrival_slices", "select count(*) as rows, true as rounded, true as near from orders")
def arrivals_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files get the quarter hour after their arrival; nothing is moved."""
    root = work_dir(spark, "landing")
    table(spark, sf_dir, "orders").select("o_orderpriority").write.text(root)
    files = arrival_slices(list_files(spark, root, "part-*"), 15)
    seconds = F.unix_seconds("slice_end")
    wait = seconds - F.unix_seconds(F.date_trunc("minute", "modified"))
    lines = read_lines(spark, root).select("path").join(files, "path")
    return lines.agg(
        F.count("*").alias("rows"),
        F.bool_and(F.pmod(seconds, F.lit(900)) == 0).alias("rounded"),
        F.bool_and(wait.between(0, 899)).alias("near"),
    )


@case(
    "multi_output",
    """select 'orders' as entity, count(*) as rows from orders
    union all select 'suppliers', count(*) from supplier union all select 'returns', 0""",
)
def multi_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two optional inputs, one missing, and one more, each stored by one job."""
    root, out = work_dir(spark, "in"), work_dir(spark, "out")
    orders = dated_orders(spark, sf_dir)
    spec = StoreSpec.named("rows", "row")
    stored = {
        "orders": write_xml(orders, f"{out}/orders", spec),
        "suppliers": write_xml(table(spark, sf_dir, "supplier"), f"{out}/suppliers", spec),
        "returns": write_xml(
            check(locate(spark, root, "returns").lines, customer_spec()).good, f"{out}/returns", spec
        ),
    }
    report = None
    for entity, written in stored.items():
        rows = spark.read.text(written.path).where(is_entry(F.col("value"), "row"))
        rows = rows.agg(F.lit(entity).alias("entity"), F.count("*").alias("rows"))
        report = rows if report is None else report.unionByName(rows)
    return report


@case(
    "slice_partitioned_output",
    """select strftime(time_bucket(interval 30 minutes, ts), '%Y%m%d') as slice_date,
      strftime(time_bucket(interval 30 minutes, ts), '%H%M') as slice_time, count(*) as n,
      cast(sum(event_id * case when event_type = 'error' then 1 else 0 end) as bigint) as errors
    from events group by 1, 2""",
)
def slice_partitioned_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """30-minute slices written twice: the second write replaces only the slices it holds."""
    where = work_dir(spark, "by-slice")
    events = table(spark, sf_dir, "events")
    events = events.withColumn("day", F.window(F.col("ts").cast("timestamp"), "30 minutes")["start"])
    stale = events.withColumn("event_type", F.lit("stale"))
    late = F.col("day") >= F.lit(datetime(2024, 1, 16))
    columns = ("event_id", "event_type")
    write_slices(stale.where(late).unionByName(events.where(~late)), where, "day", keep=columns)
    write_slices(events.where(late), where, "day", keep=columns)
    error_id = F.when(F.col("event_type") == "error", F.col("event_id")).otherwise(0)
    read = read_slices(spark, where, "event_id bigint, event_type string")
    return read.groupBy("slice_date", "slice_time").agg(
        F.count("*").alias("n"), F.sum(error_id).alias("errors")
    )


@case(
    "delivery",
    "select count(*) as rows, cast(0 as bigint) as open_steps, true as twice_same from orders",
)
def delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stored, every file delivered in two steps, and a second run that
    finds nothing left to do."""
    out, ledger = work_dir(spark, "stored"), work_dir(spark, "ledger")
    orders = dated_orders(spark, sf_dir)
    write_xml(orders, out, StoreSpec.named("orders", "order"))
    steps = ("check {file}", "post {file}")

    def action(path: str, command: str) -> None:
        if not command.endswith(path):
            raise RuntimeError("the command does not name its file")

    first = deliver(spark, out, ledger, action, steps)
    deliver(spark, out, ledger, action, steps)
    wanted = manifest(spark, out, steps)
    left = wanted.join(first.where("delivered"), ["path", "step"], "left_anti")
    open_steps = left.agg(F.count("*")).scalar()
    same = (first.agg(F.count("*")).scalar() == wanted.agg(F.count("*")).scalar())
    return part_rows(spark, out, "order").agg(F.sum("rows").alias("rows")).select(
        "rows", open_steps.alias("open_steps"), same.alias("twice_same")
    )


@case("posted_output", "select * replace (strftime(o_orderdate, '%Y-%m-%d') as o_orderdate) from orders")
def posted_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in envelopes, posted file by file to a stand-in for a web service
    that keeps each body, and read back from what was posted."""
    out, box = work_dir(spark, "envelopes"), work_dir(spark, "posted")
    soap = StoreSpec.of({"root": "orders", "entry": "order", "pre": ["<Envelope><Body>"], "post": ["</Body></Envelope>"]})
    orders = dated_orders(spark, sf_dir)
    write_xml(orders, out, soap)

    def post(command, body):
        def opener(request: Request) -> nullcontext:
            filesystem, folder = fs.FileSystem.from_uri(box)
            filesystem.create_dir(folder)
            name = hashlib.md5(command.encode()).hexdigest()
            with filesystem.open_output_stream(f"{folder}/{name}.xml") as kept:
                shutil.copyfileobj(request.data, kept)
            return nullcontext()

        post_xml("http://service.invalid/orders", body, opener)

    deliver(spark, out, work_dir(spark, "ledger"), sending(post))
    return read_entries(spark, box, orders.schema, "order")


@case(
    "store_slice",
    """select cast(l_orderkey as integer) as CUSTOMER_ID, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as Extraction_Time,
      cast(l_quantity as varchar) as quantity, 2 as openings from lineitem""",
)
def whole_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job on files: load, log, reshape, store, and read the XML back."""
    root, out, log = work_dir(spark, "feed"), work_dir(spark, "xml"), work_dir(spark, "log")
    feed_text(table(spark, sf_dir, "lineitem")).write.text(f"{root}/customer-csv")
    run = Run("ACME-Normalize-20240201T1330", "job", datetime(2024, 2, 1, 13, 30))
    store = replace(FEED_STORE, compression="gzip")
    store_slice(spark, root, "customer-csv", f"{out}/customer-xml", log, run, store=store)
    schema = "CUSTOMER_ID int, Extraction_Time string, Scale array<struct<Scale_Quantity: string>>"
    entries = read_entries(spark, f"{out}/customer-xml", schema, "data")
    openings = read_log(spark, log).where("log_index < 2").agg(F.count("*").cast("int")).scalar()
    return entries.select(
        "CUSTOMER_ID",
        "Extraction_Time",
        F.col("Scale")[0]["Scale_Quantity"].alias("quantity"),
        openings.alias("openings"),
    )


@case(
    "quarantine_table",
    f"""with {CUSTOMER_FAULTS} select fault, 'ACME-1' as instance_id, 1 as first_line, count(*) as n
    from faults where fault is not null group by fault""",
)
def quarantine_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected lines of a stored slice, kept after the job; the job ran twice with a failure between."""
    root, out, log = work_dir(spark, "feed"), work_dir(spark, "xml"), work_dir(spark, "log")
    lines = customer_lines(spark, sf_dir, width_faults=True, type_faults=True)
    lines.select("value").write.text(f"{root}/customers")
    run = Run("ACME-1", "7", datetime(2024, 2, 1, 13, 30))

    def broken(rows: DataFrame) -> DataFrame:
        raise ValueError("the first run stops before it stores")

    try:
        store_slice(spark, root, "customers", out, log, run, customer_spec(), StoreSpec.named(), broken, detailed=None)
    except ValueError:
        store_slice(spark, root, "customers", out, log, run, customer_spec(), StoreSpec.named(), lambda rows: rows)
    kept = read_quarantine(spark, f"{log}-quarantine")
    first = F.least(F.lit(1), F.min("line")).cast("int").alias("first_line")
    return kept.groupBy("fault", "instance_id").agg(first, F.count("*").alias("n"))


@case(
    "store_and_deliver",
    "select 2 as steps, count(*) as rows, true as all_delivered from lineitem",
)
def store_and_deliver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored slice whose spec names two steps for each file that is closed."""
    root, out, log = work_dir(spark, "feed"), work_dir(spark, "xml"), work_dir(spark, "log")
    feed_text(table(spark, sf_dir, "lineitem")).write.text(f"{root}/customer-csv")
    store = replace(FEED_STORE, on_close=("check {file}", "post {file}"), compression="gzip")

    def action(path: str, command: str) -> None:
        if not command.endswith(path):
            raise RuntimeError("the command does not name its file")

    run = Run("ACME-2", "1", datetime(2024, 2, 1, 13, 30))
    stored, _ = store_slice(
        spark, root, "customer-csv", out, log, run, FEED_SPEC, store, normalize_feed, action=action
    )
    ledger = spark.read.parquet(f"{out}-ledger")
    files = non_empty(list_files(spark, out, "part-*")).agg(F.count("*")).scalar()
    return ledger.agg(
        F.count_distinct("step").cast("int").alias("steps"),
        F.lit(stored.rows).cast("bigint").alias("rows"),
        (F.bool_and("delivered") & (F.count("*") == 2 * files)).alias("all_delivered"),
    )


@case(
    "egress_csv",
    "select * replace (strftime(o_orderdate, '%Y-%m-%d') as o_orderdate), 2 as entries from orders",
)
def egress_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stored as XML, and taken back out as CSV, logged and delivered."""
    xml, out, log = work_dir(spark, "xml"), work_dir(spark, "csv"), work_dir(spark, "log")
    orders = dated_orders(spark, sf_dir)
    write_xml(orders, xml, StoreSpec.named("orders", "order"))
    run = Run("00120240101", "42", datetime(2024, 2, 1, 13, 30))
    egress(spark, xml, orders.schema.simpleString()[7:-1].replace(":", " "), "order", out, log, run, action=lambda path, command: None)
    entries = read_log(spark, log).where("instance_id = '00120240101' and job_id = '42'").agg(F.count("*").cast("int"))
    rows = spark.read.schema(orders.schema).option("header", True).option("escape", '"').csv(out)
    return rows.withColumn("entries", entries.scalar())
