"""Slice normalization: checked load, reshape, XML store and load log."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluice.functions.dates import FEED_PATTERN, OUTPUT_PATTERN, SHORT_PATTERN, day_key, reformat
from sluice.functions.scale import build_scale
from sluice.operators.loadlog import SKIPS_DETAILED, load_log, opening_entries, raise_on_failure
from sluice.operators.validate import Checked, check
from sluice.session import configure
from sluice.sinks.deliver import Action, deliver
from sluice.sinks.tables import append_log, read_quarantine, write_csv, write_quarantine
from sluice.sinks.xmlfiles import Stored, write_xml
from sluice.sources.files import has_files, list_files
from sluice.sources.lines import locate
from sluice.sources.xml import read_entries
from sluice.spec import LoadSpec, StoreSpec

# The twelve columns of the customer and product feeds.
FEED_COLUMNS = (
    ("CUSTOMER_SEGMENT_ID", "int"),
    ("CUSTOMER_SEGMENT_DESC", "string"),
    ("CUSTOMER_ID", "int"),
    ("CUSTOMER_DESC", "string"),
    ("CUSTOMER_DEST_LOC", "string"),
    ("CUSTOMER_DEST_LOC_DESC", "string"),
    ("SALES_REP", "string"),
    ("extime", "string"),
    ("QTY1", "string"),
    ("VAL1", "string"),
    ("QTY2", "string"),
    ("VAL2", "string"),
)
FEED_SPEC = LoadSpec.of(
    {
        "onWrongColumnCount": "skip",
        "columns": [{"name": n, "type": t, "onWrongType": "skip"} for n, t in FEED_COLUMNS],
    }
)
FEED_STORE = StoreSpec.of(
    {
        "root": "root",
        "entry": "data",
        "processors": [
            {
                "column": "scale",
                "type": "scale",
                "node": "Scale",
                "children": ["Scale_Quantity", "Scale_Value"],
            }
        ],
    }
)

# What the small script adds to every row.
LOCAL_SCHEMA = "customer string, product string, discount float, startdate string, enddate string"
LOCAL_SCALE = "(4,4.54;6,7894.00;3,479.79)"


def normalize_feed(feed: DataFrame) -> DataFrame:
    """The twelve-column feed in output order, with date and scale reshaped."""
    return feed.select(
        "CUSTOMER_DESC",
        "CUSTOMER_DEST_LOC",
        "CUSTOMER_DEST_LOC_DESC",
        "CUSTOMER_ID",
        "CUSTOMER_SEGMENT_DESC",
        "CUSTOMER_SEGMENT_ID",
        reformat(F.col("extime"), FEED_PATTERN, OUTPUT_PATTERN).alias("Extraction_Time"),
        "SALES_REP",
        build_scale((F.col("QTY1"), F.col("VAL1")), (F.col("QTY2"), F.col("VAL2"))).alias("scale"),
    )


def without_sentinel(feed: DataFrame) -> DataFrame:
    """Drop filler rows written only so that a folder is not empty."""
    return feed.where(F.col("CUSTOMER_SEGMENT_ID") >= 0)


def normalize_local(rows: DataFrame, now: Column) -> DataFrame:
    """The small five-column feed: constants, joined names, dates and run time."""
    return rows.select(
        F.lit("PP01").alias("ppa"),
        F.lit("PP02").alias("ppb"),
        F.concat(F.concat("customer", F.lit("/")), "product").alias("cp"),
        reformat(F.col("startdate"), SHORT_PATTERN, OUTPUT_PATTERN).alias("start"),
        reformat(F.col("enddate"), SHORT_PATTERN, OUTPUT_PATTERN).alias("end"),
        F.date_format(now, OUTPUT_PATTERN).alias("current"),
        F.lit(LOCAL_SCALE).alias("scale"),
    )


@dataclass(frozen=True)
class Run:
    """Names and clock of one run."""

    instance: str
    job: str
    now: datetime


def store_slice(
    spark: SparkSession,
    root: str,
    target: str,
    out: str,
    log_path: str,
    run: Run,
    load: LoadSpec = FEED_SPEC,
    store: StoreSpec = FEED_STORE,
    transform: Callable[[DataFrame], DataFrame] = normalize_feed,
    empty: str | None = None,
    files: int | None = None,
    detailed: int | None = SKIPS_DETAILED,
    action: Action | None = None,
) -> tuple[Stored, Checked]:
    """Load one optional folder, log the load, and store the result as XML.

    Rejected lines with their line numbers stay in ``<log_path>-quarantine``,
    whatever number of them the log details.  Log and quarantine are written
    before a failing line stops the run, and nothing is stored in that case.  A
    run whose output is there already stops before it writes anything; one
    that runs again after a failure replaces its own entries.  No step shuffles
    the accepted rows unless ``files`` asks for evenly filled output.

    Steps of ``store.on_close`` are run by ``action`` for each file once the
    write has committed, with a ledger in ``<out>-ledger``; configured steps
    without an action are refused.  What is staged on the way is removed.
    """
    configure(spark)
    if store.on_close and action is None:
        raise ValueError("the store spec has steps on close, but no action was given")
    if has_files(list_files(spark, out)):
        raise FileExistsError(f"there is output in {out} already")
    located = locate(spark, root, target)
    staged = check(located.lines, load).stage(spark)
    kept = f"{log_path.rstrip('/')}-quarantine"
    try:
        write_quarantine(staged.with_line(staged.quarantine), kept, run.instance, run.job)
        opening = opening_entries(spark, located, run.job, empty)
        log = load_log(staged, run.instance, run.job, F.lit(run.now), opening, opening_rows=2, detailed=detailed)
        append_log(log, log_path)
        raise_on_failure(staged)
        stored = write_xml(transform(staged.good), out, store, files)
    finally:
        staged.close()
    if store.on_close:
        deliver(spark, out, f"{out.rstrip('/')}-ledger", action, store.on_close)
    own = (F.col("instance_id") == run.instance) & (F.col("job_id") == run.job)
    kept_rows = read_quarantine(spark, kept).where(own)
    return stored, replace(staged, staged_rows=None, staged_quarantine=kept_rows, staged_stats=None, staged_folder=None)


def egress(
    spark: SparkSession,
    folder: str,
    schema: str,
    entry: str,
    out: str,
    log_path: str,
    run: Run,
    transform: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    action: Action | None = None,
    steps: Sequence[str] = ("{file}",),
) -> int:
    """The way back: XML entries below ``folder`` as CSV files in ``out``, logged and delivered.

    Returns the number of rows.  The log gets two entries, what was read and
    what was written; a run again replaces them, and refuses to write over
    output.  With ``action`` every file is delivered after the write.
    """
    configure(spark)
    if has_files(list_files(spark, out)):
        raise FileExistsError(f"there is output in {out} already")
    counted = Observation()
    rows = transform(read_entries(spark, folder, schema, entry)).observe(counted, F.count(F.lit(1)).alias("rows"))
    write_csv(rows, out)
    n = counted.get["rows"]
    texts = [(0, f"Started reading entries from: {folder}."), (1, f"Completed writing to: {out}; {n} row(s) written.")]
    entries = spark.createDataFrame([(i, "INFO", text) for i, text in texts], "log_index bigint, level string, message string")
    now = F.lit(run.now)
    named = {"instance_id": F.lit(run.instance), "job_id": F.lit(run.job), "ts": now, "assoc_day": day_key(now)}
    append_log(entries.withColumns(named), log_path)
    if action is not None:
        deliver(spark, out, f"{out.rstrip('/')}-ledger", action, steps)
    return n


def slice_paths(slice_end: datetime) -> tuple[str, str]:
    """Input and output folder of a slice, on a 24-hour clock."""
    stamp = f"{slice_end:%Y%m%d%H%M}"
    return f"input-{stamp}", f"output-{stamp}/process-{stamp}"


class MissingInput(RuntimeError):
    """A required folder holds no data yet."""


def store_entities(
    spark: SparkSession,
    root: str,
    slice_end: datetime,
    log_path: str,
    run: Run,
    required: Sequence[str] = (),
    optional: Sequence[str] = (),
    load: LoadSpec = FEED_SPEC,
    store: StoreSpec = FEED_STORE,
    transform: Callable[[DataFrame], DataFrame] = normalize_feed,
) -> dict[str, Stored]:
    """Store every entity folder of one slice.  Nothing starts before all
    required folders hold data; an optional one may be missing or empty."""
    source, target = slice_paths(slice_end)
    absent = [e for e in required if not locate(spark, f"{root}/{source}", e).found]
    if absent:
        raise MissingInput(f"slice {source} still lacks: {', '.join(absent)}")
    stored = {}
    for entity in (*required, *optional):
        named = replace(run, job=f"{run.job}-{entity}")
        stored[entity], _ = store_slice(
            spark, f"{root}/{source}", entity, f"{root}/{target}/{entity}", log_path, named, load, store, transform
        )
    return stored
