"""Micro-batches: new files are checked and written as they arrive.

Each batch overwrites its own ``batch=<id>`` folder, so a batch that runs
again after a failure leaves the same result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sluice.operators.loadlog import load_log, raise_on_failure
from sluice.operators.validate import check
from sluice.session import configure
from sluice.sinks.tables import append_log
from sluice.sources.files import decoded
from sluice.spec import LoadSpec

INTERVAL = "30 minutes"


def line_stream(
    spark: SparkSession, folder: str, glob: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Lines of files as they appear below a folder."""
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder).select(
        F.col("_metadata.file_path").alias("path"),
        decoded(F.col("_metadata.file_name")).alias("file_name"),
        F.col("_metadata.file_block_start").alias("block_start"),
        "value",
    )


def table_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of Parquet files as they appear.  The path goes in as a pattern, so
    it may name a folder or a single file."""
    return spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]")


def start_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, once: bool, mode: str = "append"
) -> StreamingQuery:
    """Hand every micro-batch and its id to ``handle``: all there are now with ``once``, else every half hour."""
    writer = stream.writeStream.outputMode(mode).foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=INTERVAL)
    return writer.start()


def write_batches(
    stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, once: bool = False
) -> StreamingQuery:
    """Apply a batch operator to every micro-batch."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return start_batches(stream, handle, checkpoint, once)


def ingest(
    stream: DataFrame,
    spec: LoadSpec,
    transform: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    instance: str = "stream",
    once: bool = False,
) -> StreamingQuery:
    """Check each micro-batch; good rows, quarantine and load log go to their
    own tables below ``out``.

    A line under the ``fail`` policy stops the stream, after its batch has
    logged the failure and before it writes any good row."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        configure(batch.sparkSession)
        folder = f"batch={batch_id}"
        lines = batch.withColumn("row_id", F.monotonically_increasing_id())
        checked = check(lines, spec).stage(batch.sparkSession)
        rejected = checked.with_line(checked.quarantine)
        rejected.write.mode("overwrite").parquet(f"{out}/quarantine/{folder}")
        log = load_log(checked, instance, f"batch-{batch_id}", F.current_timestamp())
        append_log(log, f"{out}/log")
        try:
            raise_on_failure(checked)
            transform(checked.good).write.mode("overwrite").parquet(f"{out}/good/{folder}")
        finally:
            checked.close()

    return start_batches(stream, handle, checkpoint, once)
