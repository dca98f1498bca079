"""Delivery of written files after their write has committed.

The manifest of a folder drives it; an outcome per file and step goes to a
ledger before any failure is raised, so a second run picks up only what is
still open.  A task that dies half-way may deliver its open files again.
"""

from __future__ import annotations

import urllib.request
from collections.abc import Callable, Iterator, Sequence
from typing import BinaryIO

import pandas as pd
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.sources.files import list_files, non_empty

LEDGER = "path string, step int, command string, delivered boolean, error string"
Action = Callable[[str, str], None]


def sending(send: Callable[[str, BinaryIO], None]) -> Action:
    """An action that hands the open file to ``send(command, body)``; the file
    is streamed from whatever file system holds it."""

    def action(path: str, command: str) -> None:
        filesystem, inside = fs.FileSystem.from_uri(path)
        with filesystem.open_input_stream(inside) as body:
            send(command, body)

    return action


def post_xml(url: str, body: BinaryIO, opener: Callable = urllib.request.urlopen) -> None:
    """Post an enveloped file to a web service; an error status raises."""
    request = urllib.request.Request(url, data=body, method="POST")
    request.add_header("Content-Type", "text/xml; charset=utf-8")
    with opener(request):
        pass


class DeliveryFailed(RuntimeError):
    """An action failed for at least one file; the ledger names them all."""


def manifest(spark: SparkSession, folder: str, steps: Sequence[str] = ("{file}",), glob: str = "part-*") -> DataFrame:
    """One row per non-empty file and step, with the file's path filled in."""
    files = non_empty(list_files(spark, folder, glob))
    commands = F.array(*[F.lit(s) for s in steps])
    return files.select("path", "length", F.posexplode(commands).alias("step", "template")).select(
        "path", "length", "step", F.replace("template", F.lit("{file}"), F.col("path")).alias("command")
    )


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def deliver(
    spark: SparkSession,
    folder: str,
    ledger: str,
    action: Action,
    steps: Sequence[str] = ("{file}",),
    tasks: int | None = None,
) -> DataFrame:
    """Run ``action(path, command)`` for every file and step not yet delivered.

    The steps of one file run in order in one task and stop at its first
    failure.  Returns the ledger; raises ``DeliveryFailed`` if a step failed.
    """
    done = _ledger(spark, ledger).where("delivered").select("path", "step")
    todo = manifest(spark, folder, steps).join(done, ["path", "step"], "left_anti")
    count = tasks or spark.sparkContext.defaultParallelism
    spread = todo.repartition(count, "path").sortWithinPartitions("path", "step")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stopped = None
        for batch in batches:
            outcomes = []
            for row in batch.itertuples():
                error = None
                if row.path == stopped:
                    error = "an earlier step failed"
                else:
                    try:
                        action(row.path, row.command)
                    except Exception as failure:  # recorded, then raised by the driver
                        error, stopped = str(failure) or type(failure).__name__, row.path
                outcomes.append((row.path, row.step, row.command, error is None, error))
            yield pd.DataFrame(outcomes, columns=["path", "step", "command", "delivered", "error"])

    spread.mapInPandas(run, LEDGER).write.mode("append").parquet(ledger)
    outcomes = _ledger(spark, ledger)
    done = outcomes.where("delivered").select("path", "step")
    open_steps = manifest(spark, folder, steps).join(done, ["path", "step"], "left_anti")
    first = open_steps.join(outcomes, ["path", "step"]).select("path", "step", "error").take(1)
    if first:
        raise DeliveryFailed(f"step {first[0]['step']} of {first[0]['path']}: {first[0]['error']}")
    return outcomes
