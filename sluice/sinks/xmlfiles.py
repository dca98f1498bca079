"""XML files: entries inside an optional envelope, one envelope per file."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluice.operators.xmlrows import to_entries
from sluice.sources.files import decoded
from sluice.sources.xml import is_entry
from sluice.spec import StoreSpec


@dataclass(frozen=True)
class Stored:
    """What a write left behind."""

    path: str
    rows: int


def enveloped(entries: DataFrame, spec: StoreSpec) -> DataFrame:
    """Add header and footer lines around each non-empty partition.

    Arrow batches pass through untouched; an empty partition yields nothing,
    so it leaves no envelope-only file.
    """
    head = "".join(spec.pre) + (f"<{spec.root}>" if spec.root else "")
    tail = (f"</{spec.root}>" if spec.root else "") + "".join(spec.post)
    if not head and not tail:
        return entries

    def line(text: str, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
        if text:
            yield pa.RecordBatch.from_arrays([pa.array([text], kind)], names=["value"])

    def wrap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        for batch in batches:
            if batch.num_rows and kind is None:
                # Sessions may ask for large strings; the envelope follows the rows.
                kind = batch.schema.field(0).type
                yield from line(head, kind)
            yield batch
        if kind is not None:
            yield from line(tail, kind)

    return entries.mapInArrow(wrap, "value string")


def write_xml(df: DataFrame, path: str, spec: StoreSpec, files: int | None = None) -> Stored:
    """Write rows as XML part files into a new folder (never over old output).

    ``files`` asks for that many evenly filled files; by default files follow
    the partitions of the input and nothing is shuffled.  Files that
    ``spec.compression`` names a codec for are read back whole, not split.
    """
    written = Observation()
    rows = df.observe(written, F.count(F.lit(1)).alias("rows"))
    if files is not None:
        rows = rows.repartition(files)
    codec = spec.compression or "none"
    enveloped(to_entries(rows, spec), spec).write.mode("errorifexists").option("compression", codec).text(path)
    return Stored(path, written.get["rows"])


def part_rows(spark: SparkSession, path: str, entry: str) -> DataFrame:
    """Entries per written file."""
    lines = spark.read.text(path).where(is_entry(F.col("value"), entry))
    return lines.groupBy(decoded(F.col("_metadata.file_name")).alias("name")).agg(F.count("*").alias("rows"))
