"""CSV input as raw lines with file and position, and CSV with a declared schema."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.sources.files import decoded, has_files, list_files

LINES = "path string, file_name string, block_start bigint, row_id bigint, value string"


def _with_provenance(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("_metadata.file_path").alias("path"),
        decoded(F.col("_metadata.file_name")).alias("file_name"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_id"),
        "value",
    )


def read_lines(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> DataFrame:
    """Every line below the paths with its file, its split and a row id that
    grows along the split.  Files split freely, so one huge file is no hot spot."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return _with_provenance(reader.text(paths))


def lines_from(df: DataFrame, value: Column, path: Column, row_id: Column, block_start: Column | None = None) -> DataFrame:
    """Rows of any DataFrame as lines, for feeds that never were files.

    Row ids must run without gaps within each path and ``block_start`` (all
    rows of a path, if that is left out) for lines to be numbered.
    """
    return df.select(
        path.alias("path"),
        F.element_at(F.split(path, "/"), -1).alias("file_name"),
        (F.lit(0) if block_start is None else block_start).cast("bigint").alias("block_start"),
        row_id.cast("bigint").alias("row_id"),
        value.alias("value"),
    )


@dataclass(frozen=True)
class Located:
    """Lines of an optional folder, and whether it held any data."""

    lines: DataFrame
    files: DataFrame
    found: bool
    root: str
    target: str


def locate(spark: SparkSession, root: str, target: str, glob: str | None = None) -> Located:
    """Lines of ``root/target``, or none when it is missing or empty."""
    folder = f"{root.rstrip('/')}/{target.lstrip('/')}"
    files = list_files(spark, folder, glob)
    found = has_files(files)
    lines = read_lines(spark, folder, glob) if found else spark.createDataFrame([], LINES)
    return Located(lines, files, found, root, target)


def read_declared(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: str | T.StructType,
    sep: str = ",",
    glob: str | None = None,
) -> DataFrame:
    """Delimited files under a declared schema, unchecked."""
    reader = spark.read.schema(schema).option("sep", sep).option("escape", '"')
    reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.csv(paths)


def entity_of(path: Column, depth: int = 1) -> Column:
    """Name of the folder ``depth`` levels above the file."""
    return F.element_at(F.split(path, "/"), -1 - depth)


def slice_of(path: Column, prefix: str = "input-", pattern: str = "yyyyMMddHHmm") -> Column:
    """Slice end stated in a folder name such as ``input-202401011230``."""
    digits = F.regexp_extract(path, rf"[/=]{prefix}([0-9T]+)/", 1)
    return F.try_to_timestamp(digits, F.lit(pattern))
