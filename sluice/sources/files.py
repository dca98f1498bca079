"""File listings without file contents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LISTING = "path string, name string, length bigint, modified timestamp"


def decoded(name: Column) -> Column:
    """File names arrive percent-encoded; a plus sign is not encoded."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def list_files(
    spark: SparkSession,
    roots: str | Sequence[str],
    glob: str | None = None,
    recursive: bool = True,
) -> DataFrame:
    """One row per file below the roots.  A root that does not exist adds
    nothing.  Contents are never read: only listing columns are selected."""
    listing = None
    for root in [roots] if isinstance(roots, str) else roots:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
        if glob:
            reader = reader.option("pathGlobFilter", glob)
        try:
            found = reader.load(root)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        found = found.select(
            F.col("_metadata.file_path").alias("path"),
            decoded(F.col("_metadata.file_name")).alias("name"),
            F.col("_metadata.file_size").alias("length"),
            F.col("_metadata.file_modification_time").alias("modified"),
        )
        listing = found if listing is None else listing.unionByName(found)
    return spark.createDataFrame([], LISTING) if listing is None else listing


def non_empty(files: DataFrame) -> DataFrame:
    return files.where("length > 0")


def has_files(files: DataFrame) -> bool:
    """Whether any listed file holds data; stops at the first one."""
    return bool(non_empty(files).take(1))


def changed_files(
    files: DataFrame,
    since: Column,
    kinds: Sequence[str] = ("ls", "ds", "pl"),
    part: int = 3,
    extension: str = ".json",
) -> DataFrame:
    """Files changed at or after ``since`` whose dash-separated name carries
    one of the kinds at the given part (counted from 0)."""
    name = F.lower("name")
    parts = F.split(name, "-")
    return (
        files.where(name.endswith(extension) & (F.size(parts) > 2) & (F.col("modified") >= since))
        .withColumn("kind", F.get(parts, F.lit(part)))
        .where(F.col("kind").isin(*kinds))
    )
