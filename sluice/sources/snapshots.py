"""Stored file listings: what is new, changed or gone since the last look at the folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import remove_dir
from sluice.sources.files import LISTING, list_files

FACTS = ("length", "modified")
FOLDER_FACTS = ("files", "length", "modified")


def _folder(store: str, version: int) -> str:
    return f"{store.rstrip('/')}/version={version:010d}"


def versions(spark: SparkSession, store: str) -> list[int]:
    """Numbers of the stored listings, oldest first; one whose write did not end is none."""
    ended = spark._jvm.org.apache.hadoop.fs.Path(f"{store.rstrip('/')}/version=*/_SUCCESS")
    found = ended.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(ended) or []
    return sorted(int(status.getPath().getParent().getName().split("=")[1]) for status in found)


def take(spark: SparkSession, roots: str | Sequence[str], store: str, glob: str | None = None) -> int:
    """List the files below the roots, store the listing as the next version, and return its number.

    Folders that overlap list a file once.  What a broken write left behind
    under that number is replaced.  One job at a time takes listings.
    """
    version = max(versions(spark, store), default=0) + 1
    listing = list_files(spark, roots, glob).dropDuplicates(["path"])
    listing.write.mode("overwrite").parquet(_folder(store, version))
    return version


def read(spark: SparkSession, store: str, version: int) -> DataFrame:
    """A stored listing; version 0, before the first one, has no files."""
    if version == 0:
        return spark.createDataFrame([], LISTING)
    return spark.read.schema(LISTING).parquet(_folder(store, version))


def keep_last(spark: SparkSession, store: str, count: int) -> None:
    """Delete all stored listings but the last ``count``."""
    if count < 1:
        raise ValueError("at least one listing is kept")
    for version in versions(spark, store)[:-count]:
        remove_dir(spark, _folder(store, version))


def by_folder(files: DataFrame) -> DataFrame:
    """folder, files, length and newest ``modified`` of each folder that holds files itself."""
    return files.groupBy(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).agg(
        F.count("*").alias("files"), F.sum("length").alias("length"), F.max("modified").alias("modified")
    )


def diff(old: DataFrame, new: DataFrame, key: str = "path", facts: Sequence[str] = FACTS) -> DataFrame:
    """key, change (new, changed or removed), and the facts ``before`` and ``after``, of all that differs.

    Listings are held against each other by their facts, not by a time, so a
    file put there with an old time stamp is found too.
    """
    state = F.struct(*facts)
    both = old.select(key, state.alias("before")).join(new.select(key, state.alias("after")), key, "full")
    before, after = F.col("before"), F.col("after")
    change = (
        F.when(before.isNull(), "new").when(after.isNull(), "removed").when(~before.eqNullSafe(after), "changed")
    )
    return both.select(key, change.alias("change"), "before", "after").where("change is not null")


def high_water(listing: DataFrame) -> Column:
    """The newest modification time in a listing, as a value for other queries; null for no files."""
    return listing.select(F.max("modified")).scalar()


def past_mark(files: DataFrame, seen: DataFrame) -> DataFrame:
    """Files modified after the newest of the ``seen`` ones, or at that very time and not seen as they are.

    Only the files at the mark are joined, so this stays cheap however long the
    listing grows.  It misses what ``diff`` finds: removed files and files put
    there with an older time.
    """
    mark = high_water(seen)
    fresh = files.where(mark.isNull() | (F.col("modified") >= mark))
    known = seen.where(F.col("modified") == mark)
    return fresh.join(known, ["path", *FACTS], "left_anti")
