"""The access table on disk: hashed parts, batches of changes beside them, and their merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.access import FIELDS, current
from sluice.session import remove_dir, work_dir

PARTS = 64
ROWS = "account string, " + ", ".join(f"{name} string" for name in FIELDS) + ", sequence bigint, part int"
#: A change without sequence yields to every numbered one.
_UNNUMBERED = -(2**63)


def _part(account: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(account), F.lit(parts)).cast("int")


def add_changes(changes: DataFrame, path: str, batch: int, parts: int = PARTS) -> None:
    """Store a batch of assignments beside the merged parts.

    A batch stored again replaces its own rows.  All batches of a table use the
    same number of parts.
    """
    sequence = F.coalesce(F.col("sequence").cast("bigint"), F.lit(_UNNUMBERED)).alias("sequence")
    rows = changes.select("account", *FIELDS, sequence, _part(F.col("account"), parts).alias("part"))
    folder = f"{path}/changes/batch={batch:010d}"
    rows.repartition("part").write.mode("overwrite").partitionBy("part").parquet(folder)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows below a folder, or None where there is no such folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return None
    return spark.read.schema(ROWS).parquet(path)


def _batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches beside the parts whose write came to an end."""
    ended = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/changes/batch=*/_SUCCESS")
    found = ended.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(ended) or []
    return sorted(int(status.getPath().getParent().getName().split("=")[1]) for status in found)


def _all_rows(spark: SparkSession, path: str, batches: list[int]) -> DataFrame:
    rows = _stored(spark, f"{path}/merged")
    for batch in batches:
        more = _stored(spark, f"{path}/changes/batch={batch:010d}")
        rows = more if rows is None else rows.unionByName(more)
    return spark.createDataFrame([], ROWS) if rows is None else rows


def scan(spark: SparkSession, path: str) -> DataFrame:
    """The last assignment of each account, from merged parts and all batches beside them."""
    return current(_all_rows(spark, path, _batches(spark, path)))


def compact(spark: SparkSession, path: str, until: int | None = None) -> list[int]:
    """Merge batches up to and with number ``until`` (all by default) into their parts; returns these parts.

    Parts that no batch touches keep their files.  Rows keep their sequence, so
    a merge that broke off before its batches were deleted changes no answer
    and is run again.  Readers that began before may have to begin anew.
    """
    batches = [b for b in _batches(spark, path) if until is None or b <= until]
    changes = [_stored(spark, f"{path}/changes/batch={b:010d}").select("part") for b in batches]
    touched = sorted({row["part"] for rows in changes for row in rows.distinct().collect()})
    if touched:
        rows = _all_rows(spark, path, batches).where(F.col("part").isin(*touched))
        # A part is read and replaced, so its new rows are written elsewhere first.
        last = F.max_by(F.struct(*FIELDS, "sequence"), "sequence").alias("_a")
        staged = work_dir(spark, "access-merge")
        rows.groupBy("part", "account").agg(last).select("account", "_a.*", "part").write.parquet(staged)
        (
            spark.read.schema(ROWS)
            .parquet(staged)
            .repartition("part")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("part")
            .parquet(f"{path}/merged")
        )
        remove_dir(spark, staged)
    for batch in batches:
        remove_dir(spark, f"{path}/changes/batch={batch:010d}")
    return touched
