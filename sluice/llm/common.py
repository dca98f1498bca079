"""What several operators share: work tables, words, and fixed column sets."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import work_dir

# The blanks between words, as a Java class and as characters.
BLANKS = r"[\x20\x09-\x0D]"
BLANK_CHARS = " \t\n\x0b\x0c\r"
WORD_GAP = BLANKS + "+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def saved_at(frame: DataFrame, label: str) -> tuple[DataFrame, str]:
    """As ``saved``, with the folder, for tables that are removed before the end."""
    spark = frame.sparkSession
    where = work_dir(spark, label)
    frame.write.parquet(where)
    return spark.read.schema(frame.schema).parquet(where), where


def saved(frame: DataFrame, label: str) -> DataFrame:
    """The frame, written to a new folder below ``spark.checkpoint.dir`` and read back.

    This cuts the lineage: what follows reads shared files, whatever executors
    were lost meanwhile.
    """
    return saved_at(frame, label)[0]


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, a query's shuffle files go when the query ends; for steps that write all they hand on."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def words(text: Column) -> Column:
    """The words of a text, in order; a null text has none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANK_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, WORD_GAP))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else.

    ``translate`` looks at each character on its own.  For texts of ASCII
    alone ``lower`` means the same and is far cheaper.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def rows_of(batches: Iterator[pa.RecordBatch], budget: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that each holds about ``budget`` bytes at most; a longer row stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        step = max(1, int(batch.num_rows * budget / max(batch.nbytes, 1)))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def grouped(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """Runs of rows that agree in integer ``keys``, from batches sorted by them; one run is held at a time."""
    waiting: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in keys])
        edges = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1
        for start, end in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            own = tuple(values[:, start])
            if waiting and own != key:
                yield pa.Table.from_batches(waiting)
                waiting = []
            key = own
            waiting.append(batch.slice(start, end - start))
    if waiting:
        yield pa.Table.from_batches(waiting)


def bound(frame: DataFrame, **columns: Column) -> DataFrame:
    """The frame with columns that are computed once a row.

    The optimizer copies a column's expression into each place that uses it,
    even into lambdas, where it would run once an element.  It doesn't look
    through ``inline``.
    """
    return frame.select("*", F.inline(F.array(F.struct(*(c.alias(name) for name, c in columns.items())))))
