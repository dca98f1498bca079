"""CSV records whose quoted fields hold line feeds, from files that split freely.

A line begins inside a quoted field if the quotes before it in its file are
odd in number.  One pass counts quotes and record ends of every split under
both assumptions; totals over the splits, one small row each, say which one
holds and which record of the file a split begins with.  A second pass joins
the lines of each split.  Only pieces of records that cross a split's border
meet by a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.running import running_total
from sluice.operators.validate import LINE_CHUNK_BYTES
from sluice.session import work_dir

#: A record longer than this is taken for a quote that was never closed.
MAX_RECORD_CHARS = 16 << 20
UNCLOSED = "a quote is not closed within %d characters: %s, line %d"

_SPLIT = "path string, file_name string, block_start bigint"
_FACTS = f"{_SPLIT}, lines bigint, quotes bigint, ends_outside bigint, ends_inside bigint"
_PIECE = f"{_SPLIT}, row_id bigint, line bigint, record bigint, whole boolean, value string"


def _runs(batch: pa.RecordBatch, *columns: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch within which the columns don't change."""
    if not batch.num_rows:
        return
    edges = {0, batch.num_rows}
    for column in columns:
        values = batch.column(column)
        differ = pc.not_equal(values.slice(1), values.slice(0, len(values) - 1))
        edges.update((np.flatnonzero(differ.to_numpy(zero_copy_only=False)) + 1).tolist())
    marks = sorted(edges)
    for start, end in zip(marks, marks[1:], strict=False):
        yield batch.slice(start, end - start)


def _odd(batch: pa.RecordBatch) -> np.ndarray:
    """For each line whether it has an odd number of quotes."""
    return pc.count_substring(batch.column("value"), '"').to_numpy(zero_copy_only=False).astype(np.int64) & 1


def _split_facts(lines: DataFrame) -> DataFrame:
    """Lines, quotes (odd or even) and record ends of each split, for a start outside and inside of quotes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _runs(batch, "path", "block_start"):
                state = np.cumsum(_odd(part)) & 1
                inside = int(state.sum())
                own = [part.column(c)[0].as_py() for c in ("path", "file_name", "block_start")]
                row = [*own, part.num_rows, int(state[-1]), part.num_rows - inside, inside]
                kinds = [pa.string(), pa.string(), *[pa.int64()] * 5]
                names = ["path", "file_name", "block_start", "lines", "quotes", "ends_outside", "ends_inside"]
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

    parts = lines.select("path", "file_name", "block_start", "row_id", "value").mapInArrow(run, _FACTS)
    # A split that came in several batches has several rows, which a task gives out in order.
    ordered = parts.withColumn("_at", F.monotonically_increasing_id())
    facts = F.struct("_at", "lines", "quotes", "ends_outside", "ends_inside")
    listed = ordered.groupBy("path", "file_name", "block_start").agg(F.sort_array(F.collect_list(facts)).alias("parts"))
    zero = F.lit(0).cast("bigint")
    start = F.struct(zero.alias("lines"), zero.alias("quotes"), zero.alias("ends_outside"), zero.alias("ends_inside"))

    def joined(a, b):
        swapped = a["quotes"] == 1
        return F.struct(
            (a["lines"] + b["lines"]).alias("lines"),
            a["quotes"].bitwiseXOR(b["quotes"]).alias("quotes"),
            (a["ends_outside"] + F.when(swapped, b["ends_inside"]).otherwise(b["ends_outside"])).alias("ends_outside"),
            (a["ends_inside"] + F.when(swapped, b["ends_outside"]).otherwise(b["ends_inside"])).alias("ends_inside"),
        )

    return listed.select("path", "file_name", "block_start", F.aggregate("parts", start, joined).alias("f")).select(
        "path", "file_name", "block_start", "f.*"
    )


def _starts(facts: DataFrame) -> DataFrame:
    """Per split: whether it starts inside quotes, and the lines and records before it."""
    chunk = F.expr(f"block_start div {LINE_CHUNK_BYTES}")
    total = lambda frame, value, name: running_total(frame, ["path"], "block_start", value, name, chunk)
    timed = total(total(facts, "quotes", "_quotes"), "lines", "_lines").withColumn("inside", F.col("_quotes") % 2)
    ends = F.when(F.col("inside") == 1, F.col("ends_inside")).otherwise(F.col("ends_outside"))
    return total(timed.withColumn("ends", ends), "ends", "_records").select(
        "path", "block_start", "inside", F.col("_lines").alias("lines_before"), F.col("_records").alias("records_before")
    )


def _pieces(lines: DataFrame, limit: int) -> DataFrame:
    """Whole records and pieces of records of every split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple | None = None
        inside = line = record = 0
        first, held, size, whole = (0, 0), [], 0, True
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            names = ["path", "file_name", "block_start", "row_id", "line", "record", "whole", "value"]
            kinds = [pa.string(), pa.string(), *[pa.int64()] * 4, pa.bool_(), pa.string()]
            columns = list(zip(*out, strict=True)) or [()] * 8
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        def rest() -> None:
            """What is open at the end of a split is a piece."""
            if held:
                out.append((*key, *first, record, False, "\n".join(held)))
                held.clear()

        for batch in batches:
            for part in _runs(batch, "path", "block_start"):
                own = tuple(part.column(c)[0].as_py() for c in ("path", "file_name", "block_start"))
                if own != key:
                    rest()
                    key, size = own, 0
                    inside, line, record = (part.column(c)[0].as_py() for c in ("inside", "lines_before", "records_before"))
                    # A split that starts inside quotes begins with the end of a record.
                    whole = not inside
                state = (inside + np.cumsum(_odd(part))) & 1
                values, ids = part.column("value").to_pylist(), part.column("row_id").to_pylist()
                for value, row_id, is_open in zip(values, ids, state.tolist(), strict=True):
                    line += 1
                    if not held:
                        first, size = (row_id, line), 0
                    held.append(value)
                    size += len(value)
                    if size > limit and len(held) > 1:
                        raise ValueError(UNCLOSED % (limit, key[0], first[1]))
                    if not is_open:
                        out.append((*key, *first, record, whole, held[0] if len(held) == 1 else "\n".join(held)))
                        held.clear()
                        record += 1
                        whole = True
                inside = int(state[-1])
            if len(out) > 10_000:
                yield flush()
        rest()
        yield flush()

    columns = ("path", "file_name", "block_start", "row_id", "value", "inside", "lines_before", "records_before")
    return lines.select(*columns).mapInArrow(run, _PIECE)


def quoted_records(lines: DataFrame, limit: int = MAX_RECORD_CHARS) -> DataFrame:
    """``lines`` (see ``read_lines``) with those inside a quoted field joined to the line they go on from.

    Adds ``line``, the number in the file of a record's first line, and
    ``record``, its place among the file's records from 0.  A file that ends
    inside quotes ends with what there is.  A record longer than ``limit``
    raises, naming file and line, since one stray quote would otherwise turn a
    file's rest into one record.  Line feeds within a record are ``\\n``,
    whatever ended its lines.  An empty file has no records.
    """
    spark = lines.sparkSession
    starts = _starts(_split_facts(lines))
    # Written, its size is known: few splits are broadcast, and the lines stay where they are.
    folder = work_dir(spark, "quoted-splits")
    starts.write.parquet(folder)
    starts = spark.read.schema(starts.schema).parquet(folder)
    pieces = _pieces(lines.join(starts, ["path", "block_start"]).sortWithinPartitions("path", "block_start", "row_id"), limit)
    part = F.struct("block_start", "row_id", "line", "value")
    crossing = pieces.where("not whole").groupBy("path", "file_name", "record").agg(
        F.sort_array(F.collect_list(part)).alias("parts"), F.sum(F.char_length("value")).alias("chars")
    )
    head = F.col("parts")[0]
    too_long = F.raise_error(F.format_string(UNCLOSED, F.lit(limit), F.col("path"), head["line"])).cast("string")
    value = F.when(F.col("chars") > limit, too_long).otherwise(F.array_join(F.transform("parts", lambda p: p["value"]), "\n"))
    joined = crossing.select(
        "path", "file_name", head["block_start"].alias("block_start"), head["row_id"].alias("row_id"),
        head["line"].alias("line"), "record", value.alias("value"),
    )
    return pieces.where("whole").drop("whole").unionByName(joined)
