"""Sharding by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib
import math
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: The ring has this many cells, whatever the number of rows; what the driver handles is bounded by it.
CELL_BITS = 16
CELLS = 1 << CELL_BITS
VNODES = 128


def ring(shards: int, vnodes: int = VNODES, seed: str = "ring") -> tuple[np.ndarray, np.ndarray]:
    """Cells of all virtual nodes in ring order, and the shard of each."""
    placed = []
    for shard in range(shards):
        for node in range(vnodes):
            digest = hashlib.sha256(f"{seed}:{shard}:{node}".encode()).digest()
            placed.append((int.from_bytes(digest[:8], "big"), shard))
    placed.sort()
    return np.array([p >> (64 - CELL_BITS) for p, _ in placed]), np.array([s for _, s in placed])


def segments(counts: dict[int, int], shards: int, load: float = 1.0, vnodes: int = VNODES) -> list[tuple[int, int, int, int, int]]:
    """(cell, from, to, shard, shift): keys ranked [from, to) in their cell go to a shard, slot = rank + shift.

    First every shard takes the keys that are its own, in ring order, as far as
    it has room.  Then the others go on clockwise, those that have come
    furthest first, and stay at the first virtual node whose shard has room.
    With ``load`` 1 capacities add up to the number of keys and differ by one
    at most; with more, each is the ceiling of load times the mean.
    """
    total = sum(counts.values())
    if load > 1:
        room = [math.ceil(load * total / shards)] * shards
    else:
        room = [total // shards + (shard < total % shards) for shard in range(shards)]
    nodes, owner = ring(shards, vnodes)
    cells = sorted(counts)
    homes = np.searchsorted(nodes, cells) % len(nodes) if cells else []
    used, out = [0] * shards, []

    def give(cell: int, done: int, most: int, shard: int) -> int:
        n = min(most, room[shard])
        if n:
            out.append((cell, done, done + n, shard, used[shard] - done))
            room[shard] -= n
            used[shard] += n
        return n

    over: dict[int, list[list[int]]] = {}
    for cell, home in zip(cells, homes, strict=True):
        n = give(cell, 0, counts[cell], int(owner[home]))
        if n < counts[cell]:
            over.setdefault(int(home), []).append([cell, n, counts[cell] - n])
    waiting: deque[list[int]] = deque()
    for step in range(2 * len(nodes)):
        at = step % len(nodes)
        if step < len(nodes):
            waiting.extend(over.get(at, []))
        while waiting and room[owner[at]]:
            cell, done, left = waiting[0]
            n = give(cell, done, left, int(owner[at]))
            if n == left:
                waiting.popleft()
            else:
                waiting[0] = [cell, done + n, left - n]
    return out


def assign(docs: DataFrame, shards: int, load: float = 1.0, vnodes: int = VNODES) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row.

    A row's place on the ring is a hash of its doc_id.  Only the number of rows
    per ring cell reaches the driver, 65,536 numbers at most; the segments that
    come back are about as many and are broadcast for that reason.  Within a
    cell rows rank by hash, doc_id, checksum and size, so the result does not
    depend on how rows are spread; rows alike in all of these are
    interchangeable.  Slots run from 0 without gaps in each shard.

    Null and empty texts have size 8 and checksum 0.  Rows without doc_id are placed by their checksum.  An empty
    table gives an empty one.  Columns besides doc_id and text are ignored.
    """
    spark = docs.sparkSession
    place = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit("none"), "text")).otherwise(F.xxhash64("doc_id"))
    cell = F.shiftrightunsigned(place, 64 - CELL_BITS).cast("int")
    counts = {row["cell"]: row["count"] for row in docs.groupBy(cell.alias("cell")).count().collect()}
    columns = list(zip(*segments(counts, shards, load, vnodes), strict=True)) or [()] * 5
    names = ("s_cell", "from", "to", "shard", "shift")
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    plan = spark.createDataFrame(pa.Table.from_arrays(arrays, names=list(names)))
    slim = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        place.alias("place"),
        cell.alias("cell"),
    )
    order = W.partitionBy("cell").orderBy("place", "doc_id", "text_crc32", "size")
    ranked = slim.withColumn("at", (F.row_number().over(order) - 1).cast("long"))
    here = (F.col("cell") == F.col("s_cell")) & (F.col("at") >= F.col("from")) & (F.col("at") < F.col("to"))
    return ranked.join(F.broadcast(plan), here).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("at") + F.col("shift")).alias("slot")
    )
