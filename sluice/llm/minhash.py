"""Near-duplicate documents by b-bit MinHash, links confirmed on full shingle sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import grouped, rows_of, saved
from sluice.llm.components import components
from sluice.llm.shingles import mixed, shingle_hashes, word_hashes

PERCENT = 75
#: 32 bands of 4 minima miss a pair of similarity 0.75 five times in a million.
BANDS, ROWS = 32, 4
MINIMA = BANDS * ROWS
#: Low bits of each minimum that a signature keeps.
BITS = 2
#: Classes of a bucket that meet in one comparison.
BLOCK = 512
#: Pairs estimated so many standard errors below the threshold are not confirmed any more.
ERRORS = 5

_random = np.random.default_rng(75)
_masks = _random.integers(0, 2**32, MINIMA, dtype=np.uint32)[:, None]
_factors = (_random.integers(0, 2**31, MINIMA, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_band_factors = _random.integers(1, 2**63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_band_salts = _random.integers(0, 2**63, BANDS, dtype=np.uint64)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The minimum of a shingle set under each permutation."""
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(MINIMA, np.iinfo(np.uint32).max, np.uint32)
    for start in range(0, len(values), 2048):
        part = (values[None, start : start + 2048] ^ _masks) * _factors
        part ^= part >> np.uint32(15)
        np.minimum(best, part.min(axis=1), out=best)
    return best


def signature(low: np.ndarray) -> np.ndarray:
    """Low bits of the minima, 32 to a long."""
    lanes = (low & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(-1, 64 // BITS)
    return np.bitwise_or.reduce(lanes << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS)), axis=1).view(np.int64)


def band_keys(low: np.ndarray) -> np.ndarray:
    """A 64-bit key per band, of the whole minima."""
    rows = low.reshape(BANDS, ROWS).astype(np.uint64)
    return mixed((rows * _band_factors).sum(axis=1) + _band_salts).view(np.int64)


def most_unequal() -> int:
    """Unequal lanes up to which a pair may still reach the threshold.

    Lanes of unlike documents agree by chance once in 2^BITS, so lanes agree
    with probability C + (1 - C) J.
    """
    chance = 0.5**BITS
    agree = chance + (1 - chance) * PERCENT / 100
    return math.floor(MINIMA * (1 - agree) + ERRORS * math.sqrt(MINIMA * agree * (1 - agree)))


def estimate(left: Column, right: Column) -> Column:
    """Similarity estimated from two signatures, corrected for lanes that agree by chance."""
    chance = 0.5**BITS
    return ((1 - unequal_lanes(left, right) / MINIMA) - chance) / (1 - chance)


def unequal_lanes(left: Column, right: Column) -> Column:
    """Lanes that differ: any of a lane's bits, counted by ``bit_count``."""
    total = F.lit(0)
    for i in range(MINIMA * BITS // 64):
        unlike = F.get(left, i).bitwiseXOR(F.get(right, i))
        folded = unlike.bitwiseOR(F.shiftrightunsigned(unlike, 1)).bitwiseAND(F.lit(0x5555555555555555))
        total = total + F.bit_count(folded)
    return total


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, row_hash, n_shingles, print (128 bits of the set), signature, bands of every row, narrow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            sizes, prints, signs, bands = [], [], [], []
            for text in batch.column(2):
                shingles = np.unique(shingle_hashes(word_hashes(text.as_py())))
                sizes.append(len(shingles))
                if len(shingles):
                    low = minima(shingles)
                    prints.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                    signs.append(signature(low))
                    bands.append(band_keys(low))
                else:
                    prints.append(None)
                    signs.append(None)
                    bands.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.array(prints, pa.binary()),
                    pa.array(signs, pa.list_(pa.int64())),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["doc_id", "row_hash", "n_shingles", "print", "signature", "bands"],
            )

    schema = "doc_id bigint, row_hash bigint, n_shingles bigint, print binary, signature array<bigint>, bands array<bigint>"
    return docs.select("doc_id", F.xxhash64("text").alias("row_hash"), "text").mapInArrow(run, schema)


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """print, shingles of the wanted classes, from the text of one row of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches):
            sets = [np.unique(shingle_hashes(word_hashes(text.as_py()))).view(np.int64) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["print", "shingles"])

    rows = docs.select(F.col("doc_id").alias("__doc"), F.xxhash64("text").alias("__row"), "text")
    same = F.col("__doc").eqNullSafe(F.col("rep.doc_id")) & (F.col("__row") == F.col("rep.row_hash"))
    return rows.join(wanted, same).select("print", "text").mapInArrow(run, "print binary, shingles array<bigint>")


def _likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sizes and signatures allow the threshold."""
    for end in ("a", "b"):
        known = classes.select(F.col("print").alias(end), F.col("n").alias(f"n_{end}"), F.col("signature").alias(f"s_{end}"))
        pairs = pairs.join(known, end)
    return pairs.filter(_may_link("n_a", "s_a", "n_b", "s_b")).select("a", "b")


def _may_link(n_a: str, s_a: str, n_b: str, s_b: str) -> Column:
    sizes = 100 * F.least(n_a, n_b) >= PERCENT * F.greatest(n_a, n_b)
    return sizes & (unequal_lanes(F.col(s_a), F.col(s_b)) <= most_unequal())


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose full sets reach the threshold."""
    for end in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("print").alias(end), F.col("shingles").alias(f"set_{end}")), end)
    shared = F.size(F.array_intersect("set_a", "set_b"))
    counted = pairs.select("a", "b", shared.alias("shared"), (F.size("set_a") + F.size("set_b")).alias("both"))
    return counted.filter(100 * F.col("shared") >= PERCENT * (F.col("both") - F.col("shared"))).select("a", "b")


def _ordered(left: Column | str, right: Column | str) -> list[Column]:
    return [F.least(left, right).alias("a"), F.greatest(left, right).alias("b")]


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, row_hash, n_shingles, component_id, kept of every row.

    Texts with equal shingle sets form a class, and only classes are compared.
    A bucket is all classes with one band key.  A class's degree is the number
    of classes it meets over all bands; an original that was often edited has a
    higher one than its copies, which may be less alike among themselves.  The
    class of highest degree leads a bucket, and each class is first paired with
    the one that leads most of its buckets.  Where a bucket still holds several
    components after that, its classes meet in blocks of ``BLOCK``, any two
    blocks in a task of their own, and each pair of different components is
    compared once.  A meeting returns a spanning forest of the links it found,
    not its pairs, and no bucket is capped.
    Pairs are thinned out by size and by b-bit estimate, five standard errors
    below the threshold, and confirmed on their full sets of 64-bit shingle
    hashes.

    Texts without words have no shingles, link with nothing and stay.  Repeated
    rows are one class.  component_id is the smallest doc_id reachable; rows
    without doc_id link like others but give their component no number, and
    are kept only if nothing in it has one.  An empty table gives an empty one.
    Columns besides doc_id and text are ignored.
    """
    found = _grouped(docs).drop("component")
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _grouped(docs: DataFrame) -> DataFrame:
    """doc_id, row_hash, n_shingles, component (null without words), component_id of every row."""
    rows = saved(signatures(docs), "minhash-rows")
    classes = saved(
        rows.filter("n_shingles > 0")
        .groupBy("print")
        .agg(
            F.min(F.struct(F.isnull("doc_id"), "doc_id", "row_hash")).alias("rep"),
            *(F.first(c).alias(n) for c, n in (("n_shingles", "n"), ("signature", "signature"), ("bands", "bands"))),
        ),
        "minhash-classes",
    )
    member = classes.select("print", F.explode("bands").alias("band"))
    # Read from tables, both sides of this join and of those below are shuffled for it, and hot keys can be split.
    shared = saved(member.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1"), "minhash-shared")
    found = saved(member.join(shared, "band"), "minhash-found")
    degrees = saved(found.groupBy("print").agg(F.sum("size").alias("degree")), "minhash-degrees")
    buckets = saved(found.join(degrees, "print").select("print", "band", "degree"), "minhash-buckets")
    sets = _sets(docs, classes.join(degrees, "print", "left_semi").select("print", "rep"))
    sets = saved(sets, "minhash-sets")

    first = F.max(F.struct("degree", "print")).alias("lead")
    leads = saved(buckets.groupBy("band").agg(first).select("band", "lead.print"), "minhash-leads")
    led = buckets.join(leads.withColumnRenamed("print", "lead"), "band").filter(F.col("print") != F.col("lead"))
    star = saved(_nearest(led), "minhash-star")
    tried = saved(_likely(star, classes), "minhash-pairs")
    links = saved(_confirmed(tried, sets), "minhash-links")
    joined = saved(components(links), "minhash-components")

    met = _meetings(saved(_still_open(buckets, joined), "minhash-open"))
    known = classes.select("print", "signature", "bands").join(sets, "print")
    found = saved(_met(met.join(known, "print")), "minhash-met")
    joined = components(links.union(found))

    labelled = classes.select("print", "rep.doc_id").join(joined, F.col("print") == F.col("node"), "left")
    labelled = labelled.select("print", "doc_id", F.coalesce("component", "print").alias("component"))
    labelled = saved(labelled, "minhash-labels")
    smallest = saved(labelled.groupBy("component").agg(F.min("doc_id").alias("component_id")), "minhash-smallest")
    labels = saved(labelled.join(smallest, "component").select("print", "component", "component_id"), "minhash-labels")
    component_id = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return (
        rows.select("doc_id", "row_hash", "n_shingles", "print")
        .join(labels, "print", "left")
        .select("doc_id", "row_hash", "n_shingles", "component", component_id.alias("component_id"))
    )


def _nearest(led: DataFrame) -> DataFrame:
    """Each class with the one of its bands' leading classes that leads most of them."""
    shared = led.groupBy("print", "lead").agg(F.count("*").alias("bands"))
    best = shared.groupBy("print").agg(F.max_by("lead", F.struct("bands", "lead")).alias("lead"))
    return best.select(*_ordered("print", "lead")).distinct()


def _still_open(buckets: DataFrame, joined: DataFrame) -> DataFrame:
    """print, band, component, size of the buckets whose classes are in different components."""
    own = joined.select(F.col("node").alias("print"), F.col("component"))
    placed = buckets.join(own, "print", "left").withColumn("component", F.coalesce("component", "print"))
    mixed_bands = placed.groupBy("band").agg(
        F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("size")
    )
    mixed_bands = saved(mixed_bands.filter("least < most").select("band", "size"), "minhash-mixed")
    return placed.join(mixed_bands, "band").select("print", "band", "component", "size")


def _meetings(opened: DataFrame) -> DataFrame:
    """print, component, band, meeting, side: every two blocks of an open bucket meet, and each block itself."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("print", F.lit("block")), blocks).cast("int")
    meet = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda other: F.struct(
            F.least(block, other).alias("one"),
            F.greatest(block, other).alias("two"),
            F.when(block == other, 2).when(block < other, 0).otherwise(1).alias("side"),
        ),
    )
    met = opened.select("print", "component", "band", F.explode(meet).alias("m"))
    return met.select(
        "print", "component", "band", F.xxhash64("band", "m.one", "m.two").alias("meeting"), F.col("m.side").alias("side")
    )


def _links_met(met: pa.Table) -> list[tuple[bytes, bytes]]:
    """A spanning forest of the links between components, found in one meeting.

    Sizes and signatures are compared as a matrix; what is left, and has not
    met in an earlier band, is confirmed on the full sets.
    """
    n = met.num_rows
    prints = met["print"].to_pylist()
    component = np.unique(np.array(met["component"].to_pylist(), dtype=object), return_inverse=True)[1]
    side = met["side"].to_numpy()
    bands, signs = (met[c].combine_chunks().flatten().to_numpy().reshape(n, -1) for c in ("bands", "signature"))
    column = met["shingles"].combine_chunks()
    ends = column.offsets.to_numpy() - column.offsets[0].as_py()
    shingles = column.flatten().to_numpy()
    size = np.diff(ends)
    at = int(np.flatnonzero(bands[0] == met["band"][0].as_py())[0])
    low_bits = np.int64(0x5555555555555555)
    root = list(range(n))
    found = []

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(n - 1):
        others = np.arange(i + 1, n)
        others = others[(component[others] != component[i]) & ((side[others] != side[i]) | (side[others] == 2))]
        others = others[100 * np.minimum(size[others], size[i]) >= PERCENT * np.maximum(size[others], size[i])]
        unlike = signs[others] ^ signs[i]
        unequal = np.bitwise_count((unlike | (unlike >> 1)) & low_bits).sum(axis=1)
        others = others[unequal <= most_unequal()]
        others = others[~(bands[others, :at] == bands[i, :at]).any(axis=1)]
        others = others[bands[others, at] == bands[i, at]]
        if not len(others):
            continue
        own = shingles[ends[i] : ends[i + 1]]
        own = own[np.argsort(own)]
        parts = np.concatenate([shingles[ends[j] : ends[j + 1]] for j in others])
        places = np.minimum(np.searchsorted(own, parts), len(own) - 1)
        starts = np.concatenate([[0], np.cumsum(size[others])[:-1]])
        shared = np.add.reduceat((own[places] == parts).astype(np.int64), starts)
        for j in others[100 * shared >= PERCENT * (size[others] + size[i] - shared)]:
            one, two = top(i), top(int(j))
            if one != two:
                root[max(one, two)] = min(one, two)
                found.append((min(prints[i], prints[j]), max(prints[i], prints[j])))
    return found


def _met(rows: DataFrame) -> DataFrame:
    """a, b: links between classes of different components, of all meetings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for met in grouped(batches, "meeting", "band"):
            links = _links_met(met) if met.num_rows > 1 else []
            if links:
                columns = [pa.array(c, pa.binary()) for c in zip(*links, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    dealt = rows.repartition("meeting").sortWithinPartitions("meeting", "band")
    return dealt.mapInArrow(run, "a binary, b binary")


def dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, one of each group of near-duplicates; texts without words all stay.

    The one is the smallest by doc_id, null last, then by the hash of its text,
    so it is one even where doc_ids are null or repeated.
    """
    found = saved(_grouped(docs), "dedup-groups")
    first = F.min(F.struct(F.isnull("doc_id"), "doc_id", "row_hash")).alias("first")
    ones = found.filter("component is not null").groupBy("component").agg(first).select("first.doc_id", "first.row_hash")
    kept = ones.union(found.filter("component is null").select("doc_id", "row_hash")).distinct()
    # As fields of one column, the documents' names can't clash with those used here.
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("whole"))
    rows = rows.select("whole", F.col("whole.doc_id").alias("own_id"), F.xxhash64("whole.text").alias("own_hash"))
    same = F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own_hash") == F.col("row_hash"))
    once = rows.dropDuplicates(["own_id", "own_hash"]).join(kept, same)
    return once.select(*(F.col("whole")[c].alias(c) for c in docs.columns))
