"""Near-duplicate vectors: binary codes by iterative quantisation, multi-index Hamming tables, exact reranking."""

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

COSINE = 0.93
#: The rotations are learned on so many vectors at most, those of the smallest hashes.
SAMPLE = 20_000
ITERATIONS = 30
#: A pair exactly at the threshold is missed by all tables with this probability.
MISS = 0.0005
#: Rows of a bucket that meet in one comparison; larger buckets are cut into pairs of blocks.
BLOCK = 1024


class Codes:
    """Rotations that give a vector its bits, cut into one substring per table; each width has its own.

    Vectors keep their place around the origin.  Bits then differ with the
    angle that the cosine measures, whatever else the label holds; seen from
    the mean of a dense group, its members would stand at right angles.
    """

    def __init__(self, learned: dict[int, list[np.ndarray]], bits: int, tables: int, seed: int) -> None:
        self.learned, self.bits, self.tables, self.seed = learned, bits, tables, seed

    def rotations(self, width: int) -> list[np.ndarray]:
        """Those learned, or random ones for a width of which the sample had too few vectors."""
        if width not in self.learned:
            random = np.random.default_rng((self.seed, width))
            number = math.ceil(self.bits * self.tables / width)
            self.learned[width] = [np.linalg.qr(random.normal(size=(width, width)))[0] for _ in range(number)]
        return self.learned[width]

    def substrings(self, units: np.ndarray) -> np.ndarray:
        """A number per unit vector and table."""
        signs = np.concatenate([units @ r > 0 for r in self.rotations(units.shape[1])], axis=1)
        signs = signs[:, : self.tables * self.bits].reshape(len(units), self.tables, self.bits)
        return signs.astype(np.int64) @ (np.int64(1) << np.arange(self.bits, dtype=np.int64))


def learn_rotation(units: np.ndarray, start: np.ndarray, iterations: int = ITERATIONS) -> np.ndarray:
    """Iterative quantisation: turn principal axes so that signs lose little.

    In turns the codes become the signs of the turned vectors and the rotation
    the one that brings the vectors nearest to the codes, which balances the
    variance over the bits.
    """
    axes = np.linalg.svd(units, full_matrices=False)[2].T
    flat = units @ axes
    rotation = np.linalg.qr(start)[0]
    for _ in range(iterations):
        codes = np.where(flat @ rotation > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(flat.T @ codes)
        rotation = left @ right
    return axes @ rotation


def plan_tables(largest: int, cosine: float = COSINE, miss: float = MISS) -> tuple[int, int]:
    """Bits of a substring and number of tables.

    Substrings are so long that a bucket of unlike vectors has an eighth of a
    row: log2 of the largest label's rows, plus 3.  A bit of two vectors at
    the threshold differs with probability angle / pi at most; tables are
    added until a pair agrees in one of them.
    """
    bits = min(40, max(8, math.ceil(math.log2(max(largest, 2))) + 3))
    agree = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-agree))


def fit(vectors: DataFrame, sample: int = SAMPLE, cosine: float = COSINE, seed: int = 3) -> Codes | None:
    """Codes learned on a bounded sample of ``vectors`` (label, embedding); None where there is nothing to link."""
    largest = vectors.groupBy("label").count().agg(F.max("count")).first()[0]
    if not largest:
        return None
    rows = vectors.orderBy(F.xxhash64("embedding"), "embedding").limit(sample).select("embedding").collect()
    by_width: dict[int, list] = {}
    for row in rows:
        by_width.setdefault(len(row["embedding"]), []).append(row["embedding"])
    bits, tables = plan_tables(largest, cosine)
    learned = {}
    random = np.random.default_rng(seed)
    for width, sampled in sorted(by_width.items()):
        if len(sampled) >= width:
            data = np.array(sampled, dtype=np.float64)
            units = data / np.linalg.norm(data, axis=1, keepdims=True)
            number = math.ceil(bits * tables / width)
            learned[width] = [learn_rotation(units, random.normal(size=(width, width))) for _ in range(number)]
    return Codes(learned, bits, tables, seed)


def _encoded(classes: DataFrame, codes: Codes) -> DataFrame:
    """print, label, embedding, n, substrings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 4 << 20):
            vectors = batch.column(2)
            widths = np.array([len(v) for v in vectors])
            strings = np.empty((batch.num_rows, codes.tables), np.int64)
            for width in np.unique(widths):
                own = np.flatnonzero(widths == width)
                data = vectors.take(pa.array(own)).flatten().to_numpy().astype(np.float64).reshape(len(own), -1)
                strings[own] = codes.substrings(data / np.linalg.norm(data, axis=1, keepdims=True))
            column = pa.array(list(strings), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], ["print", "label", "embedding", "n", "substrings"])

    schema = "print binary, label int, embedding array<float>, n bigint, substrings array<bigint>"
    return classes.select("print", "label", "embedding", "n").mapInArrow(run, schema)


def _printed(vectors: DataFrame) -> DataFrame:
    """vec_id, label, embedding, print: 128 bits of label and vector, null where the row links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 4 << 20):
            prints = []
            for label, vector in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                usable = label is not None and vector and None not in vector
                data = np.array(vector, dtype=np.float32) + np.float32(0) if usable else np.zeros(1, np.float32)
                # Minus zero became zero; a width of its own keeps vectors of other lengths apart.
                sound = usable and np.isfinite(data).all() and data.any()
                prints.append(xxhash.xxh3_128_digest(label.to_bytes(8, "big", signed=True) + data.tobytes()) if sound else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(prints, pa.binary())], ["vec_id", "label", "embedding", "print"]
            )

    schema = "vec_id bigint, label int, embedding array<float>, print binary"
    return vectors.select("vec_id", F.col("label").cast("int"), "embedding").mapInArrow(run, schema)


def _linked(blocks: DataFrame, cosine: float) -> DataFrame:
    """print, links (rows it links with), other (a class it is joined with, null for none), per class and comparison.

    Rows arrive sorted by ``meeting``.  All rows of a meeting are compared by
    original vectors in double precision; a pair counts only in the first
    table whose substrings agree.  Joins between classes are given as a
    spanning forest of the meeting, not as pairs.
    """

    def compare(met: pa.Table) -> Iterator[tuple[bytes, int, bytes | None]]:
        n = met.num_rows
        data = met["embedding"].combine_chunks().flatten().to_numpy().astype(np.float64).reshape(n, -1)
        strings = met["substrings"].combine_chunks().flatten().to_numpy().reshape(n, -1)
        side, label, weight = (met[c].to_numpy() for c in ("side", "label", "n"))
        prints = met["print"].to_pylist()
        table = met["at"][0].as_py()
        norms = np.linalg.norm(data, axis=1)
        near = (data @ data.T) / np.outer(norms, norms) >= cosine
        # Sides 0 and 1 meet each other; side 2 meets itself.
        near &= (side[:, None] != side[None, :]) | (side[:, None] == 2)
        # Buckets whose hashes are equal by chance stay apart.
        near &= (label[:, None] == label[None, :]) & (strings[:, table, None] == strings[None, :, table])
        np.fill_diagonal(near, False)
        for i in np.flatnonzero(near.any(axis=1)):
            others = np.flatnonzero(near[i])
            earlier = (strings[others, :table] == strings[i, :table]).any(axis=1)
            near[i, others[earlier]] = False
        links = near @ weight
        root = list(range(n))

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i in np.flatnonzero(links):
            for j in np.flatnonzero(near[i, :i]):
                one, two = top(int(i)), top(int(j))
                if one != two:
                    root[max(one, two)] = min(one, two)
        for i in np.flatnonzero(links):
            r = top(int(i))
            yield prints[i], int(links[i]), prints[r] if r != i else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            kinds = (pa.binary(), pa.int64(), pa.binary())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, ["print", "links", "other"])

        for met in grouped(batches, "meeting", "at", "width"):
            if met.num_rows > 1:
                out.extend(compare(met))
            if len(out) > 20_000:
                yield flush()
        yield flush()

    return blocks.mapInArrow(run, "print binary, links bigint, other binary")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, sample: int = SAMPLE) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id, label, embedding).

    Equal vectors of a label form a class, and only classes are compared; a
    class counts for all its rows.  Rotations are learned on ``sample`` vectors
    at most.  A class lies in one bucket per table: label, table, substring.
    Buckets of one class are dropped first, so vectors travel only where they
    meet another.  A bucket of more than ``BLOCK`` classes is cut into blocks
    by hash and every two blocks meet in a task of their own, so none is capped
    and no pairs are written: a meeting gives counts and a spanning forest.

    Classes that share a bucket of the first table have met there.  In a later
    bucket the largest such part is not compared with itself again, so a dense
    group costs its pairs once, and after that only what left it.

    Vectors that are null, empty, zero or hold null or non-finite components,
    and rows with a null label, have 0 links and are their own component.
    Vectors of different widths don't link.  Repeated rows link with each other.  Rows without vec_id count
    as links; component_id is the smallest vec_id there is.  An empty table
    gives an empty one; other columns are ignored.
    """
    rows = saved(_printed(vectors), "vector-rows")
    classes = (
        rows.filter(F.col("print").isNotNull())
        .groupBy("print")
        .agg(
            F.first("label").alias("label"),
            F.first("embedding").alias("embedding"),
            F.count("*").alias("n"),
            F.min("vec_id").alias("vec_id"),
        )
    )
    classes = saved(classes, "vector-classes")
    codes = fit(classes.select("label", "embedding"), sample, cosine)
    own = classes.select("print", "n", "vec_id")
    if codes is None:
        none = F.lit(0).cast("long").alias("links")
        labelled = own.select("print", "vec_id", "n", none, F.col("print").alias("component"))
    else:
        encoded = saved(_encoded(classes, codes), "vector-codes")
        own_width = F.size("embedding").alias("width")
        cell = F.xxhash64("label", own_width, F.col("substrings")[0]).alias("cell")
        slim = encoded.select("print", "label", own_width, cell, F.posexplode("substrings").alias("at", "code"))
        slim = slim.select("print", "at", "cell", F.xxhash64("label", "width", "at", "code").alias("bucket"))
        # Of each bucket its largest part that has met in the first table, and the rest; in the first table all are rest.
        parts = slim.groupBy("bucket", "at", "cell").agg(F.count("*").alias("size"))
        shared = parts.groupBy("bucket", "at").agg(
            F.sum("size").alias("size"), F.max("size").alias("met"), F.max_by("cell", F.struct("size", "cell")).alias("main")
        )
        shared = shared.withColumn("met", F.when(F.col("at") == 0, 0).otherwise(F.col("met")))
        shared = shared.where((F.col("size") > 1) & (F.col("size") > F.col("met"))).select(
            "bucket",
            F.when(F.col("at") > 0, F.col("main")).alias("main"),
            F.ceil((F.col("size") - F.col("met")) / BLOCK).cast("int").alias("blocks"),
            F.ceil(F.col("met") / BLOCK).cast("int").alias("main_blocks"),
        )
        # Read from a table, this side is shuffled for the join, and a hot bucket can be split.
        shared = saved(shared, "vector-buckets")
        kept = slim.join(shared, "bucket").withColumn("in_main", F.coalesce(F.col("cell") == F.col("main"), F.lit(False)))
        spread = F.xxhash64("print", F.lit("block"))
        placed = kept.withColumn("block", F.pmod(spread, F.when(F.col("in_main"), F.col("main_blocks")).otherwise(F.col("blocks"))).cast("int"))

        def meeting(one: Column, two: Column, side: Column) -> Column:
            return F.struct(one.alias("one"), two.alias("two"), side.alias("side"))

        among = F.transform(
            F.sequence(F.lit(0), F.col("blocks") - 1),
            lambda other: meeting(
                F.least("block", other),
                F.greatest("block", other),
                F.when(F.col("block") == other, 2).when(F.col("block") < other, 0).otherwise(1),
            ),
        )
        # Blocks of the main part are numbered from -1 down and meet the others only.
        with_main = F.transform(
            F.sequence(F.lit(1), F.col("main_blocks")), lambda main: meeting(-main, F.col("block"), F.lit(1))
        )
        with_main = F.when(F.col("main_blocks") > 0, with_main).otherwise(F.slice(among, 1, 0))
        with_rest = F.transform(
            F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: meeting(-1 - F.col("block"), other, F.lit(0))
        )
        # All of a bucket that fits one comparison meets at once.
        small = (F.col("blocks") == 1) & (F.col("main_blocks") <= 1)
        once = F.array(meeting(F.lit(0), F.lit(0), F.lit(2)))
        meet = F.when(small, once).when(F.col("in_main"), with_rest).otherwise(F.concat(among, with_main))
        met = placed.withColumn("m", F.explode(meet)).select(
            "print", "at", F.col("m.side").alias("side"), F.xxhash64("bucket", "m.one", "m.two").alias("meeting")
        )
        full = met.join(encoded.select("print", "label", own_width, "embedding", "substrings", "n"), "print")
        blocks = full.repartition("meeting").sortWithinPartitions("meeting", "at", "width")
        linked = saved(_linked(blocks, cosine), "vector-links")
        joined = components(linked.select(F.col("print").alias("a"), F.col("other").alias("b")))
        sums = linked.groupBy("print").agg(F.sum("links").alias("links"))
        labelled = (
            own.join(sums, "print", "left")
            .join(joined, F.col("print") == F.col("node"), "left")
            .select("print", "vec_id", "n", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "print").alias("component"))
        )
    labelled = saved(labelled, "vector-labels")
    smallest = saved(labelled.groupBy("component").agg(F.min("vec_id").alias("component_id")), "vector-smallest")
    own_links = (F.col("links") + F.col("n") - 1).alias("n_links")
    labels = saved(labelled.join(smallest, "component").select("print", "component_id", own_links), "vector-labels")
    alone = F.col("print").isNull()
    return (
        rows.select("vec_id", "print")
        .join(labels, "print", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.when(alone, F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
