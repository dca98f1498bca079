"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import saved


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to its smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = saved(both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low")), "stars-low")
    return both.filter(F.col("b") > F.col("a")).join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the smallest of them."""
    low = saved(edges.groupBy("a").agg(F.min("b").alias("low")), "stars-low")
    moved = edges.join(low, "a").filter(F.col("b") > F.col("low")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(low.select("a", F.col("low").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node in ``edges`` (a, b).

    A round sends minima along the edges by aggregates, which combine before
    the shuffle, and joins them back.  The minima are written and read between
    the two, so that the join has a shuffle on either side and a hub can be
    split.  Rounds
    end when no edge changes; the number grows with the logarithm of the
    largest component.  Each round is written and read again.  Edges with a
    null end are ignored, loops and repeats do no harm.
    """
    a, b = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    proper = edges.filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    now = saved(proper.select(a, b).filter(F.col("a") > F.col("b")).distinct(), "stars")
    sign = lambda frame: frame.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before, current = None, sign(now)
    while current[0] and before != current:
        now = saved(_small_star(_large_star(now)), "stars")
        before, current = current, sign(now)
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
