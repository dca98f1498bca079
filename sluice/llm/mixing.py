"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sluice.llm.common import BLANK_CHARS, BLANKS, WORD_GAP, saved

WEIGHTS = (5, 2, 1)
REPEATS = 3
BLOCK_TOKENS = 32
SHARDS = 24
SEED = "mix-1"


def word_count(text: Column) -> Column:
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANK_CHARS))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, WORD_GAP))).cast("long")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """source, rank, source_size, cap, total, target: one row per source.

    Sources by code point, null last, get the weights in turn and share the
    total of all sizes by them.  A target stops at ``repeats`` times its
    source's size; what is left over goes to the others by weight.  In the
    order of cap / weight the capped sources come first, so running sums tell
    them apart without repeating the rounds.  The windows here run over one
    row per source.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    total, everyone = F.sum("source_size").over(W.partitionBy()), W.partitionBy()
    by_source = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("weight", weight.cast("long"))
        .withColumn("cap", F.col("source_size") * repeats)
        .withColumn("total", total)
    )
    fill = W.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = F.coalesce(F.sum("cap").over(fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    onward = F.sum("weight").over(fill.rowsBetween(0, W.unboundedFollowing))
    return (
        by_source.withColumn("before", before)
        .withColumn("onward", onward)
        .withColumn("capped", (F.col("total") - F.col("before")) * F.col("weight") > F.col("cap") * F.col("onward"))
        .withColumn("capped_sum", F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everyone), F.lit(0)))
        .withColumn("open_weight", F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everyone))
        .withColumn(
            "target",
            F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
                ((F.col("total") - F.col("capped_sum")) * F.col("weight")).cast("double") / F.col("open_weight")
            ),
        )
        .select("source", "rank", "source_size", "cap", "total", "target")
    )


def quotas(plan: DataFrame, block_tokens: int = BLOCK_TOKENS, shards: int = SHARDS) -> DataFrame:
    """Blocks of each source in each output shard: source, shard, seats (up to and with it), blocks.

    Sainte-Laguë gives seats to the highest quotients target / (2 k + 1).  The
    first h shards together form a house of h/shards of all blocks; as houses
    grow no source loses a seat, so differences between houses are each
    shard's whole numbers.  With S sources and B blocks, a source's seats lie
    within target * B / total * (1 +- S / 2B) +- 1/2.  Seats below that range
    are given outright and only the few inside it are ranked, about 4 S rows a
    house.
    """
    houses = plan.withColumn("sources", F.count("*").over(W.partitionBy())).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(shards))).alias("house")
    )
    houses = houses.withColumn("blocks", F.expr(f"(total div {block_tokens}) * house div {shards}"))
    fair = F.col("target") * F.col("blocks") / F.greatest("total", F.lit(1))
    slack = F.col("sources") / (2 * F.greatest("blocks", F.lit(1)))
    ranged = houses.withColumn("low", F.greatest(F.lit(0), F.floor(fair * (1 - slack) - 0.5)).cast("long")).withColumn(
        "high", F.ceil(fair * (1 + slack) + 0.5).cast("long")
    )
    ranged = ranged.withColumn("left", F.col("blocks") - F.sum("low").over(W.partitionBy("house")))
    seats = ranged.select("*", F.explode(F.sequence("low", "high")).alias("k"))
    quotient = F.col("target") / (2 * F.col("k") + 1)
    best = F.row_number().over(W.partitionBy("house").orderBy(quotient.desc(), "rank", "k"))
    won = (best <= F.col("left")) & (F.col("target") > 0)
    totals = (
        seats.withColumn("won", won)
        .groupBy("source", "house")
        .agg((F.first("low") + F.count_if("won")).alias("seats"))
    )
    until = F.lag("seats", 1, 0).over(W.partitionBy("source").orderBy("house"))
    return totals.select("source", (F.col("house") - 1).alias("shard"), "seats", (F.col("seats") - until).alias("blocks"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = REPEATS,
    block_tokens: int = BLOCK_TOKENS,
    shards: int = SHARDS,
    seed: str = SEED,
) -> DataFrame:
    """doc_id, source, row_hash, size, source_size, target, taken of every document.

    The documents of a source stand in a seeded order and are cut into blocks
    of ``block_tokens`` words.  A source with n seats takes its first n blocks
    in that order, going round again where it has fewer, up to ``repeats``
    times.  So every document is taken whole, a whole number of times, but for
    the one in which the last block ends.  Quotas are those of the last house
    of ``quotas``; the shards only divide them up.

    Running totals go over 4096 ranges of the seeded hash per source, then
    within one range, so a source holding most rows is never one window.

    Null and empty texts have size 0 and are taken 0 times.  A null source is a
    source.  Rows without doc_id are ordered by their text.  Repeated rows are
    documents each.  An empty table gives an empty one, a table without words
    has targets 0.  Columns besides doc_id, source and text are ignored.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.col("text")), F.lit(""))
    sized = saved(
        docs.select(
            "doc_id",
            "source",
            F.xxhash64("text").alias("row_hash"),
            word_count(F.col("text")).alias("size"),
            F.md5(F.concat(F.lit(f"{seed}:"), key)).alias("place"),
        ),
        "mix-sizes",
    )
    plan = targets(sized, weights, repeats)
    won = quotas(plan, block_tokens, shards).filter(F.col("shard") == shards - 1)
    chosen = (
        plan.alias("p")
        .join(won.alias("w"), F.col("p.source").eqNullSafe(F.col("w.source")), "left")
        .select(
            F.col("p.source").alias("p_source"),
            "source_size",
            "target",
            F.least(F.coalesce("seats", F.lit(0)) * block_tokens, "cap").alias("words"),
        )
    )
    chosen = saved(chosen, "mix-plan")
    ranged = sized.withColumn("range", F.substring("place", 1, 3))
    ranges = ranged.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    so_far = F.sum("range_size").over(W.partitionBy("source").orderBy("range")) - F.col("range_size")
    ranges = ranges.select(F.col("source").alias("r_source"), F.col("range").alias("r_range"), so_far.alias("before"))
    ranges = ranges.join(chosen, F.col("r_source").eqNullSafe(F.col("p_source")), "left")
    inside = W.partitionBy("source", "range").orderBy("place", "doc_id", "row_hash", "size")
    placed = ranged.withColumn("inside", F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, -1)))
    joined = placed.join(
        ranges, F.col("source").eqNullSafe(F.col("r_source")) & (F.col("range") == F.col("r_range")), "left"
    )
    start = F.col("before") + F.coalesce("inside", F.lit(0))
    size, words = F.col("size"), F.col("words")
    whole = F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(0)
    rest = words - whole * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(size, rest - start))
    return joined.select(
        "doc_id",
        "source",
        "row_hash",
        "size",
        "source_size",
        "target",
        (whole * size + part).cast("long").alias("taken"),
    )


def first_words(text: Column, count: Column) -> Column:
    """The text up to and with its word number ``count``, blanks between words as they are."""
    pieces = F.split(text, f"(?<={BLANKS})(?!{BLANKS})")
    lead = F.when(F.element_at(pieces, 1).rlike(f"^{BLANKS}+$"), 1).otherwise(0)
    cut = F.array_join(F.slice(pieces, F.lit(1), (count + lead).cast("int")), "")
    return F.rtrim(cut, F.lit(BLANK_CHARS))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all columns kept.

    A document taken in part comes once more with the words taken.  n_chars,
    where there is such a column, follows the text.  Documents that the mix
    does not take, those without words among them, are gone.
    """
    size, taken = F.col("size"), F.col("taken")
    times = (
        mix(docs, **how)
        .filter(taken > 0)
        .groupBy("doc_id", "source", "row_hash")
        .agg(F.sum(F.expr("taken div size")).alias("full"), F.sum(taken % size).alias("part"))
    )
    # As fields of one column, the documents' names can't clash with those used here.
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("whole"))
    rows = rows.select("whole", *(F.col(f"whole.{c}").alias(f"own_{c}") for c in ("doc_id", "source")), F.xxhash64("whole.text").alias("own_hash"))
    single = rows.dropDuplicates(["own_doc_id", "own_source", "own_hash"])
    same = (
        F.col("own_doc_id").eqNullSafe(F.col("doc_id"))
        & F.col("own_source").eqNullSafe(F.col("source"))
        & (F.col("own_hash") == F.col("row_hash"))
    )
    last = F.col("full") + F.when(F.col("part") > 0, 1).otherwise(0)
    repeated = single.join(times, same).select(
        "whole", "full", "part", F.explode(F.sequence(F.lit(1), last.cast("int"))).alias("time")
    )
    cut = F.col("time") > F.col("full")
    text = F.when(cut, first_words(F.col("whole.text"), F.col("part"))).otherwise(F.col("whole.text"))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(cut, F.char_length(text).cast(kind)).otherwise(F.col("whole.n_chars"))
    return repeated.select(*(changed.get(c, F.col("whole")[c]).alias(c) for c in docs.columns))
