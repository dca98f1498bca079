"""Benchmark decontamination: a prefix-filtered join of item windows with documents, verified word by word."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import ascii_lower, saved

#: Consecutive item words that count as copied; a shorter item is one window.
WINDOW = 10
#: Words of a shingle; a shorter window is one shingle.
SHINGLE = 3
#: Shingle hashes are first looked up in so many slots, the only table that is broadcast.
SLOTS = 1 << 20
# What stands between the words of items and documents.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def item_words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _token(width: int, words: list[Column]) -> Column:
    return F.xxhash64(F.lit(width), *words[:width])


def windows_of(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """item_id and text (words joined by blanks) of every window of every item, each pair once."""
    items = benchmark.select("item_id", item_words(F.col("text")).alias("words")).where(F.size("words") > 0)
    size = F.least(F.size("words"), F.lit(width))
    starts = F.sequence(F.lit(0), F.size("words") - size)
    texts = F.transform(starts, lambda at: F.array_join(F.slice("words", at + 1, size), " "))
    return items.select("item_id", F.explode(texts).alias("text")).distinct()


def _shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """Every window with its shingles: win, size, offset, width, token."""
    words = windows.select("win", F.split("text", " ").alias("words"))
    width = F.least(F.size("words"), F.lit(shingle))
    placed = words.select(
        "win",
        "words",
        F.size("words").alias("size"),
        width.alias("width"),
        F.explode(F.sequence(F.lit(0), F.size("words") - width)).alias("offset"),
    )
    own = [F.get("words", F.col("offset") + i) for i in range(shingle)]
    token = reduce(lambda rest, k: F.when(F.col("width") == k, _token(k, own)).otherwise(rest), range(1, shingle + 1), F.lit(None).cast("long"))
    return placed.select("win", "size", "offset", "width", token.alias("token"))


def _occurrences(docs: DataFrame, widths: list[int], tokens: DataFrame, slots: int) -> DataFrame:
    """Places of documents whose shingle may be one of ``tokens``: doc_id, row_hash, words, pos, token.

    The words of a document stay one array; places are made, hashed and looked
    up within one stage, and only those whose slot is taken go on.  The table
    of taken slots has ``slots`` rows at most, whatever the benchmark's size.
    """
    base = docs.select("doc_id", F.xxhash64("text").alias("row_hash"), item_words(F.col("text")).alias("words"))
    placed = base.select("*", F.posexplode("words").alias("pos", "word"))
    widest = [F.col("word"), *(F.get("words", F.col("pos") + i) for i in range(1, max(widths)))]
    found = [F.when(F.col("pos") + k <= F.size("words"), _token(k, widest)) for k in widths]
    own = ["doc_id", "row_hash", "words", "pos"]
    if len(widths) == 1:
        hashed = placed.select(*own, found[0].alias("token"))
    else:
        hashed = placed.select(*own, F.explode(F.array(*found)).alias("token"))
    slot = lambda token: token.bitwiseAND(F.lit(slots - 1)).cast("int")
    taken = saved(tokens.select(slot(F.col("token")).alias("slot")).distinct(), "leak-slots")
    return hashed.join(F.broadcast(taken), slot(hashed["token"]) == taken["slot"], "left_semi")


def copied_windows(
    docs: DataFrame, windows: DataFrame, width: int = WINDOW, shingle: int = SHINGLE, slots: int = SLOTS
) -> DataFrame:
    """doc_id, row_hash, start, size, win of every occurrence of a window (win, text) in a document.

    Containment must be whole, so of a window's n shingles n - n + 1 = 1 is the
    necessary prefix: the rarest one, by its number of places in all
    documents, ties by hash.  Where a document holds that shingle, the window
    can only lie at one place, which must be inside the document; the words
    there are joined with the windows' texts.  A window one of whose shingles
    occurs nowhere is dropped before.  A shingle that is the rarest of many
    windows leads to its few offsets, not to each of the windows, so no place
    is compared with more than a fixed number of texts.
    """
    shingles = saved(_shingles(windows, shingle), "leak-shingles")
    widths = sorted(r["width"] for r in shingles.select("width").distinct().collect())
    if not widths:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, row_hash bigint, start int, size int, win bigint")
    counts = _occurrences(docs, widths, shingles, slots).groupBy("token").agg(F.count("*").alias("places"))
    rare = shingles.join(saved(counts, "leak-counts"), "token", "left")
    first = F.min(F.struct(F.coalesce("places", F.lit(0)).alias("places"), "token", "offset", "size")).alias("first")
    prefixes = rare.groupBy("win").agg(first).where("first.places > 0").select("first.*")
    offsets = saved(prefixes.groupBy("token").agg(F.collect_set(F.struct("offset", "size")).alias("at")), "leak-prefixes")

    before = width - 1
    begin = F.greatest(F.col("pos") - before, F.lit(0))
    near = _occurrences(docs, widths, offsets, slots).select(
        "doc_id",
        "row_hash",
        "token",
        "pos",
        F.size("words").alias("n"),
        begin.alias("begin"),
        F.slice("words", begin + 1, F.lit(2 * width)).alias("around"),
    )
    tried = near.join(offsets, "token").select("*", F.inline("at")).withColumn("start", F.col("pos") - F.col("offset"))
    tried = tried.where((F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("n")))
    text = F.array_join(F.slice("around", F.col("start") - F.col("begin") + 1, F.col("size")), " ")
    return tried.select("doc_id", "row_hash", "start", "size", text.alias("text")).join(windows, "text").drop("text")


def contamination(
    docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, shingle: int = SHINGLE, slots: int = SLOTS
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items, items_sha256, contaminated of every row of ``docs`` (doc_id, text).

    A word is hit if it lies in any occurrence of a window of any item of
    ``benchmark`` (item_id, text).  ``items`` are the ids with an occurring
    window, as sorted strings; the digest is of them, joined by commas.

    Documents with equal sets of windows share one list of items, so a passage
    that a third of all documents hold is looked up once.  Null and empty
    texts have no words; items without words have no windows; items without id
    hit words, but are not listed.  Repeated rows are reported each, rows that
    share a doc_id by their texts.  Without a benchmark nothing is hit; empty
    documents give an empty table.  Other columns are ignored.
    """
    pairs = saved(windows_of(benchmark, width), "leak-pairs")
    windows = saved(pairs.select("text").distinct().withColumn("win", F.monotonically_increasing_id()), "leak-windows")
    found = saved(copied_windows(docs, windows, width, shingle, slots), "leak-hits")

    key = ("doc_id", "row_hash")
    # Repeated rows come together here, before a document's places meet in a window.
    spans = found.groupBy(*key, "start").agg(F.max(F.col("start") + F.col("size")).alias("stop"))
    earlier = Window.partitionBy(*key).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.col("stop") - F.greatest(F.col("start"), F.coalesce(F.max("stop").over(earlier), F.lit(0)))
    hit = spans.withColumn("fresh", F.greatest(fresh, F.lit(0))).groupBy(*key).agg(F.sum("fresh").alias("n_hit"))

    sets = found.groupBy(*key).agg(F.sort_array(F.collect_set("win")).alias("wins"))
    sets = saved(sets.withColumn("class", F.sha2(F.array_join(F.col("wins").cast("array<string>"), ","), 256)), "leak-sets")
    members = sets.groupBy("class").agg(F.first("wins").alias("wins")).select("class", F.explode("wins").alias("win"))
    listed = members.join(windows, "win").join(pairs, "text").select("class", "item_id").distinct()
    items = F.sort_array(F.collect_set(F.col("item_id").cast("string")))
    by_class = saved(listed.groupBy("class").agg(items.alias("items")), "leak-items")
    by_class = by_class.withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256))
    facts = sets.select(*key, "class").join(hit, [F.equal_null(sets[k], hit[k]) for k in key]).drop(hit.doc_id).drop(hit.row_hash)
    facts = facts.join(by_class, "class").withColumnsRenamed({"doc_id": "__doc", "row_hash": "__row"})

    rows = docs.select("doc_id", F.xxhash64("text").alias("row_hash"), F.size(item_words(F.col("text"))).cast("long").alias("n_words"))
    same = rows.doc_id.eqNullSafe(facts["__doc"]) & (rows.row_hash == facts["__row"])
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    none = F.array().cast("array<string>")
    return rows.join(facts, same, "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", none).alias("items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
