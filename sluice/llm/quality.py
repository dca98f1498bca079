"""Quality rules: a hashed n-gram log-likelihood ratio of trusted text against the whole corpus."""

from __future__ import annotations

import json
import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import bound, saved_at, words
from sluice.session import remove_dir

BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
#: Marks that tell most documents that can't be trusted ones, 64 to a number; any count of ids fits them.
MARKS = 1 << 23
#: The threshold lies so far below the median of trusted scores, in steps from there to their 1st percentile.
REACH = 3.0
MIN_WORDS = 50
SYMBOLS = r"[#*$%&|<>]"


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_id of every document labelled good and not toxic."""
    return labels.filter((F.col("quality") == 1) & (F.col("toxic") == 0)).select("doc_id").distinct()


def trusted_texts(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """The texts of trusted documents, one row each.

    A table of marks, of fixed size, leaves out documents whose id no trusted
    one can have; the join decides on the rest, so only they may be shuffled.
    """
    mark = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(MARKS))
    word, bit = F.expr("mark div 64").cast("int"), (F.col("mark") % 64).cast("int")
    marked = trusted.select(mark.alias("mark")).select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("bits"))
    table = [0] * (MARKS // 64)
    for row in marked.groupBy("word").agg(F.bit_or("bits").alias("bits")).collect():
        table[row["word"]] = row["bits"]
    held = F.get(F.from_json(F.lit(json.dumps(table)), "array<bigint>"), word)
    likely = bound(docs.select("doc_id", "text"), mark=mark).where(F.call_function("shiftright", held, bit).bitwiseAND(F.lit(1)) == 1)
    return likely.join(trusted, "doc_id", "left_semi").select("text")


def _hashed(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with the words of ``text``, their hashes, and those of pairs of neighbours."""
    split = bound(docs, words=words(F.col("text")))
    hashed = bound(split, hashes=F.transform("words", lambda w: F.xxhash64(w)))
    firsts = F.slice("hashes", F.lit(1), F.greatest(F.size("hashes") - 1, F.lit(0)))
    return bound(hashed, pairs=F.transform(firsts, lambda h, at: F.xxhash64(h, F.get("hashes", at + 1))))


def _bucket(hashed: Column) -> Column:
    return hashed.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def _bucket_counts(docs: DataFrame) -> list[int]:
    """How often each bucket is hit, and one more.

    Counts are summed in the tasks first; what is shuffled and what reaches the
    driver is one row a bucket at most (a task).
    """
    features = _hashed(docs.select("text")).select(F.explode(F.concat("hashes", "pairs")).alias("feature"))
    counts = [1] * BUCKETS
    for row in features.groupBy(_bucket(F.col("feature")).alias("bucket")).agg(F.count("*").alias("n")).collect():
        counts[row["bucket"]] += row["n"]
    return counts


def fit(docs: DataFrame, own: DataFrame) -> list[float]:
    """log(target share / corpus share) of each bucket; the corpus is every document, the target every trusted one (``own``)."""
    raw, target = _bucket_counts(docs), _bucket_counts(own)
    shift = math.log(sum(raw)) - math.log(sum(target))
    return [math.log(t) - math.log(r) + shift for t, r in zip(target, raw, strict=True)]


def _ratio(model: list[float]) -> Column:
    """Mean log ratio over a document's words and pairs; null without words."""
    table = F.from_json(F.lit(json.dumps(model)), "array<double>")
    total = lambda features: F.aggregate(features, F.lit(0.0), lambda so_far, h: so_far + F.get(table, _bucket(h)))
    return (total("hashes") + total("pairs")) / F.nullif(2 * F.size("hashes") - 1, F.lit(-1))


def _with_windows(hashed: DataFrame) -> DataFrame:
    """With ``bits`` (that hold any place in the text) and ``windows``: 3-word windows, sorted by hash, places in the low bits."""
    left = lambda x: F.call_function("shiftleft", x, F.col("bits"))
    sized = bound(hashed, bits=F.char_length(F.bin(F.size("hashes"))))
    firsts = F.slice("pairs", F.lit(1), F.greatest(F.size("pairs") - 1, F.lit(0)))
    window = lambda pair, at: left(F.xxhash64(pair, F.get("hashes", at + 2))).bitwiseOR(at.cast("long"))
    return bound(sized, mask=left(F.lit(1).cast("long")) - 1, windows=F.sort_array(F.transform(firsts, window)))


def _repeated_places() -> Column:
    """Where windows found twice or more begin, in order.

    Neighbours of equal hash are compared by the hashes of all three words.
    """
    hashes, ordered, mask = F.col("hashes"), F.col("windows"), F.col("mask")
    place = lambda x: x.bitwiseAND(mask).cast("int")

    def same(x: Column, other: Column) -> Column:
        alike = F.call_function("shiftright", x, F.col("bits")) == F.call_function("shiftright", other, F.col("bits"))
        for step in range(3):
            alike = alike & (F.get(hashes, place(x) + step) == F.get(hashes, place(other) + step))
        return F.coalesce(alike, F.lit(False))

    twice = F.filter(ordered, lambda x, at: same(x, F.get(ordered, at - 1)) | same(x, F.get(ordered, at + 1)))
    return F.sort_array(F.transform(twice, place))


def measures(docs: DataFrame, model: list[float], *more: str) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, ratio of every document, and ``more`` columns."""
    counted = bound(_with_windows(_hashed(docs.select("doc_id", "text", *more))), places=_repeated_places())
    places = F.col("places")
    steps = F.transform(places, lambda p, at: F.least(F.lit(3), F.coalesce(F.get(places, at + 1) - p, F.lit(3))))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    text = F.coalesce("text", F.lit(""))
    measured = counted.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        bound_lines(lines).cast("long").alias("n_dup_lines"),
        F.aggregate(steps, F.lit(0), lambda total, step: total + step).cast("long").alias("n_repeat_words"),
        _ratio(model).alias("ratio"),
        *more,
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured.withColumn("base_failed", failed)


def bound_lines(lines: Column) -> Column:
    """Lines equal to an earlier one; null for a null text gives 0."""
    spare = F.element_at(F.transform(F.array(lines), lambda all_: F.size(all_) - F.size(F.array_distinct(all_))), 1)
    return F.coalesce(spare, F.lit(0))


def quantiles(values: DataFrame, name: str, shares: list[float]) -> list[float] | None:
    """Exact quantiles, interpolated as ``percentile`` does, of any number of values; None without one.

    Equal values become one row with a count, rows are dealt into ranges, whose
    totals the driver adds up; no task sees more than a range.
    """
    counted = values.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n"))
    dealt, folder = saved_at(counted.repartitionByRange(name).withColumn("range", F.spark_partition_id()), "quantiles")
    try:
        totals = dealt.groupBy("range").agg(F.sum("n").alias("n")).orderBy("range").collect()
        if not totals:
            return None
        begins = list(accumulate((r["n"] for r in totals), initial=0))
        places = [share * (begins[-1] - 1) for share in shares]
        ranks = sorted({end for place in places for end in (math.floor(place), math.ceil(place))})
        # Each rank lies in one range; the first value whose running count passes it there is the one.
        at = [next(i for i in range(len(totals)) if begins[i + 1] > rank) for rank in ranks]
        running = F.sum("n").over(Window.partitionBy("range").orderBy(name))
        found = dealt.where(F.col("range").isin(*{totals[i]["range"] for i in at})).withColumn("running", running)
        first = [
            F.min(F.when((F.col("range") == totals[i]["range"]) & (F.col("running") > rank - begins[i]), F.col(name))).alias(f"v{k}")
            for k, (rank, i) in enumerate(zip(ranks, at, strict=True))
        ]
        value = dict(zip(ranks, found.agg(*first).first(), strict=True))
    finally:
        remove_dir(values.sparkSession, folder)

    def between(place: float) -> float:
        low, high = math.floor(place), math.ceil(place)
        if low == high or value[low] == value[high]:
            return value[low]
        return (high - place) * value[low] + (place - low) * value[high]

    return [between(place) for place in places]


def threshold(own: DataFrame, model: list[float], reach: float = REACH) -> float:
    """Median of all trusted documents' scores less ``reach`` times its distance to their 1st percentile.

    Without a trusted score it lies below all.
    """
    scored = _hashed(own).filter(F.size("words") >= MIN_WORDS).select(_ratio(model).alias("ratio"))
    scores, folder = saved_at(scored, "trusted-scores")
    try:
        found = quantiles(scores, "ratio", [0.01, 0.5])
    finally:
        remove_dir(own.sparkSession, folder)
    return found[1] - reach * (found[1] - found[0]) if found else -math.inf


def fitted(docs: DataFrame, labels: DataFrame, reach: float = REACH) -> tuple[list[float], float]:
    """The model and the threshold, from every document and every trusted one."""
    own, folder = saved_at(trusted_texts(docs, trusted_ids(labels)), "trusted-texts")
    try:
        model = fit(docs, own)
        return model, threshold(own, model, reach)
    finally:
        remove_dir(docs.sparkSession, folder)


def _verdict(limit: float) -> Column:
    return ~F.col("base_failed") & F.coalesce(F.col("ratio") >= limit, F.lit(False))


def rules(docs: DataFrame, labels: DataFrame, reach: float = REACH) -> DataFrame:
    """The measures of every document and the verdict ``kept``.

    kept is false where base_failed, else whether the mean log ratio of the
    document reaches the threshold.  The corpus model counts every document,
    the target model every trusted one among ``labels``.

    Null and empty texts have no words and fail.  Repeated rows are judged
    each.  Without trusted documents of fifty words the rules alone decide.  An empty table gives an empty one.  Columns besides doc_id and
    text are ignored.
    """
    model, limit = fitted(docs, labels, reach)
    return measures(docs, model).withColumn("kept", _verdict(limit))


def kept_documents(docs: DataFrame, labels: DataFrame, reach: float = REACH) -> DataFrame:
    """The rows of ``docs`` that ``rules`` keeps, all columns as they are.

    The verdict is reached in the scan that reads the row, so no text is
    shuffled.
    """
    model, limit = fitted(docs, labels, reach)
    # As fields of one column, the documents' names can't clash with those used here.
    whole = F.struct(*(docs[c] for c in docs.columns)).alias("whole")
    judged = measures(docs.select("doc_id", "text", whole), model, "whole").filter(_verdict(limit))
    return judged.select(*(F.col("whole")[c].alias(c) for c in docs.columns))
