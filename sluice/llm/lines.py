"""Line deduplication: hashes of lines in ranges, results as keep bitmaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import BLANK_CHARS, ascii_lower, saved

MIN_CHARS = 20
MIN_DOCS = 3
#: Names of the counts that dedup_lines adds.
N_LINES, N_DROPPED = "lines_before_dedup", "lines_dropped_by_dedup"


def text_lines(text: Column) -> Column:
    """A text cut at line feeds; null and empty texts are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """Per row its identity, number of lines, and position and 96-bit hash of each long line."""
    blanks = F.lit(BLANK_CHARS)
    key = F.transform(text_lines(F.col("text")), lambda line: ascii_lower(F.btrim(line, blanks)))
    hashed = F.transform(
        key,
        lambda k, at: F.when(
            F.char_length(k) >= min_chars, F.struct(at.alias("pos"), F.xxhash64(k).alias("h1"), F.hash(k).alias("h2"))
        ),
    )
    return docs.select(
        "doc_id",
        F.xxhash64("text").alias("row_hash"),
        F.size(key).cast("long").alias("n_lines"),
        F.filter(hashed, lambda s: s.isNotNull()).alias("long_lines"),
    )


def line_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Which lines of each document stay.

    A line's key is the line without blanks at its ends, A-Z lower-cased.  Keys
    of ``min_chars`` code points or more found in ``min_docs`` documents lose
    all their lines but those in the largest doc_id that holds them.

    Returns doc_id, row_hash (of the text, so that rows that share a doc_id
    stay apart), n_lines, n_dropped, keep: array of (word, bits), where bit b
    of a word stands for line 64 * word + b.  Words that lose no line are left
    out.  The texts themselves are not returned.

    Occurrences are range-partitioned by hash and document and sorted by
    document and position; the first occurrence of a key in each document is
    streamed out of that order and counted.  The bounds include the document,
    so a line held by a third of all documents lies in many ranges, each of
    which sends on one row for it.

    Null and empty texts have one line, which is too short to go.  Rows without
    doc_id count as one document and hold no line back.  Rows repeated with
    their doc_id are one document; each gets its bitmap.  An empty table gives
    an empty one; columns besides doc_id and text are ignored.
    """
    rows = saved(_keys(docs, min_chars), "line-keys")
    found = rows.select("doc_id", "row_hash", F.inline("long_lines"))
    ranged = found.repartitionByRange("h1", "h2", "doc_id").sortWithinPartitions("h1", "h2", "doc_id", "pos")
    firsts = ranged.groupBy("h1", "h2", "doc_id").agg(F.first("pos").alias("pos"))
    frequent = (
        firsts.groupBy("h1", "h2")
        .agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))
        .filter(F.col("n_docs") >= min_docs)
        .drop("n_docs")
    )
    # Read from a table, this side is shuffled anew, and a hot line can be split in the join.
    frequent = saved(frequent, "frequent-lines")
    dropped = found.join(frequent, ["h1", "h2"]).filter(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
    words = (
        dropped.groupBy("doc_id", "row_hash", F.expr("pos div 64").cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"))
        .groupBy("doc_id", "row_hash")
        .agg(
            F.sum(F.bit_count("bits")).alias("n_dropped"),
            F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("bits").alias("bits")))).alias("keep"),
        )
        .withColumnsRenamed({"doc_id": "__doc", "row_hash": "__row"})
    )
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & F.col("row_hash").eqNullSafe(F.col("__row"))
    return rows.join(words, same, "left").select(
        "doc_id", "row_hash", "n_lines", F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), "keep"
    )


def kept_text(text: Column, keep: Column) -> Column:
    """The lines of a text whose bit is set, joined by line feeds."""
    as_map = F.map_from_entries(keep)
    count = F.size(text_lines(text))
    dense = F.transform(F.sequence(F.lit(0), ((count - 1) / 64).cast("int")), lambda w: F.coalesce(as_map[w], F.lit(-1)))

    def stays(at: Column, bits: Column) -> Column:
        return F.call_function("getbit", F.get(bits, (at / 64).cast("int")), at % 64) == 1

    # The bits are handed in as an array of their own, so that they are made once a document.
    joined = F.element_at(
        F.transform(
            F.array(dense),
            lambda bits: F.array_join(F.filter(text_lines(text), lambda line, at: stays(at, bits)), "\n"),
        ),
        1,
    )
    return F.when(keep.isNull(), F.coalesce(text, F.lit(""))).otherwise(joined)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """All columns and rows of ``docs`` with the dropped lines gone from ``text``, plus the counts ``N_LINES`` and ``N_DROPPED``.

    Texts that lose nothing stay as they are, null included.
    """
    # Repeated rows have one bitmap each; one of them is enough.
    facts = [F.first(c).alias(c) for c in ("n_lines", "n_dropped", "keep")]
    bitmaps = line_bitmaps(docs, min_chars, min_docs).groupBy("doc_id", "row_hash").agg(*facts)
    # As fields of one column, the documents' names can't clash with those used here.
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("whole"))
    same = F.col("whole.doc_id").eqNullSafe(F.col("doc_id")) & (F.xxhash64("whole.text") == F.col("row_hash"))
    joined = rows.join(bitmaps, same, "left")
    text = F.col("whole.text")
    stay = F.when(F.col("keep").isNull(), text).otherwise(kept_text(text, F.col("keep")))
    out = [stay.alias(c) if c == "text" else F.col("whole")[c].alias(c) for c in docs.columns]
    return joined.select(*out, F.col("n_lines").alias(N_LINES), F.col("n_dropped").alias(N_DROPPED))
