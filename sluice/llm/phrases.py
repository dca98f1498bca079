"""Phrase collocations: word n-grams counted in mergeable counting quotient filters, scored exactly.

An n-gram of word ids is packed into 128 bits and permuted invertibly.  The
top bits of the result are the quotient, which says where a counter stands;
the rest is the remainder, stored in full, so a filter gives back every n-gram
it counted.  Filters are sorted, and two of them merge like sorted lists.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import rows_of, saved
from sluice.llm.shingles import mixed

MIN_COUNT = 10
TOP = 2000
#: A phrase goes if a longer one around it has this share of its occurrences, in percent.
ABSORBED = 50

# What ends a piece, and the language of documents that name none.
EDGES = b".,;:!?\n\x0b\x0c\r"
NO_LANG = "und"

#: Bits of a word id: three ids and the number of words fill 128 bits.
ID_BITS = 42
HASH_BITS = ID_BITS - 1
BREAK = (1 << ID_BITS) - 1
#: Bits of the maps that say which words and pairs may be frequent.
MAP_BITS = 24
#: Occurrences a task holds before it writes a filter, and entries of a row of a merged one.
HELD = 1 << 20
ROW_ENTRIES = 1 << 13
#: Bits that name a block, at least and at most: of the largest number of blocks, 32 entries of a written filter fall in each.
FEWEST_BITS, MOST_BITS = 8, 15
CACHE_WORDS = 400_000
BATCH_BYTES = 8 << 20
CHUNK_BYTES = 8 << 20

FILTER = "lang string, block bigint, runs binary, remainders binary, counts binary"
_TABLE = bytes.maketrans(EDGES + b"\t", b"\n" * len(EDGES) + b" ")
_gap = re.compile(rb"[ \n]").search
_ROUNDS = np.random.default_rng(12).integers(1, 2**63, 4, dtype=np.uint64)


# --- packed n-grams ---------------------------------------------------------------


def packed(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two or three arrays of word ids as the halves of 128-bit numbers."""
    one, two = ids[0], ids[1]
    three = ids[2] if len(ids) > 2 else np.zeros(len(one), np.uint64)
    u = np.uint64
    return (one << u(22)) | (two >> u(20)), ((two & u((1 << 20) - 1)) << u(44)) | (three << u(2)) | u(len(ids))


def unpacked(hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Three arrays of word ids (0 where there is no third) and the number of words."""
    u = np.uint64
    one, two = hi >> u(22), ((hi & u((1 << 22) - 1)) << u(20)) | (lo >> u(44))
    return one, two, (lo >> u(2)) & u(BREAK), lo & u(3)


def permuted(hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    for key in _ROUNDS:
        hi, lo = lo, hi ^ mixed(lo + key)
    return hi, lo


def restored(hi: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The inverse of ``permuted``."""
    for key in _ROUNDS[::-1]:
        hi, lo = lo ^ mixed(hi + key), hi
    return hi, lo


# --- filters ----------------------------------------------------------------------


def combined(hi: np.ndarray, lo: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys, each once, with the sums of their counts."""
    if not len(hi):
        return hi, lo, counts
    order = np.argsort(hi)
    one, two = hi[order], lo[order]
    same = one[1:] == one[:-1]
    if (same & (two[1:] != two[:-1])).any():
        order = np.lexsort((lo, hi))
        one, two = hi[order], lo[order]
        same = one[1:] == one[:-1]
    first = np.flatnonzero(np.concatenate(([True], ~same | (two[1:] != two[:-1]))))
    return one[first], two[first], np.add.reduceat(counts[order], first)


def block_bits(n_words: int) -> int:
    """Bits that name a block: as many as give a block about a million occurrences."""
    return min(MOST_BITS, max(FEWEST_BITS, (n_words >> 20).bit_length()))


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The bytes of ``data`` as values of so many bytes each."""
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _bytes_of(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The inverse of ``_binary``."""
    values = values.cast(pa.large_binary())
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    data = values.buffers()[2]
    return np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]], np.diff(offsets)


def filter_arrays(hi: np.ndarray, lo: np.ndarray, counts: np.ndarray, bits: int) -> list[pa.Array]:
    """Sorted counters as filters, one a row: block, run lengths, remainders, counts.

    The first ``bits`` bits of a key name its block, those after them, up to
    the end of a byte, its quotient in the block.  ``runs`` holds how many
    remainders each of a block's quotients has; the remainders are the bytes
    left, in order.  Counts take as many bytes each as the largest of their
    row needs.
    """
    u, head = np.uint64, bits // 8 + 1
    quotients = 1 << (8 * head - bits)
    block = hi >> u(64 - bits)
    edges = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1]))[: len(hi)])
    pieces = -(-np.diff(np.append(edges, len(hi))) // ROW_ENTRIES)
    starts = np.repeat(edges, pieces) + ROW_ENTRIES * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    sizes = np.diff(np.append(starts, len(hi)))
    row = np.repeat(np.arange(len(starts)), sizes)
    quotient = (hi >> u(64 - 8 * head)).astype(np.int64) & (quotients - 1)
    runs = np.bincount(row * quotients + quotient, minlength=len(starts) * quotients).astype("<u2")
    raw = np.stack([hi, lo], axis=1).astype(">u8").view(np.uint8)[:, head:]
    most = np.maximum.reduceat(counts, starts) if len(starts) else counts
    width = np.where(most < 1 << 8, 1, np.where(most < 1 << 16, 2, np.where(most < 1 << 32, 4, 8)))
    each = np.ascontiguousarray(counts.astype("<u8")).view(np.uint8).reshape(-1, 8)
    used = np.arange(8) < np.repeat(width, sizes)[:, None] if (width > 1).any() else np.s_[:, :1]
    return [
        pa.array(block[starts].astype(np.int64)),
        _binary(runs.view(np.uint8), np.full(len(starts), 2 * quotients)),
        _binary(raw, sizes * (16 - head)),
        _binary(each[used], sizes * width),
    ]


def array_entries(arrays: list[pa.Array], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The sorted keys and counts of each filter, one after the other, and how many each has."""
    block, runs, remainders, counts = arrays
    head = bits // 8 + 1
    quotients = 1 << (8 * head - bits)
    lengths = _bytes_of(runs)[0].view("<u2").reshape(-1, quotients).astype(np.intp)
    sizes = lengths.sum(axis=1)
    tops = (block.to_numpy().astype(np.uint64) * np.uint64(quotients))[:, None] + np.arange(quotients, dtype=np.uint64)
    raw = np.empty((int(sizes.sum()), 16), np.uint8)
    raw[:, :head] = np.repeat(tops.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - head :], lengths.ravel(), axis=0)
    raw[:, head:] = _bytes_of(remainders)[0].reshape(-1, 16 - head)
    keys = raw.view(">u8").astype(np.uint64)
    data, size = _bytes_of(counts)
    width = size // np.maximum(sizes, 1)
    if (width > 1).any():
        each = np.zeros((len(raw), 8), np.uint8)
        each[np.arange(8) < np.repeat(width, sizes)[:, None]] = data
        numbers = each.view("<u8").ravel().astype(np.int64)
    else:
        numbers = data.astype(np.int64)
    return keys[:, 0], keys[:, 1], numbers, sizes


def filter_rows(hi: np.ndarray, lo: np.ndarray, counts: np.ndarray, bits: int) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """``filter_arrays`` row by row."""
    yield from zip(*(a.to_pylist() for a in filter_arrays(hi, lo, counts, bits)), strict=True)


def filter_entries(block: int, runs: bytes, remainders: bytes, counts: bytes, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``array_entries`` of one filter."""
    return array_entries([pa.array([block], pa.int64()), *(pa.array([b], pa.binary()) for b in (runs, remainders, counts))], bits)[:3]


def _filter_batches(lang: str, hi: np.ndarray, lo: np.ndarray, counts: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """Filters of a language's sorted counters."""
    for at in range(0, len(hi), HELD):
        part = slice(at, at + HELD)
        arrays = filter_arrays(hi[part], lo[part], counts[part], bits)
        langs = pa.array([lang] * len(arrays[0]), pa.string())
        yield pa.RecordBatch.from_arrays([langs, *arrays], ["lang", "block", "runs", "remainders", "counts"])


def _read_filters(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[tuple[pa.RecordBatch, tuple[np.ndarray, ...]]]:
    """Batches of filters with their ``array_entries``."""
    for batch in rows_of(batches, BATCH_BYTES):
        yield batch, array_entries([batch.column(i) for i in range(1, 5)], bits)


def merged(filters: DataFrame, bits: int, least: int = 1) -> DataFrame:
    """Filters of all shards as one filter per language and block, without counters below ``least``.

    A shard sends one counter per n-gram whatever the number of its
    occurrences, and blocks are cut by a permuted key, so no n-gram and no
    word weighs more than another.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, held = None, [], 0

        def folded() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            return combined(*(np.concatenate(p) for p in zip(*parts, strict=True)))

        def done() -> Iterator[pa.RecordBatch]:
            if parts:
                hi, lo, counts = folded()
                enough = counts >= least
                yield from _filter_batches(key[0], hi[enough], lo[enough], counts[enough], bits)

        for batch, (hi, lo, counts, sizes) in _read_filters(batches, bits):
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            ends = np.cumsum(sizes)
            edges = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]]
            for start, end in zip(edges, [*edges[1:], len(keys)], strict=True):
                if keys[start] != key:
                    yield from done()
                    key, parts, held = keys[start], [], 0
                part = slice(ends[start] - sizes[start], ends[end - 1])
                parts.append((hi[part], lo[part], counts[part]))
                held += len(parts[-1][0])
                if held > 2 * HELD:
                    parts = [folded()]
                    held = len(parts[0][0]) // 2
        yield from done()

    near = filters.repartition("lang", "block").sortWithinPartitions("lang", "block")
    return near.mapInArrow(run, FILTER)


def entries(filters: DataFrame, bits: int) -> DataFrame:
    """lang, slot, w1, w2, w3 (0 for none), n of every counter of the filters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, (hi, lo, counts, sizes) in _read_filters(batches, bits):
            slot = (hi >> np.uint64(64 - MAP_BITS)).astype(np.int64)
            one, two, three, _ = (a.astype(np.int64) for a in unpacked(*restored(hi, lo)))
            langs = batch.column(0).take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
            arrays = [langs, *(pa.array(a) for a in (slot, one, two, three, counts))]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "slot", "w1", "w2", "w3", "n"])

    return filters.mapInArrow(run, "lang string, slot bigint, w1 bigint, w2 bigint, w3 bigint, n bigint")


# --- words ------------------------------------------------------------------------


def _by_lang(batch: pa.RecordBatch) -> dict[str, bytes]:
    """The texts of each language, lower-cased, with a line feed for what ends a piece and between texts."""
    texts: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
        texts.setdefault(lang, []).append(text or b"")
    return {lang: b"\n".join(own).lower().translate(_TABLE) for lang, own in texts.items()}


def _chunks(data: bytes, size: int) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Words and edges in order, as numbers of the different ones and these.

    Text is cut between words, so that even one huge text is never held as words.
    """
    at = 0
    while at < len(data):
        gap = _gap(data, min(len(data), at + size))
        end = gap.start() if gap else len(data)
        tokens = pc.split_pattern(pa.array([data[at:end].replace(b"\n", b" \n ")], pa.binary()), " ").values.dictionary_encode()
        numbers, empty = tokens.indices.to_numpy(), pc.index(tokens.dictionary, b"").as_py()
        yield numbers[numbers != empty], tokens.dictionary
        at = end


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), "text")


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, n of every word; counted in each task before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.Table]] = {}

        def folded(tables: list[pa.Table]) -> pa.Table:
            return pa.concat_tables(tables).group_by("word", use_threads=False).aggregate([("n", "sum")]).rename_columns(["word", "n"])

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, tables in held.items():
                own = folded(tables)
                columns = [pa.array([lang] * len(own), pa.string()), own.column("word").cast(pa.string()), own.column("n")]
                yield from pa.table(columns, ["lang", "word", "n"]).to_batches(max_chunksize=1 << 16)
            held.clear()

        for batch in rows_of(batches, BATCH_BYTES):
            for lang, data in _by_lang(batch).items():
                for numbers, tokens in _chunks(data, CHUNK_BYTES):
                    n = np.bincount(numbers, minlength=len(tokens))
                    own = np.flatnonzero(n)
                    words = tokens.take(pa.array(own))
                    is_word = pc.not_equal(words, b"\n")
                    held.setdefault(lang, []).append(pa.table([words, pa.array(n[own])], ["word", "n"]).filter(is_word))
            if sum(len(x) for tables in held.values() for x in tables) > 2 * CACHE_WORDS:
                held |= {lang: [folded(tables)] for lang, tables in held.items()}
                if sum(len(x) for tables in held.values() for x in tables) > CACHE_WORDS:
                    yield from flush()
        yield from flush()

    parts = _texts(docs).mapInArrow(run, "lang string, word string, n bigint")
    return parts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _own_id(word: Column) -> Column:
    return F.xxhash64(word).bitwiseAND(F.lit((1 << HASH_BITS) - 1))


def _clashes(words: DataFrame, least: int) -> dict[bytes, int]:
    """New ids for words whose hash another word has, as far as a frequent word is among them.

    Frequent ones are numbered, rare ones end a piece, as all rare words do.
    Of V words, F of them frequent, about V * F / 2^41 get here: 5,000 of a
    thousand million with ten million frequent ones.
    """
    each = words.groupBy("word").agg(F.max("n").alias("n")).withColumn("id", _own_id(F.col("word")))
    shared = each.groupBy("id").agg(F.count("*").alias("words"), F.max("n").alias("most"))
    found = each.join(shared.where((F.col("words") > 1) & (F.col("most") >= least)).select("id"), "id")
    rows = sorted((r["word"].encode(), r["n"]) for r in found.select("word", "n").collect())
    numbered = iter(range(1 << HASH_BITS, BREAK))
    return {word: next(numbered) if n >= least else BREAK for word, n in rows}


def _map_of(slots: DataFrame) -> bytes:
    """A bit map of the column ``slot``; 2^24 bits, whatever the number of rows."""
    word = F.shiftright("slot", 6).alias("word")
    bits = slots.groupBy(word).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits"))
    out = np.zeros(1 << (MAP_BITS - 6), np.int64)
    for row in bits.collect():
        out[row["word"]] = row["bits"]
    return out.tobytes()


def _turn(lang: str) -> int:
    return xxhash.xxh64_intdigest(lang.encode(), 42) & ((1 << MAP_BITS) - 1)


def _set_bits(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bits[(slots >> np.uint64(6)).astype(np.intp)] >> (slots & np.uint64(63))) & np.uint64(1) != 0


def _ids(lang: str, tokens: pa.Array, known: np.ndarray, clashes: dict[bytes, int], bits: int) -> np.ndarray:
    """Ids of a language's words, ``BREAK`` for edges and for words that are not frequent."""
    words = tokens.to_numpy(zero_copy_only=False)
    ids = np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(42)), np.uint64, len(words)) & np.uint64((1 << bits) - 1)
    if clashes:
        ids = np.fromiter(map(clashes.get, words, ids), np.uint64, len(words))
    frequent = _set_bits(known, (ids + np.uint64(_turn(lang))) & np.uint64((1 << MAP_BITS) - 1))
    frequent &= pc.not_equal(tokens, b"\n").to_numpy(zero_copy_only=False)
    return np.where(frequent, ids, np.uint64(BREAK))


def ngram_filters(docs: DataFrame, size: int, bits: int, known: bytes, clashes: dict[bytes, int], pairs: bytes | None = None) -> DataFrame:
    """Each task's filters of the n-grams of ``size`` words (2 or 3) within pieces.

    Words outside ``known`` end a piece.  With ``pairs`` an n-gram counts only
    if both pairs in it may be frequent.
    """
    shared = docs.sparkSession.sparkContext.broadcast((known, clashes, pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_known, own_clashes, own_pairs = shared.value
        word_bits = np.frombuffer(own_known, np.uint64)
        pair_bits = None if own_pairs is None else np.frombuffer(own_pairs, np.uint64)
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def keys(lang: str, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            sound = own != np.uint64(BREAK)
            fits = sound[:-1] & sound[1:]
            if size == 3:
                if pair_bits is not None:
                    at = np.flatnonzero(fits)
                    hi, _ = permuted(*packed([own[at], own[at + 1]]))
                    slots = ((hi >> np.uint64(64 - MAP_BITS)) + np.uint64(_turn(lang))) & np.uint64((1 << MAP_BITS) - 1)
                    fits[at] = _set_bits(pair_bits, slots)
                fits = fits[:-1] & fits[1:]
            at = np.flatnonzero(fits)
            return permuted(*packed([own[at + i] for i in range(size)]))

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                hi, lo = (np.concatenate(p) for p in zip(*parts, strict=True))
                yield from _filter_batches(lang, *combined(hi, lo, np.ones(len(hi), np.int64)), bits)
            held.clear()

        count = 0
        for batch in rows_of(batches, BATCH_BYTES):
            for lang, data in _by_lang(batch).items():
                tail = np.zeros(0, np.uint64)
                for numbers, tokens in _chunks(data, CHUNK_BYTES):
                    each = _ids(lang, tokens, word_bits, own_clashes, HASH_BITS)
                    own = np.concatenate([tail, each[numbers]])
                    tail = own[max(0, len(own) - size + 1) :]
                    if len(own) >= size:
                        held.setdefault(lang, []).append(keys(lang, own))
                        count += len(held[lang][-1][0])
                    if count > HELD:
                        yield from flush()
                        count = 0
        yield from flush()

    return _texts(docs).mapInArrow(run, FILTER)


# --- collocations -----------------------------------------------------------------


def _score(a: Column, left: Column, right: Column) -> Column:
    """1000000 * a * a / (left * right), rounded down, in decimals of 38 digits."""
    wide = [c.cast("decimal(38,0)") for c in (a, left, right)]
    above = F.lit(1_000_000).cast("decimal(38,0)") * wide[0] * wide[0]
    return F.call_function("div", above, wide[1] * wide[2])


def collocations(docs: DataFrame, least: int = MIN_COUNT, top: int = TOP, absorbed: int = ABSORBED) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of two and three words of each language.

    ``docs`` has lang and text.  Counts are whole: every word and every n-gram
    of every text counts.  An n-gram with a rare word in it, or with a rare
    pair, can't be frequent, so it never reaches a filter.

    Null texts have no words, a null lang is ``und``; repeated rows count
    each; a language without phrases has no rows, nor has an empty table.  Of
    equal scores the more frequent phrase comes first, then the smaller in
    UTF-8 order.  Other columns are ignored.
    """
    words = saved(word_counts(docs), "phrase-words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    n_words = words.agg(F.sum("n")).first()[0] or 0
    bits = block_bits(n_words)
    clashes = _clashes(words, least)
    frequent = words.where(F.col("n") >= least)
    if clashes:
        spark = docs.sparkSession
        renamed = spark.createDataFrame([(w.decode(), i) for w, i in clashes.items()], "word string, other bigint")
        frequent = frequent.join(renamed, "word", "left").withColumn("id", F.coalesce("other", _own_id(F.col("word"))))
    else:
        frequent = frequent.withColumn("id", _own_id(F.col("word")))
    frequent = saved(frequent.select("lang", "id", "word", F.col("n").alias("f")), "phrase-frequent")
    turn = F.xxhash64("lang").bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    slot = lambda c: (c + turn).bitwiseAND(F.lit((1 << MAP_BITS) - 1)).alias("slot")
    known = _map_of(frequent.select(slot(F.col("id"))))

    two = saved(merged(ngram_filters(docs, 2, bits, known, clashes), bits, least), "phrase-pairs")
    two = saved(entries(two, bits), "phrase-pair-counts")
    pairs = _map_of(two.select(slot(F.col("slot"))))
    three = saved(merged(ngram_filters(docs, 3, bits, known, clashes, pairs), bits, least), "phrase-triples")
    three = entries(three, bits).select("lang", "w1", "w2", "w3", F.col("n").alias("a"))

    def word(at: int) -> DataFrame:
        return frequent.select("lang", F.col("id").alias(f"w{at}"), F.col("word").alias(f"word{at}"), F.col("f").alias(f"f{at}"))

    two = two.select("lang", "w1", "w2", F.col("n").alias("a"))
    two = saved(two.join(word(1), ["lang", "w1"]).join(word(2), ["lang", "w2"]), "phrase-two")
    head = two.select("lang", "w1", "w2", "word1", "word2", "f1", F.col("a").alias("f12"))
    tail = two.select(
        "lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("word2").alias("word3"), F.col("f2").alias("f3"), F.col("a").alias("f23")
    )
    three = saved(three.join(head, ["lang", "w1", "w2"]).join(tail, ["lang", "w2", "w3"]), "phrase-three")

    a = F.col("a")
    first, second = _score(a, F.col("f1"), F.col("f23")), _score(a, F.col("f12"), F.col("f3"))
    cut = F.when(second < first, F.struct(F.col("f12").alias("l"), F.col("f3").alias("r"), second.alias("score"))).otherwise(
        F.struct(F.col("f1").alias("l"), F.col("f23").alias("r"), first.alias("score"))
    )
    long_ones = three.select("lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a", cut.alias("cut"))
    around = three.select("lang", "w1", "w2", F.col("a").alias("longer")).union(three.select("lang", "w2", "w3", "a"))
    around = saved(around.groupBy("lang", "w1", "w2").agg(F.max("longer").alias("longer")), "phrase-around")
    stay = F.col("longer").isNull() | (100 * F.col("longer") < absorbed * a)
    pair = F.struct(F.col("f1").alias("l"), F.col("f2").alias("r"), _score(a, F.col("f1"), F.col("f2")).alias("score"))
    short_ones = two.join(around, ["lang", "w1", "w2"], "left").where(stay)
    short_ones = short_ones.select("lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", pair.alias("cut"))
    found = short_ones.unionByName(long_ones).select("lang", "phrase", "a", "cut.*")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"
    )
