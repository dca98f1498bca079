"""Collocations against brute force; filters against plain counts."""

import re
from collections import Counter

import numpy as np
import pytest

from sluice.llm import phrases

SCHEMA = "doc_id bigint, text string, lang string, n string, word string, slot string"


def frame(spark, rows):
    return spark.createDataFrame([(i, text, lang, "x", "x", "x") for i, (text, lang) in enumerate(rows)], SCHEMA)


def brute(rows, least=10, top=2000, absorbed=50):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in (1, 2, 3):
                for i in range(len(words) - n + 1):
                    key = (lang, tuple(words[i : i + n]))
                    counts[key] = counts.get(key, 0) + 1
    found = {}
    for (lang, phrase), a in counts.items():
        if len(phrase) > 1 and a >= least:
            cuts = []
            for k in range(1, len(phrase)):
                left, right = counts[lang, phrase[:k]], counts[lang, phrase[k:]]
                cuts.append((1_000_000 * a * a // (left * right), k, left, right))
            found.setdefault(lang, {})[phrase] = (a, *min(cuts))
    out = []
    for lang, own in found.items():
        inside = Counter()
        for phrase, (a, *_) in own.items():
            if len(phrase) == 3:
                for part in (phrase[:2], phrase[1:]):
                    inside[part] = max(inside[part], a)
        kept = [(p, v) for p, v in own.items() if not (len(p) == 2 and p in inside and 100 * inside[p] >= absorbed * v[0])]
        kept.sort(key=lambda x: (-x[1][1], -x[1][0], " ".join(x[0]).encode()))
        for rank, (p, (a, score, _, left, right)) in enumerate(kept[:top], 1):
            out.append((lang, rank, " ".join(p), a, left, right, totals[lang], score))
    return sorted(out)


def check(spark, rows, **more):
    got = phrases.collocations(frame(spark, rows), **more)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, **more)
    return got


def texts(seed, n):
    rng = np.random.default_rng(seed)
    words = ["Ab", "ab", "É", "é", "x\tb", "new york city", "new york", "york", "a,b", "c.", "d!e", "f\n", "\x0b", "g  h", " "]
    weight = 1 / np.arange(1, len(words) + 1)
    return [" ".join(rng.choice(words, rng.integers(0, 60), p=weight / weight.sum())) for _ in range(n)]


@pytest.mark.parametrize("least", [1, 3, 10])
def test_equals_brute_force(spark, least):
    langs = ["en", "de", None, "und", ""]
    rows = [(text, langs[i % 5]) for i, text in enumerate(texts(least, 200))]
    check(spark, rows, least=least)


def test_nulls_repeats_and_ties(spark):
    rows = [(None, "en"), ("", "en"), ("  ", None), ("!?", "xx")] + [("same words here", "en")] * 30 + [("b a. c d", "de")] * 12
    found = check(spark, rows).collect()
    assert [r.phrase for r in found if r.lang == "de"] == ["b a", "c d"]
    # Both pairs of the triple are inside it as often as they occur.
    assert [r.phrase for r in found if r.lang == "en"] == ["same words here"]


def test_overlapping_repeats(spark):
    check(spark, [("ha ha ha ha ha ha ha ha ha ha ha ha ha ha", "en"), ("ho " * 40, "en")])


def test_top_cuts_each_language(spark):
    rows = [(t, lang) for lang in ("en", "de") for t in texts(7, 100)]
    check(spark, rows, least=2, top=5)


def test_no_phrases(spark):
    assert check(spark, [("one two", "en")]).count() == 0
    assert phrases.collocations(frame(spark, [])).count() == 0


def test_long_text_without_a_piece_end(spark, monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 50)
    monkeypatch.setattr(phrases, "HELD", 64)
    monkeypatch.setattr(phrases, "CACHE_WORDS", 3)
    rng = np.random.default_rng(3)
    long = " ".join(rng.choice(["aa", "bb", "cc", "dd", "ééé"], 3000))
    check(spark, [(long, "en"), ("aa bb. cc", "en")])


def test_words_whose_ids_clash(spark, monkeypatch):
    # Four bits of hash: most words share their id with another.
    monkeypatch.setattr(phrases, "HASH_BITS", 4)
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(40)]
    weight = 1 / np.arange(1, 41)
    rows = [(" ".join(rng.choice(words, 200, p=weight / weight.sum())), "en") for _ in range(20)]
    check(spark, rows)


def test_ids_agree_with_the_column(spark):
    import xxhash

    words = ["a", "éà", "x" * 100, "中"]
    rows = spark.createDataFrame([(w,) for w in words], "word string")
    got = [r[0] for r in rows.select(phrases._own_id(rows.word)).collect()]
    assert got == [xxhash.xxh64_intdigest(w.encode(), 42) & ((1 << phrases.HASH_BITS) - 1) for w in words]


@pytest.mark.parametrize("width", [1, 2, 3])
def test_filters_give_back_what_they_counted(width):
    rng = np.random.default_rng(width)
    ids = [rng.integers(0, 1 << 42, 5000, dtype=np.uint64) for _ in range(3)]
    hi, lo = phrases.packed(ids)
    for was, now in zip([*ids, np.full(5000, 3)], phrases.unpacked(hi, lo), strict=True):
        assert (was == now).all()
    assert all((a == b).all() for a, b in zip((hi, lo), phrases.restored(*phrases.permuted(hi, lo)), strict=True))
    counts = rng.integers(1, 70_000, 5000)
    hi, lo = phrases.permuted(np.repeat(hi, 2), np.repeat(lo, 2))
    one, two, sums = phrases.combined(hi, lo, np.repeat(counts, 2))
    assert sorted(sums) == sorted(2 * counts)
    back = [phrases.filter_entries(*row, width) for row in phrases.filter_rows(one, two, sums, width)]
    for was, now in zip((one, two, sums), (np.concatenate(p) for p in zip(*back, strict=True)), strict=True):
        assert (was == now).all()


def test_keys_with_one_high_half_stay_apart():
    hi = np.array([5, 5, 5, 1], np.uint64)
    lo = np.array([2, 1, 2, 9], np.uint64)
    one, two, counts = phrases.combined(hi, lo, np.ones(4, np.int64))
    assert (one.tolist(), two.tolist(), counts.tolist()) == ([1, 5, 5], [9, 1, 2], [1, 1, 2])


@pytest.mark.parametrize("n_words", [10_000, 136_000_000, 1_600_000_000, 10**12])
def test_filters_stay_few_however_many_words(n_words):
    # A task's filter of a million counters goes out in rows that cost little beside what they hold.
    bits = phrases.block_bits(n_words)
    rng = np.random.default_rng(bits)
    n = phrases.HELD
    hi, lo = np.sort(rng.integers(0, 1 << 64, n, dtype=np.uint64)), rng.integers(0, 1 << 64, n, dtype=np.uint64)
    counts = rng.integers(1, 200, n)
    counts[rng.integers(0, n, 9)] = 300, 70_000, 1 << 33, 255, 256, 65_535, 65_536, (1 << 32) - 1, 1 << 32
    arrays = phrases.filter_arrays(hi, lo, counts, bits)
    assert len(arrays[0]) <= 1 << 15
    assert sum(a.nbytes for a in arrays) <= 20 * n
    for start in (0, 3):
        # The arrays of a batch that was cut begin anywhere.
        *back, sizes = phrases.array_entries([a.slice(start) for a in arrays], bits)
        left = n - int(sizes.sum())
        assert left if start else not left
        assert all((was[left:] == now).all() for was, now in zip((hi, lo, counts), back, strict=True))
