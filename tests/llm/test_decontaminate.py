"""Decontamination against brute force."""

import hashlib
import random
import re

import pytest

from sluice.llm import decontaminate

DOCS = "doc_id bigint, text string, words string, pos string, win string, items string"
ITEMS = "item_id bigint, text string, win string, doc_id string"


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, width=10):
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(len(w), width)
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(item)
    out = []
    for doc, text in docs:
        w = words(text)
        hit, own = set(), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                ids = windows.get(tuple(w[i : i + size]))
                if ids is not None:
                    hit.update(range(i, i + size))
                    own |= ids
        ids = sorted(str(i) for i in own if i is not None)
        digest = hashlib.sha256(",".join(ids).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(ids), ids, digest, bool(hit)))
    return sorted(out, key=str)


def check(spark, docs, items, **more):
    d = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in docs], DOCS)
    b = spark.createDataFrame([(*r, "x", "x") for r in items], ITEMS)
    got = decontaminate.contamination(d, b, **more)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items", "items_sha256", "contaminated"]
    rows = sorted((tuple(r) for r in got.collect()), key=str)
    assert rows == brute(docs, items, more.get("width", 10))
    return rows


def corpus(seed, vocabulary):
    """Items over few words, and documents with whole, partial and overlapping copies of them."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(vocabulary)] + ["Éa", "é", "7x"]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice((1, 2, 3, 9, 10, 11, 14, 30))))) for i in range(40)]
    docs = []
    for i in range(120):
        parts = []
        for _ in range(rng.randrange(5)):
            copied = words(rng.choice(items)[1])
            start = rng.randrange(len(copied))
            parts += rng.choices(vocab, k=rng.randrange(20)) + copied[start : start + rng.randrange(1, 30)]
        docs.append((i, rng.choice((" ", ", ", "\n", "--")).join(p.upper() if rng.random() < 0.2 and p.isascii() else p for p in parts)))
    return docs, items


@pytest.mark.parametrize("seed, vocabulary, slots", [(1, 8, 1 << 20), (2, 60, 1 << 20), (3, 20, 4)])
def test_equals_brute_force(spark, seed, vocabulary, slots):
    rows = check(spark, *corpus(seed, vocabulary), slots=slots)
    assert any(r[-1] for r in rows)


def test_other_widths(spark):
    docs, items = corpus(4, 15)
    check(spark, docs, items, width=4, shingle=2)
    check(spark, docs, items, width=2, shingle=5)


def test_nulls_repeats_and_clashing_ids(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    items = [(1, passage), (1, "short item"), (None, "no id here"), (2, None), (3, ""), (4, " .,- "), (5, passage), (5, passage)]
    docs = [(None, None), (None, passage), (7, "x " + passage), (7, "x " + passage), (7, "SHORT\u0007item!"), (8, ""), (9, "no id here")]
    check(spark, docs, items)


def test_one_passage_in_a_third_of_all_documents(spark):
    rng = random.Random(9)
    passage = " ".join(rng.choices(["a", "b", "c"], k=25))
    items = [(i, passage + f" tail{i}") for i in range(30)]
    docs = [(i, ("before " if i % 2 else "") + passage * (i % 3) + f" tail{i % 40}") for i in range(90)]
    check(spark, docs, items)


def test_very_long_text(spark):
    rng = random.Random(2)
    long = rng.choices([f"v{i}" for i in range(50)], k=200_000)
    items = [(1, " ".join(long[150_000:150_030])), (2, " ".join(long[-10:])), (3, "nowhere at all")]
    check(spark, [(1, " ".join(long))], items)


def test_empty_tables(spark):
    check(spark, [], [(1, "a b c")])
    check(spark, [(1, "a b c")], [])
    check(spark, [(1, "a b c")], [(1, None)])
    check(spark, [], [])


def test_no_python_in_the_plan(spark):
    docs, items = corpus(1, 8)
    d = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in docs], DOCS)
    b = spark.createDataFrame([(*r, "x", "x") for r in items], ITEMS)
    plan = decontaminate.contamination(d, b)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
