"""Sharding, mixing, edits, chats, lines and quality: odd rows and brute force."""

import hashlib
import json
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.llm import bpe, chat, editcount, lines, mixing, quality, sharding
from sluice.llm.cases import QUERIES, RANK_FILE

SF_DIR = "/root/testdata/sf0.001"
RANKS = bpe.read_ranks(public_tokenizers.path(RANK_FILE))
OWN = bpe.Encoder(bpe.Vocabulary(RANKS, public_tokenizers.PATTERN))
ODD = [(1, None), (2, ""), (3, "the end"), (3, "the end"), (None, "it's"), (None, None), (4, "x y " * 50_000)]


def test_shards_are_even_and_gapless(spark, texts):
    got = QUERIES["op2_ring_shards"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    counts = Counter(r.shard for r in got)
    assert set(counts) <= set(range(24)) and max(counts.values()) - min(counts.get(s, 0) for s in range(24)) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
    for r in got:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "rows", None)


def test_ring_moves_little():
    counts = {cell: 3 for cell in range(0, sharding.CELLS, 7)}

    def homes(shards, load):
        return {(c, i): shard for c, start, end, shard, _ in sharding.segments(counts, shards, load) for i in range(start, end)}

    before, after = homes(24, 1.25), homes(25, 1.25)
    assert len(before) == sum(counts.values())
    assert sum(before[k] != after[k] for k in before) < 0.15 * len(before)
    exact = Counter(homes(24, 1.0).values())
    assert max(exact.values()) - min(exact.values()) <= 1
    assert sharding.segments({}, 24) == []


def test_odd_rows_are_sharded(spark, doc_frame):
    got = sharding.assign(doc_frame(ODD), 3).collect()
    assert len(got) == len(ODD) and {r.shard for r in got} == {0, 1, 2}
    assert sharding.assign(doc_frame([]), 3).count() == 0


def test_mix_meets_targets(spark, doc_frame):
    mixed = QUERIES["op4_mix_sources"](spark, SF_DIR).collect()
    assert all(0 <= r.taken <= 3 * r.size for r in mixed)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plan = mixing.targets(docs.select("source", mixing.word_count(F.col("text")).alias("size")))
    shares = mixing.quotas(plan).collect()
    assert min(r.blocks for r in shares) >= 0
    total = sum(r.size for r in mixed)
    houses = Counter()
    for r in shares:
        houses[r.shard] += r.blocks
    assert sum(houses.values()) == total // mixing.BLOCK_TOKENS and max(houses.values()) - min(houses.values()) <= 1
    rows = mixing.mixed_documents(docs)
    words = {r.source: r.n for r in rows.groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()}
    for r in plan.collect():
        assert abs(words[r.source] - r.target) <= mixing.BLOCK_TOKENS


def test_mix_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, " x  y z ", "a"), (3, " x  y z ", "a"), (None, "p q", None), (5, "w " * 300, "b"), (6, "v\nw", None)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, source string, taken string")
    got = mixing.mix(frame, block_tokens=1).collect()
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    # Weights 5, 2, 1 of 310 words; a has 6 words and the null source 4, so both stop at three times that.
    assert taken == {"a": 18, None: 12, "b": 280}
    out = mixing.mixed_documents(frame, block_tokens=1)
    assert out.columns == frame.columns
    sums = {r.source: r.n for r in out.groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()}
    assert sums == taken
    assert mixing.mix(frame.limit(0)).count() == 0
    assert mixing.mixed_documents(frame.filter("doc_id = 1")).count() == 0


@pytest.mark.parametrize("text,count,want", [(" a  b\tc ", 2, " a  b"), ("a b", 5, "a b"), ("a b", 1, "a"), ("é\n\nü x", 2, "é\n\nü")])
def test_first_words(spark, text, count, want):
    frame = spark.createDataFrame([(text, count)], "text string, n int")
    assert frame.select(mixing.first_words(F.col("text"), F.col("n"))).first()[0] == want


TEXTS = st.one_of(st.text(max_size=60), st.text(alphabet="aeènst 'lre\n\t 12.,ß", max_size=200))


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.lists(st.tuples(st.integers(-2, 220), st.integers(-2, 220), TEXTS), max_size=4))
def test_tree_follows_edits(text, changes):
    pieces = OWN.vocabulary.split(text)
    tree = editcount.TokenTree(np.array([len(p) for p in pieces], np.int32), np.array([len(OWN.piece(p)) for p in pieces], np.int32))
    for start, stop, new in changes:
        tree, edited, _ = editcount.edit(OWN, tree, text, start, stop, new)
        start = min(max(start, 0), len(text))
        text = text[:start] + new + text[max(start, min(stop, len(text))) :]
        assert edited == text
        assert tree.total == len(OWN.encode(text))
        assert tree.flat()[0].tolist() == [len(p) for p in OWN.vocabulary.split(text)]


def test_edit_query(spark, texts):
    for r in QUERIES["op5_edit_counts"](spark, SF_DIR).collect():
        text = texts[r.doc_id] or ""
        n = len(text)
        one, two, three = n // 4, n // 2, 3 * n // 4
        copied = text[max(two - 1, 0) :][:20].upper()
        now = text[:one] + copied + text[one + 12 :]
        now = now[:two] + text[:30] + now[two:]
        now = now[:three] + now[three + 25 :]
        assert (r.n_before, r.n_tokens) == (len(OWN.encode(text)), len(OWN.encode(now)))
        assert r.n_pretokens == len(OWN.vocabulary.split(now))


def test_edit_odd_rows(spark, doc_frame):
    log = spark.createDataFrame([(3, 1, 0, 3, "a"), (3, 0, 4, 7, None), (1, 0, 5, 9, "new"), (4, 0, None, None, "z")], "doc_id bigint, seq int, start int, stop int, new string")
    indexed = editcount.index(doc_frame(ODD), RANKS, public_tokenizers.PATTERN)
    joined = indexed.join(editcount.gather_edits(log), "doc_id", "left")
    got = editcount.apply_edits(joined, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted(
        [("1", "new"), ("2", ""), ("3", "a "), ("3", "a "), ("None", "it's"), ("None", ""), ("4", "z" + ODD[-1][1])]
    )
    assert all(r.n_tokens == len(OWN.encode(r.text)) for r in got)
    assert editcount.index(doc_frame([]), RANKS, public_tokenizers.PATTERN).count() == 0


LAYOUTS = [
    ({"prompt": "p", "completion": "c"}, [("user", "p"), ("assistant", "c")]),
    ({"system": "s", "prompt": None, "completion": "c"}, [("system", "s"), ("user", ""), ("assistant", "c")]),
    ({"instruction": "i", "output": "o"}, [("user", "i"), ("assistant", "o")]),
    ({"output": "o", "input": "x", "instruction": "i"}, [("user", "i\n\nx"), ("assistant", "o")]),
    ({"messages": [{"role": "tool", "content": "1"}, {"role": None, "content": None}]}, [("tool", "1"), ("", "")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, [("user", "q"), ("assistant", "a")]),
    ({"else": 1}, None),
]


def test_layouts(spark):
    rows = [(i, json.dumps(body)) for i, (body, _) in enumerate(LAYOUTS)] + [(90, "no json"), (91, None)]
    got = {r.conv_id: r for r in chat.canonical_turns(spark.createDataFrame(rows, "conv_id int, body string")).collect()}
    for i, (_, turns) in enumerate(LAYOUTS):
        assert (got[i].turns and [tuple(t) for t in got[i].turns]) == turns
    assert got[6].fingerprint is not None and got[90].fingerprint is None and got[91].turns is None


def test_layouts_by_their_field_paths(spark):
    """Other fields, missing answers, empty lists and mixed types; equal paths have equal fingerprints."""
    u, a = ("user", "q"), ("assistant", "a")
    cases = [
        ({"id": 7, "messages": [{"role": "user", "content": "q", "name": "x"}, {"role": "assistant", "content": "a"}]}, [u, a]),
        ({"messages": []}, []),
        ({"prompt": "q", "response": "a", "meta": {"n": [1, "b", {}, None]}}, [u, a]),
        ({"instruction": "q", "response": "a", "input": ""}, [u, a]),
        ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": 3}]}, [u, ("assistant", "3")]),
        ({"messages": [{"role": "user", "content": "q"}, "a"]}, None),
        ({"data": {"prompt": "q", "completion": "a"}}, None),
        ({"prompt": "q"}, None),
        ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": None}], "id": "x"}, [u, ("assistant", "")]),
        ({"prompt": 'q": "', "completion": "\\\\\""}, [("user", 'q": "'), ("assistant", "\\\\\"")]),
    ]
    rows = [(i, json.dumps(body), "x", "x") for i, (body, _) in enumerate(cases)]
    rows += [(90, '{"completion": 1, "prompt": null}', "x", "x"), (91, '{"prompt":"a","completion":[2]}', "x", "x"), (92, '{"prompt": "a", "comp', "x", "x")]
    frame = spark.createDataFrame(rows, "conv_id int, body string, known string, names string")
    got = {r.conv_id: r for r in chat.canonical_turns(frame).collect()}
    for i, (_, turns) in enumerate(cases):
        assert (None if got[i].turns is None else [tuple(t) for t in got[i].turns]) == turns, i
    assert got[0].known == got[0].names == "x"
    assert [tuple(t) for t in got[90].turns] == [("user", ""), ("assistant", "1")]
    assert got[92].fingerprint is None and got[92].turns is None
    # Names decide, in whatever order; types don't.
    assert got[9].fingerprint == got[90].fingerprint != got[2].fingerprint


def test_conversation_longer_than_the_json_limits(spark):
    """A text of 25,000,000 characters, beyond what a JSON parser takes by default."""
    size = 25_000_000
    rows = spark.range(2).select(
        F.lit(2).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.repeat(F.when(F.col("id") == 0, 'ab"c\\').otherwise("</s>x"), size // 5).alias("text"),
    )
    records = chat.as_records(chat.gathered(rows.unionByName(rows.withColumns({"turn": F.col("turn") + 2, "conv_id": F.lit(4).cast("long")}))))
    read = chat.read_back(chat.formatted(chat.canonical_turns(records)))
    for r in read.select("conv_id", "fingerprint", F.transform("turns", lambda t: F.char_length(t["text"])).alias("sizes"), F.sha2("loss_text", 256).alias("loss")).collect():
        assert r.fingerprint is not None and r.sizes == [size, size]
        assert r.loss == hashlib.sha256(("</s>x" * (size // 5)).encode()).hexdigest()


def test_template_is_reversible(spark):
    nasty = ["", "\\", "[INST]", "[\\INST]", "\\[INST]", "</s", "<</s>", "s>[/INST]", "a\nb", "é🙂</s>[INST] ok [/INST]", "\\\\</s>\\"]
    rows = [(i, i % 3, ["user", "assistant", nasty[i % len(nasty)]][i % 3], nasty[i % len(nasty)]) for i in range(66)]
    rows = [(a // 6, a, r, t) for a, _, r, t in rows] + [(50, None, None, None), (None, 1, "assistant", "x"), (None, 1, "assistant", "x")]
    turns = chat.gathered(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"))
    want = {r.conv_id: [tuple(t) for t in r.turns] for r in turns.collect()}
    for made in (turns, chat.canonical_turns(chat.as_records(turns)).select("conv_id", "turns")):
        written = chat.formatted(made)
        for r in written.collect():
            assert sum(r.loss_runs) + len(chat.END) == len(r.formatted)
        for r in chat.read_back(written).collect():
            assert [tuple(t) for t in r.turns] == want[r.conv_id]
            assert r.loss_text == "".join(t for role, t in want[r.conv_id] if role == "assistant")


def test_line_odd_rows(spark, doc_frame):
    line = "A line that is long enough"
    rows = [(1, f"{line}\nown\n{line}"), (2, f" {line.upper()}\t\nx"), (3, f"y\n{line}\n{line}"), (3, f"y\n{line}\n{line}"), (4, None), (5, "")]
    rows += [(None, line), (6, "short\n" * 70 + line), (7, "short\n" * 70 + line + "\n" + "é" * 20_000)]
    got = lines.dedup_lines(doc_frame(rows))
    texts = sorted(((r.doc_id, r.text, r[lines.N_DROPPED]) for r in got.collect()), key=str)
    want = [(1, "own", 2), (2, "x", 1), (3, "y", 2), (3, "y", 2), (4, None, 0), (5, "", 0), (None, "", 1), (6, "short\n" * 70 + "", 1)]
    want[-1] = (6, "\n".join(["short"] * 70), 1)
    want.append((7, rows[-1][1], 0))
    assert texts == sorted(want, key=str)
    keep = {r.doc_id: r.keep for r in lines.line_bitmaps(doc_frame(rows)).collect()}
    assert [(w["word"], ~w["bits"]) for w in keep[6]] == [(1, 1 << 6)] and keep[7] is None
    assert lines.dedup_lines(doc_frame([])).count() == 0


def brute_measures(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    counts = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + j for i in range(len(w) - 2) if counts[tuple(w[i : i + 3])] > 1 for j in range(3)}
    full = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), symbols, len(full) - len(set(full)), len(covered), failed


def test_quality_query(spark, texts):
    for r in QUERIES["op10_quality_rules"](spark, SF_DIR).collect():
        assert tuple(r)[1:-1] == brute_measures(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_quality_odd_rows(spark, doc_frame):
    rows = ODD + [(9, "a b c\na b c\n\n \na b c"), (10, "a a a a"), (11, "x y")]
    frame = doc_frame(rows)
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (9, 0, 0), (2, None, 0)], "doc_id bigint, quality int, toxic int")
    got = quality.rules(frame, labels).collect()
    by_id = sorted((str(r.doc_id), *tuple(r)[1:6], r.base_failed) for r in got)
    assert by_id == sorted((str(d), *brute_measures(t)) for d, t in rows)
    none = labels.limit(0)
    assert quality.rules(frame, none).count() == len(rows)
    assert quality.rules(frame.limit(0), none).count() == 0
    assert quality.kept_documents(frame, labels).columns == frame.columns


def test_quality_tells_junk_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    judged = quality.rules(docs, labels.filter(~held)).join(labels.filter(held), "doc_id").filter("n_words >= 50").collect()
    good = [r.kept for r in judged if r.quality == 1 and not r.base_failed]
    bad = [r.kept for r in judged if r.quality == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)



def test_the_fingerprint_selects_the_layout(spark):
    """One row a described fingerprint, whatever the number of records; records are mapped through it."""
    bodies = [json.dumps({"prompt": f"p{i}", "completion": i}) for i in range(5)] + [json.dumps({"messages": []}), '{"else": 1}', "no json", None]
    records = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "conv_id int, body string")
    found = {r.fingerprint: r.layout for r in chat.layouts(records).collect()}
    got = {r.conv_id: r for r in chat.canonical_turns(records).collect()}
    assert sorted(found.values()) == [0, 6] and len({got[i].fingerprint for i in range(5)}) == 1
    assert found[got[0].fingerprint] == 6 and found[got[5].fingerprint] == 0
    assert all((got[i].turns is not None) == (got[i].fingerprint in found) for i in got)


def test_every_trusted_document_counts(spark):
    """More trusted documents than a sample of 20,000: a target that is the whole corpus has no log ratios."""
    docs = spark.range(21_000).selectExpr("id as doc_id", "concat('w', id % 7, ' v', id % 11) as text")
    labels = docs.selectExpr("doc_id", "1 as quality", "0 as toxic")
    assert quality.trusted_ids(labels).count() == 21_000
    own = quality.trusted_texts(docs, quality.trusted_ids(labels.where("doc_id % 3 = 0 or doc_id > 30000")))
    assert own.count() == 7_000
    assert quality.fit(docs, docs.select("text")) == [0.0] * quality.BUCKETS


def test_quantiles_equal_percentile(spark):
    for values in ([3.0], [1.0, 2.0], [5.0] * 40 + [1.0, -2.5, 7.25], [math.sin(i) for i in range(997)]):
        frame = spark.createDataFrame([(v,) for v in values] + [(None,)], "ratio double")
        want = frame.agg(F.percentile("ratio", F.array(F.lit(0.01), F.lit(0.5))).alias("q")).first()["q"]
        assert quality.quantiles(frame, "ratio", [0.01, 0.5]) == want
    assert quality.quantiles(frame.limit(0), "ratio", [0.5]) is None
