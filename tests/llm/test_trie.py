"""The conversation trie against brute force, with blocks and ranges far smaller than the input."""

import hashlib
import random
import zlib

import pytest

from sluice.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, path string, chars string, depth string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA)


def rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, role, key, text))
    turns = {c: [(t[2], t[4]) for t in sorted(v)] for c, v in own.items()}
    made = {}
    for c, v in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = tuple(turns.get(c - c % 100, [])[:h] + v[h:])
    return made


def brute(rows):
    made = rebuilt(rows)
    members = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    kids, leaves, saved = {}, dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        if node:
            kids[node[:-1]] = kids.get(node[:-1], 0) + 1
    for node, own in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += (len(own) - 1) * len(node[-1][1]) if node else 0
    out = []
    for node, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if made[c] == node)
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(own), len(node), parent, len(own), kids.get(node, 0), leaves[node], saved[node], digest))
    return sorted(out, key=str)


def found(spark, rows):
    nodes = trie.prefix_trie(trie.rebuilt(frame(spark, rows)))
    assert nodes.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    ]
    return sorted((tuple(r) for r in nodes.collect()), key=str)


def sample(seed, convs, words, longest):
    """Conversations over few texts, so that many share their first turns."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(convs * 3), convs):
        for t in range(rng.randrange(1, longest)):
            rows.append((c, t, rng.choice(("user", "assistant")), rng.choice(words)))
    return rows


@pytest.mark.parametrize("seed, block", [(1, 2), (2, 3), (3, 7), (4, 20_000)])
def test_equals_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr(trie, "BLOCK", block)
    rows = sample(seed, 150, ["a", "bb", ""], 9)
    assert found(spark, rows) == brute(rows)


def test_many_ranges_and_rounds(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 4)
    monkeypatch.setattr(trie, "FAN_IN", 2)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = sample(5, 200, ["a", "b"], 12)
        # A conversation that a third of all have, and one that is a prefix of another at every depth.
        rows += [(1000 + c, t, "user", "same") for c in range(100) for t in range(3)]
        rows += [(2000 + c, t, "user", "chain") for c in range(40) for t in range(c)]
        assert found(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_nulls_ties_and_repeats(spark):
    rows = [
        (None, 0, "user", "nobody's"),
        (100, None, "user", None),
        (100, 0, None, "x"),
        (101, 0, "user", "tie"),
        (101, 0, "user", "eit"),
        (101, 0, "user", "tie"),
        (205, 3, "", ""),
        (306, 0, "user", "é" * 100_000),
        (307, 0, "user", "é" * 100_000),
    ]
    assert found(spark, rows) == brute(rows)


def test_turnless_conversation_is_a_member_of_the_root(spark):
    # Its own turns lie before its h, and the conversation it begins with is absent.
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 1)
    rows = [(c, 0, "user", "x"), (300, 0, "user", "y")]
    nodes = found(spark, rows)
    assert nodes == brute(rows)
    root = next(n for n in nodes if n[1] == 0)
    assert root[3] == 2 and root[7] == hashlib.sha256(str(c).encode()).hexdigest()


def test_empty_table(spark):
    assert found(spark, []) == []


def test_common_turns():
    one = bytes(range(16)) + b"a" * 16 + b"b" * 16
    assert trie.common_turns(one, one[:32]) == 2
    assert trie.common_turns(one, one[:32] + b"c" * 16) == 2
    assert trie.common_turns(one, b"z" * 48) == 0
    assert trie.common_turns(one, b"") == 0
