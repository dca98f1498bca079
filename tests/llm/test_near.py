"""Near-duplicates of documents and vectors, and repeated passages, against brute force."""

import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from sluice.llm import embeddings, minhash, passages
from sluice.llm.cases import QUERIES
from sluice.llm.components import components

SF_DIR = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def groups(nodes, links):
    top = {n: n for n in nodes}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def linked(texts):
    sets = {k: shingles(v) for k, v in texts.items()}
    ids = sorted(sets)
    pairs = []
    for i, a in enumerate(ids):
        for b in ids[:i]:
            shared = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * shared >= 75 * len(sets[a] | sets[b]):
                pairs.append((a, b))
    return sets, groups(ids, pairs)


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 200), (7, None), (300, 301), (301, 300)]
    got = components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    found = {r.node: r.component for r in got}
    assert len(got) == len(found)
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_minhash_query(spark, texts):
    sets, component = linked(texts)
    for row in QUERIES["op1_minhash"](spark, SF_DIR).collect():
        want = (len(sets[row.doc_id]), component[row.doc_id], component[row.doc_id] == row.doc_id)
        assert (row.n_shingles, row.component_id, row.kept) == want


def edited(base, rng, n):
    out = list(base)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**9)}"
    return " ".join(out)


def test_minhash_groups_and_odd_rows(spark, doc_frame):
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    # Near copies of one text and copies of one copy; many are near some of the others only.
    rows = [(i, edited(base, rng, rng.choice([1, 2, 4, 6]))) for i in range(10, 70)]
    rows += [(i, rows[3][1].upper()) for i in range(70, 90)]
    rows += [(100, None), (101, ""), (102, " \n"), (103, "one two"), (104, "ONE  two"), (105, "one two three"), (106, "x " * 60_000)]
    sets, component = linked(dict(rows))
    got = {r.doc_id: r for r in minhash.near_duplicates(doc_frame(rows + [rows[0], (None, rows[1][1])])).collect()}
    for doc, _ in rows:
        assert (got[doc].n_shingles, got[doc].component_id) == (len(sets[doc]), component[doc])
    assert got[None].component_id == component[rows[1][0]] and not got[None].kept
    kept = minhash.dedup(doc_frame(rows + [rows[0]]))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({d for d in component if component[d] == d})
    assert minhash.near_duplicates(doc_frame([])).count() == 0


def test_blocks_find_links_that_no_leader_has(spark, doc_frame, monkeypatch):
    # A chain: neighbours are linked, others of the same buckets are not.
    monkeypatch.setattr(minhash, "BLOCK", 4)
    words_ = [f"c{i}" for i in range(600)]
    rows = [(i, " ".join(words_[20 * i : 20 * i + 200])) for i in range(20)]
    sets, component = linked(dict(rows))
    assert set(component.values()) == {0}
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(doc_frame(rows)).collect()}
    assert got == component


def test_estimate_is_near_similarity(spark):
    rng = np.random.default_rng(1)
    values = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    one, two = minhash.minima(values[:3000]), minhash.minima(values[500:])
    pair = [(minhash.signature(one).tolist(), minhash.signature(two).tolist())]
    frame = spark.createDataFrame(pair, "one array<bigint>, two array<bigint>")
    got = frame.select(minhash.estimate(frame.one, frame.two).alias("j"), minhash.unequal_lanes(frame.one, frame.two).alias("u")).first()
    assert abs(got.j - 2500 / 4000) < 0.2
    assert got.u == ((one & 3) != (two & 3)).sum()


def brute_vectors(rows):
    ids, label, vector = zip(*rows, strict=True)
    links = defaultdict(int)
    pairs = []
    for i in range(len(rows)):
        for j in range(i):
            if label[i] is None or label[i] != label[j] or not vector[i] or not vector[j] or len(vector[i]) != len(vector[j]):
                continue
            if None in vector[i] or None in vector[j]:
                continue
            a, b = np.array(vector[i], np.float64), np.array(vector[j], np.float64)
            if not (np.isfinite(a).all() and np.isfinite(b).all() and a.any() and b.any()):
                continue
            if a @ b / math.sqrt((a @ a) * (b @ b)) >= 0.93:
                links[ids[i]] += 1
                links[ids[j]] += 1
                pairs.append((ids[i], ids[j]))
    return links, groups(ids, pairs)


@pytest.mark.parametrize("block", [embeddings.BLOCK, 7])
def test_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(2)
    rows = []
    for centre in rng.normal(size=(12, 32)):
        for _ in range(12):
            rows.append((len(rows), int(rng.integers(2)), (centre + 0.3 * rng.normal(size=32)).astype(np.float32).tolist()))
    rows += [(1000 + i, 0, rows[0][2]) for i in range(5)]
    rows += [(2000, None, rows[0][2]), (2001, 0, None), (2002, 0, [0.0] * 32), (2003, 0, [float("nan")] * 32), (2004, 0, [])]
    rows += [(2005, 0, [None] + rows[0][2][1:]), (2006, 1, [-0.0] * 32)]
    links, component = brute_vectors(rows)
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, label int, embedding array<float>, n_links string")
    got = embeddings.near_duplicates(frame).collect()
    assert len(got) == len(rows)
    found = sum(r.n_links for r in got)
    assert found >= 0.99 * sum(links.values())
    for r in got:
        assert r.n_links <= links[r.vec_id]
        if r.n_links == links[r.vec_id]:
            assert r.component_id == component[r.vec_id] or found < sum(links.values())
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


def test_vector_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    links, component = brute_vectors(rows)
    for r in QUERIES["op3_itq_vectors"](spark, SF_DIR).collect():
        assert (r.n_links, r.component_id) == (links[r.vec_id], component[r.vec_id])


def test_recall_at_the_threshold():
    # Pairs exactly at the threshold, one label.
    rng = np.random.default_rng(3)
    a = rng.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.normal(size=a.shape)
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.93 * a + math.sqrt(1 - 0.93**2) * side
    bits, tables = embeddings.plan_tables(4000)
    turns = [embeddings.learn_rotation(a, rng.normal(size=(64, 64)), 10) for _ in range(math.ceil(bits * tables / 64))]
    codes = embeddings.Codes({64: turns}, bits, tables, 3)
    met = (codes.substrings(a) == codes.substrings(b)).any(axis=1)
    assert met.mean() >= 0.99


@pytest.mark.parametrize("share, block", [(0.33, 1024), (0.5, 100), (0.8, 1024), (0.8, 100), (0.9, 200)])
def test_dense_groups_keep_their_links(spark, monkeypatch, share, block):
    """One label, of which a share lies in a group of pairwise cosine about 0.932; some pairs outside of it."""
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(int(share * 100))
    n, width = 1500, 64
    size = int(n * share)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    centre = unit(rng.normal(size=width))
    side = rng.normal(size=(size, width))
    side = unit(side - np.outer(side @ centre, centre))
    group = math.sqrt(0.932) * centre + math.sqrt(0.068) * side
    rest = unit(rng.normal(size=(n - size, width)))
    near = unit(rest[:50] + 0.3 * unit(rng.normal(size=(50, width))))
    data = np.concatenate([group, rest, near]).astype(np.float32)
    wide = data.astype(np.float64)
    links = unit(wide) @ unit(wide).T >= 0.93
    np.fill_diagonal(links, False)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(data)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = {r.vec_id: r for r in embeddings.near_duplicates(frame).collect()}
    found = sum(r.n_links for r in got.values())
    assert 0.999 * links.sum() <= found <= links.sum()
    assert all(got[i].n_links <= links[i].sum() for i in range(len(data)))
    assert len({got[i].component_id for i in range(size)}) == 1


def test_vectors_of_every_width(spark):
    rng = np.random.default_rng(8)
    rows = []
    for width, n in ((8, 40), (3, 12), (1, 3)):
        base = rng.normal(size=(n // 2 + 1, width))
        for v in np.repeat(base, 2, axis=0)[:n]:
            rows.append((len(rows), (v + rng.normal(size=width) * 0.01).astype(np.float32).tolist(), 4))
    links = {}
    for i, v, _ in rows:
        links[i] = sum(
            i != j and len(v) == len(w) and np.dot(v, w) / (np.linalg.norm(v) * np.linalg.norm(w)) >= 0.93 for j, w, _ in rows
        )
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = {r.vec_id: r.n_links for r in embeddings.near_duplicates(frame).collect()}
    assert got == links


def test_passages(spark, doc_frame):
    rng = random.Random(4)
    fresh = lambda n: [f"v{rng.randrange(10**8)}" for _ in range(n)]
    shared, short = fresh(60), fresh(20)
    rows, holds = [], {}
    for i in range(40):
        if i % 4 == 1:
            before = fresh(30)
            rows.append((i, " ".join(before + shared + fresh(40))))
            holds[i] = (30, 90)
        elif i % 4 == 2:
            rows.append((i, " ".join(fresh(40) + short + fresh(40))))
        else:
            rows.append((i, "\n".join(fresh(80))))
    near = list(shared)
    near[30] = "other"
    rows += [(50, " ".join(fresh(10) + near)), (60, None), (61, ""), (62, "a b"), (63, "a b"), (70, rows[0][1].upper()), (None, rows[1][1])]
    got = defaultdict(list)
    for r in passages.repeated_passages(doc_frame(rows)).collect():
        got[r.doc_id].append(r)
    assert set(got) == {*holds, 50, 0, 70, None}
    for i, (start, end) in holds.items():
        inner = [r for r in got[i] if r.component_id == 1]
        assert any(r.first_word <= start and r.first_word + r.n_words >= end for r in inner)
        assert sum(r.n_removed for r in inner) == (0 if i == 1 else 60)
    assert [(r.first_word, r.n_words, r.n_removed) for r in got[50]] == [(10, 60, 60)]
    assert [(r.component_id, r.n_removed) for r in got[70]] == [(0, 80)]
    assert [(r.component_id, r.n_removed) for r in got[0]] == [(0, 0)]
    assert passages.repeated_passages(doc_frame([])).count() == 0


def test_passage_query_finds_every_repeat(spark, texts):
    seen = defaultdict(set)
    for doc, text in texts.items():
        w = words(text)
        for i in range(len(w) - 49):
            seen[tuple(w[i : i + 50])].add((doc, i))
    covered = defaultdict(set)
    for r in QUERIES["op9_passages"](spark, SF_DIR).collect():
        covered[r.doc_id] |= set(range(r.first_word, r.first_word + r.n_words))
    for places in seen.values():
        if len({doc for doc, _ in places}) > 1:
            for doc, i in places:
                assert set(range(i, i + 50)) <= covered[doc]


def spans_of(frame):
    got = defaultdict(list)
    for r in passages.repeated_passages(frame).collect():
        got[r.doc_id].append((r.first_word, r.n_words, r.n_removed))
    return got


@pytest.mark.parametrize("block", [passages.BLOCK, 3])
def test_passages_behind_a_common_phrase(spark, doc_frame, monkeypatch, block):
    # Lower doc_ids hold every phrase of five words that is a key of the passage, but not the passage.
    monkeypatch.setattr(passages, "BLOCK", block)
    rng = random.Random(7)
    fresh = lambda n: [f"p{rng.randrange(10**8)}" for _ in range(n)]
    shared = fresh(55)
    keys = sorted(set(passages.window_keys(passages.word_hashes(" ".join(shared)))[1].tolist()))
    rows = [(i, " ".join(sum((fresh(45) + shared[k : k + 5] for k in keys), []) + fresh(45))) for i in range(8)]
    # This one has forty of the words.
    rows.append((8, " ".join(fresh(30) + shared[8:48] + fresh(30))))
    rows += [(20 + i, " ".join(fresh(25) + shared + fresh(25))) for i in range(3)]
    got = spans_of(doc_frame(rows))
    assert got == {20: [(25, 55, 0)], 21: [(25, 55, 55)], 22: [(25, 55, 55)]}


def test_passage_recall_at_the_threshold(spark, doc_frame):
    # Windows of fifty words, two neighbouring words replaced: similarity 40 / 52, the least there is from 0.75 on.
    rng = random.Random(8)
    rows, pairs = [], 400
    for i in range(pairs):
        base = [f"r{rng.randrange(10**8)}" for _ in range(50)]
        other = list(base)
        at = rng.randrange(5, 43)
        other[at : at + 2] = f"s{rng.randrange(10**8)}", f"s{rng.randrange(10**8)}"
        sets = [shingles(" ".join(x)) for x in (base, other)]
        assert 100 * len(sets[0] & sets[1]) >= 75 * len(sets[0] | sets[1])
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(other))]
    got = spans_of(doc_frame(rows))
    recall = sum(2 * i in got and 2 * i + 1 in got for i in range(pairs)) / pairs
    assert recall >= 0.96


def brute_similar(a, b):
    """Whether any two windows are alike, by sets."""
    n = passages.SHINGLES
    sets = [[set(x[i : i + n].tolist()) for i in range(len(x) - n + 1)] for x in (a, b)]
    return [(i, j) for i, s in enumerate(sets[0]) for j, t in enumerate(sets[1]) if 100 * len(s & t) >= 75 * len(s | t)]


def test_similar_windows_are_those_of_brute_force():
    rng = random.Random(11)
    found = 0
    for trial in range(60):
        base = [rng.randrange(10**9) if trial % 3 else rng.randrange(60) for _ in range(rng.randrange(46, 92))]
        other = list(base)
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(other))
            kind = rng.randrange(4)
            if kind == 0:
                other[at] = rng.randrange(10**9)
            elif kind == 1:
                other[at:at] = [rng.randrange(10**9) for _ in range(5)]
            elif kind == 2:
                del other[at : at + 4]
            else:
                other = other[at:] + other[:at]
        a, b = np.array(base, np.uint32), np.array(other[:91], np.uint32)
        want = brute_similar(a, b)
        got = passages.similar_windows(a, b)
        assert (got is not None) == bool(want)
        if want:
            found += 1
            i, j = zip(*want, strict=True)
            n = passages.SHINGLES
            assert min(i) <= got[0] <= got[1] < max(i) + n and min(j) <= got[2] <= got[3] < max(j) + n
            inside = set(a[min(i) : max(i) + n].tolist()) & set(b[min(j) : max(j) + n].tolist())
            assert [x in inside for x in (a[got[0]], a[got[1]], b[got[2]], b[got[3]])] == [True] * 4
    assert found > 10


def test_passages_with_words_put_in_or_left_out(spark, doc_frame):
    rng = random.Random(6)
    fresh = lambda n: [f"i{rng.randrange(10**8)}" for _ in range(n)]
    rows, sizes = [], {}
    for i in range(0, 40, 2):
        shared = fresh(60)
        near = shared[:30] + fresh(1) + shared[30:] if i % 4 else shared[:30] + shared[31:]
        rows += [(i, " ".join(fresh(20) + shared + fresh(20))), (i + 1, " ".join(fresh(10) + near + fresh(10)))]
        sizes |= {i: (20, 60, 0), i + 1: (10, len(near), len(near))}
    got = spans_of(doc_frame(rows))
    exact = [i for i in sizes if got[i] == [sizes[i]]]
    assert len(exact) >= 0.9 * len(sizes)


def test_dedup_keeps_one_where_ids_are_no_key(spark, doc_frame):
    rng = random.Random(9)
    one, two = ([f"d{rng.randrange(10**6)}" for _ in range(200)] for _ in range(2))
    rows = [(None, edited(one, rng, 1)) for _ in range(4)] + [(5, edited(two, rng, 1)) for _ in range(3)] + [(None, ""), (5, " ")]
    left = [(r.doc_id, bool(r.text.strip())) for r in minhash.dedup(doc_frame(rows)).collect()]
    assert sorted(left, key=str) == [(5, False), (5, True), (None, False), (None, True)]


def test_equal_surroundings_compared_once_find_the_same():
    rng = np.random.default_rng(12)
    draw = lambda *shape: rng.integers(0, 2**32, shape, dtype=np.uint64).astype(np.uint32)
    for _ in range(60):
        n = int(rng.integers(2, 40))
        base, others = draw(passages.AROUND), draw(4, passages.AROUND)
        around, valid = np.tile(base, (n, 1)), np.ones((n, passages.AROUND), bool)
        for row, fits in zip(around, valid, strict=True):
            kind, other = rng.integers(0, 6), others[rng.integers(0, 4)]
            if kind == 1:
                row[10:15] = 7
            elif kind == 2:
                row[:30] = other[:30]
            elif kind == 3:
                row[60:] = other[60:]
            elif kind == 4:
                row[:] = np.r_[row[:50], other[:2], row[50:-2]]
            elif kind == 5:
                row[:] = other
            if rng.random() < 0.2:
                cut = rng.integers(0, 45)
                fits[:cut], row[:cut] = False, 0
        own = np.unique(np.sort(rng.integers(0, max(2, n // 2), n)), return_inverse=True)[1]
        side = np.full(n, 2)
        met = passages.Meeting(own, side, around, valid)
        met.compare()
        spans, gone, group = passages.repeats(own, side, around, valid)
        assert (spans == met.spans).all() and (gone == met.gone).all()
        found = spans[:, 1] >= 0
        assert (group[found] == met.group[found]).all()


def test_meetings_leave_out_no_pair_that_adds_something():
    rng = np.random.default_rng(21)
    draw = lambda *shape: rng.integers(0, 2**32, shape, dtype=np.uint64).astype(np.uint32)
    some = 0
    for trial in range(40):
        n = int(rng.integers(3, 14))
        base, phrase = draw(passages.AROUND), draw(int(rng.integers(3, 60)))
        if trial % 4 == 0:
            base = np.resize(phrase, passages.AROUND)
        around, valid = draw(n, passages.AROUND), np.ones((n, passages.AROUND), bool)
        for row, fits in zip(around, valid, strict=True):
            low, high = int(rng.integers(0, 46)), int(rng.integers(46, 92))
            row[low:high] = base[low:high]
            kind = rng.integers(0, 4)
            if kind == 1:
                row[rng.integers(0, passages.AROUND, 4)] = draw(4)
            elif kind == 2:
                row[:] = np.r_[row[:40], draw(3), row[40:-3]]
            elif kind == 3:
                row[50:] = np.resize(phrase, passages.AROUND - 50)
            if rng.random() < 0.2:
                cut = rng.integers(1, 45)
                fits[-cut:], row[-cut:] = False, 0
        own = np.unique(np.sort(rng.integers(0, n, n)), return_inverse=True)[1]
        spans = np.tile(np.array([passages.AROUND, -1]), (n, 1))
        gone, group = spans.copy(), np.arange(n)
        for i in range(n):
            for j in range(i + 1, n):
                found = own[i] != own[j] and passages.similar_windows(around[i][valid[i]], around[j][valid[j]])
                if found:
                    a, b, c, d = (x + int(valid[k].argmax()) for x, k in zip(found, (i, i, j, j), strict=True))
                    spans[i] = min(spans[i, 0], a), max(spans[i, 1], b)
                    for own_spans in (spans, gone):
                        own_spans[j] = min(own_spans[j, 0], c), max(own_spans[j, 1], d)
                    group[group == max(group[i], group[j])] = min(group[i], group[j])
        met = passages.Meeting(own, np.full(n, 2), around, valid)
        met.compare()
        assert (met.spans == spans).all() and (met.gone == gone).all() and (met.group == group).all()
        some += len(np.unique(group)) < n
    assert some > 20


def test_passages_of_many_near_copies_in_any_blocks(spark, doc_frame, monkeypatch):
    rng = random.Random(13)
    base = [f"c{rng.randrange(10**8)}" for _ in range(120)]
    rows = []
    for i in range(60):
        copy = list(base)
        if i % 3:
            copy[rng.randrange(120)] = f"d{i}"
        if i % 7 == 0:
            copy = [f"e{i}x{j}" for j in range(20)] + copy[30:]
        rows.append((i, " ".join(copy)))
    whole = sorted(spans_of(doc_frame(rows)).items())
    assert len(whole) == 60
    monkeypatch.setattr(passages, "BLOCK", 4)
    assert sorted(spans_of(doc_frame(rows)).items()) == whole


@pytest.mark.parametrize("limits", [{}, {"FEW": 2, "MANY": 4, "PAIRS": 7, "CROSS": 3}, {"FEW": 99, "MANY": 99, "PAIRS": 1}])
def test_meetings_compared_together_are_those_compared_alone(monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(passages, name, value)
    rng = np.random.default_rng(31)
    draw = lambda *shape: rng.integers(0, 2**32, shape, dtype=np.uint64).astype(np.uint32)
    parts = []
    for trial in range(25):
        n = int(rng.integers(1, 14))
        base, around, valid = draw(passages.AROUND), draw(n, passages.AROUND), np.ones((n, passages.AROUND), bool)
        if trial % 3 == 0:
            base = np.resize(base[:20], passages.AROUND)
        for row, fits in zip(around, valid, strict=True):
            low, high = int(rng.integers(0, 40)), int(rng.integers(50, 92))
            row[low:high] = base[low:high]
            if rng.random() < 0.3:
                row[:] = np.r_[row[:40], draw(2), row[40:-2]]
            if rng.random() < 0.3:
                cut = rng.integers(1, 45)
                fits[:cut], row[:cut] = False, 0
        own = np.unique(np.sort(rng.integers(0, n, n)), return_inverse=True)[1]
        parts.append((own, np.full(n, 2), around, valid, np.full(n, 1000 - trial)))
    spans, gone, group = passages.repeats(*(np.concatenate(x) for x in zip(*parts, strict=True)))
    at = joined = 0
    for own, _, around, valid, _ in parts:
        n = len(own)
        want, lost, first = np.tile(np.array([passages.AROUND, -1]), (n, 1)), np.tile(np.array([passages.AROUND, -1]), (n, 1)), np.arange(n)
        for i in range(n):
            for j in range(i + 1, n):
                if own[i] == own[j]:
                    continue
                one, two = around[i][valid[i]], around[j][valid[j]]
                pairs = brute_similar(one, two)
                if pairs:
                    k, m = zip(*pairs, strict=True)
                    x, y = one[min(k) : max(k) + passages.SHINGLES], two[min(m) : max(m) + passages.SHINGLES]
                    p, q = np.flatnonzero(np.isin(x, y)) + min(k) + valid[i].argmax(), np.flatnonzero(np.isin(y, x)) + min(m) + valid[j].argmax()
                    want[i] = min(want[i, 0], p[0]), max(want[i, 1], p[-1])
                    for ends in (want, lost):
                        ends[j] = min(ends[j, 0], q[0]), max(ends[j, 1], q[-1])
                    first[first == max(first[i], first[j])] = min(first[i], first[j])
        part = slice(at, at + n)
        found = want[:, 1] >= 0
        assert ((spans[part, 1] >= 0) == found).all()
        assert (spans[part][found] == want[found]).all() and (gone[part][found] == lost[found]).all()
        assert (group[part][found] - at == first[found]).all()
        joined += found.sum()
        at += n
    assert joined > 40


def test_keys_of_texts_together_are_those_of_each_alone():
    rng = random.Random(32)
    texts = [" ".join(rng.choices([f"k{x}" for x in range(rng.choice([2, 9, 500]))], k=rng.choice([0, 3, 49, 50, 51, 200]))) for _ in range(60)]
    each = [passages.word_hashes(text) for text in texts]
    text, keys, places = passages.keys_of(np.concatenate(each), np.array([len(x) for x in each]))
    for i, own in enumerate(each):
        got = sorted(zip(keys[text == i].tolist(), places[text == i].tolist(), strict=True))
        want = set()
        for salt in passages._salts if len(own) >= passages.WINDOW else ():
            values = passages.mixed(passages.shingle_hashes(own) ^ salt)
            for start in range(len(values) - passages.SHINGLES + 1):
                window = values[start : start + passages.SHINGLES]
                at = start + np.flatnonzero(window == window.min())
                assert any((int(window.min().astype(np.int64)), p) in got for p in at.tolist())
                want |= {(int(window.min().astype(np.int64)), p) for p in at.tolist()}
        assert len(set(got)) == len(got) and set(got) <= want


def places_in_runs(rng, n, words=12):
    """Surroundings of a place in a run of one word, between runs of other words; few of their windows are alike."""
    own, around = [], []
    for i in range(n):
        runs = [(int(rng.integers(1, words)), int(rng.integers(2, 40))) for _ in range(6)]
        runs[3] = 0, int(rng.integers(8, 40))
        text = np.concatenate([np.full(size, word + 1, np.uint64) for word, size in runs])
        shingles = (passages.shingle_hashes(passages.mixed(text)) >> np.uint64(32)).astype(np.uint32)
        at = sum(size for _, size in runs[:3]) + int(rng.integers(0, runs[3][1] - 4))
        row, places = np.zeros(passages.AROUND, np.uint32), at + np.arange(passages.AROUND) - passages.SHINGLES + 1
        fits = (places >= 0) & (places < len(shingles))
        row[fits] = shingles[places[fits]]
        own.append(i // 3)
        around.append((row, fits))
    return np.array(own), np.stack([x for x, _ in around]), np.stack([x for _, x in around])


@pytest.mark.parametrize("found", [1 << 20, 50])
def test_windows_of_recurring_shingles_meet_by_their_sets(monkeypatch, found):
    monkeypatch.setattr(passages, "FEW", 2)
    monkeypatch.setattr(passages, "MANY", 4)
    monkeypatch.setattr(passages, "FOUND", found)
    monkeypatch.setattr(passages, "SORTED", found)
    rng = np.random.default_rng(found)
    some = 0
    for trial in range(12):
        own, around, valid = places_in_runs(rng, int(rng.integers(5, 16)), 3 + trial % 3)
        n = len(own)
        met = passages.Meeting(own, np.full(n, 2), around, valid)
        met.compare()
        want, lost, first = np.tile(np.array([passages.AROUND, -1]), (n, 1)), np.tile(np.array([passages.AROUND, -1]), (n, 1)), np.arange(n)
        for i in range(n):
            for j in range(i + 1, n):
                got = own[i] != own[j] and passages.similar_windows(around[i][valid[i]], around[j][valid[j]])
                if got:
                    a, b, c, d = (x + int(valid[k].argmax()) for x, k in zip(got, (i, i, j, j), strict=True))
                    want[i] = min(want[i, 0], a), max(want[i, 1], b)
                    for ends in (want, lost):
                        ends[j] = min(ends[j, 0], c), max(ends[j, 1], d)
                    first[first == max(first[i], first[j])] = min(first[i], first[j])
        assert (met.spans == want).all() and (met.gone == lost).all() and (met.group == first).all()
        some += len(np.unique(first)) < n
    assert some > 6


def test_a_common_repeated_word_brings_few_pairs_together(monkeypatch):
    pairs = [0]
    cross = passages.Meeting._cross

    def counted(self, one, two):
        pairs[0] += len(one)
        cross(self, one, two)

    monkeypatch.setattr(passages.Meeting, "_cross", counted)
    own, around, valid = places_in_runs(np.random.default_rng(3), 400, 2000)
    passages.repeats(own, np.full(400, 2), around, valid)
    # Of 79,401 pairs of places of different documents.
    assert pairs[0] < 400
