"""Prefix tables against the tiktoken library."""

import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import bpe
from sluice.llm.cases import QUERIES, RANK_FILE

RANKS = bpe.read_ranks(public_tokenizers.path(RANK_FILE))
OWN = bpe.Encoder(bpe.Vocabulary(RANKS, public_tokenizers.PATTERN))
THEIRS = tiktoken.Encoding(
    "own",
    pat_str=public_tokenizers.PATTERN,
    mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())},
    special_tokens={},
)
TEXTS = st.one_of(
    st.text(max_size=60),
    st.text(alphabet="aeènst 'lre\n\t 12.,ß", max_size=80),
    st.lists(st.sampled_from(["the", " of", "'ll", "'re", "  ", "\n\n", "été", "🙂", "12", "..", " "]), max_size=20).map("".join),
)


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_encode_equals_library(text):
    ids = OWN.encode(text)
    assert ids == THEIRS.encode_ordinary(text)
    assert OWN.decode(ids) == text.encode()


@settings(max_examples=400, deadline=None)
@given(TEXTS, TEXTS, st.data())
def test_edit_equals_encoding_anew(text, new, data):
    start = data.draw(st.integers(0, len(text)))
    end = data.draw(st.integers(start, len(text)))
    edited = text[:start] + new + text[end:]
    assert OWN.edit(OWN.encode(text), text, start, end, new) == THEIRS.encode_ordinary(edited)
    assert OWN.append(OWN.encode(text), text, new) == THEIRS.encode_ordinary(text + new)


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=30), st.binary(max_size=10), st.data())
def test_prefix_table_appends_and_replaces(old, new, data):
    table = bpe.PrefixTable(OWN.vocabulary, old)
    before = list(table.last)
    table.append(new)
    assert table.last[: len(old)] == before
    assert table.tokens() == OWN.vocabulary.merged(old + new)
    start = data.draw(st.integers(0, len(old)))
    table.replace(start, len(old), b"xyz")
    assert table.tokens() == OWN.vocabulary.merged(old[:start] + b"xyz" + new)


def test_long_run_of_one_character():
    text = "a" * 30_000
    assert OWN.encode(text) == THEIRS.encode_ordinary(text)


ODD = [(1, None), (2, ""), (3, "the end"), (3, "the end"), (None, "it's"), (4, "x y " * 50_000)]


def digests(text):
    ids = THEIRS.encode_ordinary(text or "")
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return len(ids), sha(",".join(map(str, ids)).encode()), sha((text or "").encode())


def test_odd_rows(spark):
    frame = spark.createDataFrame([(a, b, "x") for a, b in ODD], "doc_id bigint, text string, n_tokens string")
    got = bpe.round_trip(frame, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((a, *digests(b)) for a, b in ODD), key=str)
    encoded = bpe.encode(frame, RANKS, public_tokenizers.PATTERN)
    back = bpe.decode(encoded, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(((r.doc_id, bytes(r.data)) for r in back), key=str) == sorted(((a, (b or "").encode()) for a, b in ODD), key=str)


@pytest.mark.parametrize("keep", [True, False])
def test_empty_table(spark, keep):
    frame = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.round_trip(frame, RANKS, public_tokenizers.PATTERN).count() == 0


def test_query_over_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op8_byte_bpe"](spark, sf).collect()
    assert len(got) == len(texts)
    for row in got:
        assert tuple(row)[1:] == digests(texts[row.doc_id])
