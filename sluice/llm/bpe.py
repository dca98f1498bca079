"""Byte-level BPE by prefix tables, with decoding, exact appends and edits.

For every prefix of a byte string exactly one token can end its encoding, so
an encoding is stored as one token per prefix (``PrefixTable``).  Growing the
string adds entries and changes none; an edit keeps the entries before it.
The last token of a prefix is the one token that both ends the prefix and may
stand after the last token of what comes before: two tokens may be neighbours
exactly if merging their joined bytes gives the two of them again.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator, Sequence
from operator import itemgetter

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from sluice.llm.common import rows_of

# Caches that have grown to these numbers of entries start anew; results don't depend on them.
CACHE_ENTRIES = 400_000
CACHE_NEIGHBOURS = 1_000_000


def read_ranks(path: str) -> bytes:
    """The content of a rank file, to be handed to the tasks."""
    with open(path, "rb") as file:
        return file.read()


class Vocabulary:
    """Ranks of byte strings, and which tokens may be neighbours."""

    def __init__(self, content: bytes, pattern: str) -> None:
        pairs = (line.split() for line in content.splitlines() if line)
        self.rank = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.bytes_of = {rank: token for token, rank in self.rank.items()}
        #: Bytes of the longest token that ends in four given bytes; tokens that end otherwise have three at most.
        self.longest_ending: dict[bytes, int] = {}
        for token in self.rank:
            if len(token) >= 4:
                self.longest_ending[token[-4:]] = max(len(token), self.longest_ending.get(token[-4:], 0))
        self.split = regex.compile(pattern).findall
        self.finditer = regex.compile(pattern).finditer
        self._neighbours: dict[int, bool] = {}
        self.known_neighbours = self._neighbours.get
        self.width = max(self.bytes_of) + 2

    def merged(self, data: bytes) -> list[int]:
        """Tokens after merging the pair of lowest rank, leftmost first, until none is left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        rank = self.rank.get
        while len(parts) > 1:
            ranks = [rank(a + b, self.width) for a, b in zip(parts, parts[1:], strict=False)]
            best = min(ranks)
            if best == self.width:
                break
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.rank[part] for part in parts]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether ``right`` may stand after ``left``; -1 stands for the start of the string."""
        key = (left + 1) * self.width + right
        known = self._neighbours.get(key)
        if known is None:
            if len(self._neighbours) >= CACHE_NEIGHBOURS:
                self._neighbours.clear()
            if left < 0:
                known = self.merged(self.bytes_of[right]) == [right]
            else:
                known = self.merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
            self._neighbours[key] = known
        return known


class PrefixTable:
    """The last token of every prefix of ``data``."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"") -> None:
        self.vocabulary = vocabulary
        self.data = b""
        self.last: list[int] = []
        self.append(data)

    def append(self, more: bytes) -> None:
        """Grow the string; entries of the old prefixes stay as they are."""
        data = self.data + more
        vocabulary, last = self.vocabulary, self.last
        rank, known, width, longest = vocabulary.rank.get, vocabulary.known_neighbours, vocabulary.width, vocabulary.longest_ending.get
        for end in range(len(self.data) + 1, len(data) + 1):
            for start in range(max(0, end - longest(data[max(0, end - 4) : end], 3)), end):
                token = rank(data[start:end])
                if token is None:
                    continue
                before = last[start - 1] if start else -1
                fits = known((before + 1) * width + token)
                if fits or fits is None and vocabulary.may_follow(before, token):
                    last.append(token)
                    break
            else:
                raise ValueError("the vocabulary lacks a single byte")
        self.data = data

    def replace(self, start: int, end: int, new: bytes) -> None:
        """Replace the bytes from ``start`` to ``end``; entries before ``start`` are kept."""
        tail = self.data[end:]
        self.data = self.data[:start]
        del self.last[start:]
        self.append(new + tail)

    def tokens(self) -> list[int]:
        out = []
        at = len(self.data)
        while at:
            token = self.last[at - 1]
            out.append(token)
            at -= len(self.vocabulary.bytes_of[token])
        return out[::-1]


class _Remembered(dict):
    """What a function made of the pre-tokens met before; long ones are not kept."""

    def __init__(self, make: Callable, entries: int = CACHE_ENTRIES) -> None:
        self.make, self.entries = make, entries

    def __missing__(self, piece: str):
        value = self.make(piece)
        if len(piece) <= 64:
            if len(self) >= self.entries:
                self.clear()
            self[piece] = value
        return value


class Encoder:
    """Encodes and decodes texts, remembering the pre-tokens met before."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self._known = _Remembered(self._tokens)
        #: Tokens of one pre-token; one that is a token itself stays whole.
        self.piece = self._known.__getitem__
        #: Number of tokens of one pre-token.
        self.size = _Remembered(lambda piece: len(self._tokens(piece)), 2 * CACHE_ENTRIES).__getitem__
        #: Of one pre-token: number of tokens, decimal ids joined by commas, bytes decoded from the ids.
        self.facts = _Remembered(self._facts).__getitem__

    def _tokens(self, piece: str) -> tuple[int, ...]:
        data = piece.encode()
        whole = self.vocabulary.rank.get(data)
        return (whole,) if whole is not None else tuple(PrefixTable(self.vocabulary, data).tokens())

    def _facts(self, piece: str) -> tuple[int, str, bytes]:
        ids = self._tokens(piece)
        return len(ids), ",".join(map(str, ids)), self.decode(ids)

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for piece in self.vocabulary.split(text):
            out += self.piece(piece)
        return out

    def append(self, ids: list[int], text: str, more: str) -> list[int]:
        """Tokens of ``text + more``, given those of ``text``, which is walked as in ``edit``."""
        return self.edit(ids, text, len(text), len(text), more)

    def edit(self, ids: list[int], text: str, start: int, end: int, new: str) -> list[int]:
        """Tokens of the text with ``new`` in place of [start, end), given the tokens of the text.

        A pre-token depends on nothing before it and on two characters after
        it at most.  So all pre-tokens that end two characters before the edit
        stay, and from the first old boundary met after the edit on, the old
        ones go on unchanged.  The whole old text is split to count its tokens up
        to each boundary, so an edit takes time in proportion to the text.
        """
        edited = text[:start] + new + text[end:]
        shift = len(new) - (end - start)
        kept_chars = kept_ids = 0
        old_at: dict[int, int] = {}
        count = 0
        for match in self.vocabulary.finditer(text):
            if match.start() >= end:
                old_at[match.start() + shift] = count
            count += len(self.piece(match.group()))
            if match.end() + 2 <= start:
                kept_chars, kept_ids = match.end(), count
        out = list(ids[:kept_ids])
        for match in self.vocabulary.finditer(edited, kept_chars):
            if match.start() >= start + len(new) and match.start() in old_at:
                return out + list(ids[old_at[match.start()] :])
            out += self.piece(match.group())
        return out

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids))


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(content: bytes, pattern: str) -> Encoder:
    """The encoder of this Python worker; reused workers keep it."""
    key = (hashlib.sha256(content).hexdigest(), pattern)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(Vocabulary(content, pattern))
    return _encoders[key]


def encode(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """doc_id and token ids (``ids``) of every whole text; a null or empty text has no tokens.

    Narrow: each task encodes the rows it reads, in slices of a bounded number
    of bytes.  The rank file goes to the tasks as a broadcast variable, whose
    size is the vocabulary's.  Repeated rows are encoded each; other columns of
    ``docs`` are not read.
    """
    shared = _share(docs.sparkSession, ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(shared.value, pattern)
        for batch in rows_of(batches):
            ids = [own.encode(text or "") for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """doc_id and the bytes (``data``) of every row of ``ids``; null ids give no bytes."""
    shared = _share(encoded.sparkSession, ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(shared.value, pattern)
        for batch in rows_of(batches):
            data = [own.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, data binary")


def round_trip(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """Per document the digests of its token ids and of the bytes decoded from them.

    Columns: doc_id, n_tokens, ids_sha256 (of decimal ids joined by commas),
    decoded_sha256.  The token lists never leave the task that made them; what
    is made of a pre-token's ids, their decoding too, is remembered with it.
    Null and empty texts have 0 tokens and the digests of nothing.
    """
    shared = _share(docs.sparkSession, ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(shared.value, pattern)
        count, decimal, data = itemgetter(0), itemgetter(1), itemgetter(2)
        for batch in rows_of(batches):
            counts, id_digests, byte_digests = [], [], []
            for text in batch.column(1):
                facts = list(map(own.facts, own.vocabulary.split(text.as_py() or "")))
                counts.append(sum(map(count, facts)))
                id_digests.append(hashlib.sha256(",".join(map(decimal, facts)).encode()).hexdigest())
                byte_digests.append(hashlib.sha256(b"".join(map(data, facts))).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(id_digests), pa.array(byte_digests)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _share(spark: SparkSession, ranks: bytes):
    return spark.sparkContext.broadcast(ranks)
