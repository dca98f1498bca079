"""Token counts that follow edits: per document a segment tree over its pre-tokens."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.bpe import Encoder, encoder
from sluice.llm.common import rows_of

#: Pre-tokens in a leaf of a new tree; a leaf grown to four times that has the tree built anew.
LEAF = 64
EDITS = "array<struct<start:int,stop:int,new:string>>"
INDEX = "doc_id bigint, text string, chars array<int>, tokens array<int>"


class TokenTree:
    """Sums of characters and tokens over runs of pre-tokens.

    Leaves hold the lengths and token counts of their pre-tokens; a node's
    sums are those of its two children, so a place is found and a change is
    summed up along one path.
    """

    def __init__(self, chars: np.ndarray, tokens: np.ndarray) -> None:
        ends = range(0, len(chars), LEAF)
        self.leaves = [(chars[i : i + LEAF], tokens[i : i + LEAF]) for i in ends] or [(chars, tokens)]
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        self.char_sums, self.token_sums = (self._sums(values, list(ends)) for values in (chars, tokens))

    def _sums(self, values: np.ndarray, starts: list[int]) -> list[int]:
        """Sums of all nodes, the root at 1, the leaves from ``width`` on."""
        out = np.zeros(2 * self.width, np.int64)
        if starts:
            out[self.width : self.width + len(starts)] = np.add.reduceat(values, starts, dtype=np.int64)
        level = self.width
        while level > 1:
            out[level // 2 : level] = out[level : 2 * level : 2] + out[level + 1 : 2 * level : 2]
            level //= 2
        return out.tolist()

    def _sum(self, node: int) -> None:
        self.char_sums[node] = self.char_sums[2 * node] + self.char_sums[2 * node + 1]
        self.token_sums[node] = self.token_sums[2 * node] + self.token_sums[2 * node + 1]

    @property
    def total(self) -> int:
        return self.token_sums[1]

    def leaf_of(self, place: int) -> tuple[int, int]:
        """The leaf that holds character ``place``, and the characters before it."""
        node, before = 1, 0
        while node < self.width:
            node *= 2
            if place >= before + self.char_sums[node] and self.char_sums[node + 1]:
                before += self.char_sums[node]
                node += 1
        return min(node - self.width, len(self.leaves) - 1), before

    def splice(self, first: tuple[int, int], last: tuple[int, int], chars: np.ndarray, tokens: np.ndarray) -> bool:
        """Put pre-tokens in place of those from ``first`` to before ``last`` (leaf, place in it); False if a leaf grew too long."""
        (leaf, at), (end_leaf, end) = first, last
        head, tail = self.leaves[leaf], self.leaves[end_leaf]
        joined = tuple(np.concatenate([h[:at], new, t[end:]]) for h, new, t in zip(head, (chars, tokens), tail, strict=True))
        for i in range(leaf, end_leaf + 1):
            self.leaves[i] = joined if i == leaf else (chars[:0], tokens[:0])
            node = self.width + i
            self.char_sums[node], self.token_sums[node] = (int(part.sum()) for part in self.leaves[i])
            node //= 2
            while node:
                self._sum(node)
                node //= 2
        return len(joined[0]) <= 4 * LEAF

    def flat(self) -> tuple[np.ndarray, np.ndarray]:
        chars, tokens = zip(*self.leaves, strict=True)
        return np.concatenate(chars), np.concatenate(tokens)


def edit(own: Encoder, tree: TokenTree, text: str, start: int, stop: int, new: str) -> tuple[TokenTree, str, int]:
    """The tree and text after an edit, and the number of pre-tokens encoded for it.

    A pre-token reads two characters past its end at most, so those that end
    two characters before the edit stay.  Encoding starts behind them and ends
    at the first old boundary met after the edit.
    """
    start = min(max(start, 0), len(text))
    stop = min(max(stop, start), len(text))
    edited = text[:start] + new + text[stop:]
    shift = len(new) - (stop - start)
    leaf, place = tree.leaf_of(max(start - 2, 0))
    at = 0
    lengths = tree.leaves[leaf][0].tolist()
    while at < len(lengths) and place + lengths[at] + 2 <= start:
        place += lengths[at]
        at += 1
    first = (leaf, at)
    old_leaf, old_at, old_place = leaf, at, place
    chars: list[int] = []
    tokens: list[int] = []
    for match in own.vocabulary.finditer(edited, place):
        begin = match.start()
        if begin >= start + len(new):
            while old_place + shift < begin:
                while old_at >= len(tree.leaves[old_leaf][0]):
                    old_leaf, old_at = old_leaf + 1, 0
                old_place += int(tree.leaves[old_leaf][0][old_at])
                old_at += 1
            if old_place >= stop and old_place + shift == begin:
                break
        piece = match.group()
        chars.append(len(piece))
        tokens.append(own.size(piece))
    else:
        old_leaf = len(tree.leaves) - 1
        old_at = len(tree.leaves[old_leaf][0])
    if not tree.splice(first, (old_leaf, old_at), np.array(chars, np.int32), np.array(tokens, np.int32)):
        tree = TokenTree(*tree.flat())
    return tree, edited, len(chars)


def index(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """doc_id, text, and the leaves of each document's tree: ``chars`` and ``tokens`` of every pre-token.

    Inner nodes are sums and are summed up again when a tree is loaded.  Null
    and empty texts have no leaves.  Repeated rows have a tree each.  Columns
    besides doc_id and text are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(shared.value, pattern)
        for batch in rows_of(batches):
            chars, tokens = [], []
            for text in batch.column(1):
                pieces = own.vocabulary.split(text.as_py() or "")
                chars.append(np.fromiter(map(len, pieces), np.int32, len(pieces)))
                tokens.append(np.fromiter(map(own.size, pieces), np.int32, len(pieces)))
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(chars, kind), pa.array(tokens, kind)],
                ["doc_id", "text", "chars", "tokens"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, INDEX)


def apply_edits(indexed: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """The index after its column ``edits`` (start, stop, new: in code points, applied in order), with counts.

    Adds n_before, n_tokens and n_encoded (pre-tokens encoded for the edits).
    Null edits are none; places outside the text are moved to its ends, and a
    null ``new`` is empty.
    """
    shared = indexed.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(shared.value, pattern)
        for batch in rows_of(batches, 16 << 20):
            texts, all_chars, all_tokens, before, after, encoded = [], [], [], [], [], []
            for text, chars, tokens, edits in zip(*(batch.column(i) for i in range(1, 5)), strict=True):
                tree = TokenTree(*(np.zeros(0, np.int32) if not p.is_valid else p.values.to_numpy() for p in (chars, tokens)))
                now, count = text.as_py() or "", 0
                before.append(tree.total)
                for change in edits.as_py() or []:
                    tree, now, n = edit(own, tree, now, change["start"] or 0, change["stop"] or 0, change["new"] or "")
                    count += n
                flat = tree.flat()
                texts.append(now)
                all_chars.append(flat[0])
                all_tokens.append(flat[1])
                after.append(tree.total)
                encoded.append(count)
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(texts, pa.string()),
                    pa.array(all_chars, kind),
                    pa.array(all_tokens, kind),
                    pa.array(before, pa.int64()),
                    pa.array(after, pa.int64()),
                    pa.array(encoded, pa.int64()),
                ],
                ["doc_id", "text", "chars", "tokens", "n_before", "n_tokens", "n_encoded"],
            )

    wanted = indexed.select("doc_id", "text", "chars", "tokens", F.col("edits").cast(EDITS))
    return wanted.mapInArrow(run, f"{INDEX}, n_before bigint, n_tokens bigint, n_encoded bigint")


def gather_edits(edits: DataFrame) -> DataFrame:
    """doc_id and ``edits`` in order of ``seq``, of an edit log (doc_id, seq, start, stop, new)."""
    change = F.struct("seq", "start", "stop", "new")
    ordered = F.transform(F.sort_array(F.collect_list(change)), lambda e: F.struct(e["start"], e["stop"], e["new"]))
    return edits.groupBy("doc_id").agg(ordered.cast(EDITS).alias("edits"))
