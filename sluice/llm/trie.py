"""Prefix trie of conversations: union-find over the common prefixes of sorted neighbours, deepest first.

Conversations are sorted by their turns.  Neighbours that share d turns share
a node of depth d, and joining neighbours in descending order of d meets every
node after all that lie below it.  A task joins the blocks of its own range;
what may go on in another range (the prefixes of its first and last
conversation) is contracted to a few weighted conversations, and these are
joined in the next round, in fewer ranges, until one is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import saved

#: Bytes that stand for a turn in a conversation's sort key.
TURN = 16
#: Conversations joined at once; a task joins its blocks after that.
BLOCK = 20_000
#: Ranges of one round that meet in one range of the next.
FAN_IN = 16

SHARED_TURNS = 6
GROUP = 100
NO_IDS = hashlib.sha256(b"").hexdigest()


# --- conversations ------------------------------------------------------------------


def rebuilt(rows: DataFrame, group: int = GROUP, shared: int = SHARED_TURNS) -> DataFrame:
    """conv_id, path, chars of every conversation of ``rows`` (conv_id, turn, role, text).

    The first h turns come from the conversation whose id is the next lower
    multiple of ``group``, the others from its own behind its first h; h is
    the CRC-32 of the decimal id modulo ``shared``.  ``path`` has 16 bytes a
    turn, the MD5 of role and text; ``chars`` the code points of its text.

    Turns are ordered by number, null first, then by role and MD5; null roles
    and texts are empty; rows without conv_id belong to no conversation;
    repeated rows are turns each.  A conversation is one row of 20 bytes a turn.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))
    turn = F.struct("turn", role.alias("role"), key.alias("key"), F.char_length(text).alias("chars"))
    turns = F.transform(F.sort_array(F.collect_list(turn)), lambda t: F.struct(t["key"], t["chars"]))
    own = rows.where(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(turns.alias("turns"))
    own = saved(own, "trie-turns")
    base = own.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, shared - 1).alias("lead")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).cast("int")
    joined = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).join(base, "base", "left")
    none = F.array().cast(base.schema["lead"].dataType)
    whole = F.concat(
        F.slice(F.coalesce("lead", none), F.lit(1), h), F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    )
    made = joined.select("conv_id", whole.alias("turns"))
    return made.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: t["key"]), "")).alias("path"),
        F.transform("turns", lambda t: t["chars"]).alias("chars"),
    )


# --- joining ------------------------------------------------------------------------


@dataclass
class Weighted:
    """A sequence of turns with what ends there or hangs below it: members, smallest id, children, leaves, saved characters.

    ``ids`` are the decimal ids of the members that end there, where they are
    still to be written.
    """

    path: bytes
    chars: np.ndarray
    members: int = 0
    smallest: int | None = None
    children: int = 0
    leaves: int = 0
    saved: int = 0
    ids: list[str] = field(default_factory=list)


@dataclass
class Node:
    """A finished node; ``parent`` is known once the parent is finished in the same task."""

    path: bytes
    depth: int
    smallest: int
    members: int
    children: int
    leaves: int
    saved: int
    ids: list[str]
    parent: int | None = None
    waits: bool = False


def common_turns(one: bytes, two: bytes) -> int:
    """Number of turns that two sequences share at their start."""
    n = min(len(one), len(two))
    if one[:n] == two[:n]:
        return n // TURN
    low, high = 0, n // TURN
    while low < high:
        middle = (low + high) // 2
        end = (middle + 1) * TURN
        if one[middle * TURN : end] == two[middle * TURN : end] and one[:end] == two[:end]:
            low = middle + 1
        else:
            high = middle
    return low


def joined(rows: list[Weighted], bounds: tuple[bytes, bytes] | None) -> tuple[list[Node], list[Weighted]]:
    """Finished nodes of sorted sequences, and the contracted rest.

    ``bounds`` are the first and the last sequence of a range, both among the
    rows.  Their prefixes may have members elsewhere; each of them at which
    something ends or hangs becomes a weighted sequence.  Without bounds the
    rows are all there are, and every node is finished.
    """
    n = len(rows)
    done: list[Node] = []
    rest: list[Weighted] = []
    if not n:
        return done, rest
    edges = np.array([common_turns(a.path, b.path) for a, b in zip(rows, rows[1:], strict=False)], np.int64)
    root = list(range(n))
    top = [len(r.path) // TURN for r in rows]
    # What the top node of each component holds so far.
    held = [Weighted(r.path, r.chars, r.members, r.smallest, r.children, r.leaves, r.saved, list(r.ids)) for r in rows]
    below: list[list[Node]] = [[] for _ in rows]

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def lift(i: int, depth: int) -> None:
        """Finish the component's nodes below ``depth``, so that its top node is there."""
        own = held[i]
        if top[i] <= depth:
            return
        path = own.path[: top[i] * TURN]
        if bounds is not None and (bounds[0].startswith(path) or bounds[1].startswith(path)):
            for node in below[i]:
                node.waits = True
            if own.members or own.children or own.ids:
                rest.append(Weighted(path, own.chars[: top[i]], own.members, own.smallest, own.children, own.leaves, own.saved, own.ids))
            held[i] = Weighted(own.path, own.chars)
            below[i] = []
            top[i] = depth
            return
        leaves = own.leaves if own.children else 1
        total, children, ids = own.saved, own.children, own.ids
        child = below[i]
        for at in range(top[i], depth, -1):
            if at:
                total += (own.members - 1) * int(own.chars[at - 1])
            node = Node(own.path[: at * TURN], at, own.smallest, own.members, children, leaves, total, ids)
            for one in child:
                one.parent = own.smallest
            done.append(node)
            child, children, ids = [node], 1, []
        held[i] = Weighted(own.path, own.chars, own.members, own.smallest, 1, leaves, total)
        below[i] = child
        top[i] = depth

    for edge in np.argsort(-edges, kind="stable").tolist():
        depth = int(edges[edge])
        one, two = find(edge), find(edge + 1)
        lift(one, depth)
        lift(two, depth)
        a, b = held[one], held[two]
        a.members += b.members
        a.smallest = min((s for s in (a.smallest, b.smallest) if s is not None), default=None)
        a.children += b.children
        a.leaves += b.leaves
        a.saved += b.saved
        a.ids += b.ids
        below[one] += below[two]
        # The left one leads, so a component's first row is its root.
        root[two] = one
        held[two], below[two] = a, []
    lift(0, -1)
    rest.sort(key=lambda r: r.path)
    return done, rest


# --- tasks --------------------------------------------------------------------------

#: kind: n for a finished node, r for a contracted rest, i for ids of an unfinished one.
_OUT = {
    "kind": pa.string(),
    "path": pa.binary(),
    "chars": pa.list_(pa.int32()),
    "depth": pa.int64(),
    "smallest": pa.int64(),
    "members": pa.int64(),
    "children": pa.int64(),
    "leaves": pa.int64(),
    "saved": pa.int64(),
    "parent": pa.int64(),
    "waits": pa.bool_(),
    "digest": pa.string(),
    "ids": pa.string(),
}
_SCHEMA = (
    "kind string, path binary, chars array<int>, depth bigint, smallest bigint, members bigint, children bigint, "
    "leaves bigint, saved bigint, parent bigint, waits boolean, digest string, ids string"
)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], k) for c, k in _OUT.items()], list(_OUT))


def _key(path: bytes) -> bytes:
    return hashlib.md5(path).digest()


def _node_row(node: Node, late: bool) -> dict:
    """A node's row.  One that was open before has its key in ``path``, one whose parent is open the parent's in ``ids``."""
    row = {
        "kind": "n", "depth": node.depth, "smallest": node.smallest, "members": node.members, "children": node.children,
        "leaves": node.leaves, "saved": node.saved, "parent": node.parent, "waits": node.waits,
    }
    if late:
        row["path"] = _key(node.path)
    else:
        row["digest"] = hashlib.sha256(",".join(node.ids).encode()).hexdigest() if node.ids else NO_IDS
    if node.waits:
        row["ids"] = _key(node.path[:-TURN]).hex()
    return row


def _weighted(batch: pa.RecordBatch, raw: bool) -> Iterator[Weighted]:
    chars = batch.column(1)
    for i, path in enumerate(batch.column(0).to_pylist()):
        own = chars[i].values.to_numpy() if len(chars[i]) else np.zeros(0, np.int32)
        if raw:
            conv = batch.column(2)[i].as_py()
            yield Weighted(path, own, 1, conv, ids=[str(conv)])
        else:
            yield Weighted(path, own, *(batch.column(c)[i].as_py() for c in range(2, 7)))


def _round(rows: DataFrame, raw: bool, whole: bool) -> DataFrame:
    """Join the sorted rows of every partition block by block, then the blocks' rests.

    ``whole``: there is one partition and nothing beside it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        block: list[Weighted] = []
        rests: list[Weighted] = []
        ends: list[bytes] = []

        def give(nodes: list[Node], late: bool) -> None:
            out.extend(_node_row(node, late) for node in nodes)

        def close() -> None:
            ends[1:] = [block[-1].path]
            nodes, rest = joined(block, (block[0].path, block[-1].path))
            give(nodes, not raw)
            for own in rest:
                if own.ids:
                    out.append({"kind": "i", "path": _key(own.path), "smallest": int(own.ids[0]), "ids": ",".join(own.ids)})
                    own.ids = []
            rests.extend(rest)
            block.clear()

        for batch in batches:
            for row in _weighted(batch, raw):
                if not ends:
                    ends.append(row.path)
                block.append(row)
                if len(block) >= BLOCK:
                    close()
            if len(out) > 50_000:
                yield _batch(out)
                out.clear()
        if block:
            close()
        rests.sort(key=lambda r: r.path)
        nodes, rest = joined(rests, None if whole else (ends[0], ends[-1])) if rests else ([], [])
        give(nodes, True)
        for own in rest:
            out.append(
                {
                    "kind": "r", "path": own.path, "chars": own.chars, "members": own.members, "smallest": own.smallest,
                    "children": own.children, "leaves": own.leaves, "saved": own.saved,
                }
            )
        yield _batch(out)

    return rows.mapInArrow(run, _SCHEMA)


def _digests(parts: DataFrame) -> DataFrame:
    """path, digest: the SHA-256 of each node's ids, whose parts are read one after the other and never held together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["path", "digest"])

        for batch in batches:
            for path, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if path != key:
                    if key is not None:
                        yield row()
                    key, state = path, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if key is not None:
            yield row()

    sorted_parts = parts.select("path", "smallest", "ids").repartition("path").sortWithinPartitions("path", "smallest")
    return sorted_parts.mapInArrow(run, "path binary, digest string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of ``conversations`` (conv_id, path, chars; see ``rebuilt``).

    Columns: conv_id (the smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256 (of the ascending ids of
    members that end there, joined by commas).

    Conversations are range-partitioned by their turns and id, so even equal
    ones spread over ranges.  A range goes through in blocks; its rest is two
    paths at most, contracted to the nodes where something ends or hangs.
    Rounds end when one range is left.  The ids of a conversation that very
    many have are hashed part by part in one task, in order, as a digest
    needs, but never held.  Repeated ids are members each; an empty table has
    no nodes.
    """
    rows = conversations.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    out = [saved(_round(rows.select("path", "chars", "conv_id"), True, False), "trie-nodes")]
    ranges = int(out[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while True:
        left = out[-1].where("kind = 'r'")
        ranges = ranges // FAN_IN
        weights = left.select("path", "chars", "members", "smallest", "children", "leaves", "saved")
        one = ranges <= 1
        near = weights.coalesce(1).sortWithinPartitions("path") if one else weights.repartitionByRange(ranges, "path").sortWithinPartitions("path")
        out.append(saved(_round(near, False, one), "trie-nodes"))
        if one:
            break
    every = out[0]
    for more in out[1:]:
        every = every.unionByName(more)
    nodes = every.where("kind = 'n'")
    # Nodes that were open in some round; their digests and children come together here.
    digests = saved(_digests(out[0].where("kind = 'i'")), "trie-digests").withColumnsRenamed({"path": "own", "digest": "joined"})
    late = nodes.where(F.col("path").isNotNull()).join(digests, F.col("path") == F.col("own"), "left").drop("own")
    late = saved(late.withColumn("digest", F.coalesce("joined", F.lit(NO_IDS))).drop("joined"), "trie-late")
    parents = late.select(F.lower(F.hex("path")).alias("ids"), F.col("smallest").alias("above"))
    found = nodes.where(F.col("path").isNull()).unionByName(late)
    placed = found.where("waits").join(parents, "ids").withColumn("parent", F.col("above"))
    final = placed.drop("above").unionByName(found.where("not waits"))
    return final.select(
        F.col("smallest").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("members").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.col("digest").alias("ends_sha256"),
    )
