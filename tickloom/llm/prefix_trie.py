"""The prefix trie of conversations, from vertical bitmaps.

A node stands for the first d turns of one or more conversations, which are its members. Turns are told apart by 128
bits of a SHA-256 of role and text, so texts are read once and never shuffled.

1. Tasks read conversations in order, a shard of them at a time. A shard is indexed vertically: (position, turn) leads to
   the bitset of conversations with that turn there. Depth first from the root, the intersection of a node's bitset
   with the postings of the next position yields its children; the bits of a child are its members here, and the
   bitset of conversations that end at its depth gives its end list. A conversation longer than a shard goes on in the next
   one below the node where it was cut, so memory is bounded by the shard.
2. A node's key is a digest of its parent's key and its turn, so the parts of a node found in several shards are
   summed by key. Copies are added up in their shard; no group is gathered.
3. Sums over subtrees: below a node of one member lies one chain with one end, so only nodes of two members or more take part. They
   point to their parents, and each round doubles the distance: what hangs 2**k below a node is added to it
   and its pointer jumps as far again. A trie of depth d takes log2(d) rounds.
4. The digest of a node's end list needs its ids in order: they are sorted by node and id across partitions and hashed as they
   stream by, a batch at a time.

Edge cases: rows without a conversation id belong to none; a null turn number comes first; turns of equal number go by
role, then by the digest of their text; null roles and texts are empty; repeated rows are turns of their own; a
conversation without turns is a member of the root; columns other than the named ones are not looked at; an empty table
has no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialise

SHARD_TURNS = 1 << 16
SHARD_CONVERSATIONS = 4096
ROOT = bytes(16)
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_key(role: Column, text: Column) -> Column:
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(whole.cast("binary"), 256), 1, 32))


def numbered_turns(
    rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv, pos (from 1), key and bytes of every turn."""
    narrow = rows.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"),
        turn_key(F.col(role), F.col(text)).alias("key"), F.octet_length(F.coalesce(text, F.lit(""))).cast("long").alias("bytes"),
    )
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "key")
    return narrow.select("conv", F.row_number().over(order).cast("long").alias("pos"), "key", "bytes")


def steps_of(turns: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    """Turns as they are read: a row without a turn begins every conversation of ``turns`` (or of ``parts``, which has conv, part, pos, key, bytes)."""
    rows = turns.select("conv", F.lit(1).alias("part"), "pos", "key", "bytes") if parts is None else parts
    begin = turns.where("pos = 1").select("conv", F.lit(0).alias("part"), F.lit(0).cast("long").alias("pos"))
    return rows.unionByName(begin, allowMissingColumns=True)


@dataclass
class _Segment:
    conv: int
    depth: int = 0
    node: bytes = ROOT
    keys: list[bytes] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    ended: bool = False


def child_key(node: bytes, key: bytes) -> bytes:
    return hashlib.blake2b(node + key, digest_size=16).digest()


def shard_nodes(segments: list[_Segment]) -> Iterator[tuple]:
    """(node, parent, depth, members, smallest member, bytes, end list) of every node of a shard.

    Segments are in ascending order of conversations. A segment that goes on below a node adds no member to it.
    """
    starts: dict[tuple[int, bytes], int] = {}
    postings: dict[tuple[int, bytes], int] = {}
    present: dict[int, int] = {}
    ends: dict[int, int] = {}
    for i, s in enumerate(segments):
        bit = 1 << i
        starts[s.depth, s.node] = starts.get((s.depth, s.node), 0) | bit
        for at, key in enumerate(s.keys, s.depth + 1):
            postings[at, key] = postings.get((at, key), 0) | bit
            present[at] = present.get(at, 0) | bit
        if s.ended:
            last = s.depth + len(s.keys)
            ends[last] = ends.get(last, 0) | bit

    def smallest(bits: int) -> _Segment:
        return segments[(bits & -bits).bit_length() - 1]

    stack = []
    for (depth, node), bits in starts.items():
        # The root has no text; a node that was counted in an earlier shard counts nothing here.
        stack.append((bits, node, None, depth, 0 if depth else bits.bit_count(), None if depth else 0))
    while stack:
        bits, node, parent, depth, members, size = stack.pop()
        ending, listed = bits & ends.get(depth, 0), []
        while ending:
            listed.append(smallest(ending).conv)
            ending &= ending - 1
        yield node, parent, depth, members, smallest(bits).conv, size, listed
        rest = bits & present.get(depth + 1, 0)
        while rest:
            first = smallest(rest)
            at = depth - first.depth
            child = bits & postings[depth + 1, first.keys[at]]
            rest ^= child
            stack.append((child, child_key(node, first.keys[at]), node, depth + 1, child.bit_count(), first.sizes[at]))


def _segments(batches: Iterator[pa.RecordBatch], turns: int, conversations: int) -> Iterator[list[_Segment]]:
    """Shards of at most ``turns`` turns and ``conversations`` segments, from rows sorted by conv, part and pos."""
    held: list[_Segment] = []
    now: _Segment | None = None
    count = 0
    for batch in batches:
        columns = (batch.column(n).to_pylist() for n in ("conv", "part", "key", "bytes"))
        for conv, part, key, size in zip(*columns):
            if part == 0:
                if now is not None:
                    now.ended = True
                if count >= turns or len(held) >= conversations:
                    yield held
                    held, count = [], 0
                now = _Segment(conv)
                held.append(now)
                continue
            if count >= turns:
                node = now.node
                for k in now.keys:
                    node = child_key(node, k)
                yield held
                now = _Segment(conv, now.depth + len(now.keys), node)
                held, count = [now], 0
            now.keys.append(key)
            now.sizes.append(size)
            count += 1
    if now is not None:
        now.ended = True
        yield held


def _halves(keys: list[bytes | None]) -> tuple[pa.Array, pa.Array]:
    missing = np.array([k is None for k in keys], bool)
    pairs = np.frombuffer(b"".join(k or ROOT for k in keys), "<i8").reshape(-1, 2)
    return tuple(pa.array(np.ascontiguousarray(pairs[:, i]), pa.int64(), mask=missing) for i in (0, 1))


def parts_of_nodes(steps: DataFrame, *, turns: int = SHARD_TURNS, conversations: int = SHARD_CONVERSATIONS) -> DataFrame:
    """The nodes of every shard: key (a, b), parent (pa, pb), depth, n, conv, bytes and end list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _segments(batches, turns, conversations):
            rows = list(shard_nodes(shard))
            for at in range(0, len(rows), 1 << 14):
                node, parent, depth, members, conv, size, listed = zip(*rows[at : at + (1 << 14)])
                long = (pa.array(v, pa.int64()) for v in (depth, members, conv, size))
                yield pa.RecordBatch.from_arrays(
                    [*_halves(node), *_halves(parent), *long, pa.array(listed, pa.list_(pa.int64()))],
                    ["a", "b", "pa", "pb", "depth", "n", "conv", "bytes", "ends"],
                )

    ordered = steps.repartition("conv").sortWithinPartitions("conv", "part", "pos").select("conv", "part", "key", "bytes")
    return ordered.mapInArrow(run, "a long, b long, pa long, pb long, depth long, n long, conv long, bytes long, ends array<long>")


def _end_digests(ends: DataFrame) -> DataFrame:
    """(a, b, ends_sha256): SHA-256 of a node's ids in ascending order, joined by commas, as they stream by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        done: list[tuple] = []

        def made() -> pa.RecordBatch:
            a, b, digest = zip(*done)
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(digest)], ["a", "b", "ends_sha256"]
            )

        for batch in batches:
            a, b, conv = (batch.column(n).to_numpy() for n in ("a", "b", "conv"))
            cuts = np.flatnonzero((np.diff(a) != 0) | (np.diff(b) != 0)) + 1
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(a)]):
                if low == high:
                    continue
                listed = ",".join(map(str, conv[low:high].tolist())).encode()
                if now == (int(a[low]), int(b[low])):
                    state.update(b"," + listed)
                else:
                    if now is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = (int(a[low]), int(b[low])), hashlib.sha256(listed)
            if len(done) >= 1 << 14:
                yield made()
                done = []
        if now is not None:
            done.append((*now, state.hexdigest()))
        if done:
            yield made()

    ordered = ends.repartition("a", "b").sortWithinPartitions("a", "b", "conv")
    return ordered.mapInArrow(run, "a long, b long, ends_sha256 string")


def _subtree_sums(shared: DataFrame) -> DataFrame:
    """(a, b, leaves, saved) summed over subtrees. ``shared`` has a, b, its parent pa, pb (null for the root), leaves and saved."""
    table = materialise(shared, "subtrees")
    while not table.where("pa is not null").isEmpty():
        # Distances double: what a node knows covers its subtree down to 2**k - 1, its pointer leads 2**k up.
        below = table.where("pa is not null").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
        )
        up = table.where("pa is not null").select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("pa").alias("fa"), F.col("pb").alias("fb"))
        table = materialise(
            table.join(below, ["a", "b"], "left").join(up, ["pa", "pb"], "left").select(
                "a", "b", F.col("fa").alias("pa"), F.col("fb").alias("pb"),
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            ),
            "subtrees",
        )
    return table.select("a", "b", "leaves", "saved")


def trie(steps: DataFrame, *, turns: int = SHARD_TURNS, conversations: int = SHARD_CONVERSATIONS) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``steps`` are rows of ``steps_of``. saved_tokens sums, over a node's subtree, the bytes of each node's last text for
    all its members but one.
    """
    parts = materialise(parts_of_nodes(steps, turns=turns, conversations=conversations), "parts")
    nodes = materialise(
        parts.groupBy("a", "b").agg(
            F.max("pa").alias("pa"), F.max("pb").alias("pb"), F.max("depth").alias("depth"), F.sum("n").alias("n"),
            F.min("conv").alias("conv"), F.max("bytes").alias("bytes"), F.sum(F.size("ends").cast("long")).alias("n_ends"),
            F.min(F.get("ends", F.lit(0))).alias("one_end"),
        ),
        "nodes",
    )
    shared = nodes.where("n > 1")
    above = shared.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv").alias("above"))
    # A parent of one member has the same member.
    linked = materialise(
        nodes.join(above, ["pa", "pb"], "left").withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.coalesce("above", "conv"))), "linked"
    )
    children = linked.where("above is not null").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
        F.count(F.lit(1)).alias("n_children"), F.count(F.when(F.col("n") == 1, 1)).alias("chains")
    )
    counted = materialise(shared.join(children, ["a", "b"], "left").select(
        "a", "b", "pa", "pb", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        # Its own end, if it has no child, and that of every child with one member.
        F.when(F.col("n_children").isNull(), 1).otherwise(F.col("chains")).cast("long").alias("leaves"),
        ((F.col("n") - 1) * F.col("bytes")).alias("saved"),
    ), "counted")
    sums = _subtree_sums(counted.drop("n_children"))
    several = shared.where("n_ends > 1").select("a", "b")
    digests = _end_digests(parts.where(F.size("ends") > 0).join(several, ["a", "b"], "left_semi").select("a", "b", F.explode("ends").alias("conv")))
    few = F.when(F.col("n_ends") == 0, NO_ENDS).when(F.col("n_ends") == 1, F.sha2(F.col("one_end").cast("string").cast("binary"), 256))
    head = [F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs")]
    single = linked.where("n = 1").select(
        *head, (1 - F.col("n_ends")).alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        few.alias("ends_sha256"),
    )
    joined = linked.where("n > 1").join(counted.select("a", "b", "n_children"), ["a", "b"]).join(sums, ["a", "b"]).join(digests, ["a", "b"], "left")
    many = joined.select(
        *head, "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce(few, "ends_sha256").alias("ends_sha256")
    )
    return many.union(single)


def build(rows: DataFrame, **names: str) -> DataFrame:
    """The trie of conversations as they are."""
    return trie(steps_of(materialise(numbered_turns(rows, **names), "turns")))
