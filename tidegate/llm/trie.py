"""A prefix trie of conversations, from adaptive radix trees of bounded parts.

A turn's id is the first 16 bytes, big-endian, of the SHA-256 of its role and text; a
conversation is the ids of its turns end to end, a byte string. Conversations are dealt
into parts by a hash of their id, so a first turn that a third of them share is in every
part, and no part grows with it. Each part keys an adaptive radix tree with its byte
strings: nodes grow from 4 over 16 and 48 to 256 children, and a run of bytes without a
branch is kept as one prefix. Walking it gives a row at every byte depth that is a whole
number of turns, whether a node begins there or a prefix runs through it, and none
elsewhere. Rows of one sequence (named by a chained SHA-256 of its ids) are then added up
over the parts: a sequence has one row for each part at most.

Sums over subtrees need no walk of the whole trie. A node belongs to its smallest member;
a conversation's nodes are then the end of its path, from its first own depth on. So a
second walk of the parts adds up, for every node, what the conversations below it own:
texts once for each distinct node, and childless nodes. With the texts of all members
from the first walk, the difference is what sharing saves.

Defined results: turns are ordered by ``turn``, null first, ties by turn id; repeated rows
are turns of their own. A null role or text is empty. Rows without a conversation id are
left out. An empty table has no nodes. Other columns are not read. A conversation is held
by one task at a time, 24 bytes a turn; so is a part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.sources.shared import kept

WIDTH = 16
#: Turns of a part on average, and ids that one row of a digest's input may list.
PART_TURNS = 1 << 14
BLOCK_IDS = 1 << 12
ROOT = b""


class Node:
    """A node of the tree: the bytes on the way to it, its children by next byte, and what ends here.

    ``keys`` and ``below`` are parallel and sorted up to 16 children; then ``keys`` is an
    index of 256 entries into 48 slots (0: none), and at last ``below`` has a slot for
    each byte and ``keys`` is empty.
    """

    __slots__ = ("prefix", "keys", "below", "room", "count", "ends")

    def __init__(self, prefix: bytes):
        self.prefix, self.keys, self.below, self.room, self.count = prefix, bytearray(), [], 4, 0
        self.ends: list[int] = []

    def child(self, byte: int) -> Node | None:
        if self.room == 256:
            return self.below[byte]
        if self.room == 48:
            slot = self.keys[byte]
            return self.below[slot - 1] if slot else None
        at = self.keys.find(byte)
        return self.below[at] if at >= 0 else None

    def put(self, byte: int, node: Node) -> None:
        """Set the child of a byte, in a larger layout if this one is full."""
        fresh = self.child(byte) is None
        if fresh and self.count == self.room and self.room < 256:
            self._grow()
        if self.room == 256:
            self.below[byte] = node
        elif self.room == 48:
            if fresh:
                self.below.append(node)
                self.keys[byte] = len(self.below)
            else:
                self.below[self.keys[byte] - 1] = node
        elif fresh:
            at = sum(k < byte for k in self.keys)
            self.keys.insert(at, byte)
            self.below.insert(at, node)
        else:
            self.below[self.keys.find(byte)] = node
        self.count += fresh

    def _grow(self) -> None:
        children = list(self.children())
        if self.room == 4:
            self.room = 16
        elif self.room == 16:
            self.room, self.keys, self.below = 48, bytearray(256), [node for _, node in children]
            for slot, (byte, _) in enumerate(children, 1):
                self.keys[byte] = slot
        else:
            self.room, self.keys, self.below = 256, bytearray(), [None] * 256
            for byte, node in children:
                self.below[byte] = node

    def children(self) -> Iterator[tuple[int, Node]]:
        """In the order of their bytes."""
        if self.room == 256:
            yield from ((byte, node) for byte, node in enumerate(self.below) if node is not None)
        elif self.room == 48:
            yield from ((byte, self.below[slot - 1]) for byte, slot in enumerate(self.keys) if slot)
        else:
            yield from zip(self.keys, self.below, strict=True)


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # halves of what may differ
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle)
    return low


def insert(root: Node, key: bytes, number: int) -> None:
    """Let ``number`` end at ``key``."""
    node, at = root, 0
    while at < len(key):
        below = node.child(key[at])
        if below is None:
            leaf = Node(key[at:])
            leaf.ends.append(number)
            node.put(key[at], leaf)
            return
        same = _common(below.prefix, key[at : at + len(below.prefix)])
        if same < len(below.prefix):  # the way forks, or ends, inside the prefix
            fork = Node(below.prefix[:same])
            below.prefix = below.prefix[same:]
            fork.put(below.prefix[0], below)
            node.put(key[at], fork)
            below = fork
        node, at = below, at + same
    node.ends.append(number)


def walk(root: Node, width: int = WIDTH) -> Iterator[tuple[int, int, bytes, Node | None]]:
    """(number, parent's number, id, node) of each whole turn depth, parents before children; the root is number 0.

    Where a turn ends inside a prefix, no tree node is there and the last entry is None.
    """
    yield 0, -1, b"", root
    made = 1
    stack = [(child, 0, b"") for _, child in root.children()]
    while stack:
        node, parent, rest = stack.pop()
        way = rest + node.prefix  # the bytes since the last whole turn
        whole = len(way) // width
        for k in range(whole):
            ends_here = (k + 1) * width == len(way)
            yield made, parent, way[k * width : (k + 1) * width], node if ends_here else None
            parent, made = made, made + 1
        rest = way[whole * width :]
        stack += [(child, parent, rest) for _, child in node.children()]


class Part:
    """The trie of a part's conversations, as arrays in which parents precede children."""

    def __init__(self, keys: list[bytes], sizes: dict[bytes, int]):
        root = Node(b"")
        for number, key in enumerate(keys):
            insert(root, key, number)
        found = list(walk(root))
        self.parent = np.array([p for _, p, _, _ in found], np.int64)
        self.ends = [node.ends if node else [] for _, _, _, node in found]
        self.size = np.array([sizes.get(turn, 0) for _, _, turn, _ in found], np.int64)
        self.name, self.depth = [ROOT], [0]
        for _, parent, turn, _ in found[1:]:
            self.name.append(hashlib.sha256(self.name[parent] + turn).digest()[:WIDTH])
            self.depth.append(self.depth[parent] + 1)

    def __len__(self) -> int:
        return len(self.parent)

    def up(self, own: np.ndarray, fold) -> np.ndarray:
        """Each node's own value folded with those of all nodes below it."""
        out, parent = own.tolist(), self.parent.tolist()
        for i in range(len(out) - 1, 0, -1):
            out[parent[i]] = fold(out[parent[i]], out[i])
        return np.array(out, np.int64)

    def own(self, values: np.ndarray, fold, nothing: int) -> np.ndarray:
        """Each node's fold of the values of the conversations that end there."""
        out = np.full(len(self), nothing, np.int64)
        for i, numbers in enumerate(self.ends):
            for k in numbers:
                out[i] = fold(int(out[i]), int(values[k]))
        return out


def add(a: int, b: int) -> int:
    return a + b


def _part(table: pa.Table) -> Part:
    lists = table.column("turns").combine_chunks()
    flat = lists.flatten()
    ids, sizes = flat.field("id").to_pylist(), flat.field("size").to_pylist()
    edges = np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))).tolist()
    keys = [b"".join(ids[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return Part(keys, dict(zip(ids, sizes, strict=True)))


_FAR = np.int64(1) << 62


def first_walk(table: pa.Table) -> pa.Table:
    """A part's nodes: members, their texts from here on, and the conversations that end here."""
    part, ids = _part(table), table.column("conv_id").to_numpy()
    n_convs = part.up(part.own(np.ones(len(ids), np.int64), add, 0), add)
    return pa.table(
        {
            "node": pa.array(part.name, pa.binary()),
            "parent": pa.array([part.name[p] if p >= 0 else None for p in part.parent.tolist()], pa.binary()),
            "depth": pa.array(part.depth, pa.int64()),
            "size": pa.array(part.size),
            "conv_id": pa.array(part.up(part.own(ids, min, np.iinfo(np.int64).max), min)),
            "n_convs": pa.array(n_convs),
            "text_bytes": pa.array(part.up(n_convs * part.size, add)),
            "ends": pa.array([[int(ids[k]) for k in e] for e in part.ends], pa.list_(pa.int64())),
        }
    )


def second_walk(table: pa.Table) -> pa.Table:
    """A part's nodes: texts of the distinct nodes and childless nodes that its conversations own from here on."""
    part = _part(table)
    first = part.up(part.own(table.column("first_own").to_numpy(), min, int(_FAR)), min)
    owned = first <= np.array(part.depth, np.int64)
    leaves = part.up(part.own(table.column("owns_leaf").to_numpy(zero_copy_only=False).astype(np.int64), add, 0), add)
    return pa.table(
        {
            "node": pa.array(part.name, pa.binary()),
            "distinct_bytes": pa.array(part.up(np.where(owned, part.size, 0), add)),
            "n_leaves": pa.array(leaves),
        }
    )


def digest_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, block, listed) in order, as one digest a node; one row is held at a time."""
    node, state = None, None
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        for name, listed in zip(batch.column("node").to_pylist(), batch.column("listed").to_pylist(), strict=True):
            if state is None or name != node:
                if state is not None:
                    done.append((node, state.hexdigest()))
                node, state = name, hashlib.sha256(listed.encode())
            else:
                state.update(b"," + listed.encode())
        yield _digests(done)
    if state is not None:
        yield _digests([(node, state.hexdigest())])


def _digests(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([n for n, _ in done], pa.binary()), pa.array([d for _, d in done], pa.string())], names=["node", "ends_sha256"])


def turn_id(role: Column, text: Column) -> Column:
    whole = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.unhex(F.substring(whole, 1, 2 * WIDTH))


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as ids and byte counts of their texts."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), turn_id(role, text).alias("id"), F.octet_length(text).cast("long").alias("size")).alias("turn"),
    )
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return ordered.withColumn("turns", F.transform("turns", lambda t: F.struct(t["id"].alias("id"), t["size"].alias("size"))))


def regrown(sequences: DataFrame, every: int = 5, most: int = 9) -> DataFrame:
    """Conversations that go on from a shared begin: the first turns of the one whose id is the next lower multiple of
    ``every``, then their own. How many are shared follows from the CRC of the id and is less than ``most``."""
    base = sequences.select(F.col("conv_id").alias("base"), F.col("turns").alias("begin"))
    own = sequences.withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
    shared = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    none = F.slice("turns", 1, 0)
    begin = F.slice(F.coalesce("begin", none), F.lit(1), shared)
    return own.join(base, "base", "left").select("conv_id", F.concat(begin, F.slice("turns", shared + 1, F.size("turns"))).alias("turns"))


def prefix_trie(sequences: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """The trie of (conv_id, turns) as one row a node; ``conv_id`` is unique.

    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs (members),
    n_children, n_leaves (childless nodes from here on), saved_tokens (bytes of texts that
    sharing saves from here on), ends_sha256 (of the ids of members that end here).
    """
    given = kept(sequences.select("conv_id", "turns"), "sequences")
    n = given.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    dealt = given.withColumn("part", F.pmod(F.xxhash64("conv_id"), F.lit(max(1, -(-n // part_turns)))).cast("int"))
    found = dealt.groupBy("part").applyInArrow(
        lambda table: first_walk(table),
        "node binary, parent binary, depth bigint, size bigint, conv_id bigint, n_convs bigint, text_bytes bigint, ends array<bigint>",
    )
    found = kept(found, "part-nodes")
    nodes = found.groupBy("node").agg(
        F.first("parent").alias("parent"),
        F.first("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("text_bytes").alias("text_bytes"),
    )
    nodes = kept(nodes, "nodes")
    children = nodes.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = kept(nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "counted-nodes")

    # a conversation owns the end of its path, if anything; its deepest own node is where it ends
    last = F.max(F.struct("depth", "n_children"))["n_children"] == 0
    owners = nodes.groupBy("conv_id").agg(F.min("depth").alias("first_own"), last.alias("owns_leaf"))
    owning = dealt.join(owners, "conv_id").select("part", "turns", "first_own", "owns_leaf")
    owned = owning.groupBy("part").applyInArrow(lambda table: second_walk(table), "node binary, distinct_bytes bigint, n_leaves bigint")
    owned = owned.groupBy("node").agg(F.sum("distinct_bytes").alias("distinct_bytes"), F.sum("n_leaves").alias("n_leaves"))

    # the ids that end at a node are listed in blocks of ids, so that no list grows with a node's copies
    ends = found.where("size(ends) > 0").select("node", F.explode("ends").alias("id"))
    blocks = ends.groupBy("node", F.floor(F.col("id") / BLOCK_IDS).alias("block")).agg(F.concat_ws(",", F.sort_array(F.collect_list("id")).cast("array<string>")).alias("listed"))
    ended = blocks.repartition("node").sortWithinPartitions("node", "block").mapInArrow(digest_ends, "node binary, ends_sha256 string")

    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(above, "parent", "left").join(owned, "node").join(ended, "node", "left")
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        (F.col("text_bytes") - F.col("distinct_bytes")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
