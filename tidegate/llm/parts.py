"""Documents dealt into parts, and hashes that parts ask each other about.

A part is a bounded set of documents, chosen by a hash of the id, that one task holds
at a time. Parts exchange *entries*: each distinct hash of a part goes once to the key
that the hash belongs to, and the key's answer goes back to the part. A hash that a
third of all documents share therefore costs one entry for each part, not one for each
document. Part and key counts follow the input, so both stay of bounded size. Parts
hold their documents in id order, so a task that is run again sends the same entries.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.textkit import U64, from_planes, mix, planes

#: Text of one part in bytes (a single longer document makes its part longer).
PART_BYTES = 4 << 20
ENTRIES = "key int, part int, data binary, extra binary"
REPLIES = "part int, key int, data binary, extra binary"


def part_count(docs: DataFrame, text_col: str = "text", part_bytes: int = PART_BYTES) -> int:
    """One pass over the text lengths."""
    size = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
    return max(1, math.ceil(size / part_bytes))


def parted(docs: DataFrame, n_parts: int, id_col: str = "doc_id", text_col: str = "text", passing: tuple[str, ...] = ()) -> DataFrame:
    """(part, doc_id, text) and the passing columns, whatever others there are. Rows without an id are left out."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *passing)
    rows = rows.where(F.col("doc_id").isNotNull())
    return rows.select(F.pmod(F.xxhash64("doc_id"), F.lit(n_parts)).cast("int").alias("part"), "doc_id", "text", *passing)


def without_id(docs: DataFrame, id_col: str, text_col: str, passing: tuple[str, ...] = ()) -> DataFrame:
    """The rows that ``parted`` leaves out."""
    return docs.where(F.col(id_col).isNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *passing
    )


def in_order(table: pa.Table) -> pa.Table:
    """Rows of a part by id (rows that share an id, by text)."""
    ids = table.column("doc_id").to_numpy()
    if len(ids) < 2 or (ids[1:] > ids[:-1]).all():
        return table
    keys = [("doc_id", "ascending")]
    if len(np.unique(ids)) < len(ids):
        keys.append(("text", "ascending"))
    return table.take(pc.sort_indices(table, sort_keys=keys))


def part_id(table: pa.Table) -> int:
    return table.column("part")[0].as_py()


def placed(hashes: np.ndarray, n_keys: int) -> tuple[np.ndarray, np.ndarray]:
    """The key a hash belongs to, and a 32-bit tag for it within the key."""
    key = ((hashes & U64(0xFFFFFFFF)) * U64(n_keys)) >> U64(32)
    return key, hashes >> U64(32)


def key_edges(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of a sorted array, and where each begins (one more: the end)."""
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first].astype(np.int64), np.append(first, len(keys))


def rows_by_key(keys: np.ndarray, part: int, *columns: np.ndarray) -> pa.Table:
    """One row per key that has entries; ``keys`` is sorted, columns are cut alike."""
    used, edges = key_edges(keys)
    cut = [[planes(c[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)] for c in columns]
    cut += [[b""] * len(used)] * (2 - len(cut))
    return pa.table(
        {
            "key": pa.array(used, pa.int32()),
            "part": pa.array(np.full(len(used), part), pa.int32()),
            "data": pa.array(cut[0], pa.binary()),
            "extra": pa.array(cut[1], pa.binary()),
        }
    )


def votes(hashes: np.ndarray, anchors: np.ndarray, n_keys: int, part: int) -> pa.Table:
    """Each distinct hash once, with whether it is an anchor here (bit 0) and occurs again here (bit 1)."""
    if not len(hashes):
        return rows_by_key(np.zeros(0, U64), part, np.zeros(0, np.uint32), np.zeros(0, np.uint8))
    key, tag = placed(hashes, n_keys)
    packed = (key << U64(33)) | (tag << U64(1)) | anchors.astype(U64)
    packed.sort()
    value = packed >> U64(1)
    new = np.ones(len(value), bool)
    new[1:] = value[1:] != value[:-1]
    first = np.flatnonzero(new)
    after = np.append(first[1:], len(value))
    flags = (packed[after - 1] & U64(1)).astype(np.uint8) | ((after - first > 1).astype(np.uint8) << 1)
    value = value[first]
    return rows_by_key(value >> U64(32), part, (value & U64(0xFFFFFFFF)).astype(np.uint32), flags)


def count_votes(table: pa.Table) -> pa.Table:
    """For one key: tell each part which of its tags occur at least twice in all and as an anchor at least once."""
    tags = [from_planes(x, np.uint32) for x in table.column("data").to_pylist()]
    flags = np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("extra").to_pylist()])
    sizes = np.array([len(x) for x in tags])
    joined = np.concatenate(tags).astype(U64)
    order = (joined << U64(32)) | np.arange(len(joined), dtype=U64)
    order.sort()
    value, at = order >> U64(32), (order & U64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(value), bool)
    new[1:] = value[1:] != value[:-1]
    first = np.flatnonzero(new)
    flags_in_order = flags[at]
    often = np.add.reduceat(1 + (flags_in_order >> 1).astype(np.int64), first) >= 2
    anchored = np.bitwise_or.reduceat(flags_in_order & 1, first) > 0
    live = np.zeros(len(joined), bool)
    live[at] = np.repeat(often & anchored, np.diff(np.append(first, len(value))))
    edges = np.append(0, np.cumsum(sizes))
    data = [planes(t[live[a:b]]) for t, a, b in zip(tags, edges[:-1], edges[1:], strict=True)]
    keep = pa.array([len(x) > 0 for x in data])
    out = pa.table(
        {
            "part": table.column("part"),
            "key": table.column("key"),
            "data": pa.array(data, pa.binary()),
            "extra": pa.array([b""] * len(data), pa.binary()),
        }
    )
    return out.filter(keep)


def answered(replies: pa.Table) -> np.ndarray:
    """The (key, tag) pairs of a part's replies as sorted numbers."""
    keys = replies.column("key").to_pylist()
    held = [from_planes(x, np.uint32).astype(U64) | U64(k << 32) for k, x in zip(keys, replies.column("data").to_pylist(), strict=True)]
    out = np.concatenate(held) if held else np.zeros(0, U64)
    out.sort()
    return out


def as_number(hashes: np.ndarray, n_keys: int) -> np.ndarray:
    """A hash as the number ``answered`` uses for it."""
    key, tag = placed(hashes, n_keys)
    return (key << U64(32)) | tag


def second_key(hashes: np.ndarray, n_keys: int) -> np.ndarray:
    """A key drawn from other bits than the hash itself shows."""
    return ((mix(hashes ^ U64(0xA5A5A5A5A5A5A5A5)) >> U64(32)) * U64(n_keys)) >> U64(32)
