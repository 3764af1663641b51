"""Suffix-array dedup: longest previous factors over shared byte strings.

A string of ``length`` bytes is ranked in the suffix array of its *anchor*: the least
16-byte gram (by hash) inside it. Equal strings have the same anchor, so one key sees
every string that could match. Only anchors that occur twice anywhere are sent on, with
the bytes around them. For each key the strings are put in suffix order; the nearest
positions in that order, before and after, with a smaller document id are the earlier
matches. The larger of the two common prefixes is the longest previous factor, counted
up to ``length``. A string whose factor has ``length`` bytes goes, the first document
keeps it.

Identical stretches are ranked once, for the smallest id; the others follow from it,
inside a part, where they are sent once, and between parts. Hashes only group: the bytes themselves are compared, inside a part and between.

Defined results: a null text is empty. A row without an id is returned whole and compared
with nothing. Rows that share an id are one document and never earlier than each other.
Texts shorter than ``length`` are kept. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm import parts
from tidegate.llm.textkit import BLOCK, SPANS, U64, Texts, covered, first_alike, from_planes, gather, member, mix, planes, runs, spans_array

GRAM = 16
RESULT = f"doc_id bigint, n_bytes bigint, n_removed bigint, kept binary, kept_text string, spans {SPANS}"


def words8(buf: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on as one number; places near the end see zeros."""
    out = np.zeros(len(buf) + 8, U64)
    out[: len(buf)] = buf
    for width in (1, 2, 4):
        out[:-width] |= out[width:] << U64(8 * width)
    return out[: len(buf)]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive entries, by doubling."""
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if width > span else x


def gram_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hash of a gram from its two halves."""
    return mix(first * U64(0x9E3779B97F4A7C15) + second)


def grams_at(buf: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both halves of the gram at each place; block by block."""
    out = np.empty((2, len(places)), U64)
    for low in range(0, len(places), BLOCK):
        block = places[low : low + BLOCK]
        out[:, low : low + BLOCK] = np.ascontiguousarray(buf[block[:, None] + np.arange(GRAM)]).view("<u8").T
    return out[0], out[1]


def anchors(buf: np.ndarray, length: int) -> np.ndarray:
    """For each start of ``length`` bytes, the place of the least gram in them; block by block."""
    n = len(buf) - length + 1
    out = np.zeros(max(0, n), np.int32 if len(buf) < 1 << 31 else np.int64)
    for low in range(0, n, BLOCK):
        high = min(n, low + BLOCK)
        eight = words8(buf[low : high + length - 1])
        grams = gram_hash(eight[: len(eight) - GRAM + 1], eight[GRAM - 8 : len(eight) - 7])
        grams &= U64(0xFFFFFFFF00000000)
        grams |= np.arange(len(grams), dtype=U64)  # of equal ones the first
        out[low:high] = (sliding_min(grams, length - GRAM + 1) & U64(0xFFFFFFFF)).astype(np.int64) + low
    return out


class Stretches:
    """Maximal runs of string starts that share one anchor: strings first..last, anchored at ``anchor``."""

    def __init__(self, texts: Texts, length: int):
        n = len(texts.buf)
        self.first = self.last = self.anchor = np.zeros(0, np.int64)
        self.hash = np.zeros(0, U64)
        long_enough = texts.stop - texts.start >= length
        if not long_enough.any():
            self.text = self.first
            return
        least = anchors(texts.buf, length)
        low, high = texts.start[long_enough], texts.stop[long_enough] - length + 1
        delta = np.zeros(n + 1, np.int8)
        delta[low] += 1
        delta[high] -= 1
        at = np.flatnonzero(np.cumsum(delta[:-1], dtype=np.int8))
        anchor = least[at]
        new = np.ones(len(at), bool)
        new[1:] = anchor[1:] != anchor[:-1]
        head = np.flatnonzero(new)
        self.first = at[head]
        self.last = at[np.append(head[1:], len(at)) - 1]
        self.anchor = anchor[head].astype(np.int64)
        self.hash = gram_hash(*grams_at(texts.buf, self.anchor))
        self.text = np.searchsorted(texts.start, self.first, side="right") - 1

    def copies(self, texts: Texts, length: int) -> np.ndarray:
        """For each stretch, the first stretch with the same bytes."""
        return first_alike(texts.buf, self.first, self.last + length)


def suffix_order(buf: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """Places in the order of the ``length`` bytes from there on: one radix pass for every two bytes."""
    pairs = buf.astype(np.uint16) << 8
    pairs[:-1] |= buf[1:]
    order = np.arange(len(places))
    for j in range((length - 1) // 2 * 2, -1, -2):
        key = pairs[places[order] + j]
        if j + 1 == length:
            key = key >> 8
        order = order[np.argsort(key, kind="stable")]
    return order


def previous_smaller(ids: np.ndarray, stretch: np.ndarray) -> np.ndarray:
    """Nearest earlier position of the same stretch with a smaller id, or -1.

    Positions jump over larger ones together, so chains shorten by doubling.
    """
    before = np.arange(len(ids)) - 1
    before[1:][stretch[1:] != stretch[:-1]] = -1
    open_ = np.flatnonzero(before >= 0)
    open_ = open_[ids[before[open_]] >= ids[open_]]
    while len(open_):
        before[open_] = before[before[open_]]
        open_ = open_[before[open_] >= 0]
        open_ = open_[ids[before[open_]] >= ids[open_]]
    return before


def common_prefix(eight: np.ndarray, one: np.ndarray, two: np.ndarray, length: int) -> np.ndarray:
    """How many of ``length`` bytes from each pair of places on are equal; ``eight`` is ``words8`` of the bytes."""
    out = np.zeros(len(one), np.int64)
    open_ = np.arange(len(one))
    for j in range(0, length, 8):
        differ = eight[one[open_] + j] ^ eight[two[open_] + j]
        lowest = differ & (~differ + U64(1))
        out[open_] += np.bitwise_count(lowest - U64(1)) // 8  # all eight where nothing differs
        open_ = open_[differ == 0]
    return np.minimum(out, length)


def previous_factors(buf: np.ndarray, places: np.ndarray, ids: np.ndarray, length: int) -> np.ndarray:
    """The longest previous factor of each place: the bytes, at most ``length``, it shares with a place of a smaller id.

    In suffix order the nearest places of smaller ids, one on each side, share most.
    """
    order = suffix_order(buf, places, length)
    ranked, own = places[order], ids[order]
    eight = words8(buf)
    whole = np.zeros(len(own), np.int8)
    above = previous_smaller(own, whole)
    below = len(own) - 1 - previous_smaller(own[::-1], whole)[::-1]
    factor = np.zeros(len(own), np.int64)
    for near, held in ((above, above >= 0), (below, below < len(own))):
        at = np.flatnonzero(held)
        factor[at] = np.maximum(factor[at], common_prefix(eight, ranked[at], ranked[near[at]], length))
    out = np.zeros(len(places), np.int64)
    out[order] = factor
    return out


def repeated_starts(body: np.ndarray, size: np.ndarray, anchor: np.ndarray, ids: np.ndarray, length: int) -> np.ndarray:
    """For the strings of each stretch in ``body``, one after the other: does an earlier document have it?

    A stretch whose bytes an earlier document has goes whole. Of equal ones the earliest is
    left, and its strings can occur only in stretches around the same gram: the places
    of those that are not alone with theirs are put in suffix order.
    """
    begin = np.append(0, np.cumsum(size))[:-1]
    count = size - length + 1
    alike = first_alike(body, begin, begin + size)
    least = np.full(len(ids), np.iinfo(np.int64).max)
    np.minimum.at(least, alike, ids)
    later = ids > least[alike]
    head = alike == np.arange(len(alike))
    gram = gram_hash(*grams_at(body, begin + anchor))
    _, name, shared = np.unique(gram[head], return_inverse=True, return_counts=True)
    ranked = np.flatnonzero(head)[shared[name] > 1]
    first = np.append(0, np.cumsum(count))
    gone = np.repeat(later, count)
    width = count[ranked]
    step = np.arange(width.sum()) - np.repeat(np.append(0, np.cumsum(width))[:-1], width)
    factors = previous_factors(body, step + np.repeat(begin[ranked], width), np.repeat(least[ranked], width), length)
    known = np.zeros(first[-1], bool)
    known[step + np.repeat(first[ranked], width)] = factors >= length
    earliest = np.flatnonzero(~later)
    width = count[earliest]
    step = np.arange(width.sum()) - np.repeat(np.append(0, np.cumsum(width))[:-1], width)
    gone[step + np.repeat(first[earliest], width)] = known[step + np.repeat(first[alike[earliest]], width)]
    return gone


def suffix_dedup(
    docs: DataFrame, length: int = 50, as_text: bool = False, id_col: str = "doc_id", text_col: str = "text", passing: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, n_bytes, n_removed, the kept bytes and the removed byte spans of every document.

    ``as_text`` fills kept_text instead of kept: the kept bytes as text, without characters
    that a cut has left incomplete. ``passing`` columns go along unchanged.
    """
    if length < GRAM + 8:
        raise ValueError(f"length must be at least {GRAM + 8}")
    n = parts.part_count(docs, text_col)
    parted = parts.parted(docs, n, id_col, text_col, passing)

    def ask(table: pa.Table) -> pa.Table:
        part = parts.part_id(table)
        found = Stretches(Texts(parts.in_order(table).column("text")), length)
        return parts.votes(found.hash, np.ones(len(found.hash), bool), n, part)

    def send(table: pa.Table, replies: pa.Table) -> pa.Table:
        """Stretches whose anchor occurs elsewhere go to the anchor's key, each distinct one once."""
        if not len(table) or not len(replies):
            return parts.rows_by_key(np.zeros(0, U64), 0, np.zeros(0, U64))
        part = parts.part_id(table)
        table = parts.in_order(table)
        texts = Texts(table.column("text"))
        found = Stretches(texts, length)
        live = member(parts.as_number(found.hash, n), parts.answered(replies))
        live &= found.copies(texts, length) == np.arange(len(live))
        which = np.flatnonzero(live)
        key = parts.second_key(found.hash[which], n)
        which = which[np.argsort(key, kind="stable")]
        key = np.sort(key)
        size = found.last[which] + length - found.first[which]
        shape = size * length + found.anchor[which] - found.first[which]
        body, offset = gather(texts.buf, found.first, found.last + length - found.first, which)
        ids = table.column("doc_id").to_numpy()[found.text[which]]
        used, edges = parts.key_edges(key)
        cut = [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return pa.table(
            {
                "key": pa.array(used, pa.int32()),
                "part": pa.array(np.full(len(used), part), pa.int32()),
                "data": pa.array([body[offset[s.start] : offset[s.stop]].tobytes() for s in cut], pa.binary()),
                "extra": pa.array([planes(ids[s]) + planes(found.first[which[s]]) + planes(shape[s]) for s in cut], pa.binary()),
            }
        )

    def match(table: pa.Table) -> pa.Table:
        """For one key: the strings of each part that an earlier document has, as runs of starts."""
        heads = [np.frombuffer(x, np.uint8) for x in table.column("extra").to_pylist()]
        heads = [[from_planes(p, np.int64) for p in np.split(x, 3)] for x in heads]
        ids, first, shape = (np.concatenate([h[i] for h in heads]) for i in range(3))
        size, anchor = np.divmod(shape, length)
        body = np.frombuffer(b"".join(table.column("data").to_pylist()), np.uint8)
        count = size - length + 1
        begin = np.append(0, np.cumsum(count))
        step = np.arange(begin[-1]) - np.repeat(begin[:-1], count)
        gone = repeated_starts(body, size, anchor, ids, length)
        home = step + np.repeat(first, count)
        row = np.repeat(np.arange(len(heads)), [len(h[0]) for h in heads])
        row = np.repeat(row, count)
        at = np.flatnonzero(gone)
        new = np.ones(len(at), bool)
        new[1:] = (home[at[1:]] != home[at[:-1]] + 1) | (row[at[1:]] != row[at[:-1]])
        head = np.flatnonzero(new)
        widths = np.diff(np.append(head, len(at)))
        starts, owner = home[at[head]], row[at[head]]
        edges = np.searchsorted(owner, np.arange(len(heads) + 1))
        cut = [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        out = pa.table(
            {
                "part": table.column("part"),
                "key": table.column("key"),
                "data": pa.array([planes(starts[s]) for s in cut], pa.binary()),
                "extra": pa.array([planes(widths[s]) for s in cut], pa.binary()),
            }
        )
        return out.filter(pa.array([s.stop > s.start for s in cut]))

    def remove(table: pa.Table, replies: pa.Table) -> pa.Table:
        table = parts.in_order(table)
        texts = Texts(table.column("text"))
        ids = table.column("doc_id").to_numpy()
        found = Stretches(texts, length)
        gone = np.zeros(len(texts.buf), bool)  # string starts
        if len(replies):
            starts = np.concatenate([from_planes(x, np.int64) for x in replies.column("data").to_pylist()])
            widths = np.concatenate([from_planes(x, np.int64) for x in replies.column("extra").to_pylist()])
            gone |= covered(starts, widths, len(gone))
        head = found.copies(texts, length)
        count = found.last - found.first + 1
        other = ids[found.text] != ids[found.text[head]] if len(head) else head.astype(bool)
        gone |= covered(found.first[other], count[other], len(gone))
        same = np.flatnonzero(~other & (head != np.arange(len(head))))
        step = np.arange(count[same].sum()) - np.repeat(np.append(0, np.cumsum(count[same]))[:-1], count[same])
        gone[step + np.repeat(found.first[same], count[same])] |= gone[step + np.repeat(found.first[head[same]], count[same])]
        removed = covered(np.flatnonzero(gone), length, len(gone))
        begin, end = runs(removed)
        cuts = texts.start[(texts.start > 0) & (texts.start < texts.stop)]
        cuts = cuts[removed[cuts] & removed[cuts - 1]]
        begin, end = np.sort(np.append(begin, cuts)), np.sort(np.append(end, cuts))
        owner = np.searchsorted(texts.start, begin, side="right") - 1
        sums = np.append(0, np.cumsum(removed))
        n_removed = sums[texts.stop] - sums[texts.start]
        size = texts.stop - texts.start
        offsets = np.append(0, np.cumsum(size - n_removed)).astype(np.int32)
        kept = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(texts.buf[~removed].tobytes())])
        nothing = pa.nulls(len(texts), pa.binary())
        whole = pa.array([x.decode("utf-8", "ignore") for x in kept.to_pylist()] if as_text else [None] * len(texts), pa.string())
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "n_bytes": pa.array(size, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "kept": nothing if as_text else kept,
                "kept_text": whole,
                "spans": spans_array(begin - texts.start[owner], end - texts.start[owner], owner, len(texts)),
            }
            | {c: table.column(c) for c in passing}
        )

    result = T.StructType(T.StructType.fromDDL(RESULT).fields + [parted.schema[c] for c in passing])
    live = parted.groupBy("part").applyInArrow(ask, parts.ENTRIES).groupBy("key").applyInArrow(parts.count_votes, parts.REPLIES)
    sent = parted.groupBy("part").cogroup(live.groupBy("part")).applyInArrow(send, parts.ENTRIES)
    matched = sent.groupBy("key").applyInArrow(match, parts.REPLIES)
    found = parted.groupBy("part").cogroup(matched.groupBy("part")).applyInArrow(remove, result)
    loose = parts.without_id(docs, id_col, text_col, passing).select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"),
        (F.lit(None) if as_text else F.coalesce("text", F.lit(""))).cast("binary").alias("kept"),
        (F.coalesce("text", F.lit("")) if as_text else F.lit(None)).cast("string").alias("kept_text"),
        F.array().cast(SPANS).alias("spans"),
        *passing,
    )
    return found.unionByName(loose)
