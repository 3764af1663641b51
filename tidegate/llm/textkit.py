"""Text columns as numpy arrays: word spans, hashes and windows over one Arrow batch.

Everything works on the UTF-8 bytes of a batch at once. A null text counts as empty.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = bytes([0x20, *range(0x09, 0x0E)])
U64 = np.uint64
_MUL = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def separators(kind: str) -> np.ndarray:
    """Which bytes end a word: ``space`` splits at ASCII white space, ``plain`` keeps digits, a-z and non-ASCII."""
    table = np.zeros(256, bool)
    if kind == "space":
        table[list(SPACES)] = True
    else:
        table[0x00:0x30] = table[0x3A:0x61] = table[0x7B:0x80] = True
    return table


IS_SPACE = separators("space")
IS_BREAK = separators("plain")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Texts:
    """The texts of one batch as one byte buffer; text i is buf[start[i]:stop[i]]."""

    def __init__(self, column: pa.ChunkedArray | pa.Array, lower: bool = False):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        column = pc.fill_null(column.cast(pa.large_binary()), b"")
        _, offsets, data = column.buffers()
        bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        first = int(bounds[0]) if len(bounds) else 0
        self.buf = raw[first : int(bounds[-1])] if len(bounds) else raw[:0]
        if lower:
            self.buf = LOWER[self.buf]
        self.start = bounds[:-1] - first
        self.stop = bounds[1:] - first

    def __len__(self) -> int:
        return len(self.start)


class Words:
    """Words of a batch: byte spans, the text each belongs to, and each text's first word."""

    def __init__(self, texts: Texts, breaks: np.ndarray = IS_SPACE):
        word = ~breaks[texts.buf]
        full = texts.stop > texts.start
        before = np.empty_like(word)
        after = np.empty_like(word)
        if len(word):
            before[0], before[1:] = False, word[:-1]
            after[-1], after[:-1] = False, word[1:]
            before[texts.start[full]] = False
            after[texts.stop[full] - 1] = False
        self.begin = np.flatnonzero(word & ~before)
        self.end = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.begin, texts.start)
        self.last = np.searchsorted(self.begin, texts.stop)
        self.count = self.last - self.first
        self.text = np.repeat(np.arange(len(texts)), self.count)

    def __len__(self) -> int:
        return len(self.begin)

    def position(self) -> np.ndarray:
        return np.arange(len(self)) - self.first[self.text]

    def window_ok(self, width: int) -> np.ndarray:
        """Whether a window of ``width`` words starting here ends inside its text."""
        return np.arange(len(self)) + width <= self.last[self.text]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the splitmix64 finaliser)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


#: Bytes of pieces that are copied at a time.
BLOCK = 1 << 18
#: Spans of more bytes are hashed one by one with BLAKE2.
LONG = 1024
_ODD = U64(0xD6E8FEB86659FD93)
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)


def eight_from(buf: np.ndarray) -> np.ndarray:
    """A view of the 8 bytes from each place on as one number; beyond the end are zeros."""
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[: len(buf)] = buf
    return np.ndarray((len(buf) + 1,), "<u8", padded, strides=(1,))


def span_hash(buf: np.ndarray, begin: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each byte span: its length, then its 8-byte words, scrambled after each."""
    size = end - begin
    out = mix(size.astype(U64) + U64((seed + 1) * _MUL & _MASK))
    eight = eight_from(buf)
    short = size <= LONG
    at, done = np.flatnonzero(short & (size > 0)), 0
    if len(at) == len(size):
        out = mix(out * _ODD + (eight[begin] & _LOW_BYTES[np.minimum(size, 8)]))
        at, done = np.flatnonzero(size > 8), 8
    while len(at):
        word = eight[begin[at] + done] & _LOW_BYTES[np.minimum(size[at] - done, 8)]
        out[at] = mix(out[at] * _ODD + word)
        done += 8
        at = at[size[at] > done]
    for i in np.flatnonzero(~short).tolist():
        body = hashlib.blake2b(buf[begin[i] : end[i]].tobytes(), digest_size=8, key=b"%d" % seed).digest()
        out[i] = int.from_bytes(body, "little")
    return out


def same_spans(buf: np.ndarray, begin: np.ndarray, size: np.ndarray, other: np.ndarray, other_begin: np.ndarray, other_size: np.ndarray) -> np.ndarray:
    """Whether each span of ``buf`` has the bytes of the span of ``other`` beside it."""
    eight = eight_from(buf)
    other_eight = eight if other is buf else eight_from(other)
    out = ((eight[begin] ^ other_eight[other_begin]) & _LOW_BYTES[np.minimum(size, 8)]) == 0
    out &= size == other_size
    at, done = np.flatnonzero(out & (size > 8) & (size <= LONG)), 8
    while len(at):
        left = _LOW_BYTES[np.minimum(size[at] - done, 8)]
        like = (eight[begin[at] + done] ^ other_eight[other_begin[at] + done]) & left == 0
        out[at[~like]] = False
        done += 8
        at = at[like & (size[at] > done)]
    for i in np.flatnonzero(out & (size > LONG)).tolist():
        out[i] = np.array_equal(buf[begin[i] : begin[i] + size[i]], other[other_begin[i] : other_begin[i] + size[i]])
    return out


def window_hash(items: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """Hash of every ``width`` consecutive items; entry i is of items[i:i+width]. Shorter by width - 1.

    Runs of 1, 2, 4, .. items are joined two by two and scrambled after each join.
    """
    n = len(items) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    run, length = mix(items + U64(seed * _MUL & _MASK)), 1
    out, held = None, 0
    while True:
        if width & length:
            out, held = (run, length) if out is None else (mix(out[: len(run) - held] * _ODD + run[held:]), held + length)
        if 2 * length > width:
            return out[:n]
        run, length = mix(run[:-length] * _ODD + run[length:]), 2 * length


def grouped(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): indices sorted by hash then index, and where a new hash begins in that order."""
    n = len(hashes)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    bits = max(1, int(n - 1).bit_length())
    low = U64((1 << bits) - 1)
    keys = (hashes & ~low) | np.arange(n, dtype=U64)
    keys.sort()  # sorting packed keys is several times faster than argsort
    order = (keys & low).astype(np.int64)
    ranked = hashes[order]
    new = np.ones(n, bool)
    new[1:] = ranked[1:] != ranked[:-1]
    same_top = (ranked[1:] & ~low) == (ranked[:-1] & ~low)
    if (same_top & new[1:]).any():  # different hashes that share the packed bits may interleave
        order = np.argsort(hashes, kind="stable")
        ranked = hashes[order]
        new[1:] = ranked[1:] != ranked[:-1]
    return order, new


def heads(order: np.ndarray, new: np.ndarray) -> np.ndarray:
    """The first of each one's group, from ``grouped``."""
    out = np.empty(len(order), np.int64)
    if len(order):
        out[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    return out


def first_alike(buf: np.ndarray, begin: np.ndarray, end: np.ndarray, owner: np.ndarray | None = None) -> np.ndarray:
    """For each span the first one with the same bytes (and owner). Hashes group them, bytes decide."""
    owner = np.zeros(len(begin), np.int64) if owner is None else owner
    size = end - begin
    head = heads(*grouped(mix(span_hash(buf, begin, end) ^ mix(owner.astype(U64) + U64(1)))))
    like = same_spans(buf, begin, size, buf, begin[head], size[head]) & (owner == owner[head])
    if not like.all():  # different spans that share a hash
        first: dict[tuple[int, bytes], int] = {}
        for i in np.flatnonzero(np.isin(head, head[~like])).tolist():
            head[i] = first.setdefault((int(owner[i]), buf[begin[i] : end[i]].tobytes()), i)
    return head


def member(needles: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Whether each 64-bit needle is in ``held`` (sorted)."""
    out = np.zeros(len(needles), bool)
    if len(held) == 0 or len(needles) == 0:
        return out
    seen = np.zeros(1 << 22, bool)
    shift = U64(42)
    seen[(mix(held.copy()) >> shift).astype(np.int64)] = True
    maybe = np.flatnonzero(seen[(mix(needles.copy()) >> shift).astype(np.int64)])
    at = np.searchsorted(held, needles[maybe])
    at[at == len(held)] = 0
    out[maybe] = held[at] == needles[maybe]
    return out


def member_twice(one: np.ndarray, two: np.ndarray, held_one: np.ndarray, held_two: np.ndarray) -> np.ndarray:
    """Whether each pair of 64-bit numbers is among the held pairs."""
    order = np.lexsort((held_two, held_one))
    held_one, held_two = held_one[order], held_two[order]
    out = np.zeros(len(one), bool)
    open_ = np.flatnonzero(member(one, held_one))
    at = np.searchsorted(held_one, one[open_])
    while len(open_):
        out[open_] = held_two[at] == two[open_]
        at = at + 1
        more = ~out[open_] & (at < len(held_one))
        open_, at = open_[more], at[more]
        more = held_one[at] == one[open_]
        open_, at = open_[more], at[more]
    return out


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each maximal run of True."""
    edge = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def covered(starts: np.ndarray, widths: np.ndarray | int, n: int) -> np.ndarray:
    """Which of n positions lie in a span [start, start + width)."""
    delta = np.zeros(n + 1, np.int32)
    np.add.at(delta, starts, 1)
    np.add.at(delta, starts + widths, -1)
    return np.cumsum(delta[:-1]) > 0


def planes(values: np.ndarray) -> bytes:
    """Numbers as byte planes: like bytes lie together, which the shuffle's codec compresses."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.dtype.itemsize).T).tobytes()


def from_planes(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    raw = np.frombuffer(data, np.uint8).reshape(size, -1)
    return np.ascontiguousarray(raw.T).reshape(-1).view(dtype)


def gather(pieces: np.ndarray, piece_start: np.ndarray, piece_len: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate pieces of a table; returns the items and each piece's offset (one more than pieces)."""
    lens = piece_len[which]
    offsets = np.zeros(len(which) + 1, np.int64)
    np.cumsum(lens, out=offsets[1:])
    out = np.empty(int(offsets[-1]), pieces.dtype)
    at = 0
    while at < len(which):
        low = int(offsets[at])
        to = max(at + 1, int(np.searchsorted(offsets, low + BLOCK, side="right")) - 1)
        high = int(offsets[to])
        index = np.arange(low, high)
        index += np.repeat(piece_start[which[at:to]] - offsets[at:to], lens[at:to])
        out[low:high] = pieces[index]
        at = to
    return out, offsets


def spans_array(begin: np.ndarray, end: np.ndarray, owner: np.ndarray, n: int) -> pa.Array:
    """Spans as one list of (start, stop) per owner 0..n-1; spans are in order of their owner."""
    offsets = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    pairs = pa.StructArray.from_arrays([pa.array(begin, pa.int64()), pa.array(end, pa.int64())], names=["start", "stop"])
    return pa.ListArray.from_arrays(pa.array(offsets), pairs)


SPANS = "array<struct<start:bigint,stop:bigint>>"
