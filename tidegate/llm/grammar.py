"""Token ids as binary files, compressed by a Re-Pair grammar.

Texts are encoded by the tokenizer library and closed with an end id. The ids lie in
shards, in ascending order of the documents' ids. In each shard frequent pairs of
neighbouring ids are replaced by nonterminals, in rounds: a round counts all pairs,
makes a rule of each of the most frequent ones and replaces their places at once (where
places overlap, the more frequent pair wins, then the left one). Rounds go on until one
would save less than four thousandths of the symbols. No pair crosses a document's end,
so a document is a whole number of symbols.

A shard's row holds the rules, the number of ids that each nonterminal expands to, the
symbols, and each document's id, symbols and ids. A document, or any range of a shard's
ids, is decoded from its own symbols alone: their expansion lengths say where it lies.

Shards are cut by the order of ids alone; one takes a bounded amount of text, or one
longer document. Ids are written as planes of bytes of little-endian 32- and 64-bit
numbers.

Defined results: a null or empty text is its end id alone. Rows without an id come
first. Rows that share an id stand in an order that follows from their texts. An empty table gives no
files to read and no rows. Other columns are not read.
"""

from __future__ import annotations

import json
import math
import os
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.llm.bpe import PieceMemory, byte_letters, steps
from tidegate.llm.textkit import U64, Texts, from_planes, gather, planes

END_ID = 2
SHARD_BYTES = 8 << 20
#: Rules of a round, places that a pair must have, and the share of the symbols that a further round must save.
RULES, PLACES, SHARE = 1 << 14, 4, 0.004
#: Pieces that the library gets as one string.
SIDE_BY_SIDE = 32
_SLOTS = 18
_NO_PAIR = U64(0xFFFFFFFFFFFFFFFF)
#: The first bytes of characters of which none is white space.
_NO_SPACE = np.zeros(256, bool)
_NO_SPACE[0x21:0x7F] = _NO_SPACE[0xC3:0xE1] = _NO_SPACE[0xE4:0xF5] = True
#: The bit of a symbol that closes a document.
_CLOSES = np.uint32(1 << 31)
FILE = (
    "shard int, part int, n_tokens bigint, base int, rounds binary, left binary, right binary, lengths binary, "
    "symbols binary, doc_ids binary, has_id binary, doc_symbols binary, doc_tokens binary"
)


class LibraryPieces(PieceMemory):
    """Pieces encoded by the tokenizer library."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        parsed = json.loads(vocabulary)
        self.special = {t["content"].encode(): t["id"] for t in parsed.get("added_tokens", [])}
        vocab, blank = parsed["model"]["vocab"], next(x for x, b in byte_letters().items() if b == 0x20)
        self.blank_led = np.zeros(1 + max([0, *vocab.values(), *self.special.values()]), bool)
        self.blank_led[[i for token, i in vocab.items() if token[:1] == blank]] = True
        # side by side, pieces must not spell a special token, and each must show its blank
        self.side_by_side = SIDE_BY_SIDE if blank in vocab and not any(b" " in x for x in self.special) else 1
        self.forget()

    def encode_pieces(self, buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of pieces that lie end to end in ``buf``: flat file ids and the number of each piece.

        A piece and those after it whose one blank leads a character that is no white space go to
        the library as one string: it cuts before each such blank, as in any text, and an id that
        begins with a blank is the first of its piece.
        """
        n = len(size)
        blanks = np.append(0, np.cumsum(buf == 0x20))
        after = np.append(buf, np.zeros(2, np.uint8))
        joins = (size > 1) & (after[start] == 0x20) & _NO_SPACE[after[start + 1]] & (blanks[start + size] - blanks[start] == 1)
        joins[:1] = False
        place = np.arange(n)
        heads = np.flatnonzero((place - np.maximum.accumulate(np.where(joins, 0, place))) % self.side_by_side == 0)
        edges = np.append(start[heads], len(buf)).astype(np.int64)
        strings = pa.LargeStringArray.from_buffers(len(heads), pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(buf)))
        try:
            texts = strings.to_pylist()
        except UnicodeDecodeError:  # a text that was not UTF-8 to begin with
            texts = [x.decode("utf-8", "replace") for x in strings.cast(pa.large_binary()).to_pylist()]
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.int32, int(counts.sum()))
        if len(heads) == n:
            return ids, counts
        # the last blanks of a string are those of its joined pieces, what comes before is the first one's
        blanks = np.append(0, np.cumsum(self.blank_led[ids]))
        joined = np.diff(np.append(heads, n)) - 1
        piece = blanks[1:] - np.repeat(blanks[np.cumsum(counts)] - joined, counts)
        return ids, np.bincount(np.repeat(heads, counts) + np.maximum(piece, 0), minlength=n)


_LIBRARY: dict[int, LibraryPieces] = {}


def library(vocabulary: str) -> LibraryPieces:
    """The library's tokenizer, made once by each worker."""
    if hash(vocabulary) not in _LIBRARY:
        _LIBRARY.clear()
        _LIBRARY[hash(vocabulary)] = LibraryPieces(vocabulary)
    return _LIBRARY[hash(vocabulary)]


@dataclass
class Grammar:
    """Symbols below ``base`` are ids; symbol base + k expands to left[k] and right[k]. ``rounds`` counts each round's rules."""

    base: int
    rounds: np.ndarray
    left: np.ndarray
    right: np.ndarray
    symbols: np.ndarray

    def expansions(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All symbols' ids end to end, where each symbol's begin, and how many there are."""
        pool = np.arange(self.base, dtype=np.int32)
        start, size = np.arange(self.base), np.ones(self.base, np.int64)
        at = 0
        for n in self.rounds.tolist():
            pair = np.stack((self.left[at : at + n], self.right[at : at + n]), axis=1).ravel()
            body, offset = gather(pool, start, size, pair)
            start = np.append(start, len(pool) + offset[:-1:2])
            size = np.append(size, offset[2::2] - offset[:-2:2])
            pool = np.append(pool, body)
            at += n
        return pool, start, size

    def decode(self, first: int = 0, stop: int | None = None) -> np.ndarray:
        """The ids of a range of symbols."""
        pool, start, size = self.expansions()
        return gather(pool, start, size, self.symbols[first:stop])[0]

    def decode_range(self, first: int, n: int) -> np.ndarray:
        """Ids first .. first + n, from the symbols that hold them."""
        size = np.concatenate((np.ones(self.base, np.int64), self.lengths()))[self.symbols]
        ends = np.cumsum(size)
        a = int(np.searchsorted(ends, first, side="right"))
        b = int(np.searchsorted(ends, first + n, side="left")) + 1
        skip = first - (int(ends[a - 1]) if a else 0)
        return self.decode(a, b)[skip : skip + n]

    def lengths(self) -> np.ndarray:
        return self.expansions()[2][self.base :]


def _slot(pairs: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    out = np.multiply(pairs, U64(0x9E3779B97F4A7C15), out=out)
    out >>= U64(64 - _SLOTS)
    return out.view(np.int64)


def _frequent(counted: np.ndarray, rules: int, places: int) -> np.ndarray:
    """The most frequent pairs with ``places`` at least, most frequent first; ``counted`` is sorted."""
    counted = counted[: np.searchsorted(counted, _NO_PAIR)]
    n = len(counted) - places + 1
    if n < 1:
        return counted[:0].copy()
    change = np.ones(len(counted) + 1, bool)
    np.not_equal(counted[1:], counted[:-1], out=change[1:-1])
    many = counted[places - 1 :] == counted[:n]
    head = np.flatnonzero(many & change[:n])
    count = np.flatnonzero(many & change[places:]) - head  # less places, alike for all
    return counted[head[np.argsort(-count, kind="stable")[:rules]]]


_BEYOND = np.int32(1 << 30)


def _chosen_places(rank: np.ndarray) -> np.ndarray:
    """The places of frequent pairs that are taken: none overlap, and lower ranks, then left ones, go first.

    ``rank`` has each place's pair's rank, or ``_BEYOND``, and one more ``_BEYOND`` at either end.
    """
    here, before, after = rank[1:-1], rank[:-2], rank[2:]
    take = (here < before) & (here <= after)
    again = np.flatnonzero((here == before) & (here < _BEYOND))
    if len(again):  # runs of one pair, as in a a a, take every other place, whatever precedes them
        begins = again[np.diff(again, prepend=-1) > 1]
        step = again - begins[np.searchsorted(begins, again, side="right") - 1] + 1
        free = take[begins - 1][np.searchsorted(begins, again, side="right") - 1]
        take[again] = (step % 2 == 0) & (here[again] <= after[again]) & free
    return np.flatnonzero(take)


def re_pair(ids: np.ndarray, closes: np.ndarray, base: int, share: float = SHARE, rules: int = RULES, places: int = PLACES) -> tuple[Grammar, np.ndarray]:
    """The grammar of a sequence whose documents end where ``closes``; and where its symbols close one.

    Rounds go on until one makes the grammar shorter by less than ``share`` of the symbols.
    """
    symbols = np.ascontiguousarray(ids).astype(np.uint32)
    symbols[closes] |= _CLOSES
    left, right, sizes = [], [], []
    made = base
    whole, spare = np.empty((2, len(symbols)), "<u8")  # of all rounds
    while len(symbols) > 1:
        # a symbol and the one after it as one number; none at a document's end
        pairs, counted = whole[: len(symbols) - 1], spare[: len(symbols) - 1]
        np.bitwise_and(np.ndarray(pairs.shape, "<u8", symbols, strides=(4,)), _NO_PAIR >> U64(1), out=pairs)
        pairs[symbols[:-1] >= _CLOSES] = _NO_PAIR
        counted[:] = pairs
        counted.sort()
        chosen = _frequent(counted, rules, places)
        # a small hash table from pair to rank; of pairs that share a slot the most frequent is first, the others' turn comes
        rank = np.full(1 << _SLOTS, -1, np.int32)
        rank[_slot(chosen)[::-1]] = np.arange(len(chosen), dtype=np.int32)[::-1]
        found = rank.take(_slot(pairs, spare[: len(pairs)]))
        hit = np.flatnonzero(found >= 0)
        found = found[hit]
        same = chosen.take(found) == pairs[hit]
        hit, found = hit[same], found[same]
        ranks = np.full(len(symbols) + 1, _BEYOND)
        ranks[1 + hit] = found
        at = _chosen_places(ranks)
        ranks = ranks[1 + at]
        uses = np.bincount(ranks, minlength=len(chosen))
        pays = uses >= 3  # a rule has two symbols itself
        saved = int((uses[pays] - 2).sum())
        if saved <= share * len(symbols):
            break
        number = np.cumsum(pays) - 1
        at, ranks = at[pays[ranks]], ranks[pays[ranks]]
        used = chosen[pays]
        left.append((used & U64(0xFFFFFFFF)).astype(np.int32))
        right.append((used >> U64(32)).astype(np.int32))
        symbols[at] = (made + number[ranks]).astype(np.uint32) | (symbols[at + 1] & _CLOSES)
        sizes.append(len(used))
        made += len(used)
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols = symbols.take(np.flatnonzero(keep))  # several times faster than by the mask
    joined = [np.concatenate(x) if x else np.zeros(0, np.int32) for x in (left, right)]
    return Grammar(base, np.array(sizes, np.int32), *joined, (symbols & ~_CLOSES).astype(np.int32)), symbols >= _CLOSES


def _row(shard: int, part: int, base: int, doc_ids: list[int | None], ids: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    closes = np.zeros(len(ids), bool)
    closes[np.cumsum(counts) - 1] = True
    grammar, ends = re_pair(ids, closes, base)
    per_doc = np.diff(np.append(-1, np.flatnonzero(ends)))
    known = np.array([i is not None for i in doc_ids], np.uint8)
    fields = {
        "rounds": grammar.rounds,
        "left": grammar.left,
        "right": grammar.right,
        "lengths": grammar.lengths(),
        "symbols": grammar.symbols,
        "doc_ids": np.array([i or 0 for i in doc_ids], np.int64),
        "has_id": known,
        "doc_symbols": per_doc,
        "doc_tokens": counts,
    }
    arrays = [pa.array([shard], pa.int32()), pa.array([part], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([base], pa.int32())]
    arrays += [pa.array([planes(np.ascontiguousarray(x))], pa.binary()) for x in fields.values()]
    return pa.RecordBatch.from_arrays(arrays, names=["shard", "part", "n_tokens", "base", *fields])


def write_tokens(docs: DataFrame, vocabulary_path: str, path: str, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode all documents and write their shards."""
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = file.read()
    parsed = json.loads(vocabulary)
    base = 1 + max(end_id, *parsed["model"]["vocab"].values(), *(t["id"] for t in parsed.get("added_tokens", [])))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    # rows of one id are dealt over shards by their texts' hashes
    order = ("doc_id", F.xxhash64("text"))
    ordered = rows.repartitionByRange(max(1, math.ceil(size / shard_bytes)), *order).sortWithinPartitions(*order, "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = library(vocabulary)
        shard, part = TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        ids: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        text = 0
        for batch in batches:
            for step in steps(batch, "text"):
                texts = Texts(step.column("text"))
                found, offset = pieces.encode(texts)
                ids.append(np.insert(found, offset[1:], np.int32(end_id)))
                counts.append(np.diff(offset) + 1)
                doc_ids += step.column("doc_id").to_pylist()
                text += len(texts.buf)
                if text >= 2 * shard_bytes:  # a range with more than its share
                    yield _row(shard, part, base, doc_ids, np.concatenate(ids), np.concatenate(counts))
                    doc_ids, ids, counts, text, part = [], [], [], 0, part + 1
        if doc_ids:
            yield _row(shard, part, base, doc_ids, np.concatenate(ids), np.concatenate(counts))

    ordered.mapInArrow(encode, FILE).write.parquet(path)


def grammar_of(row: dict) -> Grammar:
    return Grammar(row["base"], *(from_planes(row[k], np.int32) for k in ("rounds", "left", "right", "symbols")))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and the ids as little-endian 32-bit numbers."""
    files = spark.read.schema(FILE).parquet(path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = grammar_of(row).decode().astype("<u4")
                tokens = from_planes(row["doc_tokens"], np.int64)
                known = from_planes(row["has_id"], np.uint8) > 0
                doc_ids = from_planes(row["doc_ids"], np.int64)
                ends = np.append(0, np.cumsum(tokens))
                for a in range(0, len(tokens), 1000):
                    own = ends[a : a + 1001]
                    n = len(own) - 1
                    held = pa.py_buffer(ids[own[0] : own[-1]])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(doc_ids[a : a + n], mask=~known[a : a + n]),
                            pa.array([row["shard"]] * n, pa.int32()),
                            pa.array([row["part"]] * n, pa.int32()),
                            pa.array(own[:-1]),
                            pa.array(tokens[a : a + n]),
                            pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.array(4 * (own - own[0]), pa.int32()).buffers()[1], held]),
                        ],
                        names=["doc_id", "shard", "part", "place", "n_tokens", "ids"],
                    )

    return files.mapInArrow(decode, "doc_id bigint, shard int, part int, place bigint, n_tokens bigint, ids binary")


def shard_starts(spark: SparkSession, path: str, chunk: int = 1 << 12) -> DataFrame:
    """(shard, part, before): the ids of all shards before each; sums of chunks of shards first, then inside each chunk."""
    heads = spark.read.schema(FILE).parquet(path).select("shard", "part", "n_tokens", (F.col("shard") / chunk).cast("int").alias("chunk"))
    whole = heads.groupBy("chunk").agg(F.sum("n_tokens").alias("held"))
    chunks = whole.select("chunk", (F.sum("held").over(Window.orderBy("chunk")) - F.col("held")).alias("earlier"))
    own = Window.partitionBy("chunk").orderBy("shard", "part")
    inside = heads.join(chunks, "chunk").withColumn("inside", F.sum("n_tokens").over(own) - F.col("n_tokens"))
    return inside.select("shard", "part", (F.col("earlier") + F.col("inside")).cast("long").alias("before"))
