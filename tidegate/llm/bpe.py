"""Byte-level BPE by a tokenization automaton.

The merges are compiled one by one with the merge gadget. The automaton starts with one
state and an arc for each byte; the merge of u and v splits the state that u leads to,
takes the arc v from the copy that u now leads to, and adds an arc for the new token
from every state that has an arc u, to where v leads. All arcs of one token lead to the
same state, so a state is named by the token before it, and each gadget adds exactly one
version of a state: the version before it, less one arc. ``Automaton`` keeps these
versions as tables (the merge that made a token; the arc each merge took away) instead
of copying every arc. A token sequence is a path of the automaton exactly when it is
what applying the merges in order gives, so encoding a piece means finding the one path
that spells it: place by place, over all pieces of a batch at once, the arcs of a prefix
tree are tried and those the state lacks are dropped. Decoding emits the arcs' labels.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.pretokens import piece_starts
from tidegate.llm.textkit import Texts, gather, grouped, same_spans, span_hash

ENDLESS = np.int64(1) << 40
#: Text of one step of a task, in bytes, and pieces remembered by a worker.
STEP_BYTES = 2 << 20
KNOWN_PIECES = 1 << 20


def byte_letters() -> dict[str, int]:
    """Which byte each letter of a byte-level vocabulary file stands for: printable ones themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """What a vocabulary file says, small enough to go with a task.

    Tokens are numbered 0-255 for bytes, then one for each merge; ``ids`` are the file's.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        letters = byte_letters()
        vocab, merges = whole["model"]["vocab"], whole["model"]["merges"]
        number = {letter: byte for letter, byte in letters.items()}
        self.left, self.right = np.zeros((2, len(merges)), np.int32)
        for k, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in merges):
            self.left[k], self.right[k] = number[a], number[b]
            if a + b in number:
                raise ValueError(f"two merges make {a + b!r}")
            number[a + b] = 256 + k
        self.ids = np.zeros(len(number), np.int32)
        for token, at in number.items():
            self.ids[at] = vocab[token]
        self.special = {t["content"].encode(): t["id"] for t in whole.get("added_tokens", [])}
        self.key = hashlib.sha256(self.left.tobytes() + self.right.tobytes() + self.ids.tobytes()).hexdigest()


    def labels(self) -> list[bytes]:
        """The bytes of each token, by its number."""
        out = [bytes([b]) for b in range(256)]
        for a, b in zip(self.left.tolist(), self.right.tolist(), strict=True):
            out.append(out[a] + out[b])
        return out


class Table:
    """Numbers by 64-bit keys: open hash tables, each later one for what collides in those before."""

    BITS = 18

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.slots = []
        factor = 0x9E3779B97F4A7C15
        while len(keys):
            slot = self._slot(keys, factor)
            _, first = np.unique(slot, return_index=True)
            held, value = np.full(1 << self.BITS, np.uint64(0xFFFFFFFFFFFFFFFF)), np.zeros(1 << self.BITS, np.int32)
            held[slot[first]], value[slot[first]] = keys[first], values[first]
            self.slots.append((factor, held, value))
            keys, values = np.delete(keys, first), np.delete(values, first)
            factor = (factor * 0xD1342543DE82EF95 + 2) & ((1 << 64) - 1) | 1

    def _slot(self, keys: np.ndarray, factor: int) -> np.ndarray:
        return ((keys * np.uint64(factor)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def get(self, keys: np.ndarray, otherwise: int) -> np.ndarray:
        out = np.full(len(keys), otherwise, np.int64)
        for factor, held, value in self.slots:
            slot = self._slot(keys, factor)
            hit = held[slot] == keys
            out[hit] = value[slot[hit]]
        return out


class Labels:
    """The arcs' labels by file id."""

    def __init__(self, vocabulary: Vocabulary):
        by_id = dict(zip(vocabulary.ids.tolist(), vocabulary.labels(), strict=True)) | {i: text for text, i in vocabulary.special.items()}
        ordered = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.size = np.array([len(x) for x in ordered], np.int64)
        self.start = np.append(0, np.cumsum(self.size))[:-1]
        self.bytes = np.frombuffer(b"".join(ordered), np.uint8)

    def decode(self, ids: np.ndarray, offset: np.ndarray) -> list[str]:
        body, ends = gather(self.bytes, self.start, self.size, ids)
        raw, ends = body.tobytes(), ends[offset].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]


class PieceMemory:
    """Encodes texts piece by piece and remembers the pieces and their ids; ``encode_pieces`` is a subclass's."""

    special: dict[bytes, int]

    def encode_pieces(self, buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of pieces that lie end to end in ``buf``: flat file ids and the number of each piece."""
        raise NotImplementedError

    def forget(self) -> None:
        """Drop the remembered pieces."""
        self.known = np.zeros(0, np.uint64)
        self.known_at = np.zeros(0, np.int64)
        self.came_back = np.zeros(0, bool)
        self.pool = np.zeros(0, np.int32)
        self.pool_start = np.zeros(0, np.int64)
        self.pool_len = np.zeros(0, np.int64)
        self.text = np.zeros(0, np.uint8)
        self.text_start = np.zeros(0, np.int64)
        self.text_len = np.zeros(0, np.int64)

    def _tidy(self) -> None:
        """Keep the pieces that came back since the last time, or none if these are too many."""
        keep = np.flatnonzero(self.came_back)
        if 2 * len(keep) > KNOWN_PIECES:
            self.forget()
            return
        at = self.known_at[keep]
        self.pool, offset = gather(self.pool, self.pool_start, self.pool_len, at)
        self.text, text_offset = gather(self.text, self.text_start, self.text_len, at)
        self.pool_start, self.pool_len = offset[:-1], self.pool_len[at]
        self.text_start, self.text_len = text_offset[:-1], self.text_len[at]
        self.known, self.known_at, self.came_back = self.known[keep], np.arange(len(keep)), np.zeros(len(keep), bool)

    def _pooled(self, texts: Texts, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Encode pieces; their places in the pool."""
        body, offset = gather(texts.buf, begin, size, np.arange(len(begin)))
        ids, counts = self.encode_pieces(body, offset[:-1], size)
        base = len(self.pool_len)
        self.pool_start = np.append(self.pool_start, len(self.pool) + np.append(0, np.cumsum(counts))[:-1])
        self.pool_len = np.append(self.pool_len, counts)
        self.pool = np.append(self.pool, ids)
        self.text_start = np.append(self.text_start, len(self.text) + offset[:-1])
        self.text_len = np.append(self.text_len, size)
        self.text = np.append(self.text, body)
        return base + np.arange(len(begin))

    def _found(self, texts: Texts, hashes: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The place in the pool of each piece; hashes are distinct. What a hash finds counts if its bytes are the piece's."""
        rank = np.argsort(hashes, kind="stable") if (hashes[1:] < hashes[:-1]).any() else np.arange(len(hashes))
        ranked = hashes[rank]
        at = np.searchsorted(self.known, ranked)
        missing = np.append(self.known, np.uint64(0))[at] != ranked
        missing |= at == len(self.known)
        out = np.empty(len(hashes), np.int64)
        held, slot = rank[~missing], at[~missing]
        out[held] = self.known_at[slot]
        self.came_back[slot] = True
        like = same_spans(texts.buf, begin[held], size[held], self.text, self.text_start[out[held]], self.text_len[out[held]])
        other = held[~like]
        if len(other):
            out[other] = self._pooled(texts, begin[other], size[other])
        lack = rank[missing]
        if len(lack):
            out[lack] = self._pooled(texts, begin[lack], size[lack])
            self.known = np.insert(self.known, at[missing], hashes[lack])
            self.known_at = np.insert(self.known_at, at[missing], out[lack])
            self.came_back = np.insert(self.came_back, at[missing], False)
        return out

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """File ids of all texts end to end, and where each text's ids begin (one more than texts)."""
        cut, special = self._cut_specials(texts)
        begin = piece_starts(cut)
        stops = np.unique(cut.stop)
        end = np.minimum(np.append(begin[1:], len(cut.buf)), stops[np.searchsorted(stops, begin, side="right")]) if len(begin) else begin
        hashes = span_hash(cut.buf, begin, end)
        order, new = grouped(hashes)
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        one = order[np.flatnonzero(new)]
        if len(self.known) > KNOWN_PIECES:
            self._tidy()
        size = end - begin
        which = self._found(cut, hashes[one], begin[one], size[one])[group]
        first = one[group]
        odd = np.flatnonzero(~same_spans(cut.buf, begin, size, cut.buf, begin[first], size[first]))
        if len(odd):  # different pieces that share a hash
            which[odd] = self._pooled(cut, begin[odd], size[odd])
        ids, offset = gather(self.pool, self.pool_start, self.pool_len, which)
        first = offset[np.searchsorted(begin, texts.start)] if not special else None
        if special:
            return self._with_specials(texts, cut, special, begin, ids, offset)
        return ids, np.append(first, len(ids))

    def _cut_specials(self, texts: Texts) -> tuple[Texts, list[tuple[int, int, int]]]:
        """Texts cut at special tokens, which are no text; and each one's place, end and id."""
        raw = texts.buf.tobytes()
        hits = []
        for label, number in self.special.items():
            at = raw.find(label)
            while at >= 0:
                owner = int(np.searchsorted(texts.start, at, side="right")) - 1
                if at + len(label) <= texts.stop[owner]:
                    hits.append((at, at + len(label), number))
                    at = raw.find(label, at + len(label))
                else:
                    at = raw.find(label, at + 1)
        if not hits:
            return texts, []
        hits.sort()
        cut = Texts.__new__(Texts)
        cut.buf = texts.buf
        edges = np.unique(np.concatenate((texts.start, texts.stop, [x for h in hits for x in h[:2]])))
        cut.start, cut.stop = edges[:-1], edges[1:]
        return cut, hits

    def _with_specials(self, texts, cut, special, begin, ids, offset) -> tuple[np.ndarray, np.ndarray]:
        """Replace what a special token's own text gave by its id."""
        inside = np.zeros(len(ids), bool)
        put = ids.copy()
        for low, high, number in special:
            a, b = offset[np.searchsorted(begin, low)], offset[np.searchsorted(begin, high)]
            inside[a + 1 : b] = True
            put[a] = number
        keep = np.append(0, np.cumsum(~inside))
        first = offset[np.searchsorted(begin, texts.start)]
        return put[~inside], np.append(keep[first], keep[-1])


class Automaton(PieceMemory):
    def __init__(self, vocabulary: Vocabulary):
        self.left = np.concatenate((np.arange(256, dtype=np.int32), vocabulary.left))
        self.right = np.concatenate((np.arange(256, dtype=np.int32), vocabulary.right))
        n = len(self.left)
        # when a token came to be, in merges; bytes are there from the start
        self.time = np.concatenate((np.full(256, -1, np.int64), np.arange(n - 256)))
        # arc b that the state after a lost to a merge
        pairs = (vocabulary.left.astype(np.uint64) << np.uint64(32)) | vocabulary.right.astype(np.uint64)
        self.merges = Table(pairs, np.arange(len(pairs), dtype=np.int32))
        made = np.arange(256, n)
        self.alive = np.ones(n, bool)
        self.alive[256:] = self.has_arc(self.left[made].astype(np.int64), self.right[made].astype(np.int64), made - 256)
        for k in range(256, n):  # a merge whose halves never meet, or never come to be, makes no arc
            self.alive[k] &= self.alive[self.left[k]] and self.alive[self.right[k]]
        labels = vocabulary.labels()
        self._tree(labels)
        self.ids = vocabulary.ids
        self.special = vocabulary.special
        self.size = np.array([len(x) for x in labels], np.int64)
        self.forget()

    def lost(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The merge of a and b, or a number beyond all merges."""
        return self.merges.get((a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64), int(ENDLESS))

    def _tree(self, labels: list[bytes]) -> None:
        child: list[dict[int, int]] = [{}]
        token = [-1]
        for number, label in enumerate(labels):
            node = 0
            for byte in label:
                following = child[node].get(byte)
                if following is None:
                    following = child[node][byte] = len(child)
                    child.append({})
                    token.append(-1)
                node = following
            token[node] = number if self.alive[number] else -1
        arcs = [(node << 8 | byte, to) for node, each in enumerate(child) for byte, to in each.items()]
        self.child = Table(np.array([k for k, _ in arcs], np.uint64), np.array([to for _, to in arcs], np.int32))
        self.token = np.array(token, np.int32)

    def has_arc(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether the state after token a has an arc b (``before`` a merge, if given).

        Before a came to be, its state was that of its right half; before b came to be,
        its arc stood where its left half's arc stood. Going back in time, the arc is
        missing if a merge of the two took it while both were as they are.
        """
        out = np.ones(len(a), bool)
        at = np.arange(len(a))
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), ENDLESS) if before is None else before
        while len(at):
            gone = self.lost(a, b) < limit
            out[at[gone]] = False
            go = ~gone & ((a >= 256) | (b >= 256))
            at, a, b = at[go], a[go], b[go]
            younger = self.time[a] > self.time[b]
            # a merge of a token with itself takes the arc before it hands it on to the new one
            limit = np.where(younger, self.time[a], self.time[b] + 1)
            a, b = np.where(younger, self.right[a], a), np.where(younger, b, self.left[b])
        return out

    def encode_pieces(self, buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of pieces that lie end to end in ``buf``: flat file ids and the number of each piece."""
        begin = np.repeat(start, size)
        end = np.repeat(start + size, size)
        place, depth = np.arange(len(buf)), 0
        node = np.zeros(len(buf), np.int64)
        arcs = []
        while len(place):
            node = self.child.get((node.astype(np.uint64) << np.uint64(8)) | buf[place + depth], 0)
            token = self.token[node]
            is_token = token >= 0
            depth += 1
            arcs.append((place[is_token], np.full(is_token.sum(), depth), token[is_token]))
            more = (node > 0) & (place + depth < end[place])
            place, node = place[more], node[more]
        origin, width, token = (np.concatenate(x) for x in zip(*arcs, strict=True)) if arcs else (place, place, place)
        reach = origin + width - begin[origin]
        order = np.argsort(reach, kind="stable")
        origin, width, token, reach = origin[order], width[order], token[order], reach[order]
        last = np.full(len(buf), -1, np.int64)  # the token that ends at each place
        edges = np.searchsorted(reach, np.arange(1, (int(reach[-1]) if len(reach) else 0) + 2))
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            o, w, t = origin[low:high], width[low:high], token[low:high]
            whole = o == begin[o]
            last[(o + w - 1)[whole]] = t[whole]
            inner = np.flatnonzero(~whole)
            fits = inner[self.has_arc(last[o[inner] - 1], t[inner].astype(np.int64))]
            last[o[fits] + w[fits] - 1] = t[fits]
        # walk each path back from its end
        at = start + size - 1
        piece = np.flatnonzero(size > 0)
        at = at[piece]
        back = []
        while len(piece):
            token = last[at]
            back.append((piece, token))
            at = at - self.size[token]
            more = at >= start[piece]
            piece, at = piece[more], at[more]
        piece = np.concatenate([p for p, _ in reversed(back)]) if back else np.zeros(0, np.int64)
        token = np.concatenate([t for _, t in reversed(back)]) if back else np.zeros(0, np.int64)
        order = np.argsort(piece, kind="stable")
        return self.ids[token[order]], np.bincount(piece, minlength=len(size))


_BUILT: dict[tuple[type, str], Automaton | Labels] = {}


def built(kind: type, vocabulary: Vocabulary):
    """The automaton or the labels of a vocabulary, made once by each worker."""
    if (kind, vocabulary.key) not in _BUILT:
        for old in [k for k in _BUILT if k[0] is kind]:
            del _BUILT[old]
        _BUILT[kind, vocabulary.key] = kind(vocabulary)
    return _BUILT[kind, vocabulary.key]


def steps(batch: pa.RecordBatch, column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in slices of bounded text (a longer text is a slice of its own)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        base = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def _id_lists(ids: np.ndarray, offset: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offset.astype(np.int32)), pa.array(ids, pa.int32()))


def encode_documents(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and its token ids, as the vocabulary's library gives them without added special tokens.

    The text of a special token counts as that token. A null or empty text has no ids.
    Rows are independent: repeated rows and rows without an id are encoded like others.
    """
    vocabulary = Vocabulary(vocabulary_path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = built(Automaton, vocabulary)
        for batch in batches:
            for part in steps(batch, "text"):
                ids, offset = machine.encode(Texts(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), _id_lists(ids, offset)], names=["doc_id", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(encode, "doc_id bigint, ids array<int>")


def decode_documents(encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """The rows with their ids and the text that these spell; bytes that are no UTF-8 become U+FFFD."""
    vocabulary = Vocabulary(vocabulary_path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = built(Labels, vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                lists = part.column("ids")
                lists = pc.fill_null(lists, pa.scalar([], lists.type)) if lists.null_count else lists
                offset = np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))).astype(np.int64)
                texts = labels.decode(lists.flatten().to_numpy(zero_copy_only=False), offset)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists, pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id bigint, ids array<int>, decoded string")


def round_trip(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids and decoded in one pass: what ``encode_documents`` gives, and what decoding those ids gives."""
    vocabulary = Vocabulary(vocabulary_path)

    def there_and_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, labels = built(Automaton, vocabulary), built(Labels, vocabulary)
        for batch in batches:
            for part in steps(batch, "text"):
                ids, offset = machine.encode(Texts(part.column("text")))
                texts = labels.decode(ids, offset)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), _id_lists(ids, offset), pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(there_and_back, "doc_id bigint, ids array<int>, decoded string")
