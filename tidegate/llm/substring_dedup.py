"""Substring dedup with fixed-block anchors.

Every document's non-overlapping blocks of ``block`` words are the index; every rolling
window of ``block`` words is a probe. A repeat of ``window`` words always covers a whole
block of its earlier copy, so only places around a probe that hits a block of another
place can repeat. There the hits are extended: windows of ``window`` words around a hit
are compared over all documents, the first occurrence (by id, then place) stays, and
the runs of the others are the maximal repeats that go.

Blocks are matched on 32-bit tags within a key (a false hit only costs work); windows on
two 64-bit hashes that are chained over words, each hashed anew for either.

Defined results: a null text has no words. A row without an id is returned whole and
compared with nothing. Rows that share an id are one document given again: a place is
never earlier than the same place of the same id. Ties go to the smaller id, then the
earlier place. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm import parts
from tidegate.llm.textkit import (
    SPANS,
    U64,
    Texts,
    Words,
    covered,
    from_planes,
    grouped,
    heads,
    member,
    member_twice,
    planes,
    runs,
    span_hash,
    spans_array,
    window_hash,
)

RESULT = f"doc_id bigint, n_words bigint, n_removed bigint, kept_text string, spans {SPANS}"


#: The two hashes of a window.
PAIR = np.dtype([("one", "<u8"), ("two", "<u8")])


def _hashed(table: pa.Table) -> tuple[pa.Table, Texts, Words, np.ndarray]:
    table = parts.in_order(table)
    texts = Texts(table.column("text"))
    words = Words(texts)
    return table, texts, words, span_hash(texts.buf, words.begin, words.end)


def _alike(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(head, odd): the first window with the same first hash, and the windows whose second one is not its."""
    head = heads(*grouped(one))
    return head, two != two[head]


def _windows(words: Words, hashes: np.ndarray, width: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of each window that lies in one text."""
    values = window_hash(hashes, width, seed)
    place = np.flatnonzero(words.window_ok(width))
    return place, values[place]


def kept_texts(texts: Texts, words: Words, removed: np.ndarray) -> pa.Array:
    """The words that stay of each text, joined by one space."""
    kept = np.flatnonzero(~removed)
    owner = words.text[kept]
    is_last = np.ones(len(kept), bool)
    is_last[:-1] = owner[1:] != owner[:-1]
    begin, stop = words.begin[kept], words.end[kept] + ~is_last
    delta = np.zeros(len(texts.buf) + 1, np.int8)
    delta[begin] += 1
    delta[stop] -= 1
    mask = np.cumsum(delta[:-1], dtype=np.int8) > 0
    buf = texts.buf.copy()
    buf[words.end[kept[~is_last]]] = 0x20
    sizes = np.bincount(owner, weights=stop - begin, minlength=len(texts)).astype(np.int64)
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(offsets), pa.py_buffer(buf[mask].tobytes()))


def substring_dedup(
    docs: DataFrame, window: int = 20, block: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text and the removed spans (word places) of every document."""
    block = block or (window + 1) // 2
    if 2 * block - 1 > window:
        raise ValueError("a repeat must be sure to cover a whole block: 2 * block - 1 <= window")
    n = parts.part_count(docs, text_col)
    parted = parts.parted(docs, n, id_col, text_col)

    def blocks_and_probes(table: pa.Table) -> pa.Table:
        part = parts.part_id(table)
        table, _, words, hashes = _hashed(table)
        place, values = _windows(words, hashes, block, 1)
        return parts.votes(values, words.position()[place] % block == 0, n, part)

    def extend(table: pa.Table, replies: pa.Table) -> pa.Table:
        """The first place of each distinct window around a hit goes to the window's key, with its document."""
        if not len(table) or not len(replies):
            return parts.rows_by_key(np.zeros(0, U64), 0, np.zeros(0, U64))
        part = parts.part_id(table)
        table, texts, words, hashes = _hashed(table)
        place, values = _windows(words, hashes, block, 1)
        hit = np.zeros(len(words) + window + 1, np.int64)
        hit[place + 1] = member(parts.as_number(values, n), parts.answered(replies))
        hits = np.cumsum(hit)
        place, one = _windows(words, hashes, window, 2)
        near = hits[place + window - block + 1] > hits[place]
        place, one = place[near], one[near]
        two = _windows(words, span_hash(texts.buf, words.begin, words.end, 1), window, 3)[1][near]
        head, odd = _alike(one, two)
        first = np.flatnonzero(odd | (head == np.arange(len(head))))
        ids = table.column("doc_id").to_numpy()[words.text[place[first]]]
        values = np.empty(len(first), PAIR)
        values["one"], values["two"] = one[first], two[first]
        key = parts.second_key(values["one"], n)
        by_key = np.argsort(key, kind="stable")
        return parts.rows_by_key(key[by_key], part, values[by_key], ids[by_key])

    def first_places(table: pa.Table) -> pa.Table:
        """For one key: tell each part which of its windows occur in a document with a smaller id elsewhere."""
        values = [from_planes(x, PAIR) for x in table.column("data").to_pylist()]
        ids = np.concatenate([from_planes(x, np.int64) for x in table.column("extra").to_pylist()])
        joined = np.concatenate(values)
        order = np.lexsort((ids, joined["two"], joined["one"]))
        ranked = joined[order]
        later = np.zeros(len(joined), bool)
        later[order[1:]] = ranked[1:] == ranked[:-1]
        edges = np.append(0, np.cumsum([len(x) for x in values]))
        data = [planes(v[later[a:b]]) for v, a, b in zip(values, edges[:-1], edges[1:], strict=True)]
        out = pa.table(
            {
                "part": table.column("part"),
                "key": table.column("key"),
                "data": pa.array(data, pa.binary()),
                "extra": pa.array([b""] * len(data), pa.binary()),
            }
        )
        return out.filter(pa.array([len(x) > 0 for x in data]))

    def remove(table: pa.Table, replies: pa.Table) -> pa.Table:
        table, texts, words, hashes = _hashed(table)
        ids = table.column("doc_id").to_numpy()
        place, one = _windows(words, hashes, window, 2)
        two = _windows(words, span_hash(texts.buf, words.begin, words.end, 1), window, 3)[1]
        head, odd = _alike(one, two)
        # again in this part, unless it is the same place of a row given twice
        position = words.position()[place]
        owner = ids[words.text[place]]
        again = ~odd & ((owner != owner[head]) | (position != position[head]))
        held = [from_planes(x, PAIR) for x in replies.column("data").to_pylist()] if len(replies) else []
        held = np.concatenate([*held, np.zeros(0, PAIR)])
        again |= member_twice(one, two, held["one"], held["two"])
        removed = covered(place[again], window, len(words))
        begin, end = runs_in_texts(removed, words)
        base = words.first[words.text[begin]] if len(begin) else begin
        counts = np.bincount(words.text[removed], minlength=len(texts))
        return pa.table(
            {
                "doc_id": table.column("doc_id"),
                "n_words": pa.array(words.count, pa.int64()),
                "n_removed": pa.array(counts, pa.int64()),
                "kept_text": kept_texts(texts, words, removed),
                "spans": spans_array(begin - base, end - base, words.text[begin] if len(begin) else begin, len(texts)),
            }
        )

    asked = parted.groupBy("part").applyInArrow(blocks_and_probes, parts.ENTRIES)
    live = asked.groupBy("key").applyInArrow(parts.count_votes, parts.REPLIES)
    around = parted.groupBy("part").cogroup(live.groupBy("part")).applyInArrow(extend, parts.ENTRIES)
    later = around.groupBy("key").applyInArrow(first_places, parts.REPLIES)
    # parts without text answer to no one, so a left side without rows cannot occur here
    found = parted.groupBy("part").cogroup(later.groupBy("part")).applyInArrow(remove, RESULT)
    loose = parts.without_id(docs, id_col, text_col).select(
        "doc_id",
        F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "[ \\t-\\r]+"), lambda w: w != "")).cast("long").alias("n_words"),
        F.lit(0).cast("long").alias("n_removed"),
        F.array_join(F.filter(F.split(F.coalesce("text", F.lit("")), "[ \\t-\\r]+"), lambda w: w != ""), " ").alias("kept_text"),
        F.array().cast(SPANS).alias("spans"),
    )
    return found.unionByName(loose)


def runs_in_texts(removed: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of removed words, none of which crosses a text's end."""
    begin, end = runs(removed)
    if not len(begin):
        return begin, end
    cuts = words.first[(words.first > 0) & (words.first < len(removed)) & (words.count > 0)]
    cuts = cuts[removed[cuts] & removed[cuts - 1]]
    return np.sort(np.append(begin, cuts)), np.sort(np.append(end, cuts))
