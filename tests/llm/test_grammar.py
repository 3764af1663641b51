import json
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidegate.llm import grammar as op
from tidegate.llm.queries import QUERIES, VOCABULARY
from tidegate.llm.tables import documents


def expand(grammar, symbol):
    if symbol < grammar.base:
        return [symbol]
    k = symbol - grammar.base
    return expand(grammar, int(grammar.left[k])) + expand(grammar, int(grammar.right[k]))


@pytest.mark.parametrize("seed", range(8))
def test_round_trip_and_random_access(seed):
    rng = random.Random(seed)
    docs = [[rng.randrange(rng.choice([2, 5, 40])) for _ in range(rng.randint(0, 60))] + [2] for _ in range(rng.randint(1, 30))]
    docs += [[1] * 50 + [2], [1, 2] * 30 + [2], [2]]
    ids = np.array([i for d in docs for i in d], np.int32)
    closes = np.zeros(len(ids), bool)
    closes[np.cumsum([len(d) for d in docs]) - 1] = True
    grammar, ends = op.re_pair(ids, closes, base=50, share=0, places=2)
    assert grammar.decode().tolist() == ids.tolist()
    assert len(grammar.symbols) < len(ids) and ends.sum() == len(docs)
    assert grammar.lengths().tolist() == [len(expand(grammar, 50 + k)) for k in range(len(grammar.left))]
    cuts = np.append(0, np.flatnonzero(ends) + 1)
    for d, a, b in zip(docs, cuts[:-1], cuts[1:]):
        assert grammar.decode(a, b).tolist() == d == [i for s in grammar.symbols[a:b].tolist() for i in expand(grammar, s)]
    for _ in range(50):
        a = rng.randrange(len(ids))
        n = rng.randint(0, len(ids) - a)
        assert grammar.decode_range(a, n).tolist() == ids[a : a + n].tolist()


def test_the_most_frequent_pair_goes_first():
    ids = np.array([1, 2, 1, 2, 1, 2, 3, 1, 4], np.int32)
    closes = np.zeros(9, bool)
    closes[-1] = True
    grammar, _ = op.re_pair(ids, closes, base=10, rules=1, places=2)
    assert (grammar.left.tolist(), grammar.right.tolist(), grammar.symbols.tolist()) == ([1], [2], [10, 10, 10, 3, 1, 4])
    one, none = np.array([7], np.int32), np.zeros(0, np.int32)
    assert op.re_pair(one, np.ones(1, bool), 10)[0].decode().tolist() == [7]
    assert op.re_pair(none, np.zeros(0, bool), 10)[0].decode().tolist() == []


def brute_rounds(docs, base, rules, places):
    """Round by round on lists, until no rule pays."""
    docs = [list(d) for d in docs]
    made = base
    while True:
        pairs = Counter(p for d in docs for p in zip(d, d[1:]))
        size = max([n for n in pairs.values()], default=0)
        if size < places:
            return docs, made
        chosen = {p: k for k, (p, n) in enumerate(sorted((x for x in pairs.items() if x[1] >= places), key=lambda x: (-x[1], x[0][1], x[0][0]))[:rules])}
        taken = []
        for d in docs:
            rank = [chosen.get(p, 1 << 30) for p in zip(d, d[1:])]
            got = []
            for i, r in enumerate(rank):
                if r == 1 << 30:
                    continue
                before, after = rank[i - 1] if i else 1 << 30, rank[i + 1] if i + 1 < len(rank) else 1 << 30
                if r < before and r <= after or r == before == rank[i - 2] and r <= after and i - 2 in got:
                    got.append(i)
            taken.append(got)
        uses = Counter(d[i : i + 2][0] * 10**6 + d[i + 1] for d, got in zip(docs, taken) for i in got)
        number = {}
        for (a, b), _ in sorted(chosen.items(), key=lambda x: x[1]):
            if uses[a * 10**6 + b] >= 3:
                number[a, b] = made + len(number)
        if not number:
            return docs, made
        for d, got in zip(docs, taken):
            for i in reversed(got):
                if (d[i], d[i + 1]) in number:
                    d[i : i + 2] = [number[d[i], d[i + 1]]]
        made += len(number)


@pytest.mark.parametrize("seed", range(6))
def test_rounds_equal_brute_force(seed, monkeypatch):
    monkeypatch.setattr(op, "_SLOTS", 22)  # no two pairs share a slot, so none waits for the next round
    rng = random.Random(seed)
    docs = [[rng.randrange(rng.choice([2, 3, 8])) for _ in range(rng.randint(0, 80))] + [9] for _ in range(25)] + [[1] * 41 + [9], [0, 0, 1] * 20 + [9]]
    ids = np.array([i for d in docs for i in d], np.int32)
    closes = np.zeros(len(ids), bool)
    closes[np.cumsum([len(d) for d in docs]) - 1] = True
    grammar, ends = op.re_pair(ids, closes, base=10, share=0, places=3)
    want, made = brute_rounds(docs, 10, op.RULES, 3)
    assert grammar.symbols.tolist() == [x for d in want for x in d]
    assert 10 + len(grammar.left) == made and np.flatnonzero(ends).tolist() == (np.cumsum([len(d) for d in want]) - 1).tolist()


def test_a_long_repeat_is_stored_once():
    rng = random.Random(1)
    passage = [rng.randrange(3, 5000) for _ in range(900)]
    ids = np.array((passage + [2]) * 64, np.int32)
    closes = ids == 2
    grammar, _ = op.re_pair(ids, closes, base=5000)
    assert grammar.decode().tolist() == ids.tolist()
    assert len(grammar.symbols) + 2 * len(grammar.left) < 3 * 900 + 64 * 12


def joined(pieces):
    size = np.array([len(x.encode()) for x in pieces], np.int64)
    return np.frombuffer("".join(pieces).encode(), np.uint8), np.cumsum(size) - size, size


class Recorder:
    """A tokenizer that keeps what it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, []

    def encode_batch_fast(self, texts, **how):
        self.given += texts
        return self.tokenizer.encode_batch_fast(texts, **how)


def test_pieces_go_to_the_library_side_by_side():
    rng = random.Random(6)
    with open(VOCABULARY, encoding="utf-8") as file:
        vocabulary = file.read()
    library = Tokenizer.from_str(vocabulary)
    odd = ["a", "Zoé", "漢", " 漢", " é", " 12", "'s", "'", " '", "!!", " !", "\u3000", " \u3000", " \xa0", "\x1d", " \x1d", "\x85", "\n", " ", "   ", "\n ", " \U0001f600", " \u0378", "a  "]
    words = [" " + "".join(rng.choice("abcdefghé") for _ in range(rng.randint(1, 9))) for _ in range(2000)]
    for pieces in (words, [*words[:300], *odd * 30], odd, words[:1], []):
        pieces = rng.sample(pieces, len(pieces))
        memory = op.LibraryPieces(vocabulary)
        memory.tokenizer = Recorder(memory.tokenizer)
        ids, counts = memory.encode_pieces(*joined(pieces))
        want = [library.encode(x, add_special_tokens=False).ids for x in pieces]
        assert (ids.tolist(), counts.tolist()) == ([i for x in want for i in x], [len(x) for x in want])
        if len(pieces) == 2000:
            assert len(memory.tokenizer.given) < 100


def test_pieces_that_would_spell_a_special_token_stay_apart():
    with open(VOCABULARY, encoding="utf-8") as file:
        parsed = json.load(file)
    parsed["added_tokens"].append(parsed["added_tokens"][0] | {"id": 50257, "content": "end of text"})
    memory = op.LibraryPieces(json.dumps(parsed))
    library = Tokenizer.from_file(VOCABULARY)
    want = [library.encode(x, add_special_tokens=False).ids for x in ("end", " of", " text")]
    ids, counts = memory.encode_pieces(*joined(["end", " of", " text"]))
    assert (ids.tolist(), counts.tolist()) == ([i for x in want for i in x], [len(x) for x in want])


def expected(texts):
    library = Tokenizer.from_file(VOCABULARY)
    start, out = 0, []
    for doc_id, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_equal_the_library(spark, tmp_path, monkeypatch):
    rng = random.Random(4)
    words = ["the ", "of", "\n", " é", "ñandú ", "12", "!! ", "<|endoftext|>", "漢字"]
    rows = [(i * 3 - 50, "".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(200)]
    rows += [(None, "no id"), (None, None), (1000, None), (1001, ""), (1002, "again"), (1002, "again"), (1002, "other"), (1003, "x" * 40000)]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "doc_id bigint, text string, start int").repartition(5)
    path = str(tmp_path / "files")
    op.write_tokens(frame, VOCABULARY, path, shard_bytes=4000)
    assert spark.read.parquet(path).count() > 4
    found = op.read_tokens(spark, path).join(op.shard_starts(spark, path), ["shard", "part"])
    got = found.select("doc_id", F.col("before") + F.col("place"), "n_tokens", F.crc32("ids")).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected(order)


def test_query_equals_the_library(spark):
    folder = "/root/testdata/sf0.001"
    texts = sorted((r.doc_id, r.text) for r in documents(spark, folder).collect())
    rows = QUERIES["op5_grammar_tokens"](spark, folder).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows) == expected(texts)


def test_empty_table(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    op.write_tokens(empty, VOCABULARY, str(tmp_path / "none"))
    assert op.read_tokens(spark, str(tmp_path / "none")).collect() == []
