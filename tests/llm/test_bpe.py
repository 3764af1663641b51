import random

import numpy as np
import pyarrow as pa
import pytest
import regex
from tokenizers import Tokenizer

from tests.llm.odd_texts import thue_morse
from tidegate.llm import bpe
from tidegate.llm.bpe import Automaton, Vocabulary, decode_documents, encode_documents, round_trip
from tidegate.llm.pretokens import piece_starts
from tidegate.llm.queries import VOCABULARY
from tidegate.llm.tables import documents
from tidegate.llm.textkit import Texts

PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def odd_texts(n, seed=3):
    rng = random.Random(seed)
    atoms = ["'s", "'ll", "'", "''", "s", "tt", " ", "  ", "\n", "\n\n", "\t", "a", "The", "hello", "é", "ñandú", "12", "٣", "!", "?!", " ", "　", "漢字", "🙂", "<|endoftext|>", "<|end", "'re", "'RE", "\x85", "x'm", "­"]
    texts = ["".join(rng.choice(atoms) for _ in range(rng.randint(0, 25))) for _ in range(n)]
    return texts + ["", "a" * 3000, "ab" * 500, "!" * 700, " " * 300, "\n" * 99 + "x", "the" * 400, "'" * 50, "<|endoftext|>" * 3]


def test_pieces_match_the_pattern():
    texts = [t for t in odd_texts(3000) if "<|" not in t]
    starts = piece_starts(Texts(pa.array(texts))).tolist()
    want, at = [], 0
    for t in texts:
        want += [at + len(t[: m.start()].encode()) for m in PATTERN.finditer(t)]
        at += len(t.encode())
    assert starts == want


def test_equals_the_library(spark, library):
    texts = odd_texts(1500)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, None, None), (0, texts[0], "again")], "doc_id bigint, text string, ids string")
    rows = decode_documents(encode_documents(docs, VOCABULARY), VOCABULARY).collect()
    assert len(rows) == len(texts) + 2
    assert sorted(map(str, rows)) == sorted(map(str, round_trip(docs, VOCABULARY).collect()))
    for r in rows:
        text = "" if r.doc_id is None else texts[r.doc_id]
        want = library.encode(text, add_special_tokens=False).ids
        assert list(r.ids) == want, text
        assert r.decoded == library.decode(want, skip_special_tokens=False) == text


def test_equals_the_library_on_the_documents(spark, library):
    frame = documents(spark, "/root/testdata/sf0.001")
    texts = {r.doc_id: r.text for r in frame.collect()}
    rows = encode_documents(frame, VOCABULARY).collect()
    assert len(rows) == len(texts)
    assert all(list(r.ids) == library.encode(texts[r.doc_id], add_special_tokens=False).ids for r in rows)
    empty = frame.limit(0)
    assert decode_documents(encode_documents(empty, VOCABULARY), VOCABULARY).collect() == []


def test_broken_bytes_decode_like_the_library(spark, library):
    rng = random.Random(5)
    lists = [[rng.randrange(50257) for _ in range(rng.randint(0, 12))] for _ in range(400)]
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(lists)] + [(-1, None)], "doc_id bigint, ids array<int>")
    for r in decode_documents(frame, VOCABULARY).collect():
        want = "" if r.doc_id < 0 else library.decode(lists[r.doc_id], skip_special_tokens=False)
        assert r.decoded == want


class Small(Vocabulary):
    """A vocabulary made of random merges over three bytes."""

    def __init__(self, seed):
        rng = random.Random(seed)
        labels = {bytes([b]): b for b in range(256)}
        pairs = []
        pool = [97, 98, 99]
        names = {b: bytes([b]) for b in pool}
        while len(pairs) < 14:
            a, b = rng.choice(pool), rng.choice(pool)
            if names[a] + names[b] in labels:
                continue
            new = 256 + len(pairs)
            labels[names[a] + names[b]] = new
            names[new] = names[a] + names[b]
            pairs.append((a, b))
            pool.append(new)
        self.left, self.right = (np.array(x, np.int32) for x in zip(*pairs))
        self.ids = np.arange(256 + len(pairs), dtype=np.int32)
        self.special, self.key, self.pool = {}, str(seed), pool


def explicit_gadgets(vocabulary):
    """The automaton with every arc written out: states are dicts from token to state."""
    states = [{b: 0 for b in (97, 98, 99)}]
    for k, (u, v) in enumerate(zip(vocabulary.left.tolist(), vocabulary.right.tolist())):
        targets = {s[u] for s in states if u in s}
        split = {}
        for t in targets:
            if v in states[t]:
                states.append({x: y for x, y in states[t].items() if x != v})
                split[t] = len(states) - 1
        through = [(s, states[s[u]][v]) for s in states if u in s and s[u] in split]
        for s in states:
            if u in s and s[u] in split:
                s[u] = split[s[u]]
        for s, after in through:
            s[256 + k] = after
    return states


@pytest.mark.parametrize("seed", range(12))
def test_arcs_equal_the_explicit_construction(seed):
    vocabulary = Small(seed)
    machine = Automaton(vocabulary)
    states = explicit_gadgets(vocabulary)
    rng = random.Random(seed)
    for _ in range(300):
        path = [rng.choice(vocabulary.pool) for _ in range(rng.randint(1, 6))]
        at = 0
        for token in path:
            at = states[at].get(token) if at is not None else None
        pairs = np.array(path, np.int64)
        assert (at is not None) == bool(machine.has_arc(pairs[:-1], pairs[1:]).all() and machine.alive[pairs].all()), path


def test_vocabulary_counts():
    vocabulary = Vocabulary(VOCABULARY)
    assert len(vocabulary.left) == 50000 and len(set(vocabulary.ids.tolist())) == 50256
    assert Automaton(vocabulary).alive.all()


def test_pieces_that_weak_hashes_take_for_one(spark, library):
    texts = ["".join(x) for n in (1024, 2048) for x in thue_morse(n, "a", "b")]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    got = {r.doc_id: (list(r.ids), r.decoded) for r in round_trip(rows, VOCABULARY).collect()}
    assert got == {i: (library.encode(t, add_special_tokens=False).ids, t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("known", [1 << 20, 40, 0])
def test_bytes_decide_what_is_remembered(library, monkeypatch, known):
    monkeypatch.setattr(bpe, "span_hash", lambda buf, begin, end, seed=0: (end - begin).astype(np.uint64) % np.uint64(5))
    monkeypatch.setattr(bpe, "KNOWN_PIECES", known)
    machine = Automaton(Vocabulary(VOCABULARY))
    texts = odd_texts(300)
    for _ in range(2):
        for a in range(0, len(texts), 60):
            ids, offset = machine.encode(Texts(pa.array(texts[a : a + 60])))
            for text, low, high in zip(texts[a : a + 60], offset[:-1], offset[1:], strict=True):
                assert ids[low:high].tolist() == library.encode(text, add_special_tokens=False).ids


def test_pieces_that_come_back_are_kept(monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_PIECES", 50)
    machine = Automaton(Vocabulary(VOCABULARY))
    often, made = Texts(pa.array(["the same words again"])), []
    encode = machine.encode_pieces
    monkeypatch.setattr(machine, "encode_pieces", lambda buf, start, size: made.append(len(size)) or encode(buf, start, size))
    for k in range(30):
        machine.encode(Texts(pa.array([" ".join(f"{k}x{chr(97 + i)}" for i in range(20))])))
        made.clear()
        machine.encode(often)
        assert made == ([4] if k == 0 else [])
        assert len(machine.known) < 200
