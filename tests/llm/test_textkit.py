import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.odd_texts import thue_morse
from tidegate.llm import textkit
from tidegate.llm.textkit import Texts, first_alike, member_twice, same_spans, span_hash, window_hash


def spans(pieces):
    texts = Texts(pa.array(pieces))
    return texts.buf, texts.start, texts.stop


def test_equal_spans_hash_alike_wherever_they_lie():
    rng = random.Random(3)
    pieces = ["".join(rng.choice("ab") for _ in range(rng.choice([0, 1, 7, 8, 9, 16, 40, 1023, 1024, 1025, 3000]))) for _ in range(300)]
    pieces += pieces[::-1]
    found = {}
    for piece, value in zip(pieces, span_hash(*spans(pieces)).tolist(), strict=True):
        assert found.setdefault(piece, value) == value
    assert len(set(found.values())) == len(found)


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_thue_morse_sequences_differ(n):
    one, two = ("".join(x) for x in thue_morse(n, "a", "b"))
    for seed in (0, 1):
        a, b = span_hash(*spans([one, two]), seed)
        assert a != b
    items = [span_hash(*spans(x)) for x in thue_morse(n, "a", "b")]
    for width in (n, n - 1, 64):
        assert window_hash(items[0], width)[0] != window_hash(items[1], width)[0]


def test_windows_hash_alike_where_their_items_are_alike():
    rng = random.Random(5)
    items = np.array([rng.randrange(3) for _ in range(400)], np.uint64)
    for width in (1, 2, 3, 5, 10, 20, 31):
        values = window_hash(items, width)
        assert len(values) == len(items) - width + 1
        found = {}
        for i, value in enumerate(values.tolist()):
            assert found.setdefault(tuple(items[i : i + width].tolist()), value) == value
        assert len(set(found.values())) == len(found)
    assert len(window_hash(items[:4], 5)) == 0


def test_same_spans_compares_bytes():
    pieces = ["", "a", "b", "abcdefgh", "abcdefgi", "abcdefghi", "x" * 2000, "x" * 1999 + "y", "x" * 2000]
    buf, begin, end = spans(pieces)
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(pieces)), np.arange(len(pieces))))
    size = end - begin
    got = same_spans(buf, begin[a], size[a], buf, begin[b], size[b])
    assert got.tolist() == [pieces[i] == pieces[j] for i, j in zip(a, b, strict=True)]


@pytest.mark.parametrize("weak", [False, True])
def test_bytes_decide_even_if_all_hashes_are_alike(weak, monkeypatch):
    if weak:
        monkeypatch.setattr(textkit, "span_hash", lambda buf, begin, end, seed=0: np.zeros(len(begin), np.uint64))
    rng = random.Random(8)
    pieces = [rng.choice(["", "a", "b", "ab", "x" * 1500, "x" * 1501]) for _ in range(200)]
    owner = np.array([rng.randrange(3) for _ in pieces])
    want, first = [], {}
    for i, key in enumerate(zip(owner.tolist(), pieces, strict=True)):
        want.append(first.setdefault(key, i))
    buf, begin, end = spans(pieces)
    assert first_alike(buf, begin, end, owner).tolist() == want


def test_member_twice():
    one, two = np.array([1, 1, 2, 3, 9], np.uint64), np.array([5, 6, 5, 8, 1], np.uint64)
    held_one, held_two = np.array([3, 1, 1, 2], np.uint64), np.array([7, 6, 4, 5], np.uint64)
    assert member_twice(one, two, held_one, held_two).tolist() == [False, True, True, False, False]
    assert member_twice(one, two, held_one[:0], held_two[:0]).tolist() == [False] * 5
