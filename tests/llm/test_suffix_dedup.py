import random

import numpy as np
import pytest

from tidegate.llm import parts, suffix_dedup as op
from tidegate.llm.suffix_dedup import previous_smaller, sliding_min, suffix_dedup, suffix_order

SCHEMA = "doc_id bigint, text string, n_bytes string, spans string"


def brute(docs, length):
    first = {}
    for doc_id, text in docs:
        data = (text or "").encode()
        for i in range(len(data) - length + 1):
            key = data[i : i + length]
            first[key] = min(doc_id, first.get(key, doc_id))
    out = {}
    for doc_id, text in docs:
        data = (text or "").encode()
        gone = set()
        for i in range(len(data) - length + 1):
            if first[data[i : i + length]] < doc_id:
                gone.update(range(i, i + length))
        kept = bytes(b for i, b in enumerate(data) if i not in gone)
        spans = sum(1 for i in gone if i - 1 not in gone)
        out.setdefault(doc_id, set()).add((len(data), len(gone), spans, kept))
    return out


def found(spark, docs, length):
    out = {}
    for r in suffix_dedup(spark.createDataFrame([(i, t, "x", "y") for i, t in docs], SCHEMA), length).collect():
        assert sum(s.stop - s.start for s in r.spans) == r.n_removed
        out.setdefault(r.doc_id, set()).add((r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)))
    return out


@pytest.mark.parametrize("length", [24, 33, 50])
def test_equals_brute_force(spark, length, monkeypatch):
    monkeypatch.setattr(parts.part_count, "__defaults__", ("text", 3000))
    rng = random.Random(length)
    passage = ["".join(rng.choice("abcdé ") for _ in range(120)) for _ in range(4)]
    docs = []
    for i in range(70):
        text = "".join(rng.choice("abcdefgh ñ\n") for _ in range(rng.randint(0, 200)))
        if i % 2:
            at, p = rng.randint(0, len(text)), rng.choice(passage)
            a = rng.randint(0, 60)
            text = text[:at] + p[a : a + rng.randint(20, 100)] + text[at:] + p[:70]
        docs.append((i * 5 - 30, text))
    docs += [(900, docs[7][1]), (901, docs[7][1]), (902, "ab" * 100), (903, "ab" * 90), (904, None), (905, ""), (-900, docs[11][1])]
    docs += [(1000 + i, "zu oft " * 30) for i in range(15)]
    assert found(spark, docs, length) == brute(docs, length)


def test_rows_without_id_repeats_and_empty_table(spark):
    text = "".join(chr(97 + i % 26) for i in range(100))
    got = found(spark, [(5, text), (5, text), (None, text), (None, None), (9, text)], 50)
    assert got == {5: {(100, 0, 0, text.encode())}, None: {(100, 0, 0, text.encode()), (0, 0, 0, b"")}, 9: {(100, 100, 1, b"")}}
    assert suffix_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_text_without_broken_characters(spark):
    shared = "é" * 40
    docs = spark.createDataFrame([(1, "x" + shared), (2, "ab" + shared[:25] + "ê" + "end")], "doc_id bigint, text string")
    got = {r.doc_id: (r.n_removed, r.kept_text) for r in suffix_dedup(docs, as_text=True).collect()}
    assert got[1] == (0, "x" + shared)
    assert got[2] == (51, "abend")  # the lead byte that both letters share goes with the copy


def test_parts_of_the_method():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 50, 200).astype(np.uint64)
    for width in (1, 2, 3, 7, 35):
        assert sliding_min(x, width).tolist() == [x[i : i + width].min() for i in range(200 - width + 1)]
    ids = rng.integers(0, 9, 300)
    stretch = np.sort(rng.integers(0, 12, 300))
    want = [max([j for j in range(i) if stretch[j] == stretch[i] and ids[j] < ids[i]], default=-1) for i in range(300)]
    assert previous_smaller(ids, stretch).tolist() == want
    buf = rng.integers(0, 3, 400).astype(np.uint8)
    places = np.arange(360)
    data = buf.tobytes()
    assert suffix_order(buf, places, 31).tolist() == sorted(places, key=lambda p: data[p : p + 31])


def test_only_short_and_empty_texts(spark):
    rows = suffix_dedup(spark.createDataFrame([(1, None, "x", "y"), (2, "", "x", "y"), (3, "short", "x", "y")], SCHEMA)).collect()
    assert sorted((r.doc_id, r.n_removed) for r in rows) == [(1, 0), (2, 0), (3, 0)]


def shared(a, b):
    return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


@pytest.mark.parametrize("letters", [1, 2, 4])
def test_longest_previous_factors(letters):
    rng = np.random.default_rng(letters)
    buf = rng.integers(0, letters, 500).astype(np.uint8)
    buf[300:400] = buf[50:150]
    places = rng.permutation(460)
    ids = rng.integers(0, 40, 460)
    data = buf.tobytes()
    strings = [data[p : p + 30] for p in places]
    want = [max([shared(s, t) for t, j in zip(strings, ids) if j < i], default=0) for s, i in zip(strings, ids)]
    assert op.previous_factors(buf, places, ids, 30).tolist() == want
    assert max(want) == 30


def test_common_prefix():
    buf = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz" * 2 + b"abcdefghijklmnopqrstuvwxyA" + b"\0" * 40, np.uint8)
    eight = op.words8(buf)
    one, two = np.array([0, 0, 0, 1, 25, 26]), np.array([26, 52, 0, 53, 51, 1])
    assert op.common_prefix(eight, one, two, 26).tolist() == [26, 25, 26, 24, 26, 0]
    assert op.common_prefix(eight, one, two, 9).tolist() == [9, 9, 9, 9, 9, 0]


def test_repeated_starts_against_all_pairs(monkeypatch):
    """Stretches around few grams: equal ones, ones that overlap in part, and the same id twice."""
    rng = random.Random(4)
    length, gram = 24, b"0123456789abcdef"
    stretches, anchor, ids = [], [], []
    for _ in range(120):
        left, right = rng.randint(0, 8), rng.randint(8, 20)
        stretches.append(bytes(rng.choice(b"xy") for _ in range(left)) + gram[rng.randint(0, 1) :] + b"z" * 3 + bytes(rng.choice(b"xy") for _ in range(right)))
        anchor.append(left)
        ids.append(rng.randint(0, 30))
    size = np.array([len(s) for s in stretches])
    starts = [(s[i : i + length], d) for s, d in zip(stretches, ids) for i in range(len(s) - length + 1)]
    least = {}
    for s, d in starts:
        least[s] = min(d, least.get(s, d))
    given = np.frombuffer(b"".join(stretches), np.uint8), size, np.zeros(120, np.int64), np.array(ids), length
    monkeypatch.setattr(op, "gram_hash", lambda a, b: np.zeros(len(a), np.uint64))
    assert op.repeated_starts(*given).tolist() == [least[s] < d for s, d in starts]


def test_a_gram_that_a_third_of_all_documents_share(spark, monkeypatch):
    """One passage in every third document, cut and continued differently; the hash key holds them all."""
    monkeypatch.setattr(parts.part_count, "__defaults__", ("text", 2000))
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefghij") for _ in range(150))
    docs = []
    for i in range(90):
        own = "".join(rng.choice("klmnopqrst") for _ in range(40))
        a = rng.randint(0, 40)
        docs.append((i, own + (passage[a : 150 - rng.randint(0, 40)] if i % 3 == 0 else "") + own[::-1]))
    assert found(spark, docs, 50) == brute(docs, 50)


def test_anchors_block_by_block(monkeypatch):
    buf = np.random.default_rng(8).integers(97, 123, 5000).astype(np.uint8)
    whole = op.anchors(buf, 50)
    monkeypatch.setattr(op, "BLOCK", 700)
    assert op.anchors(buf, 50).tolist() == whole.tolist()
    assert all(s <= a <= s + 50 - op.GRAM for s, a in enumerate(whole.tolist()))
    assert op.anchors(buf[:49], 50).tolist() == [] and len(op.anchors(buf[:50], 50)) == 1
