import math
import zlib
from collections import Counter

import numpy as np
import pytest
import regex

from tidegate.llm.language_id import identify, letter_vector, train_profiles
from tidegate.llm.queries import QUERIES
from tidegate.llm.tables import documents

SCHEMA = "doc_id bigint, text string, lang string, score string"


def brute_bundle(text, dimensions):
    out = np.zeros(dimensions)
    for word in regex.findall(r"\p{L}+", text or ""):
        places = [0, *(ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in word), 0]
        for a, b, c in Counter(zip(places, places[1:], places[2:])).elements():
            out += np.roll(letter_vector(a, dimensions), 2) * np.roll(letter_vector(b, dimensions), 1) * letter_vector(c, dimensions)
    return out


def test_profiles_and_cosines_equal_brute_force(spark):
    rows = [
        (1, "Guten Tag, die Straße ist schön!", "de"), (2, "hello THE world, it's fine", "en"), (3, "que sí señor 12 añO", "es"),
        (4, None, "en"), (5, "", "de"), (6, "12 34 !!", "fr"), (7, "the the the", None), (8, "ΑΒΓ αβγ 漢字 İstanbul", "xx"), (2, "hello THE world, it's fine", "en"),
    ]
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    profiles = train_profiles(docs, dimensions=128)
    want = {}
    for _, text, lang in rows:
        if lang and text:
            want[lang] = want.get(lang, 0) + brute_bundle(text, 128)
    assert set(profiles) == {k for k, v in want.items() if np.any(v)}
    assert all(np.array_equal(profiles[k], want[k]) for k in profiles)
    got = {(r.doc_id, r.lang_pred, round(r.score, 9)) for r in identify(docs, profiles).collect()}
    expected = set()
    for doc_id, text, _ in rows:
        v = brute_bundle(text, 128)
        if not v.any():
            expected.add((doc_id, "und", 0.0))
            continue
        cosines = {k: v @ p / math.sqrt((v @ v) * (p @ p)) for k, p in profiles.items()}
        best = max(sorted(cosines), key=cosines.get)
        expected.add((doc_id, best, round(min(1, max(0, cosines[best])), 9)))
    assert got == expected


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "hello", None, "x")], SCHEMA)
    assert train_profiles(docs) == {}
    assert [tuple(r) for r in identify(docs, {}).collect()] == [(1, "und", 0.0)]
    assert identify(docs.limit(0), {}).collect() == []


@pytest.mark.parametrize("scale", ["sf0.01"])
def test_held_out_accuracy(spark, scale):
    folder = f"/root/testdata/{scale}"
    truth = {r.doc_id: r.lang for r in documents(spark, folder).collect()}
    rows = QUERIES["op4_language_id"](spark, folder).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    tested = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in tested) >= 0.98 * len(tested)
