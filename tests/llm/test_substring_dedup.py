import hashlib
import random
import re

import pytest

from tests.llm.odd_texts import thue_morse
from tidegate.llm.substring_dedup import substring_dedup

SCHEMA = "doc_id bigint, text string, n_words string, spans string"


def brute(docs, window):
    """Every window in order of id and place; what was seen before goes."""
    seen, out = {}, {}
    for doc_id, text in sorted(docs, key=lambda d: (d[0], d[1] or "")):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for i in range(len(words) - window + 1):
            at = seen.setdefault(tuple(words[i : i + window]), (doc_id, i))
            if at != (doc_id, i):
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.setdefault(doc_id, set()).add((len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def found(spark, docs, window):
    frame = spark.createDataFrame([(i, t, "x", None) for i, t in docs], SCHEMA)
    out = {}
    for row in substring_dedup(frame, window=window).collect():
        assert sum(s.stop - s.start for s in row.spans) == row.n_removed
        digest = hashlib.sha256(row.kept_text.encode()).hexdigest()
        out.setdefault(row.doc_id, set()).add((row.n_words, row.n_removed, digest))
    return out


@pytest.mark.parametrize("window", [5, 20])
def test_equals_brute_force(spark, window, monkeypatch):
    from tidegate.llm import parts

    monkeypatch.setattr(parts.part_count, "__defaults__", ("text", 2000))
    rng = random.Random(window)
    passage = [" ".join(rng.choice("abcdefgh") for _ in range(60)) for _ in range(4)]
    docs = []
    for i in range(80):
        words = [rng.choice("abcdefghijklmnopé") * rng.randint(1, 2) for _ in range(rng.randint(0, 60))]
        if i % 3 == 0:
            words.insert(rng.randint(0, len(words)), rng.choice(passage))
        docs.append((i * 7 - 20, rng.choice([" ", "\n", " \t "]).join(words)))
    docs += [(1000, docs[3][1]), (1001, docs[3][1]), (1002, "same " * 50), (1003, None), (1004, ""), (1005, " \n"), (-500, docs[9][1])]
    docs += [(2000 + i, "ü x " * 30) for i in range(20)]
    assert found(spark, docs, window) == brute(docs, window)


def test_rows_without_id_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    got = found(spark, [(5, text), (5, text), (None, text), (None, None), (9, text)], 20)
    kept = hashlib.sha256(text.encode()).hexdigest()
    empty = hashlib.sha256(b"").hexdigest()
    assert got == {5: {(40, 0, kept)}, None: {(40, 0, kept), (0, 0, empty)}, 9: {(40, 40, empty)}}


def test_empty_table_and_bad_block(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert substring_dedup(empty).collect() == []
    with pytest.raises(ValueError):
        substring_dedup(empty, window=20, block=11)


def test_only_short_and_empty_texts(spark):
    rows = substring_dedup(spark.createDataFrame([(1, None, "x", "y"), (2, "", "x", "y"), (3, "short", "x", "y")], SCHEMA)).collect()
    assert sorted((r.doc_id, r.n_removed) for r in rows) == [(1, 0), (2, 0), (3, 0)]


@pytest.mark.parametrize("window", [20, 1024])
def test_sequences_that_weak_hashes_take_for_one(spark, window):
    docs = [(i, " ".join(words)) for i, words in enumerate(thue_morse(1024, "a", "b"))]
    docs += [(5 + i, "z " + " ".join(words)) for i, words in enumerate(thue_morse(2048, "left", "right"))]
    assert found(spark, docs, window) == brute(docs, window)
