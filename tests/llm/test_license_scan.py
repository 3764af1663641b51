import random
import re

import pytest

from tidegate.llm.license_scan import PHRASES, TEMPLATES, SuffixAutomaton, all_chains, best_chain, license_scan
from tidegate.llm.queries import QUERIES
from tidegate.llm.tables import documents


def words_of(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def base(text):
    words, places, labels = words_of(text), [], set()
    for phrase, label in PHRASES:
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


@pytest.mark.parametrize("seed", range(6))
def test_matching_statistics_equal_brute_force(seed):
    rng = random.Random(seed)
    templates = [[rng.randrange(4) for _ in range(rng.randint(1, 12))] for _ in range(4)] + [[1, 1, 1, 1]]
    machine = SuffixAutomaton(templates)
    text = [rng.randrange(5) for _ in range(150)]
    for place, length, state in machine.statistics(text):
        want = 0
        for n in range(1, place + 2):
            tail = text[place + 1 - n : place + 1]
            if any(tail == t[i : i + n] for t in templates for i in range(len(t) - n + 1)):
                want = n
        assert length == want
        if length:
            tail = text[place + 1 - length : place + 1]
            ends = {k: next(i + length - 1 for i in range(len(t)) if t[i : i + length] == tail) for k, t in enumerate(templates) if any(tail == t[i : i + length] for i in range(len(t)))}
            assert machine.ends[state] == ends


def test_chains():
    assert best_chain([(0, 5, 0), (7, 4, 6), (30, 9, 20)], 20) == (18, 0, 39)
    assert best_chain([(0, 5, 10), (7, 4, 6)], 20) == (5, 0, 5)
    assert best_chain([(0, 5, 0), (50, 4, 6)], 20) == (5, 0, 5)


def test_labels_of_notices_and_edge_cases(spark):
    texts = {i: "zz " * i + text + " yy" for i, (_, text) in enumerate(TEMPLATES)}
    texts |= {100: None, 101: "", 102: "mit. LICENSE! mit license", 103: "the of and license under version", 104: "mitlicense apachelicense", 105: "x" * 5000}
    words = TEMPLATES[1][1].split()
    texts[106] = " ".join(w if i % 15 else "changed" for i, w in enumerate(words))
    docs = spark.createDataFrame([(i, t, "q") for i, t in texts.items()] + [(None, TEMPLATES[0][1], "q"), (3, texts[3], "q")], "doc_id bigint, text string, labels string")
    rows = license_scan(docs).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        text = TEMPLATES[0][1] if r.doc_id is None else texts[r.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        if r.doc_id is not None and r.doc_id < 100:
            label = TEMPLATES[r.doc_id][0]
            assert label in r.labels.split(",") and r.score == 1.0
            assert any(s.label == label and s.start == r.doc_id and s.share == 1.0 for s in r.spans)
        if r.doc_id == 106:
            assert r.labels == "mit" and r.n_base == 0 and 0.6 <= r.score < 1
        if r.doc_id in (100, 101, 103, 104, 105):
            assert (r.labels, r.score, r.spans) == ("", 0.0, [])
    assert license_scan(docs.limit(0)).collect() == []


def test_base_equals_brute_force_on_the_documents(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in documents(spark, folder).collect()}
    for r in QUERIES["op7_license_scan"](spark, folder).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(texts[r.doc_id])
        assert ("cc-by-nc" in r.labels) == ("Licensed under CC BY-NC 4.0." in texts[r.doc_id])


def test_repeated_notices_have_a_span_each(spark):
    mit, long_mit = TEMPLATES[0][1], TEMPLATES[1][1]
    texts = {1: (mit + "\n") * 1000, 2: f"{mit} a b c {mit}", 3: f"{long_mit} x {long_mit}"}
    rows = {r.doc_id: r for r in license_scan(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()}
    assert [(s.start, s.stop, s.share) for s in rows[1].spans] == [(5 * i, 5 * i + 5, 1.0) for i in range(1000)]
    assert [(s.start, s.stop) for s in rows[2].spans] == [(0, 5), (8, 13)]
    n = len(words_of(long_mit))
    assert [(s.start, s.stop) for s in rows[3].spans if s.stop - s.start > 5] == [(0, n), (n + 1, 2 * n + 1)]


def test_a_wording_that_a_template_repeats_is_chained_at_its_later_place(spark):
    template = (("x", "one two three alpha beta gamma delta one two three omega"),)
    rows = license_scan(spark.createDataFrame([(1, "alpha beta gamma delta zz one two three")], "doc_id bigint, text string"), template).collect()
    assert [(s.label, s.start, s.stop) for s in rows[0].spans] == [("x", 0, 8)]


def test_chains_do_not_overlap():
    assert all_chains([(0, 6, 0), (4, 6, 0)], 20, 3.6, 3) == [(6, 0, 6), (4, 6, 10)]
    assert all_chains([(0, 5, 0), (7, 4, 6), (30, 5, 0), (37, 4, 6)], 20, 6, 3) == [(9, 0, 11), (9, 30, 41)]
    assert all_chains([], 20, 1, 3) == []
