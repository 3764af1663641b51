import random
import re
from collections import Counter

from tidegate.llm import decontaminate as op

DOCS = "doc_id bigint, text string, item_id string, pos string"
ITEMS = "item_id string, text string, doc_id string"


def words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(docs, items, width=10):
    out = []
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for item_id, item in items:
            w = words(item)
            size = min(width, len(w))
            for i in range(max(1, len(w) - width + 1) if w else 0):
                for j in range(len(own) - size + 1):
                    if own[j : j + size] == w[i : i + size]:
                        hit.update(range(j, j + size))
                        found.add(item_id)
        out.append((doc_id, len(own), len(hit), tuple(sorted(found)), bool(hit)))
    return Counter(out)


def frames(spark, docs, items):
    return spark.createDataFrame([(*d, "x", "y") for d in docs], DOCS), spark.createDataFrame([(*i, "z") for i in items], ITEMS)


def found(spark, docs, items):
    rows = op.decontaminate(*frames(spark, docs, items)).collect()
    return Counter((r.doc_id, r.n_words, r.n_hit, tuple(r.items), r.contaminated) for r in rows)


def case(seed):
    rng = random.Random(seed)
    vocab = ["the", "of", "ñandú", "x1", "alpha", "beta", "gamma", "delta", "Q", "Éa"] + [f"w{i}" for i in range(30)]
    items = [(str(i), rng.choice(["", " ", "("]) + " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 2, 5, 9, 10, 11, 25])))) for i in range(14)]
    items += [("rep", "a a a a a a a a a a a"), ("none", None), ("blank", " ?! "), ("14", items[3][1]), ("14", items[5][1])]
    docs = []
    for i in range(60):
        w = [rng.choice(vocab) for _ in range(rng.randint(0, 30))]
        if i % 2:
            w += (rng.choice(items)[1] or "").split()[: rng.choice([9, 10, 40])] + w[:3]
        docs.append((i, rng.choice([" ", ", ", "\n--"]).join(x.upper() if rng.random() < 0.2 and x.isascii() else x for x in w) + rng.choice(["", ".", " "])))
    docs += [(100, None), (101, ""), (102, " ,"), (103, "a " * 40), (None, items[9][1]), (104, docs[1][1]), (104, docs[1][1]), (104, docs[3][1])]
    return docs, items


def test_equals_brute_force(spark):
    for seed in (1, 2):
        docs, items = case(seed)
        assert found(spark, docs, items) == brute(docs, items)


def test_equals_brute_force_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(op, "BROADCAST_ROWS", 0)
    docs, items = case(3)
    assert found(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = case(4)
    assert found(spark, [], items) == Counter()
    assert found(spark, docs, []) == brute(docs, [])


def test_near_matches(spark):
    item = "one two three four five six seven eight nine ten"
    docs = [(1, item), (2, "zero one two three x four five six y seven eight nine ten"), (3, "ten nine eight seven six five four three two one" + " far" * 30 + " one"), (4, "one two three")]
    frame, items = frames(spark, docs, [("i", item)])
    windows = op.benchmark_windows(items)
    index = op.postings(frame, windows)
    best = {}
    for r in op.near_matches(index, windows, slack=2, share=0.9).collect():
        best[r.doc] = max(best.get(r.doc, 0), r.n_near)
    assert best == {1: 10, 2: 10}


def best_near(spark, docs, item, **given):
    frame, items = frames(spark, docs, [("i", item)])
    windows = op.benchmark_windows(items)
    best = {}
    for r in op.near_matches(op.postings(frame, windows), windows, **given).collect():
        best[r.doc] = max(best.get(r.doc, 0), r.n_near)
    return best


def test_near_matches_of_a_term_that_no_document_has(spark):
    item = "one two three four rareword six seven eight nine ten"
    docs = [(1, item.replace("rareword", "changed")), (2, "one two three four")]
    assert best_near(spark, docs, item, slack=2, share=0.9) == {1: 9}


def test_near_matches_without_the_rarest_terms(spark):
    item = "one two three four five six seven eight nine ten"
    altered = item.replace("one", "x").replace("two", "y").replace("three", "z").replace("four", "v")
    docs = [(1, altered), (2, "one"), (3, "two"), (4, "three"), (5, "four")] + [(i, "five six seven eight nine ten") for i in range(6, 12)]
    assert best_near(spark, docs, item, slack=2, share=0.6)[1] == 6


def test_no_python_in_the_plan(spark):
    docs, items = frames(spark, *case(5))
    plan = op.decontaminate(docs, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
