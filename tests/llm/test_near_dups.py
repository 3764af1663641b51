import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.odd_texts import thue_morse
from tidegate.llm import near_dups, parts
from tidegate.llm.near_dups import compare_cell, connected, near_duplicates, sample
from tidegate.llm.tables import documents
from tidegate.llm.textkit import mix, planes

SCHEMA = "doc_id bigint, text string, group_id string, part string"


def shingles(text, width=5):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(docs, similarity=0.8):
    """Classes of the graph of all pairs at or above the similarity."""
    texts = {}
    for i, t in sorted((i, t or "") for i, t in docs if i is not None):
        texts.setdefault(i, t)
    bags = {i: shingles(t) for i, t in texts.items()}
    n = sum(1 for i, _ in docs if i is not None)
    df = Counter(s for b in bags.values() for s in b)
    weights = {i: {s: c * (1 + math.log((1 + n) / (1 + df[s])) / math.log(1 + n)) for s, c in b.items()} for i, b in bags.items()}
    root = {i: i for i in bags}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(bags)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            shared = sum(min(w, weights[b][s]) for s, w in weights[a].items() if s in weights[b])
            total = sum(weights[a].values()) + sum(weights[b].values()) - shared
            if total and shared / total >= similarity and bags[a]:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in ids}


def found(spark, docs):
    rows = near_duplicates(spark.createDataFrame([(*d, "x", "y") for d in docs], SCHEMA)).collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    return {r.doc_id: r.group_id for r in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(parts.part_count, "__defaults__", ("text", 4000))
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["é", "Ñu"]
    docs = []
    for g in range(14):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 5, 30, 80, 200]))]
        for _ in range(rng.choice([1, 2, 6])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 6])):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            docs.append((len(docs) * 3 - 20, rng.choice([" ", ", "]).join(words)))
    big = [rng.choice(vocab) for _ in range(120)]
    for i in range(40):
        words = list(big)
        words[rng.randrange(120)] = f"new{i}"
        docs.append((500 + i, " ".join(words)))
    docs += [(900, None), (901, ""), (902, " !"), (903, "one"), (904, "ONE."), (905, "a " * 200), (906, "a " * 150), (None, docs[0][1]), (docs[5][0], docs[5][1])]
    assert found(spark, docs) == brute(docs)


def test_small_cells_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "CELL", 3)
    rng = random.Random(9)
    base = [f"w{rng.randrange(400)}" for _ in range(100)]
    docs = [(i, " ".join(base[:i] + [f"x{i}"] + base[i + 1 :])) for i in range(30)]
    assert found(spark, docs) == brute(docs)
    assert found(spark, []) == {}
    assert found(spark, [(1, None), (2, None)]) == {1: 1, 2: 2}


def test_samples_agree_with_the_weighted_similarity():
    rng = np.random.default_rng(4)
    n = 400
    hashes = np.sort(mix(np.arange(n, dtype=np.uint64) + np.uint64(77)))
    a, b = rng.uniform(0.5, 4, n), rng.uniform(0.5, 4, n)
    b[: n // 2] = a[: n // 2]
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    start = np.zeros(1, np.int64)
    agree = np.mean([sample(hashes, a, start, k)[0] == sample(hashes, b, start, k)[0] for k in range(3000)])
    assert abs(agree - want) < 0.03


def test_connected_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, x) for x in range(101, 130)] + [(130, 129), (200, 200)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(1, 21)} | {i: 100 for i in range(101, 131)}


def test_exact_copies_of_the_documents_share_a_class(spark):
    folder = "/root/testdata/sf0.001"
    rows = {r.doc_id: r.group_id for r in near_duplicates(documents(spark, folder)).collect()}
    texts = {r.doc_id: r.text for r in documents(spark, folder).collect()}
    assert rows == brute(list(texts.items()))


def near_pairs_of_a_template(n_pairs, seed):
    """Texts of one template that are below 0.8 to each other, but for pairs that are a little above."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(200)]
    docs = []
    for pair in range(n_pairs):
        words = list(base)
        places = rng.sample(range(20), 6)
        for k in places[:3]:
            words[k * 10] = f"p{pair}-{k}"
        other = list(words)
        for k in places[3:]:
            other[k * 10] = f"q{pair}-{k}"
        docs += [(pair, " ".join(words)), (1000 - pair, " ".join(other))]
    return docs


def test_near_pairs_whose_leader_is_unlike_both(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "CELL", 2)
    docs = near_pairs_of_a_template(80, 5)
    want = brute(docs)
    assert len(set(want.values())) > 40 and want[1000 - 70] == want[70]
    assert found(spark, docs) == want


def test_chain_between_what_two_leads_reached():
    # 1 - 3 - 4 - 2 drift by a tenth each; only neighbours are alike
    begin = {1: 0, 3: 10, 4: 20, 2: 30}
    cell = pa.table(
        {
            "head": list(begin),
            "shingles": [planes(np.arange(b, b + 100, dtype=np.uint64)) for b in begin.values()],
            "weights": [planes(np.ones(100, np.float32)) for _ in begin],
        }
    )
    assert {tuple(sorted(x)) for x in compare_cell(cell, 0.8)} == {(1, 3), (3, 4), (2, 4)}


def test_drifting_chains_equal_brute_force(spark):
    rng = random.Random(11)
    docs = []
    for chain in range(12):
        words = [f"c{chain}-{i}" for i in range(300)]
        ids = rng.sample(range(100 * chain, 100 * chain + 100), 12)
        docs += [(i, " ".join(words[8 * k : 8 * k + 150])) for k, i in enumerate(ids)]
    assert found(spark, docs) == brute(docs)


def test_texts_that_weak_hashes_take_for_one(spark):
    docs = [(i, " ".join(words)) for i, words in enumerate(thue_morse(2048, "w1", "w2"))] + [(9, " ".join(thue_morse(2048, "W1", "w2")[0]) + " .")]
    rows = near_duplicates(spark.createDataFrame([(*d, "x", "y") for d in docs], SCHEMA)).collect()
    assert {r.doc_id: r.content_id for r in rows} == {0: 0, 1: 1, 9: 0}
    assert {r.doc_id: r.group_id for r in rows} == brute(docs)


def template_group(rng, n, share, words=100):
    """Texts of one template with words of their own at the end, and close copies of every fifth of them."""
    base = [f"t{rng.randrange(10**6)}" for _ in range(round(words * share))]
    docs = []
    for i in range(n):
        own = [f"o{rng.randrange(10**6)}" for _ in range(words - len(base))]
        docs.append(base + own)
        if i % 5 == 0:
            near = list(docs[-1])
            near[rng.randrange(len(base), words)] = "changed"
            docs.append(near)
    rng.shuffle(docs)
    return [(i, " ".join(d)) for i, d in enumerate(docs)]


@pytest.mark.parametrize("share", [0.7, 0.8, 0.84, 0.88])
def test_pairs_inside_a_large_group_of_one_template(spark, monkeypatch, share):
    monkeypatch.setattr(near_dups, "CELL", 4)
    docs = template_group(random.Random(int(share * 100)), 40, share)
    assert found(spark, docs) == brute(docs)


def test_prefixes_lose_no_pair():
    rng = np.random.default_rng(2)
    n, similarity, hits = 200, 0.8, 0
    for _ in range(400):
        size = rng.integers(3, 60)
        tags = np.sort(rng.choice(n, size, replace=False)).astype(np.uint64)
        weights = rng.uniform(0.5, 4, size).astype(np.float32)
        keep = rng.uniform(size=size) < rng.choice([0.8, 0.95])
        other = weights * np.where(rng.uniform(size=size) < 0.9, 1, rng.uniform(0.7, 1.4, size)).astype(np.float32)
        sides = [(tags, weights), (tags[keep], other[keep])]
        if not keep.any():
            continue
        like = near_dups.weighted_jaccard((tags, weights.astype(float)), tags[keep], other[keep].astype(float), np.zeros(keep.sum(), int), 1)[0]
        posts = [list(near_dups.prefix_posts([pa.record_batch({"head": [k], "root": [k], "shingles": [planes(t)], "weights": [planes(w)]})], similarity))[0].to_pylist() for k, (t, w) in enumerate(sides)]
        light, heavy = sorted(posts, key=lambda p: (p[0]["total"], p[0]["head"]))
        met = any(
            a["light"] and a["tag"] == b["tag"] and a["total"] >= similarity * (1 - 1e-5) * b["total"] and min(a["rest"], b["rest"]) >= similarity / (1 + similarity) * (1 - 1e-5) * (a["total"] + b["total"])
            for a in light
            for b in heavy
        )
        assert met or like < similarity
        hits += like >= similarity
    assert hits > 50
