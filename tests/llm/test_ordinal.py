import random
import re
import zlib

import numpy as np
import pyarrow as pa

from tidegate.llm import ordinal as op
from tidegate.llm.tables import documents, table
from tidegate.llm.textkit import Texts, mix


def n_features(text):
    """How many features a text has before hashing: distinct words, distinct shapes, and two of the whole."""
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower))
    shapes = set()
    for word in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
        kinds = "".join("A" if "A" <= c <= "Z" else "a" if "a" <= c <= "z" or ord(c) > 127 else "0" if "0" <= c <= "9" else c for c in word)
        shapes.add(re.sub(r"(.)\1+", r"\1", kinds))
    return len(words) + len(shapes) + 2


def test_features_of_each_text_do_not_depend_on_the_batch():
    rng = random.Random(1)
    atoms = ["the ", "IDIOT ", "é!! ", "a|b ", "12 ", "\n", "Word&&& ", "漢字 "]
    texts = ["".join(rng.choice(atoms) for _ in range(rng.randint(0, 40))) for _ in range(200)] + [None, "", " ", "x " * 5000]
    buckets, starts = op.features(Texts(pa.array(texts)))
    for i, text in enumerate(texts):
        own = buckets[starts[i] : starts[i + 1]]
        alone, _ = op.features(Texts(pa.array([text], pa.string())))
        assert own.tolist() == alone.tolist() == sorted(set(own.tolist()))
        assert len(own) == n_features(text)


def test_gradient_equals_differences():
    rng = np.random.default_rng(2)
    starts = np.append(0, np.cumsum(rng.integers(1, 5, 30)))
    buckets = rng.integers(0, 12, starts[-1])
    grade = rng.integers(0, 3, 30)
    model = op.Ordinal(rng.normal(size=12), np.array([-0.7, 0.9]))
    value, by_score, by_threshold = op.likelihood(model, buckets, starts, grade)
    chance = model.grades(model.scores(buckets, starts))
    assert np.isclose(value, np.log(chance[np.arange(30), grade]).mean()) and np.allclose(chance.sum(axis=1), 1)
    slope = np.bincount(buckets, weights=np.repeat(by_score, np.diff(starts)), minlength=12)
    for vector, change in ((model.weights, slope), (model.thresholds, by_threshold)):
        for i in range(len(vector)):
            vector[i] += 1e-5
            up = op.likelihood(model, buckets, starts, grade)[0]
            vector[i] -= 2e-5
            down = op.likelihood(model, buckets, starts, grade)[0]
            vector[i] += 1e-5
            assert np.isclose((up - down) / 2e-5, change[i], atol=1e-6)


def test_grades_labels_and_edge_cases(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 1), (3, 1, 0), (4, None, 0), (None, 1, 0), (5, 1, None), (99, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert {tuple(r) for r in op.graded(labels).collect()} == {(1, 2), (2, 1), (3, 0), (99, 2)}
    docs = spark.createDataFrame([(1, "a b", 0), (2, None, 0), (3, "", 0), (None, "c", 0), (1, "a b", 0), (4, "z " * 9000, 0)], "doc_id bigint, text string, grade int")
    rows = op.score_documents(docs, op.Ordinal.constant()).collect()
    assert len(rows) == 6 and all(r.kept and r.p_top == 1 and r.grade == 2 and r.expected_grade == 2 for r in rows)
    assert not op.train_ordinal(docs, op.graded(labels.where("doc_id = 1"))).weights.any()
    assert op.score_documents(docs.limit(0), op.Ordinal.constant()).collect() == []


def test_scores_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    model = op.Ordinal(np.where(rng.random(op.BUCKETS) < 0.1, rng.normal(size=op.BUCKETS), 0), np.array([-1.0, 0.5]))
    frame = documents(spark, "/root/testdata/sf0.001")
    texts = {r.doc_id: r.text for r in frame.collect()}
    for r in op.score_documents(frame, model).collect():
        buckets, _ = op.features(Texts(pa.array([texts[r.doc_id]])))
        score = sum(model.weights[b] for b in buckets)
        below = 1 / (1 + np.exp(-(model.thresholds - score)))
        chance = [below[0], below[1] - below[0], 1 - below[1]]
        assert np.allclose([r.p_toxic, r.p_top, r.expected_grade], [chance[0], chance[2], chance[1] + 2 * chance[2]])


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, grades = documents(spark, folder), op.graded(table(spark, folder, "labels"))
    truth = {r.doc_id: r.grade for r in grades.collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    tested = spark.createDataFrame([(i,) for i in held], "doc_id bigint")
    model = op.train_ordinal(docs, grades.join(tested, "doc_id", "left_anti"))
    assert (np.diff(model.thresholds) >= 0).all()
    rows = op.score_documents(docs.join(tested, "doc_id", "left_semi"), model).collect()
    kept = {g: [r.kept for r in rows if truth[r.doc_id] == g] for g in range(3)}
    assert np.mean(kept[2]) >= 0.97 and np.mean(kept[1]) <= 0.15 and np.mean(kept[0]) <= 0.15
    assert np.mean([r.grade == truth[r.doc_id] for r in rows]) >= 0.92


def test_hash_has_no_fixed_point_at_zero():
    assert mix(np.arange(1, 5, dtype=np.uint64)).tolist() != [1, 2, 3, 4]
