import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from tidegate.llm import line_quality as op
from tidegate.llm.queries import QUERIES
from tidegate.llm.tables import documents, table
from tidegate.llm.textkit import Texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dups += line in seen
            seen.add(line)
    n = len(words)
    failed = n < 50 or 100 * len(repeated) > 50 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(repeated), failed


def odd_texts():
    rng = random.Random(2)
    atoms = ["a", "b", "é ", "\n", "\n\n", " ", "#", "x|y", "\t", "漢", "<b>", "\r\n", "a b c", "\x0b"]
    texts = ["".join(rng.choice(atoms) for _ in range(rng.randint(0, 150))) for _ in range(300)]
    return [*texts, None, "", "\n", "word " * 500, "\n".join(f"line {i} of many words here" for i in range(400)), "a b c\n" * 30]


def test_base_counts_equal_brute_force(spark):
    texts = odd_texts()
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "a b", "x"), (0, texts[0], "x")], "doc_id bigint, text string, kept string")
    rows = op.judge_lines(docs, op.Field.neutral()).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        text = "a b" if r.doc_id is None else texts[r.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(text), repr(text)
        assert r.kept == (not r.base_failed) or not r.n_words
        assert len(r.line_labels) == sum(bool(WORD.search(line)) for line in (text or "").split("\n"))
    assert op.judge_lines(docs.limit(0), op.Field.neutral()).collect() == []


def random_case(seed):
    rng = np.random.default_rng(seed)
    field = op.Field(rng.normal(size=op.N_FEATURES), rng.normal(size=(2, 2)), rng.normal(size=2), rng.normal(size=2))
    lines = np.array([3, 0, 5, 1, 4])
    first = np.append(0, np.cumsum(lines))[:-1]
    features = rng.integers(0, op.N_FEATURES, (int(lines.sum()), len(op.BINS)))
    return field, features, first, lines


def path_score(field, score, path):
    out = field.start[path[0]] + field.stop[path[-1]] + sum(score[i, k] for i, k in enumerate(path))
    return out + sum(field.turns[a, b] for a, b in zip(path, path[1:]))


def test_viterbi_equals_all_paths():
    for seed in range(10):
        field, features, first, lines = random_case(seed)
        got = op.viterbi(field, features, first, lines)
        for a, n in zip(first, lines):
            if n:
                score = field.scores(features[a : a + n])
                assert tuple(got[a : a + n]) == max(itertools.product((0, 1), repeat=int(n)), key=lambda p: path_score(field, score, p))


def test_gradient_equals_differences():
    field, features, first, lines = random_case(3)
    labels = np.random.default_rng(1).integers(0, 2, len(features))
    value, change = op.gradient(field, features, first, lines, labels)
    want = 0.0
    for a, n in zip(first, lines):
        if n:
            score = field.scores(features[a : a + n])
            paths = [path_score(field, score, p) for p in itertools.product((0, 1), repeat=int(n))]
            want += path_score(field, score, labels[a : a + n]) - np.logaddexp.reduce(paths)
    assert np.isclose(value, want / 4)
    for name in ("weights", "turns", "start", "stop"):
        weight = getattr(field, name)
        for at in np.ndindex(weight.shape):
            weight[at] += 1e-5
            up, _ = op.gradient(field, features, first, lines, labels)
            weight[at] -= 2e-5
            down, _ = op.gradient(field, features, first, lines, labels)
            weight[at] += 1e-5
            assert np.isclose((up - down) / 2e-5, getattr(change, name)[at], atol=1e-5)


def test_keeps_good_documents_and_drops_bad_ones(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in documents(spark, folder).collect()}
    rows = {r.doc_id: r for r in QUERIES["op8_quality_rules"](spark, folder).collect()}
    assert len(rows) == len(texts)
    assert all((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(texts[i]) for i, r in rows.items())
    marks = {r.doc_id: r.quality for r in table(spark, folder, "labels").collect()}
    judged = [(rows[i].kept, q) for i, q in marks.items() if not rows[i].base_failed]
    good = [k for k, q in judged if q]
    bad = [k for k, q in judged if not q]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_untrained_without_labels(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert not op.train_field(docs, none).weights.any()
    found = op.Lines(Texts(pa.array(["a\nb"])))
    assert op.viterbi(op.Field.neutral(), found.features, found.first, found.lines).tolist() == [1, 1]
