import re

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipe
from tests.llm import test_decontaminate, test_near_dups, test_suffix_dedup
from tidegate.llm.tables import documents, table

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def given(spark):
    rows = [tuple(r) for r in documents(spark, FOLDER).select(*pipe.COLUMNS).collect()]
    item = table(spark, FOLDER, "benchmark").first().text
    longest = max(rows, key=lambda r: len(r[1]))
    rows += [
        (5000, None, "en", "s", 0), (5001, "", "en", "s", 0), (5002, "12 34!", None, "s", 6), (5003, "etwas Neues über ein Thema", None, "s", 26),
        (5004, longest[1], "en", None, None), (5005, item, "es", "s", len(item)), (5006, longest[1].replace(" ", "  "), "en", "s", 1), (5003, "etwas Neues über ein Thema", None, "s", 26),
    ]
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, lang_pred string")


def brute(docs, items):
    """The ids and texts that each stage keeps of its predecessor's, by brute force."""
    out = []
    docs = [(i, t) for i, t in docs if any(c.isalpha() for c in t or "")]
    out.append(docs)
    classes = test_near_dups.brute(docs)
    docs = sorted({(i, t) for i, t in docs if classes[i] == i})
    out.append(docs)
    cut = test_suffix_dedup.brute(docs, 50)
    after = []
    for i, t in docs:
        ((_, n_removed, _, kept),) = cut[i]
        kept = kept.decode("utf-8", "ignore")
        if not n_removed or re.search(r"[^\x20\x09-\x0D]", kept):
            after.append((i, kept))
    docs = after
    out.append(docs)
    hit = {r[0] for r in test_decontaminate.brute(docs, items) if r[4]}
    docs = [(i, t) for i, t in docs if i not in hit]
    out.append(docs)
    return out


def test_stages_equal_brute_force(spark, given):
    items = [(r.item_id, r.text) for r in table(spark, FOLDER, "benchmark").collect()]
    want = brute([(r.doc_id, r.text) for r in given.collect()], [(str(i), t) for i, t in items])
    docs = given
    for (name, stage), expected in zip(pipe.STAGES, want):
        docs = spark.createDataFrame(stage(spark, docs, FOLDER).collect(), given.drop("lang_pred").schema)
        assert docs.columns == list(pipe.COLUMNS)
        assert sorted((r.doc_id, r.text) for r in docs.collect()) == sorted(expected), name
    library = Tokenizer.from_file(pipe.VOCABULARY)
    rows = pipe.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert sorted((r.doc_id, tuple(r.ids)) for r in rows) == sorted((i, tuple(library.encode(t, add_special_tokens=False).ids)) for i, t in want[-1])
    assert all(r.n_tokens == len(r.ids) for r in rows)


def test_columns_of_kept_documents_stay(spark, given):
    before = {(r.doc_id, r.text): r for r in given.collect()}
    for name, stage in pipe.STAGES[:4]:
        for r in stage(spark, given, FOLDER).collect():
            old = before.get((r.doc_id, r.text))
            if old is None:  # a text that was cut
                assert name == "suffix_array_dedup" and r.n_chars == len(r.text)
            else:
                assert (r.source, r.n_chars) == (old.source, old.n_chars)
                assert r.lang == old.lang or (old.lang is None and name == "language_id")


def test_stages_take_odd_rows(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, group_id string"
    odd = spark.createDataFrame([(None, "some words here", None, None, None, None), (None, None, None, None, None, None), (1, None, None, None, None, None), (2, "", "en", None, None, None), (2, "", "en", None, None, None)], schema)
    for _, stage in pipe.STAGES[:4]:
        assert ("some words here", None) in {(r.text, r.doc_id) for r in stage(spark, odd, FOLDER).collect()}
    assert len(pipe.encode_tokens(spark, odd, FOLDER).collect()) == 5
    for _, stage in pipe.STAGES:
        assert stage(spark, odd.limit(0), FOLDER).collect() == []


def test_run(spark):
    rows = pipe.run(spark, FOLDER)
    assert set(rows.columns) == {"doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"}
    assert 0 < rows.count() < documents(spark, FOLDER).count()
