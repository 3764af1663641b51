import random

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from tidegate.llm.tables import documents
from tidegate.llm.token_counts import Pieces, calls, count_batch, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def machine():
    with open(MODEL, "rb") as file:
        return Pieces(file.read())


def odd_texts(n, most=40, seed=5):
    rng = random.Random(seed)
    atoms = [" ", "  ", "   ", "\n", "\t", "the", "The ", "ing", "ab", "é", "ñ", "漢字", "🙂", "▁", "<s>", "</s>", "<unk>", "<0x0A>", "\x00", "12", "345", "...", "a" * 17, "é", " "]
    return ["".join(rng.choice(atoms) for _ in range(rng.randint(0, most))) for _ in range(n)] + ["", " ", "  ", "▁", " a", "a ", " " * 70, "a" * 500]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 50])
def test_cuts_change_no_length(machine, library, size):
    texts = odd_texts(600)
    want = [len(x) for x in library.encode(texts)]
    assert count_batch(machine, texts, segment=size, call_bytes=97).tolist() == want
    for text in texts:
        assert "".join(machine.segments(text, size)) == text


def test_a_text_is_cut_wherever_no_piece_spans(machine):
    assert len(machine.segments("some words and more " * 1000, 20)) > 500
    assert machine.segments("a" * 1000, 20) == ["a" * 1000]  # "aa" is inside pieces


def test_calls_have_like_bytes():
    import numpy as np

    sizes = np.array([5] * 1000 + [400] * 10)
    call = calls(sizes, 900)
    held = np.bincount(call, weights=sizes)
    assert len(held) == 10 and held.max() <= 900 + 2 * 400
    assert calls(np.array([0, 0]), 10).tolist() == [0, 0]


def test_equals_the_library(spark, library):
    texts = odd_texts(400) + ["A long one. " * 30_000, "x" * 40_000, "word\n" * 20_000]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, None, None), (3, texts[3], None), (None, "no id", None)]
    got = token_counts(spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string").repartition(3), MODEL).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 4096) for i, t, _ in rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


def test_equals_the_library_on_the_documents(spark, library):
    frame = documents(spark, "/root/testdata/sf0.001")
    texts = {r.doc_id: r.text or "" for r in frame.collect()}
    for r in token_counts(frame, MODEL, limit=1000).collect():
        n = len(library.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 1000)


def test_a_tokenizers_file(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    texts = odd_texts(50)
    got = token_counts(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), path).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(own.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_empty_table(spark):
    assert token_counts(spark.createDataFrame([], "doc_id bigint, text string"), MODEL).collect() == []
