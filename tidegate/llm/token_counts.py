"""Number of tokens of each text, without keeping the tokens.

A tokenizer file decides the library: ``.model`` sentencepiece, ``.json`` tokenizers. The
driver reads the file and its bytes go with the tasks, so executors need only the library.

A task cuts long texts at safe boundaries and deals the segments of an Arrow batch into
library calls of nearly equal bytes, so neither a call nor its result grows with a text. A
boundary is safe between two characters that stand side by side in no piece of the
vocabulary: no merge can ever span it, so the segments' lengths add up to the text's. This
holds for vocabularies of merges whose normaliser changes nothing but blanks; for others,
and for ``.json`` files, a text is one segment. A run without a safe boundary (one letter
repeated, say) stays whole.

Defined results: a null or empty text has no bytes and no tokens. Texts of special tokens
inside a text are what the library takes them for by default; none are added. Truncation
and padding are off. Rows are independent: repeated rows and rows without an id are counted
like others. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a segment and bytes of a library call, at least.
SEGMENT = 1 << 15
CALL_BYTES = 1 << 19
#: Tokens above which a document does not fit a context.
LIMIT = 4096
BLANK, ESCAPED = " ", "▁"
#: Kinds of pieces in a sentencepiece file, and its model kind of merges.
_UNKNOWN, _CONTROL, _BYTE = 2, 3, 6
_MERGES = 2


class Pieces:
    """A sentencepiece model that counts: ``first`` for the begin of a text, ``later`` for what follows a cut."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        self.first = self.later = SentencePieceProcessor(model_proto=model)
        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(model)
        plain = spec.normalizer_spec
        self.cuts = spec.trainer_spec.model_type == _MERGES and not plain.precompiled_charsmap and not plain.remove_extra_whitespaces and plain.escape_whitespaces
        self.cuts &= not spec.trainer_spec.treat_whitespace_as_suffix
        if self.cuts:
            texts = [x.piece for x in spec.pieces if x.type not in (_UNKNOWN, _CONTROL, _BYTE)]
            self.side_by_side = {text[i : i + 2] for text in texts for i in range(len(text) - 1)}
            plain.add_dummy_prefix = False
            self.later = SentencePieceProcessor(model_proto=spec.SerializeToString())

    def lengths(self, texts: list[str], begins: bool) -> list[int]:
        return [len(ids) for ids in (self.first if begins else self.later).encode(texts, num_threads=1)]

    def segments(self, text: str, size: int = SEGMENT) -> list[str]:
        """The text cut at safe boundaries, each segment as short as one of ``size`` characters can be."""
        out, begin, at = [], 0, size
        while self.cuts and at < len(text):
            if text[at - 1 : at + 1].replace(BLANK, ESCAPED) in self.side_by_side:
                at += 1
                continue
            out.append(text[begin:at])
            begin, at = at, at + size
        return [*out, text[begin:]]


class Library:
    """A tokenizer of the tokenizers library that counts."""

    def __init__(self, model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def lengths(self, texts: list[str], begins: bool) -> list[int]:
        return [len(x.ids) for x in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def segments(self, text: str, size: int = SEGMENT) -> list[str]:
        return [text]


_BUILT: dict[str, Pieces | Library] = {}


def counter(kind: type, model: bytes) -> Pieces | Library:
    """The tokenizer, made once by each worker."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = kind(model)
    return _BUILT[key]


def calls(sizes: np.ndarray, call_bytes: int = CALL_BYTES) -> np.ndarray:
    """The library call of each segment: as many calls as the bytes ask for, with like shares of them."""
    total = int(sizes.sum())
    n = max(1, total // call_bytes)
    middle = np.cumsum(sizes) - sizes / 2
    return np.minimum(n - 1, (middle * n / max(1, total)).astype(np.int64))


def count_batch(machine: Pieces | Library, texts: list[str], segment: int = SEGMENT, call_bytes: int = CALL_BYTES) -> np.ndarray:
    """Tokens of each text."""
    pieces = [(i, k == 0, part) for i, text in enumerate(texts) for k, part in enumerate(machine.segments(text, segment))]
    out = np.zeros(len(texts), np.int64)
    for begins in (True, False):  # few segments are later ones; they go to calls of their own
        some = [(i, part) for i, first, part in pieces if first is begins]
        if not some:
            continue
        owner = np.array([i for i, _ in some])
        call = calls(np.array([len(part.encode()) for _, part in some]), call_bytes)
        for a, b in zip(*_edges(call), strict=True):
            np.add.at(out, owner[a:b], machine.lengths([part for _, part in some[a:b]], begins))
    return out


def _edges(call: np.ndarray) -> tuple[list[int], list[int]]:
    first = np.flatnonzero(np.append(True, call[1:] != call[:-1]))
    return first.tolist(), np.append(first[1:], len(call)).tolist()


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens) of every row."""
    with open(tokenizer_path, "rb") as file:
        model = file.read()
    kind = Pieces if tokenizer_path.endswith(".model") else Library

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = counter(kind, model)
        for batch in batches:
            column = pc.fill_null(batch.column("text"), "")
            sizes = pc.binary_length(column).to_numpy(zero_copy_only=False)
            n_tokens = np.zeros(len(sizes), np.int64)
            step = np.cumsum(sizes.astype(np.int64)) // (8 * CALL_BYTES) if len(sizes) else sizes
            for a, b in zip(*_edges(step), strict=True) if len(sizes) else ():
                n_tokens[a:b] = count_batch(machine, column.slice(a, b - a).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(n_tokens > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(count, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
