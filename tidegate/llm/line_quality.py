"""Quality rules by labelling lines: a linear-chain conditional random field.

A text is its lines that have a word. Each line has binned features (case, signs,
lengths, repetition); the field has two labels, boilerplate (0) and content (1), a weight
for each feature value, and weights for neighbouring labels, the first and the last line.
Viterbi decoding gives the likeliest labels of all lines of a text together; the share of
words in content lines decides whether the text stays.

The field is trained from document labels: lines of a good document count as content,
those of a bad one as boilerplate. It is fitted on the driver from the line features of
at most ``SAMPLE`` labelled documents of each kind (those with the smallest hash of
their id), so training has a fixed bound; decoding covers every line of every document.

Defined results: a null text has no words and fails the base rule, as does any text of
fewer than 50 words or with more than half of its words in repeated windows. Documents
with equal features get equal results; a tie in Viterbi goes to content. Without good
and bad labelled documents the field is neutral and only the base rule decides. Repeated
rows and rows without an id are judged like others. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.bpe import steps
from tidegate.llm.textkit import Texts, Words, covered, first_alike, grouped, heads, mix, span_hash, window_hash

#: Labelled documents of each kind that the field is fitted on.
SAMPLE = 1500
MIN_WORDS = 50
MAX_REPEATED = 0.5
CONTENT_SHARE = 0.5
# The signs that the base rule counts.
SYMBOLS = "#*$%&|<>"

_SHARES = np.array([0.01, 0.05, 0.1, 0.2, 0.35, 0.5, 0.75])
_COUNTS = np.array([2, 4, 8, 16, 32, 64, 128, 256])
_LENGTHS = np.array([2, 3, 4, 5, 6, 8, 10, 14])
#: Edges of the bins of each feature, in the order that Lines.features fills them.
BINS = (_SHARES, _SHARES, _SHARES, _SHARES, _COUNTS, _LENGTHS, _SHARES, _SHARES, np.array([0.5]))
_OFFSETS = np.append(0, np.cumsum([len(b) + 1 for b in BINS]))
N_FEATURES = int(_OFFSETS[-1])


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_IS_SYMBOL = _table(SYMBOLS.encode())
_IS_UPPER = _table(bytes(range(65, 91)))
_IS_DIGIT = _table(bytes(range(48, 58)))
_IS_MARK = _table(b"!?;:\"()[]{}=+/\\_~^@`")


class Lines:
    """Word and line counts of a batch of texts, and the features of each line that has a word."""

    def __init__(self, texts: Texts):
        self.n = len(texts)
        buf = texts.buf
        words = Words(texts)
        hashes = span_hash(buf, words.begin, words.end)
        self.n_words = words.count
        lead = np.append(0, np.cumsum((buf & 0xC0) != 0x80))
        word_chars = lead[words.end] - lead[words.begin]
        self.word_chars = np.bincount(words.text, weights=word_chars, minlength=self.n).astype(np.int64)
        symbols = np.append(0, np.cumsum(_IS_SYMBOL[buf]))
        self.n_symbols = symbols[texts.stop] - symbols[texts.start]
        self._repeats(words, hashes, first_alike(buf, words.begin, words.end))
        # lines with a word
        breaks = np.flatnonzero(buf == 10)
        full = texts.stop > texts.start
        begin = np.unique(np.concatenate((texts.start[full], breaks + 1)))
        begin = begin[begin < len(buf)]
        stops, breaks = np.unique(texts.stop[full]), np.append(breaks, len(buf))
        end = begin
        if len(begin):
            end = np.minimum(stops[np.searchsorted(stops, begin, side="right")], breaks[np.searchsorted(breaks, begin)])
        first = np.searchsorted(words.begin, begin)
        count = np.searchsorted(words.begin, end) - first
        has = count > 0
        begin, end, first, count = begin[has], end[has], first[has], count[has]
        self.text = words.text[first]
        self.words = count
        self.first = np.searchsorted(self.text, np.arange(self.n))
        self.lines = np.bincount(self.text, minlength=self.n)
        duplicate = first_alike(buf, begin, end, self.text) != np.arange(len(begin))
        self.n_dup_lines = np.bincount(self.text[duplicate], minlength=self.n)
        chars = np.maximum(lead[end] - lead[begin], 1)

        def share(table: np.ndarray) -> np.ndarray:
            sums = np.append(0, np.cumsum(table[buf]))
            return (sums[end] - sums[begin]) / chars

        line = np.repeat(np.arange(len(begin)), count)
        order, new = grouped(mix(hashes[_indices(first, count)] ^ mix(line.astype(np.uint64) + np.uint64(7))))
        distinct = np.bincount(line[order[new]], minlength=len(begin))
        same = np.zeros(len(hashes) + 1, np.int64)
        same[1:-1] = hashes[1:] == hashes[:-1]
        same = np.append(0, np.cumsum(same))
        ends = np.append(0, np.cumsum(word_chars))
        values = (
            share(_IS_UPPER),
            share(_IS_SYMBOL),
            share(_IS_MARK),
            share(_IS_DIGIT),
            count,
            (ends[first + count] - ends[first]) / np.maximum(count, 1),
            1 - distinct / np.maximum(count, 1),
            (same[first + count] - same[first + 1]) / np.maximum(count, 1),
            duplicate,
        )
        self.features = np.stack([np.searchsorted(b, v, side="right") + o for b, v, o in zip(BINS, values, _OFFSETS, strict=False)], axis=1).astype(np.int32)

    def _repeats(self, words: Words, hashes: np.ndarray, same: np.ndarray) -> None:
        """``same``: each word's first equal word."""
        at = np.flatnonzero(words.window_ok(3))
        value = window_hash(hashes, 3)[at] if len(at) else np.zeros(0, np.uint64)
        text = words.text[at]
        head = heads(*grouped(mix(value ^ mix(text.astype(np.uint64) + np.uint64(3)))))
        like = text == text[head]
        for k in range(3):
            like &= same[at + k] == same[at[head] + k]
        if not like.all():  # different windows that share a hash
            first: dict[tuple[int, ...], int] = {}
            for i in np.flatnonzero(np.isin(head, head[~like])).tolist():
                head[i] = first.setdefault((int(text[i]), *same[at[i] : at[i] + 3].tolist()), i)
        again = np.bincount(head, minlength=len(head))[head] > 1
        self.n_repeat_words = np.bincount(words.text[covered(at[again], 3, len(words))], minlength=self.n)


def _indices(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    ends = np.cumsum(count)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - (ends - count), count)


@dataclass
class Field:
    """Scores: ``weights`` of a feature for content; ``turns[a, b]`` of label b after a; ``start`` and ``stop`` by label."""

    weights: np.ndarray
    turns: np.ndarray
    start: np.ndarray
    stop: np.ndarray

    @staticmethod
    def neutral() -> Field:
        return Field(np.zeros(N_FEATURES), np.zeros((2, 2)), np.zeros(2), np.zeros(2))

    def scores(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((len(features), 2))
        out[:, 1] = self.weights[features].sum(axis=1)
        return out


def _by_length(lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with lines, longest first, and for each step how many of them have that line."""
    order = np.argsort(-lines, kind="stable")
    order = order[lines[order] > 0]
    longest = int(lines[order[0]]) if len(order) else 0
    return order, np.searchsorted(-lines[order], -np.arange(longest), side="left")


def viterbi(field: Field, features: np.ndarray, first: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """The likeliest label of every line; texts go step by step together, those with more lines longer."""
    score = field.scores(features)
    order, alive = _by_length(lines)
    out = np.zeros(len(features), np.int8)
    if not len(order):
        return out
    start, size = first[order], lines[order]
    best = score[start] + field.start
    came = np.zeros((len(features), 2), np.int8)
    for step in range(1, len(alive)):
        n = alive[step]
        at = start[:n] + step
        through = best[:n, :, None] + field.turns
        came[at] = through[:, 1] >= through[:, 0]
        best[:n] = through.max(axis=1) + score[at]
    label = ((best + field.stop)[:, 1] >= (best + field.stop)[:, 0]).astype(np.int8)
    for step in range(len(alive) - 1, -1, -1):
        n = alive[step]
        at = start[:n] + step
        out[at] = label[:n]
        if step:
            label[:n] = came[at, label[:n]]
    assert (size > 0).all()
    return out


def gradient(field: Field, features: np.ndarray, first: np.ndarray, lines: np.ndarray, labels: np.ndarray) -> tuple[float, Field]:
    """Mean log-likelihood of the labels for each text, and its gradient, by the forward-backward recursion."""
    score = field.scores(features)
    order, alive = _by_length(lines)
    start, size = first[order], lines[order]
    forward, backward = np.zeros_like(score), np.zeros_like(score)
    forward[start] = score[start] + field.start
    for step in range(1, len(alive)):
        at = start[: alive[step]] + step
        forward[at] = np.logaddexp.reduce(forward[at - 1][:, :, None] + field.turns, axis=1) + score[at]
    last = start + size - 1
    whole = np.logaddexp.reduce(forward[last] + field.stop, axis=1)
    backward[last] = field.stop
    for step in range(len(alive) - 1, 0, -1):
        at = start[: alive[step]] + step
        backward[at - 1] = np.where(
            (at - 1 == last[: alive[step]])[:, None], backward[at - 1], np.logaddexp.reduce(field.turns + (score[at] + backward[at])[:, None, :], axis=2)
        )
    total = np.zeros(len(score))
    total[_indices(start, size)] = np.repeat(whole, size)
    near = np.exp(forward + backward - total[:, None])
    n = max(1, len(order))
    inner = np.setdiff1d(_indices(start, size), start)
    pair = np.exp(forward[inner - 1][:, :, None] + field.turns + (score[inner] + backward[inner])[:, None, :] - total[inner][:, None, None])
    truth = np.eye(2)[labels]
    turns = np.zeros((2, 2))
    np.add.at(turns, (labels[inner - 1], labels[inner]), 1)
    value = score[np.arange(len(score)), labels].sum() + (field.turns * turns).sum() + field.start[labels[start]].sum() + field.stop[labels[last]].sum() - whole.sum()
    change = Field(
        np.bincount(features.ravel(), weights=np.repeat(labels - near[:, 1], features.shape[1]), minlength=N_FEATURES) / n,
        (turns - pair.sum(axis=0)) / n,
        (truth[start] - near[start]).sum(axis=0) / n,
        (truth[last] - near[last]).sum(axis=0) / n,
    )
    return value / n, change


def fit(features: np.ndarray, first: np.ndarray, lines: np.ndarray, labels: np.ndarray, rounds: int = 80, rate: float = 0.3, ridge: float = 1e-3) -> Field:
    """Gradient ascent with step sizes by each weight's own history."""
    field = Field.neutral()
    past = Field.neutral()
    for _ in range(rounds):
        _, change = gradient(field, features, first, lines, labels)
        for name in ("weights", "turns", "start", "stop"):
            weight, step, history = getattr(field, name), getattr(change, name), getattr(past, name)
            step = step - ridge * weight
            history += step**2
            weight += rate * step / np.sqrt(history + 1e-8)
    return field


def train_field(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", quality_col: str = "quality") -> Field:
    """Fit the field on the lines of at most ``sample`` good and as many bad labelled documents."""
    marks = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(quality_col).cast("int").alias("quality")).dropna()
    marks = marks.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    picked = [marks.where(F.col("quality") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for k in (0, 1)]
    chosen = picked[0].unionByName(picked[1])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.join(F.broadcast(chosen), "doc_id").select("quality", "text")  # at most 2 * sample rows

    def line_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text"):
                found = Lines(Texts(part.column("text")))
                data = [found.features[a : a + n].tobytes() for a, n in zip(found.first, found.lines, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("quality"), pa.array(data, pa.binary())], names=["quality", "lines"])

    # in a fixed order, so that the fit does not depend on how the rows arrive
    known = sorted((bytes(r.lines), r.quality) for r in rows.mapInArrow(line_features, "quality int, lines binary").collect() if len(r.lines))
    if len({q > 0 for _, q in known}) < 2:
        return Field.neutral()
    features = [np.frombuffer(x, np.int32).reshape(-1, len(BINS)) for x, _ in known]
    lines = np.array([len(x) for x in features])
    first = np.append(0, np.cumsum(lines))[:-1]
    return fit(np.concatenate(features), first, lines, np.repeat(np.array([int(q > 0) for _, q in known]), lines))


def judge_lines(
    docs: DataFrame, field: Field, content_share: float = CONTENT_SHARE, min_words: int = MIN_WORDS, max_repeated: float = MAX_REPEATED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Counts of the base rule, base_failed, the share of words in content lines, kept, and each line's label."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text"):
                found = Lines(Texts(part.column("text")))
                label = viterbi(field, found.features, found.first, found.lines)
                content = np.bincount(found.text, weights=found.words * label, minlength=found.n)
                share = content / np.maximum(found.n_words, 1)
                failed = (found.n_words < min_words) | (found.n_repeat_words > max_repeated * found.n_words)
                offsets = np.append(found.first, len(label)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        *(pa.array(x, pa.int64()) for x in (found.n_words, found.word_chars, found.n_symbols, found.n_dup_lines, found.n_repeat_words)),
                        pa.array(failed),
                        pa.array(~failed & (share >= content_share)),
                        pa.array(share),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(label)),
                    ],
                    names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share", "line_labels"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(
        judge,
        "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
        "base_failed boolean, kept boolean, content_share double, line_labels array<tinyint>",
    )
