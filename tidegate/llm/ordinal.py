"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A document's grade is one of 0 < 1 < 2: toxic, of low quality, good. The model has one
weight for each bucket of hashed text features, shared by all grades, and ordered
thresholds: P(grade <= k) = logistic(threshold[k] - score), where score is the sum of
the weights of the features a document has. The expected grade and the tail probability
P(grade >= 2) are for selection. Features are the distinct words, the distinct shapes of
blank-separated words with how common each is, and how much the words repeat.

It is fitted on the driver from the features of at most ``SAMPLE`` labelled documents
(those with the smallest hash of their id), a fixed bound, by proximal gradient steps:
the likelihood's gradient, then a shrinking of each weight, which leaves the weights of
words that say nothing at zero. Scoring covers every document and its whole text.

Defined results: a null or empty text has one feature, that it is empty. A label that is
null or of a document that is not there is left out; of several labels of a document the
lowest grade counts. Without labels of two grades every document gets the top grade with
probability 1. Repeated rows and rows without an id are scored like others. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.bpe import steps
from tidegate.llm.textkit import IS_BREAK, U64, Texts, Words, grouped, mix, span_hash

SAMPLE = 12_000
#: Labelled documents that must have a feature for it to get a weight.
SUPPORT = 3
BUCKETS = 1 << 20
GRADES = 3
#: Bytes by the kind of sign a word's shape shows: letters A and a, digit 0, other bytes as they are.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[65:91], _SHAPE[97:123], _SHAPE[48:58], _SHAPE[128:] = 65, 97, 48, 97
_EDGES = np.array([0.02, 0.1, 0.3, 0.6])


def _distinct(owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, value, count) of the distinct pairs."""
    order, new = grouped(mix(value ^ mix(owner.astype(U64) + U64(1))))
    first = order[new]
    return owner[first], value[first], np.diff(np.append(np.flatnonzero(new), len(order)))


def _shapes(texts: Texts, words: Words) -> np.ndarray:
    """A hash of each word's signs with runs of one sign as one."""
    kind = _SHAPE[texts.buf]
    turn = np.ones(len(kind), bool)
    turn[1:] = kind[1:] != kind[:-1]
    turn[words.begin] = True
    place = np.append(0, np.cumsum(turn))
    short = kind[turn]
    return span_hash(short, place[words.begin], place[words.end])


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all texts end to end, each text's sorted and distinct, and where each text begins."""
    n = len(texts)
    lower = Texts.__new__(Texts)
    lower.buf, lower.start, lower.stop = np.where(_SHAPE[texts.buf] == 65, texts.buf + 32, texts.buf).astype(np.uint8), texts.start, texts.stop
    words = Words(lower, IS_BREAK)
    owner, value, _ = _distinct(words.text, span_hash(lower.buf, words.begin, words.end))
    distinct = np.bincount(owner, minlength=n)
    repeat = 1 - distinct / np.maximum(words.count, 1)
    tokens = Words(texts)
    shape_owner, shape, count = _distinct(tokens.text, _shapes(texts, tokens))
    common = np.searchsorted(_EDGES, count / np.maximum(tokens.count, 1)[shape_owner])
    everyone = np.arange(n)
    owners = np.concatenate((owner, shape_owner, everyone, everyone))
    values = np.concatenate(
        (
            value,
            mix(shape + U64(11)) ^ mix(common.astype(U64) + U64(23)),
            mix(np.searchsorted(np.arange(0.1, 1, 0.1), repeat).astype(U64) + U64(1000)),
            mix((words.count == 0).astype(U64) + U64(2000)),
        )
    )
    keys = owners.astype(U64) * U64(BUCKETS) + (mix(values) >> U64(44))
    keys.sort()
    keep = np.ones(len(keys), bool)
    keep[1:] = keys[1:] != keys[:-1]
    keys = keys[keep]
    starts = np.searchsorted(keys, np.arange(n + 1, dtype=U64) * U64(BUCKETS))
    return (keys % U64(BUCKETS)).astype(np.int32), starts


@dataclass
class Ordinal:
    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, buckets: np.ndarray, starts: np.ndarray) -> np.ndarray:
        sums = np.append(0.0, np.cumsum(self.weights[buckets]))
        return sums[starts[1:]] - sums[starts[:-1]]

    def grades(self, scores: np.ndarray) -> np.ndarray:
        """Probability of each grade."""
        below = logistic(self.thresholds[None, :] - scores[:, None])
        whole = np.concatenate((np.zeros((len(scores), 1)), below, np.ones((len(scores), 1))), axis=1)
        return np.diff(whole, axis=1)

    @staticmethod
    def constant() -> Ordinal:
        return Ordinal(np.zeros(BUCKETS), np.full(GRADES - 1, -np.inf))


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def likelihood(model: Ordinal, buckets: np.ndarray, starts: np.ndarray, grade: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean log-likelihood and its derivatives by each document's score and by the thresholds."""
    score = model.scores(buckets, starts)
    edges = np.concatenate(([-np.inf], model.thresholds, [np.inf]))
    low, high = logistic(edges[grade] - score), logistic(edges[grade + 1] - score)
    low[grade == 0], high[grade == GRADES - 1] = 0, 1
    chance = np.maximum(high - low, 1e-12)
    by_low, by_high = low * (1 - low), high * (1 - high)
    by_threshold = np.zeros(GRADES + 1)
    np.add.at(by_threshold, grade, -by_low / chance)
    np.add.at(by_threshold, grade + 1, by_high / chance)
    n = len(grade)
    return float(np.log(chance).mean()), (by_low - by_high) / chance / n, by_threshold[1:-1] / n


def fit(
    buckets: np.ndarray, starts: np.ndarray, grade: np.ndarray, shrink: float = 2e-4, rounds: int = 300, rate: float = 1.0, support: int = SUPPORT
) -> Ordinal:
    """Proximal gradient ascent; each weight's steps shorten with its own past gradients."""
    share = np.clip(np.cumsum(np.bincount(grade, minlength=GRADES))[:-1] / len(grade), 1e-3, 1 - 1e-3)
    thresholds = np.log(share / (1 - share))
    thresholds = np.maximum.accumulate(thresholds + np.arange(GRADES - 1) * 1e-3)
    used = np.flatnonzero(np.bincount(buckets, minlength=BUCKETS) >= support)
    column = np.full(BUCKETS, -1, np.int32)
    column[used] = np.arange(len(used))
    keep = column[buckets] >= 0
    starts = np.append(0, np.cumsum(keep))[starts]
    buckets = column[buckets[keep]]
    model = Ordinal(np.zeros(len(used)), thresholds)
    past, past_thresholds = np.full(len(used), 1e-6), np.full(GRADES - 1, 1e-6)
    owner = np.repeat(np.arange(len(grade)), np.diff(starts))
    for _ in range(rounds):
        _, by_score, by_threshold = likelihood(model, buckets, starts, grade)
        slope = np.bincount(buckets, weights=by_score[owner], minlength=len(used))
        past += slope**2
        step = rate / np.sqrt(past)
        moved = model.weights + step * slope
        model.weights = np.sign(moved) * np.maximum(np.abs(moved) - step * shrink, 0)
        past_thresholds += by_threshold**2
        model.thresholds = model.thresholds + rate * by_threshold / np.sqrt(past_thresholds)
        model.thresholds = np.maximum.accumulate(model.thresholds)  # they stay in order
    weights = np.zeros(BUCKETS)
    weights[used] = model.weights
    return Ordinal(weights, model.thresholds)


def graded(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, grade) from the quality and toxic marks: 0 toxic, 1 low quality, 2 good."""
    grade: Column = F.when(F.col("toxic") > 0, 0).when(F.col("quality") > 0, 2).otherwise(1)
    marks = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isNotNull() & F.col("quality").isNotNull())
    return marks.select(F.col(id_col).cast("long").alias("doc_id"), grade.alias("grade")).groupBy("doc_id").agg(F.min("grade").alias("grade"))


def train_ordinal(docs: DataFrame, grades: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Ordinal:
    """Fit on at most ``sample`` rows of (doc_id, grade)."""
    chosen = grades.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.join(F.broadcast(chosen), "doc_id").select("grade", "text")  # at most ``sample`` rows

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text"):
                buckets, starts = features(Texts(part.column("text")))
                data = [buckets[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("grade"), pa.array(data, pa.binary())], names=["grade", "buckets"])

    # in a fixed order, so that the fit does not depend on how the rows arrive
    known = sorted((bytes(r.buckets), r.grade) for r in rows.mapInArrow(extract, "grade int, buckets binary").collect())
    if len({g for _, g in known}) < 2:
        return Ordinal.constant()
    starts = np.append(0, np.cumsum([len(x) // 4 for x, _ in known]))
    return fit(np.frombuffer(b"".join(x for x, _ in known), np.int32), starts, np.array([g for _, g in known]))


def score_documents(docs: DataFrame, model: Ordinal, keep_from: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, expected_grade, p_top = P(grade >= 2), p_toxic = P(grade 0), grade (the likeliest) and kept (p_top >= keep_from)."""
    used = np.flatnonzero(model.weights).astype(np.int32)
    weights, thresholds = model.weights[used], model.thresholds  # only these go with the tasks

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.zeros(BUCKETS)
        whole[used] = weights
        own = Ordinal(whole, thresholds)
        for batch in batches:
            for part in steps(batch, "text"):
                chance = own.grades(own.scores(*features(Texts(part.column("text")))))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(chance @ np.arange(GRADES)),
                        pa.array(chance[:, -1]),
                        pa.array(chance[:, 0]),
                        pa.array(chance.argmax(axis=1).astype(np.int32)),
                        pa.array(chance[:, -1] >= keep_from),
                    ],
                    names=["doc_id", "expected_grade", "p_top", "p_toxic", "grade", "kept"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id bigint, expected_grade double, p_top double, p_toxic double, grade int, kept boolean")
