"""Logistic scoring as plain column algebra."""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field
from functools import reduce
from operator import add

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import OneHotEncoderModel, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.rows import above

PROBABILITY_CLIP = 1e-15


@dataclass(frozen=True)
class LinearScorer:
    """Frozen coefficients: scoring stays in whole-stage codegen, no ML transform."""

    intercept: float
    numeric: dict[str, float]
    categorical: dict[str, dict[str, float]] = field(default_factory=dict)

    def probability(self) -> Column:
        """NULL for a row with a NULL number, NaN for one with a NaN; an unseen category adds nothing."""
        terms = [F.lit(float(self.intercept))]
        terms += [F.col(c).cast("double") * F.lit(float(w)) for c, w in self.numeric.items()]
        terms += [looked_up(F.col(c), weights) for c, weights in self.categorical.items() if weights]
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-reduce(add, terms)))

    def score(self, df: DataFrame) -> DataFrame:
        return df.withColumn("p1", self.probability())


def looked_up(value: Column, weights: dict[str, float]) -> Column:
    """The weight of a value, 0 for any other: a table of small maps, found by the value's hash."""
    buckets: dict[int, list[Column]] = {}
    n = max(1, len(weights) // 4)
    for key, weight in weights.items():
        buckets.setdefault(zlib.crc32(key.encode()) % n, []).extend((F.lit(key), F.lit(float(weight))))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))
    table = F.array(*[F.create_map(*buckets[i]) if i in buckets else empty for i in range(n)])
    slot = F.pmod(F.crc32(F.coalesce(value, F.lit(""))), F.lit(n)).cast("int") + 1
    return F.coalesce(F.element_at(F.element_at(table, slot), value), F.lit(0.0))


def scorer_of(model: PipelineModel) -> LinearScorer:
    """A fitted logistic model as column algebra, for any number of categories (M2)."""
    logistic = next(s for s in model.stages if isinstance(s, LogisticRegressionModel))
    indexers = [s for s in model.stages if isinstance(s, StringIndexerModel)]
    encoders = [s for s in model.stages if isinstance(s, OneHotEncoderModel)]
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    labels = {
        column: list(values)
        for s in indexers
        for column, values in zip(s.getInputCols(), s.labelsArray, strict=True)
    }
    category_of = {}
    for encoder in encoders:
        for indexed, encoded in zip(encoder.getInputCols(), encoder.getOutputCols(), strict=True):
            for s in indexers:
                if indexed in s.getOutputCols():
                    category_of[encoded] = s.getInputCols()[s.getOutputCols().index(indexed)]
    weights = iter(logistic.coefficients.toArray().tolist())
    numeric: dict[str, float] = {}
    categorical: dict[str, dict[str, float]] = {}
    for name in assembler.getInputCols():
        if name in category_of:
            column = category_of[name]
            categorical[column] = {value: next(weights) for value in labels[column]}
        else:
            numeric[name] = next(weights)
    return LinearScorer(float(logistic.intercept), numeric, categorical)


def predicted_class(p1: Column) -> Column:
    return F.when(above(p1, 0.5), F.lit(1)).otherwise(F.lit(0)).cast("long")


def class_probs(p1: Column) -> Column:
    """One struct per class, the positive class first."""
    return F.array(
        F.struct(F.lit(1).cast("long").alias("label"), p1.alias("prob")),
        F.struct(F.lit(0).cast("long").alias("label"), (F.lit(1.0) - p1).alias("prob")),
    )


def prob_of(probs: Column, label: int) -> Column:
    return F.filter(probs, lambda e: e["label"] == label)[0]["prob"]


def clipped(p: Column) -> Column:
    return F.least(F.greatest(p, F.lit(PROBABILITY_CLIP)), F.lit(1.0 - PROBABILITY_CLIP))
