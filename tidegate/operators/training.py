"""Training on time-ordered data."""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate import schemas
from tidegate.config import EVAL_SHARE
from tidegate.functions.scoring import scorer_of
from tidegate.operators.evaluate import evaluate
from tidegate.operators.features import labelled
from tidegate.operators.quantiles import exact_quantiles

MAX_ITERATIONS = 100


def split_cutoff(df: DataFrame, time_column: str = "pickup_datetime", eval_share: float = EVAL_SHARE) -> int | None:
    """The last training instant, in microseconds; a quantile, not a global sort."""
    micros = df.select(F.unix_micros(time_column).alias("t"))
    found = exact_quantiles(micros, {"t": [1.0 - eval_share]})["t"]
    return None if found is None else int(found[0])


def chronological_split(
    df: DataFrame, time_column: str = "pickup_datetime", eval_share: float = EVAL_SHARE
) -> tuple[DataFrame, DataFrame]:
    """The latest ``eval_share`` of the rows by time is held out."""
    cutoff = split_cutoff(df, time_column, eval_share)
    early = F.unix_micros(time_column) <= F.lit(cutoff)
    return df.where(early), df.where(~early)


def with_split(df: DataFrame, time_column: str = "pickup_datetime", eval_share: float = EVAL_SHARE) -> DataFrame:
    cutoff = split_cutoff(df, time_column, eval_share)
    return df.withColumn("split", F.when(F.unix_micros(time_column) <= F.lit(cutoff), "train").otherwise("eval"))


def train(
    rows: DataFrame,
    numeric: tuple[str, ...] = schemas.NUMERIC_FEATURES,
    categorical: tuple[str, ...] = schemas.CATEGORICAL_FEATURES,
    label: str = schemas.LABEL,
) -> PipelineModel:
    """M1: logistic regression, standardised numbers, one-hot categories, no class weights."""
    indexed = [f"{c}_index" for c in categorical]
    encoded = [f"{c}_onehot" for c in categorical]
    stages = []
    if categorical:
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True))
    stages.append(VectorAssembler(inputCols=[*numeric, *encoded], outputCol="features", handleInvalid="skip"))
    stages.append(
        LogisticRegression(labelCol=label, maxIter=MAX_ITERATIONS, standardization=True, regParam=0.0, aggregationDepth=3)
    )
    columns = [*numeric, *categorical, label]
    # Every iteration reads the rows again; spilled blocks and lost executors recompute from the scan.
    kept = rows.select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return Pipeline(stages=stages).fit(kept)
    finally:
        kept.unpersist()


def train_and_evaluate(rows: DataFrame, numeric=schemas.NUMERIC_FEATURES, categorical=schemas.CATEGORICAL_FEATURES):
    """M1 with its holdout metrics."""
    early, late = chronological_split(labelled(rows))
    model = train(early, numeric, categorical)
    metrics = evaluate(scorer_of(model).score(late), [], schemas.LABEL)
    return model, metrics


def compare_feature_sets(rows: DataFrame, feature_sets: dict[str, tuple[str, ...]]) -> DataFrame:
    """M6: holdout metrics of one model per numeric feature list, side by side."""
    reports = []
    for name, numeric in feature_sets.items():
        _, metrics = train_and_evaluate(rows, numeric)
        reports.append(metrics.withColumn("feature_set", F.lit(name)))
    out = reports[0]
    for report in reports[1:]:
        out = out.unionByName(report)
    return out.select("feature_set", "labelled_rows", "roc_auc", "accuracy", "log_loss")
