"""Scoring one partition or a range of them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidegate import schemas
from tidegate.config import JobConfig
from tidegate.operators.evaluate import evaluate
from tidegate.operators.features import feature_view, labelled
from tidegate.operators.predictions import predict
from tidegate.sources.tables import partition, partitions, replace_partitions


def score_partition(spark: SparkSession, cfg: JobConfig, scorer) -> dict[str, int]:
    """Replace the target date's predictions.

    No shuffle: each task scores and writes the rows it read, and those are
    already sorted by vendor inside the feature files.
    """
    view = feature_view(spark.table(cfg.features_table))
    scored = predict(partition(view, cfg.target), scorer, cfg.model_name, cfg.target)
    return replace_partitions(spark, scored, cfg.predictions_table, [cfg.target])


def score_dates(spark: SparkSession, cfg: JobConfig, scorer, days: list[dt.date]) -> dict[str, int]:
    """E5, range form: many dates in one job, each landing in its own partition."""
    view = feature_view(spark.table(cfg.features_table))
    wanted = view.where(F.col("scoring_date").isin(days))
    return replace_partitions(spark, predict(wanted, scorer, cfg.model_name), cfg.predictions_table, days)


def evaluate_window(view, scorer, first: dt.date, last: dt.date, min_roc_auc: float | None = None):
    """Metrics over a trailing window of dates whose labels have matured."""
    rows = labelled(partitions(view, first, last))
    return evaluate(scorer.score(rows), [], schemas.LABEL, min_roc_auc=min_roc_auc)


def evaluate_partition(view, scorer, cfg: JobConfig):
    """M3 for the evaluation date."""
    return evaluate_window(view, scorer, cfg.eval_date, cfg.eval_date, cfg.min_roc_auc)
