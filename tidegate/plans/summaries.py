"""Keeping the summaries of dates beside the feature table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tidegate import schemas
from tidegate.config import JobConfig
from tidegate.operators.summaries import FEATURE_SKETCHES, SCORE_COUNTS, feature_sketches, score_counts
from tidegate.sources.tables import create_table, replace_partitions


def sketch_table(cfg: JobConfig) -> str:
    return f"{cfg.features_table}_sketches"


def score_table(cfg: JobConfig) -> str:
    return f"{cfg.features_table}_score_counts"


def summarise_dates(spark: SparkSession, cfg: JobConfig, view: DataFrame, scorer, days: list[dt.date]) -> dict[str, int]:
    """Replace the summaries of ``days`` by those of the view's rows; other dates stay as they are.

    Run after an ingest of the same dates; done twice it leaves the same rows. Counts of
    scores belong to one model, so a new model needs its dates summarised again.
    """
    create_table(spark, sketch_table(cfg), FEATURE_SKETCHES, cfg.table_root)
    create_table(spark, score_table(cfg), SCORE_COUNTS, cfg.table_root)
    rows = view.where(view["scoring_date"].isin(days))
    sketches = replace_partitions(spark, feature_sketches(rows, list(schemas.NUMERIC_FEATURES)), sketch_table(cfg), days)
    counts = replace_partitions(spark, score_counts(scorer.score(rows), schemas.LABEL), score_table(cfg), days)
    return {"sketches": sketches["rows_written"], "score_counts": counts["rows_written"]}
