"""Filling the feature table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.config import JobConfig
from tidegate.functions.rows import on_day, remap_day, replay_source_date, within_days
from tidegate.operators.features import feature_rows, source_window, without_populated_dates
from tidegate.sources.tables import clustered, is_populated, partition_counts, replace_partitions, replace_table


def replay_rows(source: DataFrame, cfg: JobConfig) -> DataFrame:
    """Feature rows of the target date, taken from its day in the replay window."""
    day = replay_source_date(cfg.target, cfg.replay_start, cfg.replay_days)
    return feature_rows(source.where(on_day("pickup_datetime", day)), F.lit(cfg.target))


def ingest_partition(spark: SparkSession, cfg: JobConfig, source: DataFrame | None) -> int:
    """Fill the target partition unless it holds rows; rows inserted, 0 = skipped.

    The check reads one pruned partition and stops at the first row. The date is
    written by replacing it, so two runs that overlap leave its rows once.
    """
    if not cfg.enable_replay_ingest or source is None:
        return 0
    if is_populated(spark.table(cfg.features_table), cfg.target):
        return 0
    rows = clustered(replay_rows(source, cfg))
    return replace_partitions(spark, rows, cfg.features_table, [cfg.target])["rows_written"]


def replay_dates(source: DataFrame, cfg: JobConfig, days: list[dt.date]) -> DataFrame:
    """Feature rows of many target dates, each taken from its day in the replay window.

    The source is scanned once, over the days that serve a target; a day that serves
    several gives its rows to each. The map has one row for each target date.
    """
    pairs = [(replay_source_date(day, cfg.replay_start, cfg.replay_days), day) for day in days]
    served = source.sparkSession.createDataFrame(pairs, "source_day date, target_day date")
    picked = source.where(within_days("pickup_datetime", min(a for a, _ in pairs), max(a for a, _ in pairs)))
    rows = picked.withColumn("source_day", F.to_date("pickup_datetime")).join(F.broadcast(served), "source_day")
    return feature_rows(rows, F.col("target_day"))


def ingest_dates(spark: SparkSession, cfg: JobConfig, source: DataFrame | None, days: Iterable[dt.date]) -> dict[str, int]:
    """E1, J6 for many dates: fill those of ``days`` that hold no row, in a number of jobs that does not follow them.

    Which dates are held is asked once; held ones are left out of the scan and of the rows.
    The others are written together, each by replacing it, so that runs that overlap leave
    a date's rows once and a run that dies leaves each date as it was or filled.
    """
    days = sorted(set(days))
    if not cfg.enable_replay_ingest or source is None or not days:
        return {"dates_written": 0, "dates_skipped": len(days), "rows_written": 0}
    counts = partition_counts(spark.table(cfg.features_table), days)
    missing = [day for day in days if not counts[day]]
    if not missing:
        return {"dates_written": 0, "dates_skipped": len(days), "rows_written": 0}
    held = spark.createDataFrame([(day,) for day in days if counts[day]], "scoring_date date")
    rows = clustered(without_populated_dates(replay_dates(source, cfg, missing), held))
    written = replace_partitions(spark, rows, cfg.features_table, missing)["rows_written"]
    return {"dates_written": len(missing), "dates_skipped": len(days) - len(missing), "rows_written": written}


def seed_rows(
    source: DataFrame,
    train: tuple[dt.date, dt.date],
    scoring_day: dt.date,
    backfill_day: dt.date,
    run_date: Column | None = None,
) -> DataFrame:
    """Training window, one day remapped to the day before the run, one backfill day."""
    picked = source_window(source, *train, scoring_day, backfill_day)
    source_date = F.to_date("pickup_datetime")
    return feature_rows(picked, remap_day(source_date, scoring_day, run_date))


def seed(
    spark: SparkSession,
    cfg: JobConfig,
    source: DataFrame,
    train: tuple[dt.date, dt.date],
    scoring_day: dt.date,
    backfill_day: dt.date,
    run_date: Column | None = None,
) -> int:
    """Replace the feature table with the seed rows."""
    rows = seed_rows(source, train, scoring_day, backfill_day, run_date)
    return replace_table(spark, rows, cfg.features_table)
