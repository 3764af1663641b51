"""The nightly run and backfills: guard, evaluate, score and record, for one date or many."""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import schemas
from tidegate.config import EXIT_FAILED, EXIT_HALTED, JobConfig
from tidegate.operators.drift import psi_matrix
from tidegate.operators.evaluate import evaluate
from tidegate.operators.features import labelled, register_feature_view
from tidegate.operators.guards import DriftDetected, InsufficientData, require_baseline, require_stable, require_volume
from tidegate.plans.ingest import ingest_partition
from tidegate.plans.ledger import RunOutcome, record_runs
from tidegate.plans.scoring import score_dates
from tidegate.sources.tables import partition_counts, partitions


def guarded(view: DataFrame, cfg: JobConfig, runs: dict[dt.date, RunOutcome]) -> list[dt.date]:
    """G1, G2 for all dates: volumes and PSIs in one pass each; returns the dates that pass.

    Volume comes first, then the baseline, then drift. Dates that halt get their outcome,
    and the PSI of the rows they have.
    """
    volumes = partition_counts(view, runs)
    for day, run in runs.items():
        try:
            require_volume(volumes[day], cfg, day)
        except InsufficientData as halt:
            runs[day] = replace(run, exit_code=EXIT_HALTED, error=halt)
    asked = [day for day, run in runs.items() if run.error is None]
    if not any(volumes.values()):
        return []
    window = (cfg.baseline_start, cfg.baseline_end)
    baseline_rows = 0
    psis: dict[dt.date, float | None] = {}
    wanted = F.col("scoring_date").isin(list(runs))
    in_baseline = F.col("scoring_date").between(F.lit(window[0]), F.lit(window[1]))
    for row in psi_matrix(view.where(wanted | in_baseline), [cfg.canary_feature], window).where(wanted).collect():
        psis[row["scoring_date"]], baseline_rows = row["total_psi"], row["baseline_rows"]
    passed = []
    runs |= {day: replace(run, psi=psis.get(day)) for day, run in runs.items() if run.error is not None}
    for day in asked:
        try:
            require_baseline(baseline_rows, cfg)
            runs[day] = replace(runs[day], psi=require_stable(psis.get(day), cfg))
            passed.append(day)
        except DriftDetected as halt:
            runs[day] = replace(runs[day], exit_code=EXIT_HALTED, error=halt, psi=halt.psi)
        except InsufficientData as halt:
            runs[day] = replace(runs[day], exit_code=EXIT_HALTED, error=halt)
    return passed


def quality(view: DataFrame, scorer, cfg: JobConfig, days: list[dt.date]) -> dict[dt.date, float | None]:
    """M3 for all dates in one job: the AUC of each date's evaluation date."""
    lag = dt.timedelta(days=cfg.eval_label_lag_days)
    matured = partitions(view, min(days) - lag, max(days) - lag).where(F.col("scoring_date").isin([d - lag for d in days]))
    rows = evaluate(scorer.score(labelled(matured)), ["scoring_date"], schemas.LABEL).collect()
    found = {row["scoring_date"]: row["roc_auc"] for row in rows}
    return {day: found.get(day - lag) for day in days}


def run_dates(
    spark: SparkSession, cfg: JobConfig, scorer, days: list[dt.date], source: DataFrame | None = None, execution: str = "local"
) -> list[RunOutcome]:
    """Guard, evaluate and score dates with a fixed number of jobs, and record every one of them.

    Dates that pass are scored and replaced in one write; dates that halt keep the
    predictions they had. An error fails the dates that no guard has halted. Whatever
    happens, each date leaves a ledger row.
    """
    started = time.monotonic()
    runs = {day: RunOutcome(day, cfg.psi_threshold, min_roc_auc=cfg.min_roc_auc, execution=execution) for day in days}
    try:
        if source is not None:
            ingest_partition(spark, cfg, source)
        view = register_feature_view(spark, cfg.features_table, cfg.feature_view)
        passed = guarded(view, cfg, runs)
        if passed:
            for day, auc in quality(view, scorer, cfg, passed).items():
                runs[day] = replace(runs[day], roc_auc=auc)
            score_dates(spark, cfg, scorer, passed)
            written = partition_counts(spark.table(cfg.predictions_table), passed)
            runs |= {day: replace(runs[day], rows_scored=written[day]) for day in passed}
    except Exception as failure:
        runs |= {day: replace(run, exit_code=EXIT_FAILED, error=failure) for day, run in runs.items() if run.error is None}
    finally:
        took = time.monotonic() - started
        done = record_runs(spark, cfg, [replace(runs[day], duration_s=took) for day in days])
    return done


def run_nightly(spark: SparkSession, cfg: JobConfig, scorer, source: DataFrame | None = None, execution: str = "local") -> RunOutcome:
    """The target date, after its ingest."""
    return run_dates(spark, cfg, scorer, [cfg.target], source, execution)[0]


def backfill(spark: SparkSession, cfg: JobConfig, scorer, days: list[dt.date]) -> list[RunOutcome]:
    """E5: the same run for many dates at once, without ingest."""
    return run_dates(spark, cfg, scorer, days)
