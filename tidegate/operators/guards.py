"""Checks that stop a run before it writes, and the reports they come from."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.config import JobConfig
from tidegate.operators.drift import psi_report
from tidegate.sources.tables import partition


class InsufficientData(Exception):
    """The target partition is missing or suspiciously small."""


class DriftDetected(Exception):
    """PSI reached the threshold."""

    def __init__(self, message: str, psi: float):
        super().__init__(message)
        self.psi = psi


def volume_report(view: DataFrame, min_row_count: int) -> DataFrame:
    """A1, G1 for every date at once; a count equal to the minimum passes."""
    return (
        view.groupBy("scoring_date")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("sufficient", F.col("row_count") >= min_row_count)
    )


def require_volume(row_count: int, cfg: JobConfig, day: dt.date) -> None:
    if row_count < cfg.min_row_count:
        raise InsufficientData(
            f"{day} holds {row_count:,} rows where at least {cfg.min_row_count:,} are needed; "
            "its load is missing or incomplete"
        )


def require_stable(psi: float | None, cfg: JobConfig) -> float:
    """The PSI already rounded halts at the threshold itself; NULL counts as 0."""
    value = 0.0 if psi is None else float(psi)
    if value >= cfg.psi_threshold:
        raise DriftDetected(
            f"{cfg.canary_feature} drifted: PSI is {value:.4f} (Threshold: {cfg.psi_threshold})",
            value,
        )
    return value


def require_baseline(rows: int, cfg: JobConfig) -> None:
    if rows < cfg.min_baseline_rows:
        raise InsufficientData(
            f"baseline {cfg.baseline_start}..{cfg.baseline_end} has {rows:,} usable rows, "
            f"below the minimum of {cfg.min_baseline_rows:,}"
        )


def check_volume(view: DataFrame, cfg: JobConfig) -> int:
    """A1, G1: the pre-flight count, one pruned partition."""
    rows = partition(view, cfg.target).count()
    require_volume(rows, cfg, cfg.target)
    return rows


def check_drift(view: DataFrame, cfg: JobConfig) -> float:
    """Pre-flight first, then the baseline, then PSI of the canary."""
    check_volume(view, cfg)
    window = (cfg.baseline_start, cfg.baseline_end)
    row = psi_report(view, cfg.canary_feature, window, cfg.target).collect()[0]
    require_baseline(row["baseline_rows"], cfg)
    return require_stable(row["total_psi"], cfg)
