"""Alert rules over run metrics and run logs.

Functions taking ``points``, ``logs`` or ``firings`` without sorting them work on
streaming frames too; the rest have a stateful twin under ``streaming``.
"""

from __future__ import annotations

from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.config import (
    ABNORMAL_EXIT,
    ALERT_COUNTER_ABOVE,
    ALERT_WINDOW_S,
    COUNTER_IDLE_S,
    KILLED,
    LOG_INCIDENT_CLOSE_S,
    METRIC_INCIDENT_CLOSE_S,
    NOTIFY_GAP_S,
    PSI_HALT_AT,
    RUN_SUMMARY_EVENT,
)
from tidegate.functions.rows import above

MICROS = 1_000_000
# Log severities from ERROR upwards (fixed values).
ERROR_SEVERITIES = ("ERROR", "CRITICAL", "ALERT", "EMERGENCY")
# Fields of a run summary (fixed values).
SUMMARY_FIELDS = ("status", "target_date", "status_message", "execution", "exit_code")


def _window_start(ts: str, seconds: int) -> Column:
    return F.window(ts, f"{seconds} seconds")


def gauge_windows(points: DataFrame, key: str = "feature", seconds: int = ALERT_WINDOW_S) -> DataFrame:
    """Largest gauge value per tumbling window and series; partial maxima fold map-side."""
    return (
        points.groupBy(_window_start("ts", seconds).alias("w"), key)
        .agg(F.max("value").alias("max_value"))
        .select(key, F.col("w.start").alias("window_start"), "max_value")
    )


def gauge_alerts(
    points: DataFrame, threshold: float = PSI_HALT_AT, key: str = "feature", seconds: int = ALERT_WINDOW_S
) -> DataFrame:
    """Windows whose maximum is above (not at) the threshold."""
    return gauge_windows(points, key, seconds).where(above(F.col("max_value"), threshold))


def counter_step(value: Column, previous: Column, restart: bool = False) -> Column:
    """Increase between two readings of a cumulative counter.

    A reading below the one before means the counter was reset: no increase, or
    with ``restart`` the new reading itself, counted from zero.
    """
    after_reset = value if restart else F.lit(0.0)
    return F.when(value >= previous, value - previous).otherwise(after_reset)


def counter_increases(
    points: DataFrame, restart: bool = False, chunk_s: int = 3_600, idle_s: int = COUNTER_IDLE_S
) -> DataFrame:
    """R2, first half: the increase each reading adds; a series starts from zero.

    A series that is silent for more than ``idle_s`` starts anew.

    Consecutive readings are paired inside (series, hour) groups, so one hot
    series spreads over as many tasks as it has hours. The first reading of an
    hour is paired with the last reading of the series' hour before, on a table
    of one row per series and hour.
    """
    chunk = F.floor(F.unix_seconds("ts") / F.lit(chunk_s))
    chunked = points.withColumn("chunk", chunk)
    inside = Window.partitionBy("series", "chunk").orderBy("ts", "seq")

    def since(value: Column, ts: Column) -> Column:
        return F.when(F.unix_micros("ts") - F.unix_micros(ts) > F.lit(idle_s * MICROS), F.lit(0.0)).otherwise(value)

    paired = (
        chunked.withColumn("previous", since(F.lag("value").over(inside), F.lag("ts").over(inside)))
        .where(F.col("previous").isNotNull())
        .select("model_name", "ts", counter_step(F.col("value"), F.col("previous"), restart).alias("increase"))
    )
    ends = chunked.groupBy("series", "chunk").agg(
        F.min(F.struct("ts", "seq", "value", "model_name")).alias("first"),
        F.max(F.struct("ts", "seq", "value")).alias("last"),
    )
    by_hour = Window.partitionBy("series").orderBy("chunk")
    earlier = since(F.lag("last.value").over(by_hour), F.lag("last.ts").over(by_hour))
    carried = ends.withColumn("ts", F.col("first.ts")).withColumn("previous", F.coalesce(earlier, F.lit(0.0))).select(
        F.col("first.model_name").alias("model_name"),
        F.col("first.ts").alias("ts"),
        counter_step(F.col("first.value"), F.col("previous"), restart).alias("increase"),
    )
    return paired.unionByName(carried)


def increase_windows(increases: DataFrame, seconds: int = ALERT_WINDOW_S) -> DataFrame:
    return (
        increases.groupBy(_window_start("ts", seconds).alias("w"), "model_name")
        .agg(F.sum("increase").alias("increase"))
        .select("model_name", F.col("w.start").alias("window_start"), "increase")
    )


def counter_alerts(
    points: DataFrame, threshold: float = ALERT_COUNTER_ABOVE, seconds: int = ALERT_WINDOW_S, restart: bool = False
) -> DataFrame:
    """R2: windows in which a model's counters rose by more than the threshold."""
    windows = increase_windows(counter_increases(points, restart), seconds)
    return windows.where(F.col("increase") > F.lit(float(threshold)))


def abnormal_exits(logs: DataFrame) -> DataFrame:
    """Lines of runs that ended without a status of their own."""
    return logs.where(F.col("message").rlike(ABNORMAL_EXIT) | F.col("message").rlike(KILLED))


def run_status_feed(logs: DataFrame) -> DataFrame:
    """The five fields of every run summary among the log records."""
    wanted = ", ".join(f"{name} STRING" for name in ("event", *SUMMARY_FIELDS))
    parsed = logs.withColumn("summary", F.from_json("fields", wanted))
    return parsed.where(F.col("summary.event") == RUN_SUMMARY_EVENT).select(
        "ts", *[F.col(f"summary.{name}").alias(name) for name in SUMMARY_FIELDS]
    )


def status_severity(status: Column) -> Column:
    """Only halted and failed runs are errors."""
    return F.when(status.isin("HALTED", "FAILED"), "ERROR").otherwise("INFO")


def errors_only(logs: DataFrame) -> DataFrame:
    """Severity at or above ERROR."""
    return logs.where(F.col("severity").isin(*ERROR_SEVERITIES))


def incidents(firings: DataFrame, close_s: int = LOG_INCIDENT_CLOSE_S) -> DataFrame:
    """Firings of a rule at most ``close_s`` apart form one incident.

    Firings in the same ``close_s``-long cell always belong together, so they
    fold map-side to one row per rule and cell. Only those rows, at most one per
    rule and half hour, are ordered to find the gaps.
    """
    close = close_s * MICROS
    t = F.unix_micros("ts")
    cells = firings.groupBy("rule", F.floor(t / F.lit(close)).alias("cell")).agg(
        F.min(t).alias("first"), F.max(t).alias("last"), F.count(F.lit(1)).alias("firings")
    )
    in_order = Window.partitionBy("rule").orderBy("cell")
    opens = F.coalesce((F.col("first") - F.lag("last").over(in_order) > close).cast("int"), F.lit(1))
    numbered = cells.withColumn("opens", opens).withColumn(
        "incident", F.sum("opens").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    )
    return (
        numbered.groupBy("rule", "incident")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("firings").alias("firings"))
        .select(
            "rule",
            F.timestamp_micros("first").alias("opened_at"),
            F.timestamp_micros(F.col("last") + close).alias("closed_at"),
            "firings",
        )
    )


def metric_gauges(metrics: DataFrame, name: str = "feature_psi") -> DataFrame:
    """A gauge of the run metrics as the points of R1; without a feature the series is the model."""
    own = F.col("attributes")
    series = F.coalesce(own["feature"], own["model_name"])
    return metrics.where((F.col("name") == name) & (F.col("kind") == "gauge")).select(series.alias("feature"), "ts", "value")


def metric_counters(metrics: DataFrame, name: str = "rows_scored") -> DataFrame:
    """A counter of the run metrics as the points of R2; of one instant's readings the larger total is the later."""
    model = F.col("attributes")["model_name"]
    found = metrics.where((F.col("name") == name) & (F.col("kind") == "counter"))
    return found.select(model.alias("series"), model.alias("model_name"), "ts", F.col("value").cast("long").alias("seq"), "value")


def metric_firings(alerts: DataFrame, name: str = "feature_psi") -> DataFrame:
    """R1's alerts as firings of one rule for each series, at the begin of the window that fired."""
    return alerts.select(F.concat(F.lit(f"{name}:"), "feature").alias("rule"), F.col("window_start").alias("ts"))


def metric_incidents(alerts: DataFrame, name: str = "feature_psi", close_s: int = METRIC_INCIDENT_CLOSE_S) -> DataFrame:
    """R7 for metrics: incidents that stay open for a day after their last alert."""
    return incidents(metric_firings(alerts, name), close_s)


def keep_first(gap: int):
    """The rule both forms share, as a closure that travels to the executors whole."""

    def picks(instants: np.ndarray, allowed: int) -> np.ndarray:
        kept = []
        at = int(np.searchsorted(instants, allowed))
        while at < len(instants):
            kept.append(at)
            at = int(np.searchsorted(instants, instants[at] + gap))
        return instants[kept]

    return picks


def rate_limited(firings: DataFrame, gap_s: int = NOTIFY_GAP_S, chunk_s: int = 86_400) -> DataFrame:
    """Notifications left when a rule may send one per ``gap_s`` at most.

    Which firing is kept depends on the one kept before, back to the first, yet
    one rule may hold a third of all firings. So each (rule, day) works alone:
    it reports, for every moment sending may be allowed again, the last firing
    it would keep. Those short step functions, most of which agree after a few
    steps, are chained per rule, and each day is then walked once from the
    moment it is really allowed. No task sees more than one rule's day.
    """
    gap, span = gap_s * MICROS, chunk_s * MICROS
    picks = keep_first(gap)
    if span < gap:
        raise ValueError("a chunk must be at least as long as the gap")

    t = F.unix_micros("ts")
    instants = firings.select("rule", F.floor(t / F.lit(span)).alias("chunk"), t.alias("t")).distinct()

    def outcomes(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        times = np.sort(rows["t"].to_numpy())
        following = np.searchsorted(times, times + gap)
        early = int(np.searchsorted(times, key[1] * span + gap)) + 1
        at = np.arange(min(early, len(times)))
        while (moving := following[at] < len(times)).any():
            at = np.where(moving, following[at], at)
        last = times[at]
        keep = np.append(last[1:] != last[:-1], True)
        return pd.DataFrame(
            {"rule": key[0], "chunk": key[1], "allowed_until": times[: len(at)][keep], "last_kept": last[keep]}
        )

    def chain(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        starts, allowed = [], -(2**62)
        for chunk, steps in rows.sort_values(["chunk", "allowed_until"]).groupby("chunk"):
            starts.append((key[0], int(chunk), allowed))
            at = int(np.searchsorted(steps["allowed_until"].to_numpy(), allowed))
            if at < len(steps):
                allowed = int(steps["last_kept"].iloc[at]) + gap
        return pd.DataFrame(starts, columns=["rule", "chunk", "allowed"])

    def walk(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        kept = picks(np.sort(rows["t"].to_numpy()), int(rows["allowed"].iloc[0]))
        return pd.DataFrame({"rule": key[0], "t": kept})

    steps = instants.groupBy("rule", "chunk").applyInPandas(
        outcomes, "rule string, chunk long, allowed_until long, last_kept long"
    )
    starts = steps.groupBy("rule").applyInPandas(chain, "rule string, chunk long, allowed long")
    kept = instants.join(starts, ["rule", "chunk"]).groupBy("rule", "chunk").applyInPandas(walk, "rule string, t long")
    return kept.select("rule", F.timestamp_micros("t").alias("ts"))
