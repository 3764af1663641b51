"""Audits and profiles: volumes, label artifacts, leakage, contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.config import LEAK_RULE_ABOVE
from tidegate.functions.psi import count_if
from tidegate.functions.rows import above


def partition_summary(features: DataFrame, label: str = "is_high_tip") -> DataFrame:
    """A6."""
    return features.groupBy("scoring_date").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col(label) == 1).alias("high_tip")
    )


def key_audit(df: DataFrame, key: str = "trip_id") -> DataFrame:
    """Rows against distinct keys per date.

    Counting per (date, key) first folds copies map-side, so neither a hot date
    nor a hot key meets one task with all of its rows.
    """
    per_key = df.groupBy("scoring_date", key).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.groupBy("scoring_date").agg(
        F.sum("copies").alias("row_count"), F.count(F.col(key)).alias("unique_trips")
    )


def duplicated_partitions(df: DataFrame, key: str = "trip_id") -> DataFrame:
    """Q1: partitions breaking rows == distinct keys; empty when all is well."""
    return key_audit(df, key).where(F.col("row_count") != F.col("unique_trips"))


def backfill_audit(predictions: DataFrame) -> DataFrame:
    """A8."""
    return predictions.groupBy("scoring_date").agg(
        F.min("scored_at").alias("first_scored_at"), F.count(F.lit(1)).alias("row_count")
    )


def zero_rate(df: DataFrame, category: str, value: str = "tip_amount") -> DataFrame:
    """Percentage of exact zeros per category."""
    zeros = F.count_if(F.col(value) == 0)
    return df.groupBy(category).agg(
        F.count(F.lit(1)).alias("trips"),
        F.round(zeros / F.count(F.lit(1)) * 100, 1).alias("pct_zero_tip"),
    )


def segment_rates(df: DataFrame, categories: list[str], label: Column) -> DataFrame:
    """Positive rate of every value of every category column, in one pass."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("segment")) for c in categories]
    )
    return (
        df.select(label.alias("y"), F.inline(pairs))
        .groupBy("dimension", "segment")
        .agg(F.count(F.lit(1)).alias("trips"), count_if(F.col("y") == 1).alias("positives"))
        .withColumn("pct_positive", F.round(F.col("positives") / F.col("trips") * 100, 1))
    )


def artifact_segments(df: DataFrame, categories: list[str], label: Column) -> DataFrame:
    """A10: segments whose positive rate rounds to 0.0 or 100.0 percent."""
    return segment_rates(df, categories, label).where(F.col("pct_positive").isin(0.0, 100.0))


def leak_rule_accuracy(df: DataFrame, threshold: float = LEAK_RULE_ABOVE) -> DataFrame:
    """How well ``total - fare > threshold`` alone reproduces the label."""
    predicted = F.when(above(F.col("total_amount") - F.col("fare_amount"), threshold), 1).otherwise(0)
    return df.agg(
        F.count(F.lit(1)).alias("trips"),
        F.round(F.avg((predicted == F.col("is_high_tip")).cast("int")), 4).alias("accuracy"),
    )


def leak_rule_sweep(df: DataFrame, thresholds: list[float]) -> DataFrame:
    """A11 for a grid of thresholds, still one pass.

    Rows are counted by the number of thresholds they exceed; the accuracy at
    each threshold follows from running totals over that handful of counts.
    """
    grid = sorted(thresholds)
    gap = F.col("total_amount") - F.col("fare_amount")
    passed = sum((above(gap, t).cast("int") for t in grid[1:]), above(gap, grid[0]).cast("int"))
    counts = df.groupBy(passed.alias("passed")).agg(
        F.sum("is_high_tip").alias("pos"), F.count(F.lit(1)).alias("n")
    )
    steps = F.array(
        *[F.struct(F.lit(i).alias("step"), F.lit(float(t)).alias("threshold")) for i, t in enumerate(grid)]
    )
    hit = F.col("passed") > F.col("step")
    return (
        counts.select("*", F.inline(steps))
        .groupBy("step", "threshold")
        .agg(
            F.sum(F.when(hit, F.col("pos")).otherwise(F.col("n") - F.col("pos"))).alias("right"),
            F.sum("n").alias("trips"),
        )
        .select("threshold", "trips", F.round(F.col("right") / F.col("trips"), 4).alias("accuracy"))
    )


def label_correlation(df: DataFrame, columns: list[str], keep: Column, label: str = "is_high_tip") -> DataFrame:
    """Pearson correlation with the label, over all rows and over kept rows."""
    y = F.col(label).cast("double")
    row = df.agg(
        *[F.corr(F.col(c).cast("double"), y).alias(f"all_{c}") for c in columns],
        *[F.corr(F.when(keep, F.col(c).cast("double")), F.when(keep, y)).alias(f"kept_{c}") for c in columns],
    )
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.round(F.col(f"all_{c}"), 6).alias("corr_all"),
                F.round(F.col(f"kept_{c}"), 6).alias("corr_kept"),
            )
            for c in columns
        ]
    )
    return row.select(F.inline(pairs))


def class_balance(rows: DataFrame, label: str = "is_high_tip") -> DataFrame:
    """A13."""
    return rows.agg(
        F.count(label).alias("labelled_rows"),
        F.sum(label).alias("positives"),
        F.round(F.avg(label), 6).alias("positive_rate"),
    )


def daily_counts(df: DataFrame, day: Column) -> DataFrame:
    return df.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("row_count"))


def volume_floor(daily: DataFrame, last_days: int = 30) -> DataFrame:
    """Half the median daily row count of the last days.

    Like ``trailing_volume`` this sees one row per calendar day, so the window
    over all of them stays small whatever the table holds.
    """
    newest = F.max("day").over(Window.partitionBy(F.lit(0)))
    recent = daily.withColumn("newest", newest).where(F.col("day") > F.date_sub("newest", last_days))
    return recent.agg(
        F.count(F.lit(1)).alias("days"),
        F.percentile("row_count", 0.5).alias("median_rows"),
        (F.percentile("row_count", 0.5) / 2).alias("floor_rows"),
    )


def trailing_volume(daily: DataFrame, days: int = 7, least_share: float = 0.5) -> DataFrame:
    """Each day against the median of the days before it.

    The window has no partition key because its input is one row per calendar
    day, however large the table is.
    """
    number = F.datediff("day", F.lit("1970-01-01"))
    before = Window.partitionBy(F.lit(0)).orderBy("day_number").rangeBetween(-days, -1)
    out = daily.withColumn("day_number", number).withColumn(
        "trailing_median", F.percentile("row_count", 0.5).over(before)
    )
    return out.select(
        "day",
        "row_count",
        "trailing_median",
        (F.col("row_count") < F.lit(least_share) * F.col("trailing_median")).alias("too_small"),
    )


def contract_check(features: DataFrame, filtered: tuple[str, ...], keys: tuple[str, ...]) -> DataFrame:
    """Q3: share of NULLs per column and date; a filtered column left empty by a
    write path would silently empty the view, and a key must never be NULL."""
    columns = [*filtered, *keys]
    per_date = features.groupBy("scoring_date").agg(
        *[F.round(F.avg(F.col(c).isNull().cast("int")), 6).alias(c) for c in columns]
    )
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_share"), F.lit(c in keys).alias("is_key"))
            for c in columns
        ]
    )
    broken = F.when(F.col("is_key"), F.col("null_share") > 0).otherwise(F.col("null_share") >= 1)
    return per_date.select("scoring_date", F.inline(pairs)).withColumn("violated", broken)
