"""The feature table's rows and the one view everything reads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import schemas
from tidegate.functions.rows import high_tip_label, label_valid, on_day, quality_predicate, trip_key, within_days


class LeakageError(Exception):
    """A column that already holds the label reached a model input."""


def check_no_leak(df: DataFrame) -> DataFrame:
    """Q4: refuse any frame that exposes a forbidden column."""
    exposed = [c for c in df.columns if c.lower() in schemas.FORBIDDEN_COLUMNS]
    if exposed:
        raise LeakageError(f"columns not allowed in a model input: {', '.join(exposed)}")
    return df


def feature_view(features: DataFrame) -> DataFrame:
    """The only definition of feature columns and row filters."""
    rows = features.where(quality_predicate() & label_valid())
    return check_no_leak(rows.select(*schemas.VIEW_COLUMNS))


def register_feature_view(spark: SparkSession, features_table: str, view: str) -> DataFrame:
    """Create or replace the view over the feature table."""
    df = feature_view(spark.table(features_table))
    df.createOrReplaceTempView(view)
    return df


def labelled(view: DataFrame) -> DataFrame:
    """P5."""
    return view.where(F.col(schemas.LABEL).isNotNull())


def dedupe(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, the least by all other columns.

    An aggregate instead of a window: each map task reduces its copies to one
    row per key before the shuffle, so a key holding a third of the table costs
    one row per task there.
    """
    rest = [c for c in df.columns if c not in keys]
    kept = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("kept"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"kept.{c}") for c in df.columns])


def feature_rows(source: DataFrame, scoring_date: Column, null_label: bool = False) -> DataFrame:
    """Source trips to feature rows: quality filter, casts, key, label, one row per key.

    P2 is deliberately not applied: rows without a trustworthy label stay in the
    table, where the exclusion can be audited.
    """
    vendor = F.col("vendor_id").cast("string")
    rows = source.where(quality_predicate()).select(
        trip_key(
            F.col("pickup_datetime"),
            F.col("dropoff_datetime"),
            vendor,
            F.col("trip_distance"),
            F.col("total_amount"),
        ).alias("trip_id"),
        "pickup_datetime",
        "dropoff_datetime",
        vendor.alias("vendor_id"),
        F.col("passenger_count").cast("long").alias("passenger_count"),
        "trip_distance",
        "fare_amount",
        "total_amount",
        "tip_amount",
        F.col("payment_type").cast("string").alias("payment_type"),
        high_tip_label(F.col("tip_amount"), null_label).alias(schemas.LABEL),
        scoring_date.alias("scoring_date"),
    )
    return dedupe(rows, ["trip_id", "scoring_date"])


def without_populated_dates(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Keep only dates the table holds no row for; many dates in one job.

    The other side is one row per calendar date; whether it is broadcast is left to
    its measured size.
    """
    held = table.select("scoring_date").distinct()
    return rows.join(held, "scoring_date", "left_anti")


def source_window(source: DataFrame, first: dt.date, last: dt.date, *extra: dt.date) -> DataFrame:
    """A window of pickup days and any extra days."""
    wanted = within_days("pickup_datetime", first, last)
    for day in extra:
        wanted = wanted | on_day("pickup_datetime", day)
    return source.where(wanted)
