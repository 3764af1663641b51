"""Prediction rows, and reading them back against the features."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate import schemas
from tidegate.functions.scoring import class_probs, predicted_class
from tidegate.operators.features import check_no_leak

KEY = ["trip_id", "scoring_date"]


def predict(view: DataFrame, scorer, model_name: str, day: dt.date | None = None) -> DataFrame:
    """One prediction row per view row, key and date passed through.

    With ``day`` the date is a literal, as for a single scored partition;
    without it every row keeps its own date, as for a range backfill.
    """
    inputs = ["trip_id", "scoring_date", *schemas.CATEGORICAL_FEATURES, *schemas.NUMERIC_FEATURES]
    scored = scorer.score(check_no_leak(view.select(*inputs)))
    p1 = F.col("p1")
    return scored.select(
        "trip_id",
        "vendor_id",
        predicted_class(p1).alias("predicted_is_high_tip"),
        class_probs(p1).alias("predicted_is_high_tip_probs"),
        F.lit(model_name).alias("model_name"),
        F.current_timestamp().alias("scored_at"),
        (F.lit(day) if day else F.col("scoring_date")).alias("scoring_date"),
    )


def join_features(predictions: DataFrame, view: DataFrame) -> DataFrame:
    """Both keys, since a key is unique only within its date.

    The second key also lets a partition filter on one side prune the other.
    """
    return predictions.join(view.drop("vendor_id"), KEY)


def unmatched(predictions: DataFrame, view: DataFrame) -> DataFrame:
    """Q2: predictions without a feature row, counted per date."""
    return (
        predictions.join(view.select(*KEY), KEY, "left_anti")
        .groupBy("scoring_date")
        .agg(F.count(F.lit(1)).alias("unmatched"))
    )


def _same_row() -> Column:
    """Equal keys, said so that rows meet by trip alone: tables are bucketed by it, within dates."""
    return (F.col("p.trip_id") == F.col("f.trip_id")) & (F.datediff("p.scoring_date", "f.scoring_date") == 0)


def join_features_in_buckets(predictions: DataFrame, view: DataFrame) -> DataFrame:
    """J7 where both tables have the same buckets of ``trip_id``: bucket meets bucket, nothing is shuffled.

    A filter on the date must be put on both sides.
    """
    own = [F.col(f"f.{c}") for c in view.columns if c not in (*KEY, "vendor_id")]
    return predictions.alias("p").join(view.alias("f"), _same_row()).select("p.*", *own)


def unmatched_in_buckets(predictions: DataFrame, view: DataFrame) -> DataFrame:
    """Q2 on such tables; only the counts of dates are shuffled."""
    alone = predictions.alias("p").join(view.select(*KEY).alias("f"), _same_row(), "left_anti")
    return alone.groupBy("scoring_date").agg(F.count(F.lit(1)).alias("unmatched"))


def worth_offering(joined: DataFrame, threshold: float, p1: str = "p1") -> DataFrame:
    """M5: rows whose expected value, probability times fare, exceeds the threshold."""
    value = F.col(p1) * F.col("fare_amount")
    return joined.withColumn("expected_value", value).where(value > F.lit(threshold))
