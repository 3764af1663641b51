"""Joins of bucketed tables, and dates that are swapped."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate import schemas
from tidegate.functions.rows import quality_predicate
from tidegate.functions.scoring import prob_of
from tidegate.operators.predictions import join_features_in_buckets, predict, unmatched_in_buckets, worth_offering
from tidegate.queries.base import FROZEN, MODEL_NAME, VIEW, plain, rounded, view
from tidegate.queries.model import OFFER_ABOVE
from tidegate.queries.rows import job_tables
from tidegate.registry import SQL, query
from tidegate.schemas import PREDICTIONS
from tidegate.sources import star
from tidegate.sources.layout import bucket_count, create_bucketed_table, replace_bucketed, swap_partitions
from tidegate.sources.shared import fresh_dir
from tidegate.sources.tables import replace_partitions

#: Buckets of a small table; more rows get more.
BUCKETS = 8


def _dates(df):
    """The dates of a frame and its number of rows."""
    counts = df.groupBy("scoring_date").count().collect()
    return [r["scoring_date"] for r in counts], sum(r["count"] for r in counts)


def _bucketed(spark, df, schema, purpose, days, buckets):
    root = fresh_dir(spark, "buckets")
    name = f"{purpose}_{root[-12:]}"
    create_bucketed_table(spark, name, schema, "trip_id", buckets, root)
    replace_bucketed(spark, df, name, "trip_id", buckets, days)
    return spark.table(name)


@query("expected_value_in_buckets", SQL["expected_value"])
def expected_value_in_buckets(spark, sf_dir):
    """Predictions and features meet bucket by bucket."""
    rows = view(spark, sf_dir)
    days, n = _dates(rows)
    buckets = bucket_count(n, BUCKETS)
    features = _bucketed(spark, rows, rows.schema, "features", days, buckets)
    made = _bucketed(spark, predict(features, FROZEN, MODEL_NAME), PREDICTIONS, "predictions", days, buckets)
    p1 = prob_of(F.col("predicted_is_high_tip_probs"), 1)
    rows = worth_offering(join_features_in_buckets(made, features).withColumn("p1", p1), OFFER_ABOVE)
    return plain(rounded(rows.select("trip_id", "scoring_date", "expected_value"), expected_value=4))


@query("unmatched_in_buckets", SQL["unmatched_predictions"])
def unmatched_rows_in_buckets(spark, sf_dir):
    """Q2, S5."""
    inputs = star.trips(spark, sf_dir).where(quality_predicate()).select(*schemas.VIEW_COLUMNS)
    days, n = _dates(inputs)
    # the view's rows are some of these, so their dates and their number do for both tables
    buckets = bucket_count(n, BUCKETS)
    made = _bucketed(spark, predict(inputs, FROZEN, MODEL_NAME), PREDICTIONS, "predictions", days, buckets)
    rows = view(spark, sf_dir)
    return plain(unmatched_in_buckets(made, _bucketed(spark, rows, rows.schema, "features", days, buckets)))


@query(
    "swapped_dates",
    f"""WITH {VIEW} SELECT CAST(scoring_date AS VARCHAR) AS scoring_date, count(*) AS held FROM v
    WHERE month(scoring_date) % 2 = 0 OR fare_amount > 20 GROUP BY scoring_date""",
)
def swapped_dates(spark, sf_dir):
    """The odd months are replaced by fewer rows, by way of new folders."""
    cfg, rows = job_tables(spark), view(spark, sf_dir)
    days = [r["scoring_date"] for r in rows.select("scoring_date").distinct().collect()]
    replace_partitions(spark, predict(rows, FROZEN, MODEL_NAME), cfg.predictions_table, days)
    fewer = predict(rows.where("fare_amount > 20"), FROZEN, MODEL_NAME)
    swap_partitions(spark, fewer, cfg.predictions_table, [day for day in days if day.month % 2])
    return plain(spark.table(cfg.predictions_table).groupBy("scoring_date").agg(F.count(F.lit(1)).alias("held")))
