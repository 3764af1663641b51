"""Audits and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.functions.rows import label_valid, quality_predicate
from tidegate.operators.profile import (
    artifact_segments,
    class_balance,
    contract_check,
    daily_counts,
    duplicated_partitions,
    key_audit,
    label_correlation,
    leak_rule_accuracy,
    leak_rule_sweep,
    partition_summary,
    segment_rates,
    trailing_volume,
    volume_floor,
    zero_rate,
)
from tidegate.queries.base import BASELINE, IN_BASELINE, QUALITY, TRIPS, VIEW, plain, view
from tidegate.queries.rows import COPIED, _copied
from tidegate.registry import query
from tidegate.schemas import FILTERED_COLUMNS
from tidegate.sources import star
from tidegate.sources.tables import partitions

SWEEP = [2.0, 3.5, 5.5, 7.5, 10.0]
CATEGORIES = ["vendor_id", "payment_type", "passenger_count"]


@query(
    "partition_summary",
    f"""WITH {TRIPS} SELECT CAST(scoring_date AS VARCHAR) AS scoring_date, count(*) AS row_count,
    count(*) FILTER (WHERE is_high_tip = 1) AS high_tip FROM trips GROUP BY scoring_date ORDER BY scoring_date""",
)
def partition_summary_rows(spark, sf_dir):
    """A6, L1."""
    return plain(partition_summary(star.trips(spark, sf_dir)).orderBy("scoring_date"))


KEY_AUDIT = f"""WITH {COPIED}, audit AS (SELECT scoring_date, count(*) AS row_count, count(DISTINCT trip_id) AS unique_trips
  FROM copied GROUP BY scoring_date) SELECT CAST(scoring_date AS VARCHAR) AS scoring_date, row_count, unique_trips FROM audit"""


@query("key_audit", KEY_AUDIT)
def key_audit_rows(spark, sf_dir):
    """A7."""
    return plain(key_audit(_copied(spark, sf_dir)))


@query("duplicated_partitions", f"{KEY_AUDIT} WHERE row_count <> unique_trips")
def duplicated_partition_rows(spark, sf_dir):
    """Q1."""
    return plain(duplicated_partitions(_copied(spark, sf_dir)))


@query(
    "zero_tip_rate",
    f"""WITH {TRIPS} SELECT payment_type, count(*) AS trips,
    round(count(*) FILTER (WHERE tip_amount = 0) / count(*) * 100, 1) AS pct_zero_tip
    FROM trips GROUP BY payment_type ORDER BY trips DESC""",
)
def zero_tip_rate(spark, sf_dir):
    """A9, L1."""
    return zero_rate(star.trips(spark, sf_dir), "payment_type").orderBy(F.desc("trips"))


SEGMENTS = f"""WITH {TRIPS}, long AS ({" UNION ALL ".join(
    f"SELECT '{c}' AS dimension, CAST({c} AS VARCHAR) AS segment, is_high_tip AS y FROM trips" for c in CATEGORIES)}),
rates AS (SELECT dimension, segment, count(*) AS trips, count(*) FILTER (WHERE y = 1) AS positives,
  round(count(*) FILTER (WHERE y = 1) / count(*) * 100, 1) AS pct_positive FROM long GROUP BY ALL) SELECT * FROM rates"""


@query("segment_rates", SEGMENTS)
def segment_rate_rows(spark, sf_dir):
    """A10, before the filter."""
    return segment_rates(star.trips(spark, sf_dir), CATEGORIES, F.col("is_high_tip"))


@query("artifact_segments", f"{SEGMENTS} WHERE pct_positive IN (0.0, 100.0)")
def artifact_segment_rows(spark, sf_dir):
    """A10."""
    return artifact_segments(star.trips(spark, sf_dir), CATEGORIES, F.col("is_high_tip"))


CARD = f"SELECT * FROM trips WHERE {QUALITY} AND payment_type = '1'"


@query(
    "leak_rule",
    f"""WITH {TRIPS}, card AS ({CARD}) SELECT count(*) AS trips,
    round(avg(CASE WHEN (total_amount - fare_amount > 5.5) = (is_high_tip = 1) THEN 1 ELSE 0 END), 4) AS accuracy FROM card""",
)
def leak_rule(spark, sf_dir):
    """A11, Q4 as a data test."""
    return leak_rule_accuracy(_card(spark, sf_dir))


def _card(spark, sf_dir):
    return star.trips(spark, sf_dir).where(quality_predicate() & label_valid())


@query(
    "leak_rule_sweep",
    f"""WITH {TRIPS}, card AS ({CARD}), grid AS (SELECT unnest({SWEEP})::DOUBLE AS threshold)
    SELECT threshold, count(*) AS trips,
    round(avg(CASE WHEN (total_amount - fare_amount > threshold) = (is_high_tip = 1) THEN 1 ELSE 0 END), 4) AS accuracy
    FROM card, grid GROUP BY threshold""",
)
def leak_rule_sweep_rows(spark, sf_dir):
    """A11 over a grid."""
    return leak_rule_sweep(_card(spark, sf_dir), SWEEP)


@query(
    "label_correlation",
    f"""WITH {TRIPS}, good AS (SELECT * FROM trips WHERE {QUALITY})
    SELECT 'trip_distance' AS feature, round(corr(trip_distance, is_high_tip), 6) AS corr_all,
      round(corr(trip_distance, is_high_tip) FILTER (WHERE payment_type = '1'), 6) AS corr_kept FROM good
    UNION ALL SELECT 'fare_amount', round(corr(fare_amount, is_high_tip), 6),
      round(corr(fare_amount, is_high_tip) FILTER (WHERE payment_type = '1'), 6) FROM good""",
)
def label_correlation_rows(spark, sf_dir):
    """A12."""
    rows = star.trips(spark, sf_dir).where(quality_predicate())
    return label_correlation(rows, ["trip_distance", "fare_amount"], label_valid())


@query(
    "class_balance",
    f"""WITH {VIEW} SELECT count(is_high_tip) AS labelled_rows, CAST(sum(is_high_tip) AS BIGINT) AS positives,
    round(avg(is_high_tip), 6) AS positive_rate FROM v WHERE {IN_BASELINE}""",
)
def class_balance_rows(spark, sf_dir):
    """A13 over the training window, P5."""
    return class_balance(partitions(view(spark, sf_dir, *BASELINE), *BASELINE))


DAILY = "daily AS (SELECT CAST(ts AS DATE) AS day, count(*) AS row_count FROM events GROUP BY 1)"


def _daily(spark, sf_dir):
    return daily_counts(star.events(spark, sf_dir), F.to_date("ts"))


@query(
    "volume_floor",
    f"""WITH {DAILY} SELECT count(*) AS days, quantile_cont(row_count, 0.5) AS median_rows,
    quantile_cont(row_count, 0.5) / 2 AS floor_rows FROM daily WHERE day > (SELECT max(day) FROM daily) - 30""",
)
def volume_floor_row(spark, sf_dir):
    """A14."""
    return volume_floor(_daily(spark, sf_dir))


@query(
    "trailing_volume",
    f"""WITH {DAILY}, m AS (SELECT d.day, d.row_count, quantile_cont(p.row_count, 0.5) AS trailing_median FROM daily d
      LEFT JOIN daily p ON p.day BETWEEN d.day - 7 AND d.day - 1 GROUP BY d.day, d.row_count)
    SELECT CAST(day AS VARCHAR) AS day, row_count, trailing_median, row_count < 0.5 * trailing_median AS too_small FROM m""",
)
def trailing_volume_rows(spark, sf_dir):
    """X3."""
    return plain(trailing_volume(_daily(spark, sf_dir)))


@query(
    "contract_check",
    f"""WITH {TRIPS}, long AS ({" UNION ALL ".join(
        f"SELECT scoring_date, '{c}' AS column_name, {c} IS NULL AS missing FROM trips" for c in (*FILTERED_COLUMNS, "trip_id"))})
    SELECT CAST(scoring_date AS VARCHAR) AS scoring_date, column_name, round(avg(missing::INTEGER), 6) AS null_share,
    column_name = 'trip_id' AS is_key,
    CASE WHEN column_name = 'trip_id' THEN avg(missing::INTEGER) > 0 ELSE avg(missing::INTEGER) >= 1 END AS violated
    FROM long GROUP BY scoring_date, column_name""",
)
def contract_check_rows(spark, sf_dir):
    """Q3."""
    return plain(contract_check(star.trips(spark, sf_dir), FILTERED_COLUMNS, ("trip_id",)))
