"""Row-level expressions: surrogate key, quality predicates, label, date maps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tidegate.config import CARD_PAYMENT, FARE_MAX, FARE_MIN, HIGH_TIP_ABOVE

TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
EPOCH = dt.date(1970, 1, 1)


def _stamp(ts: Column) -> Column:
    return F.coalesce(F.date_format(ts, TS_FORMAT), F.lit(""))


def _number(value: Column) -> Column:
    """The shortest text that reads back as the same double; -0.0 as 0.0."""
    return F.coalesce((value.cast("double") + F.lit(0.0)).cast("string"), F.lit(""))


def trip_key(pickup, dropoff, vendor, distance, total) -> Column:
    """K1: md5 over five natural attributes, each in full precision, so that trips
    that differ at all have different keys.

    The logical date is left out on purpose, so one source day replayed on two
    dates repeats its keys: dedupe and join by (trip_id, scoring_date).
    """
    return F.md5(
        F.concat_ws(
            "|",
            _stamp(pickup),
            _stamp(dropoff),
            F.coalesce(vendor, F.lit("")),
            _number(distance),
            _number(total),
        )
    )


def register_sql_functions(spark: SparkSession) -> None:
    """K1 for SQL users; an inlined SQL body, not a Python UDF."""
    spark.sql(
        """
        CREATE OR REPLACE TEMPORARY FUNCTION make_trip_id(
          pickup TIMESTAMP, dropoff TIMESTAMP, vendor STRING, dist DOUBLE, total DOUBLE)
        RETURNS STRING
        RETURN md5(concat_ws('|',
          coalesce(date_format(pickup, 'yyyy-MM-dd HH:mm:ss.SSSSSS'), ''),
          coalesce(date_format(dropoff, 'yyyy-MM-dd HH:mm:ss.SSSSSS'), ''),
          coalesce(vendor, ''),
          coalesce(CAST(dist + CAST(0 AS DOUBLE) AS STRING), ''),
          coalesce(CAST(total + CAST(0 AS DOUBLE) AS STRING), '')))
        """
    )


def above(value: Column, limit: float) -> Column:
    """``value > limit`` where NaN compares false (Spark alone sorts NaN on top)."""
    return (value > F.lit(limit)) & ~F.isnan(value)


def quality_predicate() -> Column:
    """The row filter shared by ingest, seed and the feature view."""
    return (
        F.col("vendor_id").isNotNull()
        & (F.col("passenger_count") > 0)
        & above(F.col("trip_distance"), 0.0)
        & F.col("fare_amount").between(F.lit(FARE_MIN), F.lit(FARE_MAX))
        & above(F.col("total_amount"), 0.0)
    )


def label_valid() -> Column:
    """Only card payments record tips; a view-only rule, never at ingest."""
    return F.col("payment_type") == CARD_PAYMENT


def high_tip_label(tip: Column, null_label: bool = False) -> Column:
    """1 above the limit, else 0; a NULL tip is 0 unless ``null_label``."""
    label = F.when(above(tip, HIGH_TIP_ABOVE), F.lit(1)).otherwise(F.lit(0)).cast("long")
    return F.when(tip.isNotNull(), label) if null_label else label


def usable(value: Column) -> Column:
    """Not NULL and not NaN."""
    return value.isNotNull() & ~F.isnan(value.cast("double"))


def replay_source_day(target: Column, window_start: dt.date, window_days: int) -> Column:
    """Rotate any date through a fixed window of source days."""
    offset = F.pmod(F.datediff(target, F.lit(EPOCH)), F.lit(window_days))
    return F.date_add(F.lit(window_start), offset)


def replay_source_date(target: dt.date, window_start: dt.date, window_days: int) -> dt.date:
    """P9 for one driver-side date, so the scan filter stays a literal."""
    return window_start + dt.timedelta(days=(target - EPOCH).days % window_days)


def remap_day(source: Column, from_day: dt.date, run_date: Column | None = None) -> Column:
    """One source day becomes the day before the run; others keep their date."""
    run_date = F.current_date() if run_date is None else run_date
    return F.when(source == F.lit(from_day), F.date_sub(run_date, 1)).otherwise(source)


def mature_date(target: Column, lag_days: int) -> Column:
    """The date whose labels are known by ``target``."""
    return F.date_sub(target, lag_days)


def on_day(ts: str, day: dt.date) -> Column:
    """A calendar day as a half-open range, which parquet statistics can skip on."""
    return within_days(ts, day, day)


def within_days(ts: str, first: dt.date, last: dt.date) -> Column:
    """Calendar days first..last inclusive as a half-open range."""
    start = dt.datetime.combine(first, dt.time())
    stop = dt.datetime.combine(last + dt.timedelta(days=1), dt.time())
    return (F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(stop))
