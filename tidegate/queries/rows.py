"""Scans, projections, keys, dedupe and the ingest paths."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegate.config import JobConfig
from tidegate.functions.rows import (
    high_tip_label,
    mature_date,
    on_day,
    quality_predicate,
    register_sql_functions,
    remap_day,
    replay_source_day,
)
from tidegate.operators.features import dedupe, source_window, without_populated_dates
from tidegate.operators.profile import partition_summary
from tidegate.plans.ingest import ingest_dates, ingest_partition, replay_rows, seed
from tidegate.queries.base import BASELINE, IN_BASELINE, IN_TARGET, QUALITY, STAMP, TARGET, TRIPS, VIEW, plain, view
from tidegate.registry import query
from tidegate.sources import star
from tidegate.sources.shared import fresh_dir
from tidegate.sources.tables import create_tables, partition, partitions

PICKUP_DAY = dt.date(1998, 3, 14)
EXTRA_DAYS = (dt.date(1996, 7, 4), dt.date(1997, 12, 24))
REPLAY = dict(target_date="2022-02-10", source_table="source_trips_1995", replay_start="1995-02-01")
RUN_DATE = dt.date(1998, 9, 1)

VIEW_ROWS = f"""SELECT trip_id, CAST(scoring_date AS VARCHAR) AS scoring_date,
  strftime(pickup_datetime, {STAMP}) AS pickup_datetime, vendor_id, passenger_count, trip_distance, fare_amount, is_high_tip
  FROM v"""


@query("feature_view", f"WITH {VIEW} {VIEW_ROWS}")
def feature_view_rows(spark, sf_dir):
    """Every row of the view."""
    return plain(view(spark, sf_dir))


@query("partition_scan", f"WITH {VIEW} {VIEW_ROWS} WHERE {IN_TARGET}")
def partition_scan(spark, sf_dir):
    """S3."""
    return plain(partition(view(spark, sf_dir, TARGET, TARGET), TARGET))


@query("window_scan", f"WITH {VIEW} {VIEW_ROWS} WHERE {IN_BASELINE}")
def window_scan(spark, sf_dir):
    """S4."""
    return plain(partitions(view(spark, sf_dir, *BASELINE), *BASELINE))


SOURCE_ROWS = f"""SELECT strftime(pickup_datetime, {STAMP}) AS pickup_datetime, vendor_id, passenger_count,
  trip_distance, fare_amount, payment_type FROM trips"""
SOURCE_COLUMNS = ("pickup_datetime", "vendor_id", "passenger_count", "trip_distance", "fare_amount", "payment_type")


@query("source_day_scan", f"WITH {TRIPS} {SOURCE_ROWS} WHERE CAST(pickup_datetime AS DATE) = DATE '{PICKUP_DAY}'")
def source_day_scan(spark, sf_dir):
    """S1."""
    rows = star.source_trips(spark, sf_dir).where(on_day("pickup_datetime", PICKUP_DAY))
    return plain(rows.select(*SOURCE_COLUMNS))


@query(
    "source_windows_scan",
    f"""WITH {TRIPS} {SOURCE_ROWS} WHERE CAST(pickup_datetime AS DATE) BETWEEN DATE '1995-01-01' AND DATE '1995-01-15'
    OR CAST(pickup_datetime AS DATE) IN (DATE '{EXTRA_DAYS[0]}', DATE '{EXTRA_DAYS[1]}')""",
)
def source_windows_scan(spark, sf_dir):
    """S2."""
    rows = source_window(
        star.source_trips(spark, sf_dir), dt.date(1995, 1, 1), dt.date(1995, 1, 15), *EXTRA_DAYS
    )
    return plain(rows.select(*SOURCE_COLUMNS))


@query(
    "quality_filter",
    f"""WITH {TRIPS} SELECT CAST(scoring_date AS VARCHAR) AS scoring_date, count(*) AS trips,
    count(*) FILTER (WHERE {QUALITY}) AS kept,
    count(*) FILTER (WHERE {QUALITY} AND payment_type = '1') AS in_view FROM trips GROUP BY scoring_date""",
)
def quality_filter(spark, sf_dir):
    """P1 and P2, counted."""
    good = quality_predicate()
    return plain(
        star.trips(spark, sf_dir)
        .groupBy("scoring_date")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.count_if(good).alias("kept"),
            F.count_if(good & (F.col("payment_type") == "1")).alias("in_view"),
        )
    )


@query(
    "high_tip_label",
    f"""WITH {TRIPS} SELECT payment_type, CAST(CASE WHEN tip_amount > 2.0 THEN 1 ELSE 0 END AS BIGINT) AS label,
    count(*) AS trips FROM trips GROUP BY 1, 2""",
)
def label_counts(spark, sf_dir):
    """P3."""
    rows = star.source_trips(spark, sf_dir).select("payment_type", high_tip_label(F.col("tip_amount")).alias("label"))
    return rows.groupBy("payment_type", "label").agg(F.count(F.lit(1)).alias("trips"))


@query("trip_key", f"WITH {TRIPS} SELECT trip_id, total_amount FROM trips")
def trip_key_rows(spark, sf_dir):
    """K1 as a column expression."""
    return star.trips(spark, sf_dir).select("trip_id", "total_amount")


@query("trip_key_sql_function", f"WITH {TRIPS} SELECT trip_id, fare_amount FROM trips")
def trip_key_sql(spark, sf_dir):
    """K1 as a SQL function."""
    register_sql_functions(spark)
    star.table(spark, sf_dir, "lineitem").createOrReplaceTempView("key_lines")
    star.table(spark, sf_dir, "orders").createOrReplaceTempView("key_orders")
    return spark.sql(
        """SELECT make_trip_id(CAST(o_orderdate AS TIMESTAMP), CAST(l_shipdate AS TIMESTAMP), l_returnflag,
             l_quantity, l_extendedprice) AS trip_id, l_extendedprice / 1000 AS fare_amount
           FROM key_lines JOIN key_orders ON l_orderkey = o_orderkey"""
    )


def _copied(spark, sf_dir):
    rows = star.trips(spark, sf_dir)
    return rows.unionByName(rows.where(F.col("passenger_count") == 1))


COPIED = f"{TRIPS}, copied AS (SELECT * FROM trips UNION ALL SELECT * FROM trips WHERE passenger_count = 1)"
ALL_ORDER = """pickup_datetime NULLS FIRST, dropoff_datetime NULLS FIRST, vendor_id NULLS FIRST, passenger_count NULLS FIRST,
  trip_distance NULLS FIRST, fare_amount NULLS FIRST, total_amount NULLS FIRST, tip_amount NULLS FIRST"""
KEPT_ROWS = f"""SELECT trip_id, CAST(scoring_date AS VARCHAR) AS scoring_date, vendor_id, passenger_count,
  trip_distance, fare_amount, total_amount, payment_type, is_high_tip"""
KEPT_COLUMNS = (
    "trip_id",
    "scoring_date",
    "vendor_id",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "total_amount",
    "payment_type",
    "is_high_tip",
)


@query(
    "dedupe_by_key",
    f"""WITH {COPIED} {KEPT_ROWS} FROM (SELECT *, row_number() OVER (PARTITION BY trip_id
    ORDER BY scoring_date NULLS FIRST, {ALL_ORDER}) AS n FROM copied) WHERE n = 1""",
)
def dedupe_by_key(spark, sf_dir):
    """W1."""
    return plain(dedupe(_copied(spark, sf_dir), ["trip_id"]).select(*KEPT_COLUMNS))


@query(
    "dedupe_by_key_and_date",
    f"""WITH {COPIED} {KEPT_ROWS} FROM (SELECT *, row_number() OVER (PARTITION BY trip_id, scoring_date
    ORDER BY {ALL_ORDER}) AS n FROM copied) WHERE n = 1""",
)
def dedupe_by_key_and_date(spark, sf_dir):
    """W2."""
    return plain(dedupe(_copied(spark, sf_dir), ["trip_id", "scoring_date"]).select(*KEPT_COLUMNS))


@query(
    "replay_day_map",
    """SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS target_date,
    CAST(DATE '1995-02-01' + CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) % 28 AS INTEGER) AS VARCHAR)
      AS source_date, count(*) AS orders FROM orders GROUP BY 1, 2""",
)
def replay_day_map(spark, sf_dir):
    """Every order date rotated through a 28-day window."""
    days = star.table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("target_date"))
    counted = days.agg(F.count(F.lit(1)).alias("orders"))
    mapped = replay_source_day(F.col("target_date"), dt.date(1995, 2, 1), 28)
    return plain(counted.withColumn("source_date", mapped))


@query(
    "remap_day",
    f"""SELECT CAST(CASE WHEN CAST(o_orderdate AS DATE) = DATE '{PICKUP_DAY}' THEN DATE '{RUN_DATE}' - 1
    ELSE CAST(o_orderdate AS DATE) END AS VARCHAR) AS scoring_date, count(*) AS orders FROM orders GROUP BY 1""",
)
def remapped_days(spark, sf_dir):
    """P8, with the run date as a parameter."""
    day = remap_day(F.to_date("o_orderdate"), PICKUP_DAY, F.lit(RUN_DATE))
    orders = star.table(spark, sf_dir, "orders").groupBy(day.alias("scoring_date"))
    return plain(orders.agg(F.count(F.lit(1)).alias("orders")))


@query(
    "label_lag",
    """SELECT CAST(CAST(o_orderdate AS DATE) - 7 AS VARCHAR) AS eval_date, count(*) AS orders FROM orders GROUP BY 1""",
)
def label_lag(spark, sf_dir):
    """G6."""
    orders = star.table(spark, sf_dir, "orders")
    dated = orders.groupBy(mature_date(F.to_date("o_orderdate"), 7).alias("eval_date"))
    return plain(dated.agg(F.count(F.lit(1)).alias("orders")))


# 2022-02-10 is day 19033 since the epoch; 19033 mod 28 = 21, so the source day is 1995-02-22.
INGEST_SQL = f"""{TRIPS}, day AS (
  SELECT DATE '1995-02-01' + CAST(date_diff('day', DATE '1970-01-01', DATE '2022-02-10') % 28 AS INTEGER) AS d),
candidate AS (
  SELECT '2022-02-10' AS scoring_date, vendor_id, passenger_count, trip_distance, fare_amount, total_amount, payment_type, is_high_tip,
    pickup_datetime, dropoff_datetime, tip_amount
  FROM trips, day WHERE CAST(pickup_datetime AS DATE) = day.d AND {QUALITY}),
kept AS (SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY pickup_datetime, dropoff_datetime, vendor_id, trip_distance, total_amount ORDER BY {ALL_ORDER}) AS n FROM candidate) WHERE n = 1)"""


@query(
    "ingest_rows",
    f"""WITH {INGEST_SQL} SELECT TRUE AS key_is_own, scoring_date, vendor_id, passenger_count, trip_distance, fare_amount,
    total_amount, payment_type, is_high_tip FROM kept""",
)
def ingest_rows(spark, sf_dir):
    """E1, the rows: P9, S1, P1, P3, P10, K1, W1. The engines print some doubles differently,
    so SQL partitions by the key's attributes and here each key must stand for one row."""
    rows = replay_rows(star.source_trips(spark, sf_dir), JobConfig(**REPLAY)).select(*KEPT_COLUMNS)
    own = rows.withColumn("key_is_own", F.count(F.lit(1)).over(Window.partitionBy("trip_id")) == 1)
    return plain(own.drop("trip_id"))


@query(
    "ingest_new_dates",
    f"""WITH {TRIPS}, held AS (SELECT scoring_date FROM trips WHERE {IN_BASELINE})
    SELECT CAST(scoring_date AS VARCHAR) AS scoring_date, count(*) AS trips FROM trips t
    WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.scoring_date = t.scoring_date) GROUP BY scoring_date""",
)
def ingest_new_dates(spark, sf_dir):
    """Insert only dates the table does not hold."""
    rows = star.trips(spark, sf_dir)
    held = partitions(star.trips(spark, sf_dir, *BASELINE), *BASELINE)
    return plain(without_populated_dates(rows, held).groupBy("scoring_date").agg(F.count(F.lit(1)).alias("trips")))


def job_tables(spark, **settings) -> JobConfig:
    """A job on its own set of tables in the shared folder."""
    root = fresh_dir(spark, "tables")
    tag = root[-12:]
    names = ("features_table", "feature_view", "predictions_table", "ledger_table", "metrics_table", "logs_table", "registry_table")
    cfg = JobConfig(table_root=root, **{n: f"{n}_{tag}" for n in names}, **settings)
    create_tables(spark, cfg)
    return cfg


@query(
    "ingest_guarded",
    f"""WITH {INGEST_SQL} SELECT count(*) AS first_insert, 0::BIGINT AS second_insert, count(*) AS rows_held,
    sum(is_high_tip)::BIGINT AS high_tip FROM kept""",
)
def ingest_guarded(spark, sf_dir):
    """Written once, skipped the second time, read back."""
    cfg = job_tables(spark, **REPLAY)
    source = star.source_trips(spark, sf_dir)
    first = ingest_partition(spark, cfg, source)
    second = ingest_partition(spark, cfg, source)
    return partition(spark.table(cfg.features_table), cfg.target).agg(
        F.lit(first).cast("long").alias("first_insert"),
        F.lit(second).cast("long").alias("second_insert"),
        F.count(F.lit(1)).alias("rows_held"),
        F.sum("is_high_tip").alias("high_tip"),
    )


REPLAY_DATES = [dt.date(2022, 2, 1) + dt.timedelta(days=k) for k in range(28)]
INGEST_MANY_SQL = f"""{TRIPS}, wanted AS (
  SELECT d, DATE '1995-02-01' + CAST(date_diff('day', DATE '1970-01-01', d) % 28 AS INTEGER) AS source_day
  FROM (SELECT DATE '2022-02-01' + CAST(k AS INTEGER) AS d FROM range(28) AS r(k))),
arrived AS (SELECT DISTINCT d, pickup_datetime, dropoff_datetime, vendor_id, trip_distance, total_amount, is_high_tip
  FROM trips JOIN wanted ON CAST(pickup_datetime AS DATE) = source_day WHERE {QUALITY}),
kept AS (SELECT d, pickup_datetime, dropoff_datetime, vendor_id, trip_distance, total_amount FROM arrived GROUP BY ALL)"""


@query(
    "ingest_many_dates",
    f"""WITH {INGEST_MANY_SQL} SELECT CAST(d AS VARCHAR) AS scoring_date, count(*) AS trips, (SELECT count(DISTINCT d) FROM kept) AS dates_held,
    (SELECT count(*) FROM kept WHERE d <> DATE '2022-02-10') AS rows_written, 0::BIGINT AS written_again FROM kept GROUP BY d""",
)
def ingest_many_dates(spark, sf_dir):
    """28 dates filled together, one of which was held already; a second run writes nothing."""
    cfg = job_tables(spark, **REPLAY)
    source = star.source_trips(spark, sf_dir)
    ingest_partition(spark, cfg, source)
    first = ingest_dates(spark, cfg, source, REPLAY_DATES)
    again = ingest_dates(spark, cfg, source, REPLAY_DATES)
    held = spark.table(cfg.features_table).groupBy("scoring_date").agg(F.count(F.lit(1)).alias("trips"))
    dates = held.count()
    return plain(
        held.select(
            "scoring_date",
            "trips",
            F.lit(dates).cast("long").alias("dates_held"),
            F.lit(first["rows_written"]).cast("long").alias("rows_written"),
            F.lit(again["rows_written"]).cast("long").alias("written_again"),
        )
    )


@query(
    "seed_load",
    f"""WITH {TRIPS}, picked AS (SELECT *, CASE WHEN CAST(pickup_datetime AS DATE) = DATE '{PICKUP_DAY}'
      THEN DATE '{RUN_DATE}' - 1 ELSE CAST(pickup_datetime AS DATE) END AS logical_date
      FROM trips WHERE {QUALITY} AND (CAST(pickup_datetime AS DATE) BETWEEN DATE '1995-01-01' AND DATE '1995-12-31'
        OR CAST(pickup_datetime AS DATE) IN (DATE '{PICKUP_DAY}', DATE '{EXTRA_DAYS[1]}'))),
    keyed AS (SELECT DISTINCT logical_date, pickup_datetime, dropoff_datetime, coalesce(vendor_id, ''),
      trip_distance, total_amount, is_high_tip FROM picked)
    SELECT CAST(logical_date AS VARCHAR) AS scoring_date, count(*) AS row_count,
      count(*) FILTER (WHERE is_high_tip = 1) AS high_tip FROM keyed GROUP BY logical_date""",
)
def seed_load(spark, sf_dir):
    """The feature table replaced by the seed, then summarised."""
    cfg = job_tables(spark, **REPLAY)
    train = (dt.date(1995, 1, 1), dt.date(1995, 12, 31))
    seed(spark, cfg, star.source_trips(spark, sf_dir), train, PICKUP_DAY, EXTRA_DAYS[1], F.lit(RUN_DATE))
    return plain(partition_summary(spark.table(cfg.features_table)))
