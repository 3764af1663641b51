"""The driver's star-schema tables mapped onto trips, metric points and log lines.

Lineitem joined to its order stands in for a trip; its logical date is the order
month. The event stream stands in for gauge points, counter points and logs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.functions.rows import above, trip_key
from tidegate.config import HIGH_TIP_ABOVE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _next_month(day: dt.date) -> dt.date:
    return (day.replace(day=1) + dt.timedelta(days=32)).replace(day=1)


def trips(
    spark: SparkSession, sf_dir: str, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """Feature-table rows; ``first``/``last`` months are pushed to the order scan.

    The join is left to the optimizer: orders broadcast only when statistics or
    the measured shuffle size prove them small, else both sides shuffle on the
    order key, which no single order dominates.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    if first is not None:
        orders = orders.where(F.col("o_orderdate") >= F.lit(first).cast("timestamp_ntz"))
    if last is not None:
        orders = orders.where(F.col("o_orderdate") < F.lit(_next_month(last)).cast("timestamp_ntz"))
    lines = table(spark, sf_dir, "lineitem")
    price, priority = F.col("l_extendedprice"), F.col("o_orderpriority")
    tip = F.when(priority == "5-LOW", F.lit(0.0)).otherwise(price * F.col("l_discount") / 1000)
    joined = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).withColumn("tip_amount", tip)
    return joined.select(
        trip_key(
            F.col("o_orderdate"), F.col("l_shipdate"), F.col("l_returnflag"), F.col("l_quantity"), price
        ).alias("trip_id"),
        F.trunc(F.to_date("o_orderdate"), "month").alias("scoring_date"),
        F.col("o_orderdate").cast("timestamp").alias("pickup_datetime"),
        F.col("l_shipdate").cast("timestamp").alias("dropoff_datetime"),
        F.col("l_returnflag").alias("vendor_id"),
        F.col("l_linenumber").cast("long").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        (price / 1000).alias("fare_amount"),
        (price * (F.lit(1.0) + F.col("l_tax")) / 1000 + F.col("tip_amount")).alias("total_amount"),
        "tip_amount",
        F.when(priority == "5-LOW", "2").when(priority == "4-NOT SPECIFIED", "0").otherwise("1").alias("payment_type"),
        F.when(above(F.col("tip_amount"), HIGH_TIP_ABOVE), F.lit(1)).otherwise(F.lit(0)).cast("long").alias("is_high_tip"),
    )


def source_trips(spark: SparkSession, sf_dir: str, pickup: Column | None = None) -> DataFrame:
    """The same rows shaped as an upstream source: no key, date or label yet."""
    rows = trips(spark, sf_dir).drop("trip_id", "scoring_date", "is_high_tip")
    return rows if pickup is None else rows.where(pickup)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def gauge_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One gauge per event type."""
    return events(spark, sf_dir).select(F.col("event_type").alias("feature"), "ts", "value")


def counter_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cumulative counter per user: the running sum of its values.

    A running sum per user in one window task would not survive a hot user, so
    the sum runs per (user, day) and each day adds the total of the days before.
    The offsets hold one row per user and day and join on the window's own key.
    """
    day = events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    before = Window.partitionBy("user_id").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        day.groupBy("user_id", "day")
        .agg(F.sum("value").alias("day_total"))
        .select("user_id", "day", F.coalesce(F.sum("day_total").over(before), F.lit(0.0)).alias("carried"))
    )
    within = Window.partitionBy("user_id", "day").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return (
        day.withColumn("running", F.sum("value").over(within))
        .join(offsets, ["user_id", "day"])
        .select(
            F.col("user_id").cast("string").alias("series"),
            F.col("event_type").alias("model_name"),
            "ts",
            F.col("event_id").alias("seq"),
            (F.col("carried") + F.col("running")).alias("value"),
        )
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Container exit lines built from the error events."""
    code = F.get_json_object("props", "$.k")
    return (
        events(spark, sf_dir)
        .where(F.col("event_type") == "error")
        .select(
            "ts",
            "event_id",
            F.concat(F.lit("Container called exit("), code, F.lit(").")).alias("message"),
        )
    )


def firings(spark: SparkSession, sf_dir: str, threshold: float) -> DataFrame:
    """Alert firings: one rule per event type, firing above ``threshold``."""
    return (
        events(spark, sf_dir)
        .where(above(F.col("value"), threshold))
        .select(F.col("event_type").alias("rule"), "ts")
    )
