"""Shared inputs of the queries and the same inputs as SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.scoring import LinearScorer
from tidegate.operators.features import feature_view
from tidegate.sources import star

BASELINE = (dt.date(1995, 1, 1), dt.date(1995, 12, 1))
TARGET = dt.date(1998, 3, 1)
MODEL_NAME = "tip_model"

FROZEN = LinearScorer(
    intercept=-2.4222,
    numeric={"fare_amount": 0.04595, "trip_distance": 0.00295, "passenger_count": -0.00566},
    categorical={"vendor_id": {"A": -0.0111, "N": 0.0633, "R": -0.0523}},
)


def plain(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, so engines compare them alike."""
    out = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        out.append(column.alias(field.name))
    return df.select(*out)


def rounded(df: DataFrame, **decimals: int) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), d) for c, d in decimals.items()})


def view(spark: SparkSession, sf_dir: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    return feature_view(star.trips(spark, sf_dir, first, last))


def scored(spark: SparkSession, sf_dir: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    return FROZEN.score(view(spark, sf_dir, first, last))


STAMP = "'%Y-%m-%d %H:%M:%S.%f'"

TRIPS = f"""
trips AS (
  SELECT md5(concat_ws('|', strftime(o_orderdate, {STAMP}), strftime(l_shipdate, {STAMP}),
                       coalesce(l_returnflag, ''), CAST(l_quantity AS VARCHAR), CAST(l_extendedprice AS VARCHAR))) AS trip_id,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS scoring_date,
         o_orderdate AS pickup_datetime, l_shipdate AS dropoff_datetime, l_returnflag AS vendor_id,
         CAST(l_linenumber AS BIGINT) AS passenger_count, l_quantity AS trip_distance,
         l_extendedprice / 1000 AS fare_amount,
         l_extendedprice * (1 + l_tax) / 1000 + tip_amount AS total_amount, tip_amount,
         CASE o_orderpriority WHEN '5-LOW' THEN '2' WHEN '4-NOT SPECIFIED' THEN '0' ELSE '1' END AS payment_type,
         CAST(CASE WHEN tip_amount > 2.0 THEN 1 ELSE 0 END AS BIGINT) AS is_high_tip
  FROM (SELECT *, CASE WHEN o_orderpriority = '5-LOW' THEN 0.0::DOUBLE ELSE l_extendedprice * l_discount / 1000 END AS tip_amount
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
)"""

QUALITY = """vendor_id IS NOT NULL AND passenger_count > 0 AND trip_distance > 0
    AND fare_amount BETWEEN 2.50 AND 100.00 AND total_amount > 0"""

VIEW = f"""{TRIPS},
v AS (
  SELECT trip_id, scoring_date, pickup_datetime, vendor_id, passenger_count, trip_distance, fare_amount, is_high_tip
  FROM trips WHERE {QUALITY} AND payment_type = '1'
)"""

LOGIT = """(-2.4222::DOUBLE + fare_amount * 0.04595::DOUBLE + trip_distance * 0.00295::DOUBLE
    + passenger_count * (-0.00566::DOUBLE)
    + CASE vendor_id WHEN 'A' THEN -0.0111::DOUBLE WHEN 'N' THEN 0.0633::DOUBLE WHEN 'R' THEN -0.0523::DOUBLE ELSE 0 END)"""

SCORED = f"""{VIEW},
scored AS (SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + exp(-{LOGIT})) AS p1 FROM v)"""

IN_BASELINE = f"scoring_date BETWEEN DATE '{BASELINE[0]}' AND DATE '{BASELINE[1]}'"
IN_TARGET = f"scoring_date = DATE '{TARGET}'"


def metrics_sql(rows: str, by: str = "") -> str:
    """Six evaluation metrics per group, with the AUC from average ranks."""
    key = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
  SELECT {key}count(*) AS labelled_rows,
         sum(CASE WHEN hit AND y = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN hit AND y = 0 THEN 1 ELSE 0 END) AS fp,
         sum(y) AS pos, sum(1 - y) AS neg,
         avg(-(y * ln(pc) + (1 - y) * ln(1 - pc))) AS log_loss, sum(CASE WHEN y = 1 THEN rank_avg ELSE 0 END) AS ranks
  FROM (SELECT *, p1 > 0.5 AS hit, least(greatest(p1, 1e-15), 1 - 1e-15) AS pc,
               rank() OVER ({part} ORDER BY p1) + (count(*) OVER (PARTITION BY {key}p1) - 1) / 2.0::DOUBLE AS rank_avg
        FROM (SELECT *, is_high_tip AS y FROM {rows} WHERE is_high_tip IS NOT NULL)) {group}"""


METRIC_COLUMNS = """CAST(labelled_rows AS BIGINT) AS labelled_rows,
  round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(pos, 0), 0), 6) AS recall,
  round((tp + neg - fp) / labelled_rows, 6) AS accuracy,
  round(coalesce(2 * tp / nullif(2 * tp + fp + pos - tp, 0), 0), 6) AS f1_score, round(log_loss, 6) AS log_loss,
  round((ranks - pos * (pos + 1) / 2.0::DOUBLE) / nullif(pos * neg, 0), 6) AS roc_auc"""
METRIC_DECIMALS = dict(precision=6, recall=6, accuracy=6, f1_score=6, log_loss=6, roc_auc=6)
