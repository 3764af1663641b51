import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from helpers import TARGET, feature, features
from tidegate import schemas
from tidegate.config import JobConfig
from tidegate.functions.rows import (
    high_tip_label,
    mature_date,
    register_sql_functions,
    remap_day,
    replay_source_date,
    replay_source_day,
    trip_key,
)
from tidegate.operators.features import LeakageError, check_no_leak, dedupe, feature_rows, feature_view
from tidegate.operators.profile import contract_check


@pytest.mark.parametrize(
    "change,kept",
    [
        ({}, True),
        ({"fare_amount": 2.50}, True),
        ({"fare_amount": 100.00}, True),
        ({"fare_amount": 2.49}, False),
        ({"fare_amount": 100.01}, False),
        ({"fare_amount": math.nan}, False),
        ({"vendor_id": None}, False),
        ({"passenger_count": 0}, False),
        ({"passenger_count": None}, False),
        ({"trip_distance": 0.0}, False),
        ({"trip_distance": math.nan}, False),
        ({"total_amount": 0.0}, False),
        ({"total_amount": math.nan}, False),
        ({"payment_type": "2"}, False),
        ({"payment_type": None}, False),
    ],
)
def test_view_filters(spark, change, kept):
    rows = feature_view(features(spark, [feature(**change)]))
    assert rows.count() == int(kept)
    assert tuple(rows.columns) == schemas.VIEW_COLUMNS


def test_view_exposes_no_leak(spark):
    df = features(spark, [feature()])
    with pytest.raises(LeakageError):
        check_no_leak(df)
    check_no_leak(feature_view(df))


@pytest.mark.parametrize("tip,label,strict", [(2.0, 0, 0), (2.01, 1, 1), (None, 0, None), (math.nan, 0, 0)])
def test_label(spark, tip, label, strict):
    row = spark.createDataFrame([(tip,)], "tip double").select(
        high_tip_label(F.col("tip")).alias("a"), high_tip_label(F.col("tip"), null_label=True).alias("b")
    )
    assert tuple(row.collect()[0]) == (label, strict)


def test_key_is_total_and_matches_sql_function(spark):
    register_sql_functions(spark)
    at = dt.datetime(2022, 1, 1, 8, 30)
    rows = [(at, at, "1", 2.5, 14.0), (None, at, None, None, None), (at, None, "1", 2.5, None)]
    df = spark.createDataFrame(rows, "p timestamp, d timestamp, v string, dist double, total double")
    df.createOrReplaceTempView("keyed")
    columns = [F.col(c) for c in ("p", "d", "v", "dist", "total")]
    ours = [r[0] for r in df.select(trip_key(*columns)).collect()]
    sql = [r[0] for r in spark.sql("SELECT make_trip_id(p, d, v, dist, total) FROM keyed").collect()]
    assert ours == sql and len(set(ours)) == 3 and None not in ours


def test_key_tells_close_trips_apart(spark):
    at = dt.datetime(2022, 1, 1, 8, 30)
    later = at + dt.timedelta(milliseconds=250)
    rows = [(at, at, "1", 1.001, 14.0), (at, at, "1", 1.004, 14.0), (later, at, "1", 1.001, 14.0), (at, later, "1", 1.001, 14.0), (at, at, "1", 1.001, 14.004)]
    rows += [(at, at, "1", 0.0, 14.0), (at, at, "1", -0.0, 14.0)]
    df = spark.createDataFrame(rows, "p timestamp, d timestamp, v string, dist double, total double")
    df.createOrReplaceTempView("close")
    register_sql_functions(spark)
    keys = [r[0] for r in df.select(trip_key(*[F.col(c) for c in ("p", "d", "v", "dist", "total")])).collect()]
    assert len(set(keys)) == 6 and keys[5] == keys[6]
    assert [r[0] for r in spark.sql("SELECT make_trip_id(p, d, v, dist, total) FROM close").collect()] == keys
    source = [feature(trip_distance=1.001), feature(trip_distance=1.004), feature(pickup_datetime=later), feature(pickup_datetime=at)]
    assert feature_rows(features(spark, source).drop("trip_id", "scoring_date", "is_high_tip"), F.lit(TARGET)).count() == 4


def test_dedupe_keeps_the_least_row(spark):
    rows = [feature("a", fare_amount=9.0), feature("a", fare_amount=8.0), feature("b"), feature("b")]
    rows.append(feature("a", dt.date(2022, 2, 11)))
    df = features(spark, rows)
    by_date = dedupe(df, ["trip_id", "scoring_date"])
    assert by_date.columns == df.columns
    assert sorted((r["trip_id"], str(r["scoring_date"]), r["fare_amount"]) for r in by_date.collect()) == [
        ("a", "2022-02-10", 8.0),
        ("a", "2022-02-11", 10.0),
        ("b", "2022-02-10", 10.0),
    ]
    assert dedupe(df, ["trip_id"]).count() == 2


def test_ingest_keeps_rows_without_a_valid_label(spark):
    source = features(spark, [feature(payment_type="2")]).drop("trip_id", "scoring_date", "is_high_tip")
    assert feature_rows(source, F.lit(TARGET)).count() == 1


def test_replay_map(spark):
    start, days = dt.date(2022, 2, 1), 28
    targets = [dt.date(2026, 10, 6), dt.date(2022, 2, 10), dt.date(1969, 12, 31), dt.date(1970, 1, 1)]
    df = spark.createDataFrame([(t,) for t in targets], "t date")
    mapped = [r[0] for r in df.select(replay_source_day(F.col("t"), start, days)).collect()]
    assert mapped == [replay_source_date(t, start, days) for t in targets]
    assert all(start <= m < start + dt.timedelta(days=days) for m in mapped)
    week = [replay_source_date(targets[0] + dt.timedelta(days=i), start, days) for i in range(days)]
    assert len(set(week)) == days


def test_remap_and_maturity(spark):
    df = spark.createDataFrame([(dt.date(2022, 2, 10),), (dt.date(2022, 1, 1),)], "d date")
    run = F.lit(dt.date(2026, 10, 6))
    moved = [r[0] for r in df.select(remap_day(F.col("d"), dt.date(2022, 2, 10), run)).collect()]
    assert moved == [dt.date(2026, 10, 5), dt.date(2022, 1, 1)]
    assert df.select(mature_date(F.col("d"), 7)).collect()[0][0] == dt.date(2022, 2, 3)


def test_config():
    assert JobConfig(target_date=" 2022-02-10 ").target == TARGET
    assert JobConfig(target_date="2022-02-10", eval_label_lag_days=7).eval_date == dt.date(2022, 2, 3)
    yesterday = dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1)
    assert JobConfig(target_date="  ").target == yesterday == JobConfig().target
    assert (JobConfig().psi_threshold, JobConfig().min_roc_auc, JobConfig().replay_days) == (0.25, 0.60, 28)
    for bad in ({"eval_label_lag_days": -1}, {"min_row_count": -1}, {"replay_days": 0}):
        with pytest.raises(ValueError):
            JobConfig(**bad)


def test_source_year_must_match_window():
    with pytest.raises(ValueError, match="2021"):
        JobConfig(source_table="trips_2021")
    JobConfig(source_table="trips_2021", enable_replay_ingest=False)
    JobConfig(source_table="trips_2021", replay_start="2021-03-01")
    JobConfig(source_table="trips")


def test_contract_check_finds_an_unfilled_column(spark):
    df = features(spark, [feature("a", payment_type=None), feature(None, dt.date(2022, 2, 11))])
    found = contract_check(df, schemas.FILTERED_COLUMNS, ("trip_id",)).where("violated").collect()
    assert {(str(r["scoring_date"]), r["column_name"]) for r in found} == {
        ("2022-02-10", "payment_type"),
        ("2022-02-11", "trip_id"),
    }
