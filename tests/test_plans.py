"""What the optimizer makes of the queries."""

import datetime as dt
import re

import pytest

from helpers import TARGET, day_rows, features
from tidegate.operators.features import feature_view
from tidegate.operators.predictions import predict
from tidegate.queries import QUERIES
from tidegate.queries.base import BASELINE, FROZEN, view
from tidegate.sources.shared import fresh_dir
from tidegate.sources.tables import create_table, partition, partitions, replace_table
from tidegate.queries.rows import PICKUP_DAY
from tidegate.sources import star
from tidegate.functions.rows import on_day
from tidegate import schemas

SF_DIR = "/root/testdata/sf0.001"
WRITERS = (
    "ingest_guarded", "seed_load", "score_published", "backfill_published", "quality_warnings", "rows_scored_increase",
    "nightly_run", "nightly_run_halted", "train_model", "compare_feature_sets",
)


def plan(df):
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", 100_000)
    return spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def table(spark):
    create_table(spark, "planned", schemas.FEATURES, fresh_dir(spark, "planned"))
    days = [TARGET + dt.timedelta(days=i) for i in range(5)]
    replace_table(spark, features(spark, [r for d in days for r in day_rows(d, [10, 20])]), "planned")
    return spark.table("planned")


def test_partition_reads_are_pruned(table):
    for df in (partition(feature_view(table), TARGET), partitions(feature_view(table), TARGET, TARGET)):
        filters = re.search(r"PartitionFilters: \[(.*?)\]", plan(df)).group(1)
        assert "scoring_date" in filters


def test_only_needed_columns_are_read(table):
    text = plan(partition(feature_view(table), TARGET).select("fare_amount"))
    read = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert "fare_amount" in read and "trip_id" not in read and "tip_amount" not in read and "pickup" not in read


def test_quality_filters_reach_the_scan(table):
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan(feature_view(table))).group(1)
    for part in ("GreaterThanOrEqual(fare_amount,2.5)", "LessThanOrEqual(fare_amount,100.0)", "EqualTo(payment_type,1)"):
        assert part in pushed


def test_source_day_is_a_pushed_range(table):
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan(table.where(on_day("pickup_datetime", PICKUP_DAY)))).group(1)
    assert "GreaterThanOrEqual(pickup_datetime" in pushed and "LessThan(pickup_datetime" in pushed


def test_months_prune_the_order_scan(spark):
    text = plan(view(spark, SF_DIR, *BASELINE))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(WRITERS)))
def test_no_nested_loops(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


def test_batch_scoring_needs_no_shuffle_and_no_python(table):
    text = plan(predict(partition(feature_view(table), TARGET), FROZEN, "m", TARGET))
    assert "Exchange" not in text and "Python" not in text


def test_trip_join_reads_no_unused_column(spark):
    text = plan(star.trips(spark, SF_DIR).select("scoring_date"))
    assert "l_extendedprice" not in text and "md5" not in text
