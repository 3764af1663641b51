"""Alerts over the metrics that runs leave, as a stream that is stopped and goes on."""

import datetime as dt
import glob
import shutil

import pytest

from tidegate import schemas
from tidegate.operators.alerts import counter_increases, gauge_alerts, metric_counters, metric_firings, metric_gauges, metric_incidents
from tidegate.sources.shared import fresh_dir
from tidegate.streaming.alerts import alert_on_metrics

NOON = dt.datetime(2022, 2, 10, 12, tzinfo=dt.timezone.utc)


def point(seconds, value, name="feature_psi", feature="fare_amount", kind="gauge"):
    attributes = {"model_name": "m"} | ({"feature": feature} if feature else {})
    return (name, kind, NOON + dt.timedelta(seconds=seconds), value, attributes)


def metrics(spark, points):
    return spark.createDataFrame(points, schemas.RUN_METRICS)


def seconds(value):
    return (value.replace(tzinfo=dt.timezone.utc) - NOON).total_seconds()


def rows(frame):
    return sorted((r["feature"], seconds(r["window_start"]), r["max_value"]) for r in frame.collect())


@pytest.fixture
def folders(spark):
    return fresh_dir(spark, "metrics"), fresh_dir(spark, "alerts")


def test_a_halting_psi_raises_one_alert_that_stays_one(spark, folders):
    given, out = folders
    metrics(spark, [point(10, 0.3), point(20, 0.4), point(30, 0.25), point(400, 0.25), point(700, 0.26, feature="trip_distance")]).write.parquet(given)
    want = [("fare_amount", 0.0, 0.4), ("trip_distance", 600.0, 0.26)]
    assert rows(alert_on_metrics(spark, given, out)) == want
    assert rows(alert_on_metrics(spark, given, out)) == want  # nothing new
    # points of other metrics, at the threshold, and a larger one of a window that fired already
    metrics(spark, [point(40, 0.9), point(41, 0.9, "roc_auc", None), point(2000, 0.25), point(45, 7.0, "rows_scored", None, "counter")]).write.mode("append").parquet(given)
    assert rows(alert_on_metrics(spark, given, out)) == [("fare_amount", 0.0, 0.9), want[1]]


def test_a_batch_that_is_done_again_counts_once(spark, folders):
    given, out = folders
    metrics(spark, [point(10, 0.3)]).write.parquet(given)
    want = rows(alert_on_metrics(spark, given, out))
    for commit in glob.glob(f"{out}-progress/commits/*"):  # as if the query had died after writing, before its commit
        if commit.endswith("/0"):
            shutil.move(commit, commit.replace("/commits/0", "/lost"))
    for name in glob.glob(f"{out}-progress/commits/.0.crc"):
        shutil.move(name, name.replace("/commits/.0.crc", "/lost.crc"))
    assert rows(alert_on_metrics(spark, given, out)) == want
    assert len(glob.glob(f"{out}/batch=0/part-*")) >= 1


def test_no_metrics_no_alerts(spark, folders):
    given, out = folders
    metrics(spark, []).write.parquet(given)
    assert rows(alert_on_metrics(spark, given, out)) == []


def test_metric_incidents_close_after_a_day(spark):
    day = 86_400
    at = [0, 600, day + 600, 2 * day + 1200, 2 * day + 1500]  # gaps of up to a day belong together
    alerts = gauge_alerts(metric_gauges(metrics(spark, [point(s, 0.5) for s in at])))
    assert {r["rule"] for r in metric_firings(alerts).collect()} == {"feature_psi:fare_amount"}
    found = sorted((seconds(r["opened_at"]), seconds(r["closed_at"]), r["firings"]) for r in metric_incidents(alerts).collect())
    assert found == [(0, 2 * day + 600, 3), (2 * day + 1200, 3 * day + 1500, 2)]


def test_counter_of_runs(spark):
    points = [point(0, 100.0, "rows_scored", None, "counter"), point(0, 250.0, "rows_scored", None, "counter"), point(400, 300.0, "rows_scored", None, "counter"), point(1, 0.7, "roc_auc", None)]
    found = counter_increases(metric_counters(metrics(spark, points))).collect()
    assert sorted(r["increase"] for r in found) == [50.0, 100.0, 150.0]
