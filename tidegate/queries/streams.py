"""The alert rules as streaming queries over arriving event files.

A window or incident is emitted once the watermark has passed it, so the SQL
twins leave out those still open ten minutes before the newest event.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.functions.rows import above
from tidegate.operators.alerts import abnormal_exits, counter_increases, errors_only, increase_windows, run_status_feed
from tidegate.queries.alerts import (
    ALERT_ABOVE,
    COUNTER_ROWS,
    COUNTERS,
    ERROR_ROWS,
    EXIT_LINES,
    GAUGE_ROWS,
    GAUGES,
    INCIDENT_ROWS,
    INCIDENTS,
    NOTIFY_ABOVE,
    STATUS_ROWS,
    WINDOW_START,
    log_records_of,
    rate_limit_sql,
)
from tidegate.queries.base import STAMP, plain, rounded
from tidegate.registry import query
from tidegate.sources import star
from tidegate.sources.shared import fresh_dir
from tidegate.streaming.alerts import (
    gauge_alert_stream,
    incident_stream,
    increase_stream,
    increase_window_stream,
    late_point_stream,
    late_windows,
    rate_limited_stream,
    read_events,
    run_available,
)

WATERMARK_SQL = "(SELECT max(ts) - INTERVAL '10 minutes' FROM events)"


@query(
    "stream_gauge_alerts",
    f"WITH {GAUGES} {GAUGE_ROWS} WHERE max_value > {ALERT_ABOVE} AND s + INTERVAL '300 seconds' <= {WATERMARK_SQL}",
)
def stream_gauge_alerts(spark, sf_dir):
    """R1."""
    points = read_events(spark, sf_dir).select(F.col("event_type").alias("feature"), "ts", "value")
    return plain(_emitted(gauge_alert_stream(points, ALERT_ABOVE), "gauge-alerts"))


def _emitted(stream, name):
    return run_available(stream, fresh_dir(stream.sparkSession, name))


@query("stream_counter_windows", f"WITH {COUNTERS} {COUNTER_ROWS} WHERE s + INTERVAL '300 seconds' <= {WATERMARK_SQL}")
def stream_counter_windows(spark, sf_dir):
    """R2: readings to increases with state per series, then increases to windows."""
    increases, folder = _increases(spark, sf_dir)
    windows = increase_window_stream(spark.readStream.schema(increases.schema).parquet(folder))
    return plain(rounded(_emitted(windows, "increase-windows"), increase=4))


def _increases(spark, sf_dir, **limits):
    points_dir, folder = fresh_dir(spark, "counter-points"), fresh_dir(spark, "increases")
    points = star.counter_points(spark, sf_dir)
    points.write.parquet(points_dir)
    arriving = spark.readStream.schema(points.schema).parquet(points_dir)
    return run_available(increase_stream(arriving, **limits), folder), folder


IDLE_S = 43_200
RESTARTED = f"""points AS (SELECT user_id, event_type AS model_name, ts, event_id,
    sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS value FROM events),
pairs AS (SELECT *, lag(value) OVER u AS previous, lag(ts) OVER u AS before FROM points WINDOW u AS (PARTITION BY user_id ORDER BY ts, event_id)),
steps AS (SELECT model_name, ts,
    CASE WHEN ts - before <= INTERVAL '{IDLE_S} seconds' THEN greatest(value - previous, 0) ELSE value END AS inc FROM pairs),
w AS (SELECT model_name, {WINDOW_START} AS s, sum(inc) AS increase FROM steps GROUP BY ALL)"""


@query("stream_idle_counters", f"WITH {RESTARTED} {COUNTER_ROWS}")
def stream_idle_counters(spark, sf_dir):
    """R2 where a series that was silent for half a day starts anew."""
    increases, _ = _increases(spark, sf_dir, idle_s=IDLE_S)
    return plain(rounded(increase_windows(increases), increase=4))


@query("counter_idle_windows", f"WITH {RESTARTED} {COUNTER_ROWS}")
def counter_idle_windows(spark, sf_dir):
    """The same as a batch."""
    increases = counter_increases(star.counter_points(spark, sf_dir), idle_s=IDLE_S)
    return plain(rounded(increase_windows(increases), increase=4))


@query(
    "stream_late_points",
    f"""WITH received AS (SELECT event_type AS feature, ts, value, event_id, {WINDOW_START} AS s,
      ts + CAST(json_extract_string(props, '$.k') AS INTEGER) * INTERVAL '1 minute' AS arrived FROM events),
    clocks AS (SELECT *, max(ts) OVER (PARTITION BY feature) AS newest,
      max(ts) OVER (PARTITION BY feature ORDER BY arrived, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS clock FROM received),
    judged AS (SELECT *, coalesce(s + INTERVAL '900 seconds' <= clock, false) AS late FROM clocks)
    SELECT feature, strftime(s, {STAMP}) AS window_start, max(value) FILTER (NOT late) AS max_value,
      count(*) FILTER (NOT late) AS points, count(*) FILTER (late) AS late_points
    FROM judged WHERE s + INTERVAL '900 seconds' <= newest GROUP BY feature, s""",
)
def stream_late_points(spark, sf_dir):
    """R1 with events received as many minutes late as their payload says, and the late ones counted."""
    events = read_events(spark, sf_dir)
    minutes = F.get_json_object("props", "$.k").cast("int")
    points = events.select(
        F.col("event_type").alias("feature"),
        "ts",
        (F.col("ts") + F.make_dt_interval(mins=minutes)).alias("arrived"),
        F.col("event_id").alias("seq"),
        "value",
    )
    return plain(late_windows(_emitted(late_point_stream(points), "late-points")))


@query("stream_abnormal_exits", EXIT_LINES)
def stream_abnormal_exits(spark, sf_dir):
    """R3."""
    events = read_events(spark, sf_dir).where(F.col("event_type") == "error")
    code = F.get_json_object("props", "$.k")
    message = F.concat(F.lit("Container called exit("), code, F.lit(").")).alias("message")
    return _emitted(abnormal_exits(events.select("event_id", message)), "abnormal-exits")


@query("stream_run_status", STATUS_ROWS)
def stream_run_status(spark, sf_dir):
    """Each run summary as it arrives."""
    return plain(_emitted(run_status_feed(log_records_of(read_events(spark, sf_dir))), "run-status"))


@query("stream_error_records", ERROR_ROWS)
def stream_error_records(spark, sf_dir):
    """Each record of a halted or failed run as it arrives."""
    return _emitted(errors_only(log_records_of(read_events(spark, sf_dir))).select("event_id", "severity"), "error-records")


@query("stream_rate_limited", rate_limit_sql(NOTIFY_ABOVE))
def stream_rate_limited(spark, sf_dir):
    """R5."""
    return plain(_emitted(rate_limited_stream(_firings(spark, sf_dir, NOTIFY_ABOVE)), "notifications"))


@query(
    "stream_incidents",
    f"""WITH {INCIDENTS} {INCIDENT_ROWS}
    WHERE c <= (SELECT max(ts) - INTERVAL '10 minutes' FROM events WHERE value > {ALERT_ABOVE})""",
)
def stream_incidents(spark, sf_dir):
    """R7."""
    return plain(_emitted(incident_stream(_firings(spark, sf_dir, ALERT_ABOVE)), "incidents"))


def _firings(spark, sf_dir, threshold):
    events = read_events(spark, sf_dir).where(above(F.col("value"), threshold))
    return events.select(F.col("event_type").alias("rule"), "ts")
