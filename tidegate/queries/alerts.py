"""Alert rules over the event stream, read as a batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.operators.alerts import (
    abnormal_exits,
    counter_alerts,
    counter_increases,
    errors_only,
    gauge_alerts,
    gauge_windows,
    incidents,
    increase_windows,
    rate_limited,
    run_status_feed,
    status_severity,
)
from tidegate.queries.base import STAMP, plain, rounded
from tidegate.registry import query
from tidegate.sources import star

ALERT_ABOVE = 200.0
NOTIFY_ABOVE = 50.0

WINDOW_START = "time_bucket(INTERVAL '300 seconds', ts)"
GAUGES = f"""w AS (SELECT event_type AS feature, {WINDOW_START} AS s, max(value) AS max_value FROM events GROUP BY ALL)"""
GAUGE_ROWS = f"SELECT feature, strftime(s, {STAMP}) AS window_start, max_value FROM w"


@query("gauge_windows", f"WITH {GAUGES} {GAUGE_ROWS}")
def gauge_window_rows(spark, sf_dir):
    """R1, before the threshold."""
    return plain(gauge_windows(star.gauge_points(spark, sf_dir)))


@query("gauge_alerts", f"WITH {GAUGES} {GAUGE_ROWS} WHERE max_value > {ALERT_ABOVE}")
def gauge_alert_rows(spark, sf_dir):
    """R1."""
    return plain(gauge_alerts(star.gauge_points(spark, sf_dir), ALERT_ABOVE))


COUNTERS = f"""points AS (SELECT user_id, event_type AS model_name, ts, event_id,
    sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS value FROM events),
steps AS (SELECT model_name, ts, greatest(value - coalesce(lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0), 0) AS inc
  FROM points),
w AS (SELECT model_name, {WINDOW_START} AS s, sum(inc) AS increase FROM steps GROUP BY ALL)"""
COUNTER_ROWS = f"SELECT model_name, strftime(s, {STAMP}) AS window_start, round(increase, 4) AS increase FROM w"


@query("counter_windows", f"WITH {COUNTERS} {COUNTER_ROWS}")
def counter_window_rows(spark, sf_dir):
    """R2, before the threshold."""
    windows = increase_windows(counter_increases(star.counter_points(spark, sf_dir)))
    return plain(rounded(windows, increase=4))


@query("counter_alerts", f"WITH {COUNTERS} {COUNTER_ROWS} WHERE increase > {ALERT_ABOVE}")
def counter_alert_rows(spark, sf_dir):
    """R2."""
    return plain(rounded(counter_alerts(star.counter_points(spark, sf_dir), ALERT_ABOVE), increase=4))


LINES = """lines AS (SELECT event_id, 'Container called exit(' || json_extract_string(props, '$.k') || ').' AS message
  FROM events WHERE event_type = 'error')"""
EXIT_LINES = f"""WITH {LINES} SELECT event_id, message FROM lines
  WHERE regexp_matches(message, 'Container called exit[(](1|[4-9]|[1-9][0-9]+)[)]')"""


@query("abnormal_exits", EXIT_LINES)
def abnormal_exit_rows(spark, sf_dir):
    """R3."""
    return abnormal_exits(star.log_lines(spark, sf_dir)).select("event_id", "message")


def log_records_of(events):
    """Purchases stand in for run summaries, with the exit code taken from the payload."""
    code = F.get_json_object("props", "$.k").cast("int") % 4
    status = F.when(code == 0, "SUCCEEDED").when(code == 2, "HALTED").otherwise("FAILED")
    summary = F.when(F.col("event_type") == "purchase", "pipeline_run_summary").otherwise("phase")
    fields = F.to_json(
        F.struct(
            summary.alias("event"),
            status.alias("status"),
            F.date_format("ts", "yyyy-MM-dd").alias("target_date"),
            F.concat(status, F.lit(": "), F.col("event_type")).alias("status_message"),
            F.concat(F.lit("run-"), F.col("event_id")).alias("execution"),
            code.cast("string").alias("exit_code"),
        )
    )
    return events.select(
        "ts", "event_id", status_severity(status).alias("severity"), fields.alias("fields")
    )


RECORDS = """records AS (SELECT ts, event_id, event_type, code, CASE code WHEN 0 THEN 'SUCCEEDED' WHEN 2 THEN 'HALTED' ELSE 'FAILED' END AS status
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 AS code FROM events))"""


STATUS_ROWS = f"""WITH {RECORDS} SELECT strftime(ts, {STAMP}) AS ts, status, strftime(ts, '%Y-%m-%d') AS target_date,
    status || ': ' || event_type AS status_message, 'run-' || event_id AS execution, CAST(code AS VARCHAR) AS exit_code
    FROM records WHERE event_type = 'purchase'"""
ERROR_ROWS = f"WITH {RECORDS} SELECT event_id, 'ERROR' AS severity FROM records WHERE status IN ('HALTED', 'FAILED')"


@query("run_status_feed", STATUS_ROWS)
def run_status_rows(spark, sf_dir):
    """R4."""
    return plain(run_status_feed(log_records_of(star.events(spark, sf_dir))))


@query("error_records", ERROR_ROWS)
def error_records(spark, sf_dir):
    """R6."""
    return errors_only(log_records_of(star.events(spark, sf_dir))).select("event_id", "severity")


def rate_limit_sql(threshold: float) -> str:
    return f"""WITH RECURSIVE f AS (SELECT DISTINCT event_type AS rule, ts FROM events WHERE value > {threshold}),
    kept AS (
      SELECT rule, min(ts) AS ts FROM f GROUP BY rule
      UNION ALL
      SELECT k.rule, (SELECT min(f.ts) FROM f WHERE f.rule = k.rule AND f.ts >= k.ts + INTERVAL '300 seconds') AS ts
      FROM kept k WHERE k.ts IS NOT NULL)
    SELECT rule, strftime(ts, {STAMP}) AS ts FROM kept WHERE ts IS NOT NULL"""


@query("rate_limited", rate_limit_sql(NOTIFY_ABOVE))
def rate_limited_rows(spark, sf_dir):
    """R5."""
    return plain(rate_limited(star.firings(spark, sf_dir, NOTIFY_ABOVE)))


INCIDENTS = f"""f AS (SELECT event_type AS rule, ts FROM events WHERE value > {ALERT_ABOVE}),
g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY rule ORDER BY ts) <= INTERVAL '1800 seconds' THEN 0 ELSE 1 END AS opens FROM f),
n AS (SELECT *, sum(opens) OVER (PARTITION BY rule ORDER BY ts ROWS UNBOUNDED PRECEDING) AS i FROM g),
incidents AS (SELECT rule, min(ts) AS o, max(ts) + INTERVAL '1800 seconds' AS c, count(*) AS firings FROM n GROUP BY rule, i)"""
INCIDENT_ROWS = f"SELECT rule, strftime(o, {STAMP}) AS opened_at, strftime(c, {STAMP}) AS closed_at, firings FROM incidents"


@query("incidents", f"WITH {INCIDENTS} {INCIDENT_ROWS}")
def incident_rows(spark, sf_dir):
    """R7."""
    return plain(incidents(star.firings(spark, sf_dir, ALERT_ABOVE)))
