import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.operators.alerts import (
    abnormal_exits,
    counter_increases,
    gauge_alerts,
    incidents,
    increase_windows,
    rate_limited,
)
from tidegate.sources.shared import fresh_dir
from tidegate.streaming.alerts import (
    gauge_alert_stream,
    incident_stream,
    increase_stream,
    late_point_stream,
    late_windows,
    rate_limited_stream,
    run_available,
)

START = dt.datetime(2024, 1, 1)


def at(seconds):
    return START + dt.timedelta(seconds=float(seconds))


def frame(spark, rows):
    return spark.createDataFrame([(r, at(s)) for r, s in rows], "rule string, ts timestamp")


def kept_by_loop(rows, gap=300):
    out, last = [], {}
    for rule, s in sorted(set(rows)):
        if rule not in last or s - last[rule] >= gap:
            last[rule] = s
            out.append((rule, at(s)))
    return sorted(out)


def seconds(rng, rate, span):
    return np.round(np.cumsum(rng.exponential(1 / rate, int(rate * span))), 3).tolist()


def some_firings():
    rng = np.random.default_rng(11)
    rows = [("dense", s) for s in seconds(rng, 0.5, 9000)]
    rows += [("sparse", s) for s in seconds(rng, 1 / 400, 9000)]
    rows += [("even", float(s)) for s in range(0, 9000, 7)]
    rows += [("exact", float(s)) for s in range(0, 9000, 300)]
    rows += [("once", 4000.0), ("once", 4000.0)]
    return rows


@pytest.mark.parametrize("chunk_s", [300, 900, 3600, 86400])
def test_rate_limit_against_a_plain_loop(spark, chunk_s):
    rows = some_firings()
    got = sorted((r["rule"], r["ts"]) for r in rate_limited(frame(spark, rows), 300, chunk_s).collect())
    assert got == kept_by_loop(rows)


def test_rate_limit_rejects_a_chunk_shorter_than_the_gap(spark):
    with pytest.raises(ValueError):
        rate_limited(frame(spark, [("a", 0)]), 300, 60)


def incidents_by_loop(rows, close):
    out = []
    for rule in sorted({r for r, _ in rows}):
        times = sorted(s for r, s in rows if r == rule)
        first = last = times[0]
        n = 1
        for s in times[1:]:
            if s - last <= close:
                last, n = s, n + 1
            else:
                out.append((rule, at(first), at(last + close), n))
                first, last, n = s, s, 1
        out.append((rule, at(first), at(last + close), n))
    return sorted(out)


@pytest.mark.parametrize("close", [60, 300, 1800])
def test_incidents_against_a_plain_loop(spark, close):
    rows = some_firings()
    assert sorted(tuple(r) for r in incidents(frame(spark, rows), close).collect()) == incidents_by_loop(rows, close)


def points(spark, rows):
    return spark.createDataFrame(
        [(s, m, at(t), i, float(v)) for i, (s, m, t, v) in enumerate(rows)],
        "series string, model_name string, ts timestamp, seq long, value double",
    )


RESET = [("a", "m", 0, 10), ("a", "m", 100, 25), ("a", "m", 4000, 5), ("a", "m", 9000, 9), ("b", "m", 50, 3)]


@pytest.mark.parametrize("restart,total", [(False, 10 + 15 + 0 + 4 + 3), (True, 10 + 15 + 5 + 4 + 3)])
def test_counter_reset(spark, restart, total):
    """Readings of one series fall into different hours; the reset does too."""
    assert counter_increases(points(spark, RESET), restart).agg(F.sum("increase")).collect()[0][0] == total


def test_counter_windows_sum_series(spark):
    rows = {str(r["window_start"]): r["increase"] for r in increase_windows(counter_increases(points(spark, RESET))).collect()}
    assert rows["2024-01-01 00:00:00"] == 28.0


def test_gauge_alert_is_strict(spark):
    df = spark.createDataFrame([("f", at(1), 0.25), ("f", at(400), 0.2501), ("g", at(1), float("nan"))], "feature string, ts timestamp, value double")
    assert [(r["feature"], r["window_start"]) for r in gauge_alerts(df).collect()] == [("f", at(300))]


@pytest.mark.parametrize(
    "message,matches",
    [(f"Container called exit({n}).", n not in (0, 2, 3)) for n in (0, 1, 2, 3, 4, 9, 10, 137)]
    + [("Container Terminated on signal 9", True), ("Memory limit exceeded", True), ("all fine", False)],
)
def test_abnormal_exit_lines(spark, message, matches):
    assert abnormal_exits(spark.createDataFrame([(message,)], "message string")).count() == int(matches)


def as_stream(spark, df, files=3):
    """The frame in time order over several files, one per micro-batch."""
    folder = fresh_dir(spark, "arriving")
    df.repartitionByRange(files, "ts").sortWithinPartitions("ts").write.parquet(folder)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_streamed_rate_limit_over_several_batches(spark):
    rows = some_firings()
    # Files are read in no promised order, so one batch holds all of them here.
    stream = as_stream(spark, frame(spark, rows), files=1)
    got = run_available(rate_limited_stream(stream), fresh_dir(spark, "out"))
    assert sorted((r["rule"], r["ts"]) for r in got.collect()) == kept_by_loop(rows)


def test_state_outlives_a_restart(spark):
    """A second run over newly arrived files continues from the first one's state."""
    folder, out = fresh_dir(spark, "arriving"), fresh_dir(spark, "out")
    rows = some_firings()
    for first, last in ((0, 4000), (4000, 10**9)):
        part = [(r, s) for r, s in rows if first <= s < last]
        frame(spark, part).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema("rule string, ts timestamp").parquet(folder)
        got = run_available(rate_limited_stream(stream), out)
    assert sorted((r["rule"], r["ts"]) for r in got.collect()) == kept_by_loop(rows)


def test_streamed_increases_over_runs(spark):
    folder, out = fresh_dir(spark, "arriving"), fresh_dir(spark, "out")
    for part in (RESET[:2], RESET[2:]):
        df = points(spark, part)
        df.coalesce(1).write.mode("append").parquet(folder)
        got = run_available(increase_stream(spark.readStream.schema(df.schema).parquet(folder)), out)
    assert sorted(r["increase"] for r in got.collect()) == [0.0, 3.0, 4.0, 10.0, 15.0]


def test_streamed_windows_and_incidents_equal_the_batch_once_closed(spark):
    rows = some_firings()
    df = frame(spark, rows)
    got = run_available(incident_stream(as_stream(spark, df, 1), 300), fresh_dir(spark, "out"))
    newest = at(max(s for _, s in rows) - 600)
    want = [i for i in incidents_by_loop(rows, 300) if i[2] <= newest]
    assert sorted(tuple(r) for r in got.collect()) == want
    gauges = df.select(F.col("rule").alias("feature"), "ts", F.unix_seconds("ts").cast("double").alias("value"))
    alerts = run_available(gauge_alert_stream(as_stream(spark, gauges, 1), 0.0), fresh_dir(spark, "out"))
    batch = gauge_alerts(gauges, 0.0).where(F.col("window_start") + F.expr("INTERVAL 300 SECONDS") <= F.lit(newest))
    assert sorted(map(tuple, alerts.collect())) == sorted(map(tuple, batch.collect()))


def test_streamed_counter_does_not_count_late_readings(spark, tmp_path):
    """Batches in a fixed order: each is all there is when the query runs again from its progress."""
    source, out = str(tmp_path / "points"), str(tmp_path / "increases")
    batches = [[("a", 0, 10, 0), ("a", 20, 30, 2)], [("a", 10, 20, 1), ("b", 0, 5, 9)], [("a", 30, 40, 3), ("a", 30, 40, 3)], [("a", 30, 40, 3), ("b", 5, 2, 10)]]
    for rows in batches:
        frame_ = spark.createDataFrame([(s, "m", at(t), q, float(v)) for s, t, v, q in rows], "series string, model_name string, ts timestamp, seq long, value double")
        frame_.coalesce(1).write.mode("append").parquet(source)
        found = run_available(increase_stream(spark.readStream.schema(frame_.schema).parquet(source)), out)
    assert found.agg(F.sum("increase")).first()[0] == 40 + 5
    assert found.where("late").count() == 2


IDLE = [("a", 0, 10.0), ("b", 0, 7.0), ("a", 50, 15.0), ("a", 150, 18.0), ("b", 5_000, 9.0), ("a", 9_000, 40.0), ("a", 9_100, 41.0), ("b", 20_000, 11.0)]


def idle_points(spark, rows):
    return spark.createDataFrame([(s, "m", at(t), t, v) for s, t, v in rows], "series string, model_name string, ts timestamp, seq long, value double")


def test_an_idle_series_starts_anew_and_its_state_is_dropped(spark):
    """Each call is the query started again from its progress; batch and stream agree on every cut of the input."""
    want = sorted(r["increase"] for r in counter_increases(idle_points(spark, IDLE), idle_s=100).collect())
    assert want == sorted([10, 7, 5, 3, 9, 40, 1, 11])
    source, out = fresh_dir(spark, "arriving"), fresh_dir(spark, "out")
    held = []
    for first in (0, 4, 6, 7):
        rows = [r for r in IDLE[first : {0: 4, 4: 6, 6: 7, 7: 8}[first]]]
        idle_points(spark, rows).coalesce(1).write.mode("append").parquet(source)
        stream = increase_stream(spark.readStream.schema(idle_points(spark, rows).schema).parquet(source), 100, "200 seconds")
        got = run_available(stream, out)
        store = spark.read.format("statestore").option("stateVarName", "newest").load(f"{out}-progress")
        held.append(sorted(r["key"][0] for r in store.collect()))
    assert sorted(r["increase"] for r in got.collect()) == want
    assert held == [["a", "b"], ["a"], ["a"], ["b"]]


def test_no_state_is_left_of_a_rule_that_may_send_again(spark):
    source, out = fresh_dir(spark, "arriving"), fresh_dir(spark, "out")
    rows = [("a", 0), ("a", 10), ("b", 90_000), ("b", 90_400)]
    frame(spark, rows).coalesce(1).write.parquet(source)
    got = run_available(rate_limited_stream(spark.readStream.schema("rule string, ts timestamp").parquet(source)), out)
    assert sorted((r["rule"], r["ts"]) for r in got.collect()) == kept_by_loop(rows)
    store = spark.read.format("statestore").option("stateVarName", "allowed").load(f"{out}-progress")
    assert [r["key"][0] for r in store.collect()] == ["b"]


def late_by_loop(rows, span, delay):
    clock, windows = {}, {}
    for feature, t, value in rows:
        start = t // span * span
        entry = windows.setdefault((feature, start), [None, 0, 0])
        if start + span + delay <= clock.get(feature, -(10**9)):
            entry[2] += 1
        else:
            entry[1] += 1
            if value is not None and value == value:
                entry[0] = value if entry[0] is None else max(entry[0], value)
        clock[feature] = max(clock.get(feature, t), t)
    return sorted((f, at(s), *e) for (f, s), e in windows.items() if s + span + delay <= clock[f])


ARRIVING = "feature string, ts timestamp, arrived timestamp, seq long, value double"


@pytest.mark.parametrize("cuts", [[], [150], [1, 60, 61, 200]])
def test_late_points_are_counted_for_their_window(spark, cuts):
    rng = np.random.default_rng(5)
    times = np.maximum(np.arange(300) * 7 - rng.integers(0, 2, 300) * rng.integers(0, 400, 300), 0)
    values = [None if n % 31 == 0 else float("nan") if n % 37 == 0 else float(n % 11) for n in range(300)]
    rows = [("hot" if n % 3 else "cold", int(t), v) for n, (t, v) in enumerate(zip(times, values))]
    source, out = fresh_dir(spark, "arriving"), fresh_dir(spark, "out")
    for first, last in zip([0, *cuts], [*cuts, 300]):
        part = [(f, at(t), at(n // 4), n, v) for n, (f, t, v) in enumerate(rows) if first <= n < last]
        if first == 0:
            part.append(("hot", None, at(0), -1, 99.0))
        spark.createDataFrame(part[::-1], ARRIVING).coalesce(1).write.mode("append").parquet(source)
        got = run_available(late_point_stream(spark.readStream.schema(ARRIVING).parquet(source), 60, 120), out)
    want = late_by_loop(rows, 60, 120)
    assert sum(w[4] for w in want) > 10
    found = late_windows(got).select("feature", "window_start", "max_value", "points", "late_points")
    assert sorted(map(tuple, found.collect()), key=lambda r: r[:2]) == want
