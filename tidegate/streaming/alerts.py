"""Alert rules as streaming queries.

Stateless rules (R3, R4, R6) and the tumbling gauge rule (R1) reuse the batch
functions unchanged; only what must remember earlier rows is written here.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from tidegate import schemas
from tidegate.config import ALERT_WINDOW_S, COUNTER_IDLE_S, LATE_AFTER_S, LOG_INCIDENT_CLOSE_S, NOTIFY_GAP_S, PSI_HALT_AT
from tidegate.operators.alerts import MICROS, gauge_alerts, increase_windows, keep_first, metric_gauges

WATERMARK = "10 minutes"
LATEST = "1 day"  # how late a row may be for rules that remember a key's newest one
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def read_events(spark: SparkSession, folder: str, pattern: str = "events*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """Event files arriving in a folder; a micro-batch takes all there are unless told how many."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    reader = spark.readStream.schema(EVENTS).option("pathGlobFilter", pattern)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(folder)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def watermarked(stream: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Rows later than the delay are dropped, and counted in the query progress."""
    return stream.withWatermark("ts", delay)


def gauge_alert_stream(points: DataFrame, threshold: float, delay: str = WATERMARK) -> DataFrame:
    """A window is reported once, when the watermark passes its end."""
    return gauge_alerts(watermarked(points, delay), threshold)


def increase_stream(points: DataFrame, idle_s: int = COUNTER_IDLE_S, delay: str = LATEST) -> DataFrame:
    """R2, first half: increases per series, remembering each series' newest reading.

    A reading older than the newest (by time, then ``seq``) comes too late to count:
    the newer one has counted its increase already. It is emitted with no increase and
    marked late. A reading more than ``idle_s`` after the one before counts from zero, so
    a series' state (three numbers) is dropped once the watermark is ``idle_s`` past it:
    whatever may still come would not have used it. Readings behind the watermark are
    dropped by Spark, which counts them in the query's progress.
    """
    idle = idle_s * MICROS

    class Readings(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.newest = handle.getValueState("newest", "t long, seq long, value double")

        def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
            newest, order, last = self.newest.get() if self.newest.exists() else (-(2**62), -(2**63), 0.0)
            arrived = pd.concat(list(rows)).sort_values(["t", "seq"])
            late = ((arrived["t"] < newest) | ((arrived["t"] == newest) & (arrived["seq"] <= order))).to_numpy()
            out = pd.DataFrame({"model_name": arrived["model_name"], "t": arrived["t"], "increase": 0.0, "late": late})
            fresh = arrived[~late]
            if len(fresh):
                times, values = fresh["t"].to_numpy(), fresh["value"].to_numpy()
                before = np.append(last, values[:-1])
                before[times - np.append(newest, times[:-1]) > idle] = 0.0
                steps = values - before
                out.loc[~late, "increase"] = np.where(steps > 0, steps, 0.0)
                self.newest.update((int(times[-1]), int(fresh["seq"].iloc[-1]), float(values[-1])))
                wake(self.handle, int(times[-1]) + idle)
            yield out

        def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
            self.newest.clear()
            yield from ()

    wake = _one_timer()
    found = (
        watermarked(points, delay)
        .select("series", "model_name", "ts", F.unix_micros("ts").alias("t"), "seq", "value")
        .groupBy("series")
        .transformWithStateInPandas(
            Readings(), "model_name string, t long, increase double, late boolean", "append", "eventTime"
        )
    )
    return found.select("model_name", F.timestamp_micros("t").alias("ts"), "increase", "late")


def _one_timer():
    """Sets a key's only timer to just after an instant in microseconds; a closure, so that it travels whole."""

    def wake(handle: StatefulProcessorHandle, after: int) -> None:
        for old in handle.listTimers():
            handle.deleteTimer(old)
        handle.registerTimer(after // 1_000 + 1)

    return wake


def increase_window_stream(increases: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """R2, second half, over the table of increases written by the first."""
    return increase_windows(watermarked(increases, delay))


def rate_limited_stream(firings: DataFrame, gap_s: int = NOTIFY_GAP_S, delay: str = LATEST) -> DataFrame:
    """Notifications, remembering when each rule may send again.

    Once the watermark has passed that instant the state says nothing more and is dropped.
    """
    gap = gap_s * MICROS
    picks, wake = keep_first(gap), _one_timer()

    class Sendings(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.allowed = handle.getValueState("allowed", "t long")

        def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
            allowed = self.allowed.get()[0] if self.allowed.exists() else -(2**62)
            kept = picks(np.unique(np.concatenate([r["t"].to_numpy() for r in rows])), allowed)
            if len(kept):
                again = int(kept[-1]) + gap
                self.allowed.update((again,))
                wake(self.handle, again)
            yield pd.DataFrame({"rule": key[0], "t": kept})

        def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
            self.allowed.clear()
            yield from ()

    notified = (
        watermarked(firings, delay)
        .select("rule", "ts", F.unix_micros("ts").alias("t"))
        .groupBy("rule")
        .transformWithStateInPandas(Sendings(), "rule string, t long", "append", "eventTime")
    )
    return notified.select("rule", F.timestamp_micros("t").alias("ts"))


def late_point_stream(points: DataFrame, seconds: int = ALERT_WINDOW_S, delay_s: int = LATE_AFTER_S) -> DataFrame:
    """R1's windows with the points that came too late for them, one by one, which a watermark only drops.

    ``points`` have ``arrived`` and ``seq``, the order in which they were received. Each
    series has a clock, the newest time among the points received before; a window closes
    when the clock is ``delay_s`` past its end, and a point of a closed window is late.
    State is the clock and the open windows of a series. Emitted are closed windows with
    their maximum and number of points, and numbers of late points as they come;
    ``late_windows`` puts them together. Windows a series has not passed yet are not
    emitted. A NULL or NaN value counts as a point but is no maximum; a point without a
    time belongs to no window and is left out. Within a micro-batch the order is that of
    ``arrived`` and ``seq``, over micro-batches that of the batches.
    """
    span, delay = seconds * MICROS, delay_s * MICROS

    class Windows(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.clock = handle.getValueState("clock", "t long")
            self.open = handle.getMapState("open", "start long", "max_value double, points long")

        def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
            arrived = pd.concat(list(rows)).sort_values(["arrived", "seq"])
            times = arrived["t"].to_numpy()
            clock = self.clock.get()[0] if self.clock.exists() else -(2**62)
            clocks = np.maximum.accumulate(np.append(clock, times))
            starts = times - times % span
            late = starts + span + delay <= clocks[:-1]
            missed = pd.Series(starts[late]).value_counts()
            fresh = arrived[~late].groupby(starts[~late])["value"].agg(["max", "size"])
            found = {int(start): (high, int(n)) for start, high, n in fresh.itertuples()}
            held = {int(start[0]): (np.nan if value[0] is None else value[0], value[1]) for start, value in self.open.iterator()}
            done = []
            for start in sorted(found.keys() | held.keys()):
                high, n = (f(a, b) for f, a, b in zip((np.fmax, int.__add__), found.get(start, (np.nan, 0)), held.get(start, (np.nan, 0))))
                if start + span + delay <= clocks[-1]:
                    done.append((start, None if np.isnan(high) else float(high), n, 0))
                    if start in held:
                        self.open.removeKey((start,))
                elif start in found:
                    self.open.updateValue((start,), (None if np.isnan(high) else float(high), n))
            self.clock.update((int(clocks[-1]),))
            tallies = [(int(start), None, 0, int(n)) for start, n in missed.items()]
            out = pd.DataFrame(done + tallies, columns=["start", "max_value", "points", "late_points"])
            yield out.assign(feature=key[0])[["feature", "start", "max_value", "points", "late_points"]]

    found = (
        points.where(F.col("ts").isNotNull())
        .select("feature", F.unix_micros("ts").alias("t"), F.unix_micros("arrived").alias("arrived"), "seq", "value")
        .groupBy("feature")
        .transformWithStateInPandas(
            Windows(), "feature string, start long, max_value double, points long, late_points long", "append", "none"
        )
    )
    return found.withColumn("window_start", F.timestamp_micros("start")).drop("start")


def late_windows(emitted: DataFrame) -> DataFrame:
    """What ``late_point_stream`` emitted up to now, one row a window."""
    return emitted.groupBy("feature", "window_start").agg(
        F.max("max_value").alias("max_value"), F.sum("points").alias("points"), F.sum("late_points").alias("late_points")
    )


def incident_stream(firings: DataFrame, close_s: int = LOG_INCIDENT_CLOSE_S, delay: str = WATERMARK) -> DataFrame:
    """An incident is reported when it has closed."""
    return (
        watermarked(firings, delay)
        .groupBy("rule", F.session_window("ts", f"{close_s} seconds").alias("s"))
        .agg(F.count(F.lit(1)).alias("firings"))
        .select("rule", F.col("s.start").alias("opened_at"), F.col("s.end").alias("closed_at"), "firings")
    )


ALERTS = "feature string, window_start timestamp, max_value double"


def alert_on_metrics(spark: SparkSession, metrics_dir: str, out: str, threshold: float = PSI_HALT_AT, name: str = "feature_psi") -> DataFrame:
    """R1 over the folder that runs append their metrics to: what has arrived since the last call is alerted on.

    A micro-batch writes the windows of its own points to a folder of its number, which a
    repeated batch overwrites; so a point counts once however often the query dies. A
    window that several batches saw is one alert, with the largest value.
    """
    points = spark.readStream.schema(schemas.RUN_METRICS).parquet(metrics_dir)

    def write(batch: DataFrame, number: int) -> None:
        gauge_alerts(metric_gauges(batch, name), threshold).select("feature", "window_start", "max_value").write.mode("overwrite").parquet(f"{out}/batch={number}")

    spark.createDataFrame([], ALERTS).write.mode("ignore").parquet(f"{out}/batch=-1")
    query = points.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}-progress").trigger(availableNow=True).start()
    query.awaitTermination()
    found = spark.read.schema(ALERTS).parquet(out)
    return found.groupBy("feature", "window_start").agg(F.max("max_value").alias("max_value"))


def run_available(stream: DataFrame, out: str) -> DataFrame:
    """Process what has arrived and read back what was emitted to ``out``.

    Output and progress live in the shared folder, so a restarted query goes on
    where it stopped; the file sink's log makes each batch appear once, also to
    a second stream reading the folder. State is kept in RocksDB, beside the heap, which
    typed state needs; progress written by another store goes on with that store.
    """
    stream.sparkSession.conf.set(STATE_STORE, ROCKS)
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", f"{out}-progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)
