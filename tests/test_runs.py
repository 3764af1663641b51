"""Write paths on real tables: reruns, empty results, failures, whole runs."""

import datetime as dt
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from helpers import TARGET, day_rows, feature, features
from tidegate.config import JobConfig
from tidegate.functions.scoring import LinearScorer
from tidegate.operators.alerts import run_status_feed
from tidegate.operators.guards import DriftDetected
from tidegate.plans import ingest
from tidegate.plans.ingest import ingest_dates, ingest_partition, replay_rows, seed
from tidegate.plans.ledger import RunOutcome, ledger_rows, outcomes, rows_scored_so_far
from tidegate.plans.nightly import backfill, run_nightly
from tidegate.plans.scoring import score_dates, score_partition
from tidegate.sources import tables
from tidegate.sources.shared import fresh_dir
from tidegate.sources.tables import append_rows, attach_partitions, create_table, create_tables, partition_counts, replace_table

SCORER = LinearScorer(-2.0, {"fare_amount": 0.1}, {"vendor_id": {"1": 0.2}})
NAMES = ("features_table", "feature_view", "predictions_table", "ledger_table", "metrics_table", "logs_table", "registry_table")
JAN = [dt.date(2022, 1, d) for d in range(1, 16)]
NEXT = dt.date(2022, 2, 11)
FARES = [3 + i * 0.9 for i in range(100)]


class BrokenScorer:
    """Fails while the write runs, not before."""

    def score(self, df):
        return df.withColumn("p1", F.when(F.raise_error(F.lit("scorer broke")).isNull(), F.lit(0.5)))


@pytest.fixture
def job(spark):
    def build(rows, **settings):
        tag = uuid.uuid4().hex[:8]
        settings = {"target_date": TARGET, "enable_replay_ingest": False, **settings}
        cfg = JobConfig(table_root=fresh_dir(spark, "job"), **{n: f"{n}_{tag}" for n in NAMES}, **settings)
        create_tables(spark, cfg)
        if rows:
            replace_table(spark, features(spark, rows), cfg.features_table)
        return cfg

    return build


def baseline_rows():
    return [r for d in JAN for r in day_rows(d, FARES)]


def test_rerun_replaces_and_other_dates_stay(spark, job):
    cfg = job(day_rows(TARGET, [10, 20, 30]) + day_rows(NEXT, [5, 6]))
    assert score_dates(spark, cfg, SCORER, [TARGET, NEXT]) == {"rows_written": 5, "rows_removed": 0}
    for _ in range(2):
        assert score_partition(spark, cfg, SCORER) == {"rows_written": 3, "rows_removed": 3}
    assert partition_counts(spark.table(cfg.predictions_table), [TARGET, NEXT]) == {TARGET: 3, NEXT: 2}
    one = spark.table(cfg.predictions_table).where("scoring_date = DATE'2022-02-10'")
    assert one.select("trip_id").distinct().count() == 3


def test_replace_with_no_rows_clears_the_date(spark, job):
    cfg = job(day_rows(TARGET, [10, 20]) + day_rows(NEXT, [5]))
    score_dates(spark, cfg, SCORER, [TARGET, NEXT])
    replace_table(spark, features(spark, day_rows(NEXT, [5])), cfg.features_table)
    assert score_partition(spark, cfg, SCORER) == {"rows_written": 0, "rows_removed": 2}
    assert partition_counts(spark.table(cfg.predictions_table), [TARGET, NEXT]) == {TARGET: 0, NEXT: 1}
    assert score_dates(spark, cfg, SCORER, [TARGET, NEXT]) == {"rows_written": 1, "rows_removed": 1}


def test_failed_write_keeps_the_old_rows(spark, job):
    cfg = job(day_rows(TARGET, [10, 20, 30]))
    score_partition(spark, cfg, SCORER)
    with pytest.raises(Exception, match="scorer broke"):
        score_partition(spark, cfg, BrokenScorer())
    spark.catalog.refreshTable(cfg.predictions_table)
    assert partition_counts(spark.table(cfg.predictions_table), [TARGET]) == {TARGET: 3}


def test_overwrite_mode_is_restored(spark, job):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    cfg = job(day_rows(TARGET, [10]))
    score_partition(spark, cfg, SCORER)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_table_found_again_by_a_new_catalog(spark, job):
    cfg = job(day_rows(TARGET, [10, 20]))
    schema = spark.table(cfg.features_table).schema
    spark.sql(f"DROP TABLE {cfg.features_table}")
    create_table(spark, cfg.features_table, schema, cfg.table_root)
    attach_partitions(spark, cfg.features_table)
    assert spark.table(cfg.features_table).count() == 2


def replay_job(job, **settings):
    return job([], enable_replay_ingest=True, source_table="source_trips_2022", **settings)


def source(spark, rows):
    return features(spark, rows).drop("trip_id", "scoring_date", "is_high_tip")


def test_ingest_fills_once(spark, job):
    cfg = replay_job(job)
    # Day 19033 since the epoch, modulo 28, is day 21 of the window: 2022-02-22.
    day = dt.date(2022, 2, 22)
    rows = [feature(day=day), feature(day=day), feature(day=day, trip_distance=7.0), feature(day=NEXT, trip_distance=9.0)]
    assert ingest_partition(spark, cfg, source(spark, rows)) == 2
    assert ingest_partition(spark, cfg, source(spark, rows)) == 0
    held = spark.table(cfg.features_table).collect()
    assert {r["scoring_date"] for r in held} == {TARGET} and len(held) == 2


def test_overlapping_ingests_leave_the_rows_once(spark, job, monkeypatch):
    cfg = replay_job(job)
    rows = [feature(day=dt.date(2022, 2, 22)), feature(day=dt.date(2022, 2, 22), trip_distance=7.0)]
    monkeypatch.setattr(ingest, "is_populated", lambda *_: False)  # both look before either writes
    for _ in range(2):
        assert ingest_partition(spark, cfg, source(spark, rows)) == 2
    assert spark.table(cfg.features_table).count() == 2


def test_table_replacement_that_fails_while_writing_keeps_the_old_rows(spark, job, monkeypatch):
    cfg = job(day_rows(TARGET, [10, 20]) + day_rows(NEXT, [5]))
    spread = tables.clustered
    broken = F.when(F.raise_error(F.lit("disk full")).isNull(), F.col("vendor_id"))
    monkeypatch.setattr(tables, "clustered", lambda df: spread(df).withColumn("vendor_id", broken))
    with pytest.raises(Exception, match="disk full"):
        replace_table(spark, features(spark, day_rows(TARGET, [1, 2, 3])), cfg.features_table)
    monkeypatch.setattr(tables, "clustered", spread)
    spark.catalog.refreshTable(cfg.features_table)
    assert partition_counts(spark.table(cfg.features_table), [TARGET, NEXT]) == {TARGET: 2, NEXT: 1}
    assert replace_table(spark, features(spark, day_rows(TARGET, [1, 2, 3])), cfg.features_table) == 3
    assert partition_counts(spark.table(cfg.features_table), [TARGET, NEXT]) == {TARGET: 3, NEXT: 0}


def test_ingest_disabled_does_nothing(spark, job):
    cfg = job([])
    assert ingest_partition(spark, cfg, source(spark, [feature(day=dt.date(2022, 2, 22))])) == 0


def test_seed_remaps_one_day(spark, job):
    cfg = job([])
    days = [JAN[0], JAN[14], dt.date(2022, 1, 20), dt.date(2022, 2, 5), dt.date(2022, 2, 10)]
    run_date = F.lit(dt.date(2026, 10, 6))
    rows = seed(spark, cfg, source(spark, [feature(day=d) for d in days]), (JAN[0], JAN[14]), days[3], days[4], run_date)
    dates = {str(r[0]) for r in spark.table(cfg.features_table).select("scoring_date").collect()}
    assert rows == 4 and dates == {"2022-01-01", "2022-01-15", "2026-10-05", "2022-02-10"}


def ledger(spark, cfg):
    return [r.asDict() for r in spark.table(cfg.ledger_table).collect()]


def test_nightly_success(spark, job):
    cfg = job(baseline_rows() + day_rows(TARGET, FARES))
    run = run_nightly(spark, cfg, SCORER)
    assert (run.status, run.rows_scored, run.psi) == ("SUCCEEDED", len(FARES), 0.0)
    (row,) = ledger(spark, cfg)
    assert (row["status"], row["exit_code"], row["event"]) == ("SUCCEEDED", "0", "pipeline_run_summary")
    assert row["status_message"].startswith(f"SUCCEEDED: scored {run.rows_scored} rows for 2022-02-10")
    feed = run_status_feed(spark.table(cfg.logs_table)).collect()
    assert [(r["status"], r["target_date"], r["exit_code"]) for r in feed] == [("SUCCEEDED", "2022-02-10", "0")]
    points = {r["name"]: r["kind"] for r in spark.table(cfg.metrics_table).collect()}
    assert points == {"feature_psi": "gauge", "roc_auc": "gauge", "rows_scored": "counter"}


def test_drift_halts_before_any_write(spark, job):
    cfg = job(baseline_rows() + day_rows(TARGET, [95.0] * 50))
    run = run_nightly(spark, cfg, SCORER)
    assert (run.status, run.exit_code, run.rows_scored, run.roc_auc) == ("HALTED", 2, None, None)
    assert isinstance(run.error, DriftDetected) and run.psi >= 0.25
    assert spark.table(cfg.predictions_table).count() == 0
    (row,) = ledger(spark, cfg)
    assert row["exit_code"] == "2" and "Do not retry" in row["status_message"]
    assert spark.table(cfg.logs_table).collect()[0]["severity"] == "ERROR"


def test_missing_partition_halts(spark, job):
    cfg = job(baseline_rows())
    run = run_nightly(spark, cfg, SCORER)
    assert run.status == "HALTED" and "0 rows" in run.message and run.psi is None


def test_small_baseline_can_halt(spark, job):
    cfg = job(day_rows(TARGET, FARES), min_baseline_rows=10)
    assert run_nightly(spark, cfg, SCORER).status == "HALTED"


def test_crash_in_evaluation_prevents_scoring(spark, job):
    cfg = job(baseline_rows() + day_rows(TARGET, FARES))
    run = run_nightly(spark, cfg, BrokenScorer())
    assert (run.status, run.exit_code) == ("FAILED", 3)
    assert spark.table(cfg.predictions_table).count() == 0
    assert "is safe" in ledger(spark, cfg)[0]["status_message"]


def test_unlabelled_date_is_scored_without_auc(spark, job):
    rows = [r[:10] + (None,) + r[11:] for r in day_rows(TARGET, FARES)]
    cfg = job(baseline_rows() + rows)
    run = run_nightly(spark, cfg, SCORER)
    assert run.status == "SUCCEEDED" and run.roc_auc is None and "ROC-AUC not evaluated" in run.message


def test_backfill_keeps_halted_dates_as_they_were(spark, job):
    drifted = dt.date(2022, 2, 12)
    cfg = job(baseline_rows() + day_rows(TARGET, FARES) + day_rows(NEXT, FARES) + day_rows(drifted, [95.0] * 50))
    score_dates(spark, cfg, SCORER, [drifted])
    missing = dt.date(2022, 2, 13)
    runs = {r.target_date: r for r in backfill(spark, cfg, SCORER, [TARGET, NEXT, drifted, missing])}
    assert [runs[d].status for d in (TARGET, NEXT, drifted, missing)] == ["SUCCEEDED", "SUCCEEDED", "HALTED", "HALTED"]
    counts = partition_counts(spark.table(cfg.predictions_table), [TARGET, NEXT, drifted, missing])
    assert counts[TARGET] == counts[NEXT] == runs[TARGET].rows_scored > 0
    assert counts[drifted] == 50 and counts[missing] == 0
    assert len(ledger(spark, cfg)) == 4


def test_append_counts_rows(spark, job):
    cfg = job([])
    assert append_rows(spark, features(spark, day_rows(TARGET, [10, 11])), cfg.features_table) == 2


DAY = dt.date(2026, 10, 6)


def described(spark, *runs):
    return ledger_rows(outcomes(spark, list(runs))).collect()


def test_success_message(spark):
    done, unlabelled = described(
        spark, RunOutcome(DAY, 0.25, 0, rows_scored=69817, psi=0.0123, roc_auc=0.7906, duration_s=252.0), RunOutcome(DAY, 0.25, 0, rows_scored=10, psi=0.01, duration_s=9.0)
    )
    assert done["status_message"] == (
        "SUCCEEDED: scored 69,817 rows for 2026-10-06 in 4m 12s. "
        "Drift PSI 0.0123 (threshold 0.25). ROC-AUC 0.7906."
    )
    assert "ROC-AUC not evaluated" in unlabelled["status_message"] and "in 9s." in unlabelled["status_message"]


def test_halt_and_failure_messages(spark):
    halted, failed, unknown = described(
        spark,
        RunOutcome(DAY, 0.25, 2, psi=0.45, error=DriftDetected("PSI is 0.4500 (Threshold: 0.25)", 0.45), duration_s=30.0),
        RunOutcome(DAY, 0.0001, 3, error=RuntimeError("503 backend unavailable"), duration_s=61.0),
        RunOutcome(DAY, 0.25, 77),
    )
    for part in ("before any predictions were written", "PSI is 0.4500", "Do not retry", "after 30s"):
        assert part in halted["status_message"]
    assert "RuntimeError: 503 backend unavailable" in failed["status_message"] and "1m 01s" in failed["status_message"]
    assert "re-running TARGET_DATE=2026-10-06 is safe" in failed["status_message"]
    assert (halted["exit_code"], failed["status"], unknown["status"]) == ("2", "FAILED", "FAILED")


def test_small_baseline_halts_a_backfill(spark, job):
    cfg = job(day_rows(TARGET, FARES), min_baseline_rows=10)
    (run,) = backfill(spark, cfg, SCORER, [TARGET])
    assert run.status == "HALTED" and spark.table(cfg.predictions_table).count() == 0


def test_backfill_evaluates_and_counts_on(spark, job):
    cfg = job(baseline_rows() + day_rows(TARGET, FARES) + day_rows(NEXT, FARES))
    runs = backfill(spark, cfg, SCORER, [TARGET, NEXT])
    assert all(0 <= run.roc_auc <= 1 and "ROC-AUC 0." in run.message or run.roc_auc == 1 for run in runs)
    backfill(spark, cfg, SCORER, [NEXT])
    points = spark.table(cfg.metrics_table).where("name = 'rows_scored'").select("value").collect()
    assert sorted(r.value for r in points) == [100.0, 200.0, 300.0]
    assert rows_scored_so_far(spark.table(cfg.metrics_table), cfg.model_name) == 300.0


def test_low_quality_and_missing_labels_leave_warnings(spark, job):
    worse = LinearScorer(2.0, {"fare_amount": -0.1}, {"vendor_id": {}})
    unlabelled = [r[:10] + (None,) + r[11:] for r in day_rows(NEXT, FARES)]
    cfg = job(baseline_rows() + day_rows(TARGET, FARES) + unlabelled)
    backfill(spark, cfg, worse, [TARGET, NEXT])
    said = [r.message for r in spark.table(cfg.logs_table).where("severity = 'WARNING'").orderBy("message").collect()]
    assert len(said) == 2 and "below 0.6" in said[0] and "not evaluated" in said[1]


def test_any_error_leaves_a_ledger_row(spark, job):
    cfg = job(baseline_rows() + day_rows(TARGET, FARES), canary_feature="no_such_column")
    assert [run.status for run in backfill(spark, cfg, SCORER, [TARGET])] == ["FAILED"]
    (row,) = ledger(spark, cfg)
    assert row["exit_code"] == "3" and "no_such_column" in row["status_message"]



FEBRUARY = [dt.date(2022, 2, 1) + dt.timedelta(days=k) for k in range(28)]


def february(spark):
    """Every source day but one, with as many trips as its day of the month."""
    rows = [feature(f"{day}-{k}", day, total_amount=14.0 + k) for day in FEBRUARY if day.day != 9 for k in range(day.day)]
    return source(spark, rows + rows[:7])


def held_rows(spark, cfg):
    spark.catalog.refreshTable(cfg.features_table)
    return {r["scoring_date"]: r["count"] for r in spark.table(cfg.features_table).groupBy("scoring_date").count().collect()}


def jobs_of(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    out = run()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_many_dates_are_filled_in_a_number_of_jobs_that_does_not_follow_them(spark, job):
    cfg, trips = replay_job(job), february(spark)
    days = FEBRUARY + [day + dt.timedelta(days=28) for day in FEBRUARY]  # each source day serves two dates
    assert ingest_partition(spark, cfg, trips) == 22
    _, few = jobs_of(spark, "few", lambda: ingest_dates(spark, cfg, trips, days[:3]))
    out, many = jobs_of(spark, "many", lambda: ingest_dates(spark, cfg, trips, days + days[:4]))
    assert many <= few + 2 < 20
    assert (out["dates_written"], out["dates_skipped"]) == (52, 4)
    found = held_rows(spark, cfg)
    for day in days:  # as one date at a time would have it
        assert found.get(day, 0) == replay_rows(trips, replace(cfg, target_date=day)).count()
    assert sum(found.values()) == out["rows_written"] + 22 + sum(found.get(day, 0) for day in days[:3])
    again = ingest_dates(spark, cfg, trips, days)
    # dates whose source day is empty are asked for again
    assert again["rows_written"] == 0 and held_rows(spark, cfg) == found


def test_overlapping_ingests_leave_a_date_once(spark, job, monkeypatch):
    cfg, trips = replay_job(job), february(spark)
    ingest_dates(spark, cfg, trips, FEBRUARY[:5])
    before = held_rows(spark, cfg)
    monkeypatch.setattr(ingest, "partition_counts", lambda table, days: dict.fromkeys(days, 0))  # asked before the other wrote
    ingest_dates(spark, cfg, trips, FEBRUARY[:7])
    after = held_rows(spark, cfg)
    assert before.items() <= after.items() and len(after) > len(before)


def test_many_dates_without_a_source_or_dates(spark, job):
    cfg, trips = replay_job(job), february(spark)
    nothing = {"dates_written": 0, "dates_skipped": 1, "rows_written": 0}
    assert ingest_dates(spark, cfg, None, FEBRUARY[:1]) == nothing
    assert ingest_dates(spark, cfg, trips, [])["dates_skipped"] == 0
    assert ingest_dates(spark, replace(cfg, enable_replay_ingest=False), trips, FEBRUARY[:1]) == nothing
