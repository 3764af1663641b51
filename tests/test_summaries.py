import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import BASE, TARGET, day_rows, features
from tidegate.functions.scoring import LinearScorer
from tidegate.operators.drift import decile_edges, psi_matrix
from tidegate.operators.evaluate import evaluate
from tidegate.operators.features import feature_view
from tidegate.operators.summaries import evaluate_counts, feature_sketches, score_counts, sketched_edges, sketched_psi, trailing
from tidegate.plans.summaries import score_table, sketch_table, summarise_dates
from tidegate.queries import summaries as summary_queries
from tidegate.queries.rows import job_tables

DAYS = [BASE[0] + dt.timedelta(days=d) for d in range(15)]
SCORER = LinearScorer(intercept=-1.0, numeric={"fare_amount": 0.04}, categorical={})


def column(spark, by_day):
    rows = [(day, None if v is None else float(v)) for day, values in by_day.items() for v in values]
    return spark.createDataFrame(rows, "scoring_date date, x double")


def edges_of(frame):
    return {r["feature"]: r["edges"] for r in sketched_edges(frame, BASE).collect()}


@pytest.mark.parametrize("n", [1, 2, 7, 10, 37, 100, 1000])
def test_small_sketches_give_the_exact_deciles(spark, n):
    """Ties, whole tenths, NULL, NaN, signed zeros and a date outside the baseline."""
    rng = np.random.default_rng(n)
    values = [*rng.integers(-5, 6, n).tolist(), None, float("nan"), 0.0, -0.0, float("inf")]
    rows = column(spark, {DAYS[0]: values[::2], DAYS[3]: values[1::2], TARGET: [99.0]})
    assert edges_of(feature_sketches(rows, ["x"]))["x"] == decile_edges(rows.where(F.col("scoring_date") != TARGET), ["x"])["x"]


def rows_of(frame):
    return sorted((r["feature"], r["scoring_date"], r["baseline_rows"], r["target_rows"], r["total_psi"], r["band"]) for r in frame.collect())


def test_psi_of_small_sketches_is_exact(spark):
    rng = np.random.default_rng(3)
    rows = column(spark, {day: [None, *np.round(rng.normal(i / 9, 1, 90), 1)] for i, day in enumerate([*DAYS[:6], TARGET])})
    found = sketched_psi(feature_sketches(rows, ["x"]), BASE)
    assert rows_of(found) == rows_of(psi_matrix(rows, ["x"], BASE))
    assert found.where("exact").count() == 7


def test_large_sketches_keep_their_rank_error(spark):
    n, k = 200_000, 1_024
    rows = spark.range(n).select(F.date_add(F.lit(BASE[0]), (F.col("id") % 10).cast("int")).alias("scoring_date"), F.pow(F.rand(7), 3).alias("x"))
    values = np.sort([r[0] for r in rows.select("x").collect()])
    edges = edges_of(feature_sketches(rows, ["x"], k))["x"]
    worst = max(abs(np.searchsorted(values, e, "right") / n - i / 10) for i, e in enumerate(edges))
    assert worst < 0.006  # 2.3 / k ** 0.9 is 0.0045 at 99 %
    assert not sketched_psi(feature_sketches(rows, ["x"], k), BASE, k).where("exact").count()


def test_no_rows_no_report(spark):
    empty = feature_sketches(spark.createDataFrame([], "scoring_date date, x double"), ["x"])
    assert edges_of(empty) == {} and sketched_psi(empty, BASE).count() == 0
    only_target = feature_sketches(column(spark, {TARGET: [1.0]}), ["x"])
    assert sketched_psi(only_target, BASE).count() == 0


def scored(spark, seed, days, n=300):
    rng = np.random.default_rng(seed)
    rows = []
    for day in days:
        p = rng.choice([0.0, 0.25, 0.5, 0.5000001, 1.0, float("nan")], n) if seed == 1 else rng.random(n)
        rows += [(day, float(a), None if rng.random() < 0.05 else int(rng.random() < (0.3 + 0.4 * (a > 0.5)))) for a in p]
    return spark.createDataFrame(rows, "scoring_date date, p1 double, y int")


NAMES = ("labelled_rows", "precision", "recall", "accuracy", "f1_score", "log_loss")


@pytest.mark.parametrize("seed,buckets", [(1, 1024), (2, 1024), (2, 8)])
def test_stored_counts_give_the_metrics_and_bound_the_auc(spark, seed, buckets):
    rows = scored(spark, seed, DAYS[:4])
    usable = rows.where(~F.isnan("p1"))
    found = evaluate_counts(score_counts(rows, "y", buckets=buckets), ["scoring_date"], buckets).collect()
    want = {r["scoring_date"]: r for r in evaluate(usable, ["scoring_date"], "y").collect()}
    assert len(found) == 4
    for row in found:
        exact = want[row["scoring_date"]]
        assert [row[c] for c in NAMES] == pytest.approx([exact[c] for c in NAMES])
        assert row["auc_low"] - 1e-12 <= exact["roc_auc"] <= row["auc_high"] + 1e-12
        if seed == 1:  # 0.5 and the score just above it lie in different buckets, each with one score
            assert row["auc_low"] == row["auc_high"] == pytest.approx(exact["roc_auc"])


def test_trailing_windows_are_sums(spark):
    days = [DAYS[0], DAYS[1], DAYS[5]]
    rows = scored(spark, 1, days).where(~F.isnan("p1"))
    found = {r["as_of"]: r for r in evaluate_counts(trailing(score_counts(rows, "y"), 5), ["as_of"]).collect()}
    assert set(found) == set(days)
    for as_of in days:
        held = rows.where(F.col("scoring_date").between(F.lit(as_of - dt.timedelta(days=4)), F.lit(as_of)))
        exact = evaluate(held, [], "y").first()
        assert [found[as_of][c] for c in (*NAMES, "roc_auc")] == pytest.approx([exact[c] for c in (*NAMES, "roc_auc")])


def test_one_class_only_has_no_auc(spark):
    rows = spark.createDataFrame([(DAYS[0], 0.3, 1), (DAYS[0], 0.8, 1)], "scoring_date date, p1 double, y int")
    row = evaluate_counts(score_counts(rows, "y"), []).first()
    assert row["roc_auc"] is None and row["auc_low"] is None and row["status"] == "not_evaluable"


def test_summaries_are_replaced_by_date(spark):
    cfg = job_tables(spark)
    first = feature_view(features(spark, [*day_rows(DAYS[0], range(5, 45)), *day_rows(DAYS[1], range(5, 25))]))
    assert summarise_dates(spark, cfg, first, SCORER, DAYS[:2])["sketches"] > 0
    summarise_dates(spark, cfg, first, SCORER, DAYS[:2])

    def held():
        found = spark.table(sketch_table(cfg)).where("feature = 'fare_amount'").groupBy("scoring_date").agg(F.sum("held").alias("n"))
        return {r["scoring_date"]: r["n"] for r in found.collect()}

    assert held() == {DAYS[0]: 40, DAYS[1]: 20}
    again = feature_view(features(spark, day_rows(DAYS[1], range(5, 8))))
    summarise_dates(spark, cfg, again, SCORER, [DAYS[1]])
    assert held() == {DAYS[0]: 40, DAYS[1]: 3}
    assert spark.table(score_table(cfg)).agg(F.sum(F.col("pos") + F.col("neg"))).first()[0] == 43


def test_queries_make_the_view_once(spark, monkeypatch):
    """The list of dates and both runs, of sketches and of counts, read one copy of the view's columns."""
    rows = feature_view(features(spark, [*day_rows(DAYS[0], range(5, 45)), *day_rows(DAYS[1], range(5, 25)), *day_rows(DAYS[2], range(5, 15))]))
    made = spark.sparkContext.accumulator(0)

    def count(x):
        made.add(1)
        return x

    counted = F.udf(count, "double").asNondeterministic()  # so that it is not moved and called twice for a row
    monkeypatch.setattr(summary_queries, "view", lambda *_: rows.withColumn("fare_amount", counted("fare_amount")))
    cfg = summary_queries._stored(spark, "unused")
    assert made.value == 70
    assert spark.table(score_table(cfg)).agg(F.sum(F.col("pos") + F.col("neg"))).first()[0] == 70
    held = spark.table(sketch_table(cfg)).where("feature = 'fare_amount'").groupBy("scoring_date").agg(F.sum("held").alias("n"))
    assert {r["scoring_date"]: r["n"] for r in held.collect()} == {DAYS[0]: 40, DAYS[1]: 20, DAYS[2]: 10}
