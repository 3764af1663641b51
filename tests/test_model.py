import datetime as dt

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from helpers import TARGET, day_rows, features
from tidegate import schemas
from tidegate.functions.scoring import LinearScorer, scorer_of
from tidegate.operators.evaluate import evaluate
from tidegate.operators.features import LeakageError, check_no_leak, feature_view
from tidegate.operators.predictions import predict
from tidegate.operators.training import chronological_split, train


def brute(labels, scores):
    y, p = np.array(labels), np.array(scores)
    pos, neg = p[y == 1], p[y == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    hit = p > 0.5
    tp, fp = (hit & (y == 1)).sum(), (hit & (y == 0)).sum()
    clip = np.clip(p, 1e-15, 1 - 1e-15)
    return dict(
        roc_auc=wins / (len(pos) * len(neg)),
        accuracy=(hit == (y == 1)).mean(),
        precision=tp / max(1, tp + fp),
        recall=tp / len(pos),
        f1_score=2 * tp / (tp + fp + len(pos)),
        log_loss=-(y * np.log(clip) + (1 - y) * np.log(1 - clip)).mean(),
    )


@pytest.mark.parametrize("decimals,edges", [(1, None), (6, None), (2, [0.5]), (2, []), (3, [0.001, 0.2, 0.2001, 0.9])])
def test_metrics_against_brute_force(spark, decimals, edges):
    rng = np.random.default_rng(decimals)
    p = np.round(rng.random(700), decimals)
    p[:230] = 0.4
    y = (rng.random(700) < p).astype(int)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p1 double")
    row = evaluate(df, [], "y", edges=edges).collect()[0]
    for name, want in brute(y, p).items():
        assert row[name] == pytest.approx(want, abs=1e-9), name
    assert row["labelled_rows"] == 700


def test_metrics_per_group_equal_metrics_of_each_group(spark):
    rng = np.random.default_rng(9)
    rows = [(g, int(rng.random() < 0.4), float(np.round(rng.random() * (g + 1) / 3, 2))) for g in range(3) for _ in range(200)]
    df = spark.createDataFrame(rows, "g int, y int, p1 double")
    grouped = {r["g"]: r["roc_auc"] for r in evaluate(df, ["g"], "y").collect()}
    for g in range(3):
        mine = [(y, p) for k, y, p in rows if k == g]
        assert grouped[g] == pytest.approx(brute(*zip(*mine))["roc_auc"], abs=1e-12)


def test_not_evaluable(spark):
    unlabelled = spark.createDataFrame([(None, 0.4)], "y int, p1 double")
    for df in (unlabelled, unlabelled.where("false")):
        row = evaluate(df, [], "y", min_roc_auc=0.6).collect()[0]
        assert (row["status"], row["roc_auc"], row["below_floor"]) == ("not_evaluable", None, False)
    one_class = spark.createDataFrame([(1, 0.4), (1, 0.2)], "y int, p1 double")
    row = evaluate(one_class, [], "y", min_roc_auc=0.6).collect()[0]
    assert (row["status"], row["precision"], row["below_floor"]) == ("not_evaluable", 0.0, False)


def test_floor_is_strict(spark):
    df = spark.createDataFrame([(1, 0.6), (0, 0.4), (0, 0.6), (1, 0.4)], "y int, p1 double")
    auc = evaluate(df, [], "y").collect()[0]["roc_auc"]
    assert not evaluate(df, [], "y", min_roc_auc=auc).collect()[0]["below_floor"]
    assert evaluate(df, [], "y", min_roc_auc=auc + 1e-9).collect()[0]["below_floor"]


@pytest.fixture(scope="module")
def trained(spark):
    rng = np.random.default_rng(5)
    days = [dt.date(2022, 1, 1) + dt.timedelta(days=i) for i in range(10)]
    view = feature_view(features(spark, [r for d in days for r in day_rows(d, rng.uniform(3, 60, 60))]))
    return view, train(view)


def fitted(model, rows, folder):
    """The probability by the fitted stages themselves, saved and loaded."""
    model.write().overwrite().save(str(folder))
    return PipelineModel.load(str(folder)).transform(rows).withColumn("p1", vector_to_array("probability")[1])


def test_inlined_scorer_equals_the_fitted_stages(spark, trained, tmp_path):
    view, model = trained
    scorer = scorer_of(model)
    assert isinstance(scorer, LinearScorer)
    probe = view.unionByName(view.where("trip_id LIKE '%-7'").withColumn("vendor_id", F.lit("unseen")))
    stages = fitted(model, probe, tmp_path / "m").select("trip_id", "vendor_id", F.col("p1").alias("fitted"))
    both = scorer.score(probe).join(stages, ["trip_id", "vendor_id"])
    assert both.count() == probe.count()
    assert both.agg(F.max(F.abs(F.col("p1") - F.col("fitted")))).collect()[0][0] < 1e-9


@pytest.mark.parametrize("categories", [5, 120])
def test_any_number_of_categories_scores_alike(spark, categories, tmp_path):
    rng = np.random.default_rng(categories)
    fares = rng.uniform(3, 60, 600)
    rows = [tuple(f"v{i % categories}" if k == 3 else x for k, x in enumerate(r)) for i, r in enumerate(day_rows(TARGET, fares))]
    view = feature_view(features(spark, rows))
    model = train(view)
    scorer = scorer_of(model)
    probe = view.unionByName(view.limit(5).withColumn("vendor_id", F.lit("unseen")).withColumn("trip_id", F.concat("trip_id", F.lit("u"))))
    both = scorer.score(probe).join(fitted(model, probe, tmp_path / "m").select("trip_id", F.col("p1").alias("stages")), "trip_id")
    assert both.count() == probe.count()
    assert both.agg(F.max(F.abs(F.col("p1") - F.col("stages")))).collect()[0][0] < 1e-9
    odd = spark.createDataFrame(
        [("null", None, 2.0, 1, "v1"), ("nan", float("nan"), 2.0, 1, "v1"), ("new", 10.0, 2.0, 1, "?"), ("none", 10.0, 2.0, 1, None)],
        "trip_id string, fare_amount double, trip_distance double, passenger_count bigint, vendor_id string",
    ).withColumn("scoring_date", F.lit(TARGET))
    found = {r["trip_id"]: r for r in predict(odd, scorer, "m").collect()}
    assert len(found) == 4 and found["null"]["predicted_is_high_tip"] == found["nan"]["predicted_is_high_tip"] == 0
    assert found["new"]["predicted_is_high_tip_probs"] == found["none"]["predicted_is_high_tip_probs"]


def test_auc_equals_the_library_evaluator(trained, tmp_path):
    view, model = trained
    out = fitted(model, view, tmp_path / "m")
    want = BinaryClassificationEvaluator(labelCol=schemas.LABEL, numBins=0).evaluate(out)
    assert evaluate(out, [], schemas.LABEL).collect()[0]["roc_auc"] == pytest.approx(want, abs=1e-9)


def test_split_is_chronological(trained):
    view, _ = trained
    early, late = chronological_split(view)
    assert early.agg(F.max("pickup_datetime")).collect()[0][0] < late.agg(F.min("pickup_datetime")).collect()[0][0]
    assert early.count() == 480 and late.count() == 120


def test_prediction_rows(spark):
    scorer = LinearScorer(0.0, {"fare_amount": 0.0}, {"vendor_id": {"1": 1.0}})
    view = feature_view(features(spark, day_rows(TARGET, [10, 20, 30])))
    rows = predict(view, scorer, "m", dt.date(2022, 3, 1)).collect()
    assert {r["scoring_date"] for r in rows} == {dt.date(2022, 3, 1)}
    by_vendor = {r["vendor_id"]: r for r in rows}
    # A probability of exactly one half is the negative class.
    assert (by_vendor["0"]["predicted_is_high_tip"], by_vendor["1"]["predicted_is_high_tip"]) == (0, 1)
    assert [p["label"] for p in rows[0]["predicted_is_high_tip_probs"]] == [1, 0]
    assert sum(p["prob"] for p in rows[0]["predicted_is_high_tip_probs"]) == pytest.approx(1.0)
    with pytest.raises(LeakageError):
        check_no_leak(view.withColumn("total_amount", F.lit(1.0)))
