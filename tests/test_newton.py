import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.functions.scoring import scorer_of
from tidegate.operators import newton
from tidegate.operators.features import labelled
from tidegate.operators.newton import fit_newton
from tidegate.operators.training import train
from tidegate.queries.base import BASELINE, view
from tidegate.sources.tables import partitions

SCHEMA = "a double, b double, c string, y int"


def drawn(spark, n=3_000, nulls=False, seed=2):
    rng = np.random.default_rng(seed)
    a, b, c = rng.normal(50, 20, n), rng.exponential(2, n), rng.integers(0, 4, n)
    p = 1 / (1 + np.exp(-(-2 + 0.03 * a - 0.5 * b + np.array([0, 0.7, -0.4, 0.2])[c])))
    y = (rng.random(n) < p).astype(int)
    rows = [(float(i), float(j), None if nulls and k == 3 else f"v{k}", int(t)) for i, j, k, t in zip(a, b, c, y)]
    return spark.createDataFrame(rows, SCHEMA)


def fit(rows, numeric=("a", "b"), categorical=("c",), **given):
    return fit_newton(rows, numeric, categorical, "y", **given)


@pytest.mark.parametrize("nulls", [False, True])
def test_residuals_vanish_against_every_feature(spark, nulls):
    rows = drawn(spark, nulls=nulls)
    found = fit(rows)
    assert found.converged and found.steps < 12
    left = F.col("y") - F.col("p1")
    seen = found.scorer.score(rows)
    sums = seen.agg(F.sum(left).alias("one"), F.sum(left * F.col("a")).alias("a"), F.sum(left * F.col("b")).alias("b")).first()
    assert np.abs(list(sums)).max() < 1e-6
    by_level = seen.groupBy("c").agg(F.sum(left).alias("r")).collect()
    assert max(abs(r["r"]) for r in by_level) < 1e-6
    assert len(found.scorer.categorical["c"]) == 3


def test_same_probabilities_as_the_fitted_pipeline(spark):
    rows = labelled(partitions(view(spark, "/root/testdata/sf0.01", *BASELINE), *BASELINE))
    columns = [F.col("trip_id"), F.col("pickup_datetime")]
    ours = fit_newton(rows).scorer.score(rows).select(*columns, F.col("p1").alias("ours"))
    theirs = scorer_of(train(rows)).score(rows).select(*columns, F.col("p1").alias("theirs"))
    worst = ours.join(theirs, ["trip_id", "pickup_datetime"]).agg(F.max(F.abs(F.col("ours") - F.col("theirs")))).first()[0]
    assert worst < 1e-4


def test_rows_that_cannot_be_used_change_nothing(spark):
    rows = drawn(spark, 500)
    odd = spark.createDataFrame([(None, 1.0, "v0", 1), (float("nan"), 1.0, "v1", 0), (1.0, 1.0, "v0", None)], SCHEMA)
    one, two = fit(rows), fit(rows.unionByName(odd))
    assert two.scorer.intercept == pytest.approx(one.scorer.intercept, abs=1e-9)
    assert two.scorer.numeric == pytest.approx(one.scorer.numeric)


def test_no_rows_constants_and_one_category(spark):
    assert fit(spark.createDataFrame([], SCHEMA)) is None
    rows = spark.createDataFrame([(1.0, 2.0, "v", t) for t in (0, 1, 1, 1)], SCHEMA)
    found = fit(rows)
    assert found.scorer.numeric == {"a": 0.0, "b": 0.0} and found.scorer.categorical == {"c": {}}
    assert found.scorer.intercept == pytest.approx(np.log(3))


def test_labels_told_apart_do_not_converge(spark):
    rows = spark.createDataFrame([(float(i), 0.0, "v", int(i >= 5)) for i in range(10)], SCHEMA)
    found = fit(rows, steps=6)
    assert not found.converged and found.log_loss < 0.1


def test_too_many_weights_are_refused(spark):
    rows = spark.createDataFrame([(float(i), 0.0, f"v{i}", i % 2) for i in range(newton.MOST_WEIGHTS + 5)], SCHEMA)
    with pytest.raises(ValueError):
        fit(rows)


def test_the_rows_are_made_once(spark):
    """Every pass of the fit reads what the first one wrote, and the folder goes with the fit."""
    rows, made = drawn(spark, 400), spark.sparkContext.accumulator(0)

    def count(x):
        made.add(1)
        return x

    counted = F.udf(count, "double").asNondeterministic()  # so that it is not moved and called twice for a row
    found = fit(rows.withColumn("a", counted("a")))
    assert found.converged and made.value == 400
    want = fit(rows)
    assert found.scorer.numeric == pytest.approx(want.scorer.numeric) and found.scorer.intercept == pytest.approx(want.scorer.intercept)
