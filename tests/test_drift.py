import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import BASE, TARGET
from tidegate.config import JobConfig
from tidegate.functions.psi import bin_of, drift_band
from tidegate.operators.drift import bin_report, categorical_psi, decile_edges, psi_matrix, psi_report
from tidegate.operators.guards import DriftDetected, InsufficientData, require_stable, require_volume

EDGES = [float(10 * i) for i in range(11)]


def binned(spark, values, edges):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    return [r[0] for r in df.select(bin_of(F.col("v"), edges)).collect()]


def test_bin_boundaries(spark):
    values = [-1000.0, -0.01, 0.0, 9.99, 10.0, 55.0, 89.99, 90.0, 100.0, 100.01, 1e9]
    assert binned(spark, values, EDGES) == [0, 0, 0, 0, 1, 5, 8, 9, 9, 9, 9]


def test_bins_match_the_range_join(spark):
    values = [i * 0.37 - 20 for i in range(400)]
    want = [
        [k for k in range(10) if (v >= EDGES[k] or k == 0) and (v < EDGES[k + 1] or k == 9)] for v in values
    ]
    assert all(len(w) == 1 for w in want)
    assert binned(spark, values, EDGES) == [w[0] for w in want]


def test_tied_edges_never_count_twice(spark):
    assert binned(spark, [4.9, 5.0, 5.1], [5.0] * 11) == [0, 9, 9]


def sides(spark, baseline, target):
    rows = [(BASE[0], None if b is None else float(b)) for b in baseline]
    rows += [(TARGET, None if t is None else float(t)) for t in target]
    return spark.createDataFrame(rows, "scoring_date date, fare_amount double")


def brute_psi(baseline, target):
    baseline, target = np.sort(np.array(baseline, float)), np.array(target, float)
    n = len(baseline)
    edges = [baseline[max(1, math.ceil(k * n / 10)) - 1] for k in range(1, 10)]
    e, a = (np.bincount(np.searchsorted(edges, side, "right"), minlength=10) for side in (baseline, target))

    def share(counts):
        return np.where(counts > 0, counts / max(1, counts.sum()), 1e-4)

    e, a = share(e), share(a)
    return round(float(((a - e) * np.log(a / e)).sum()), 4)


@pytest.mark.parametrize(
    "baseline,target",
    [
        (range(100), range(100)),
        (range(100), range(50, 150)),
        (range(100), [1000.0] * 30),
        ([5.0] * 50, [4.0, 5.0, 6.0]),
        (range(37), [3.0]),
        ([7.0], [7.0]),
    ],
)
def test_psi_against_brute_force(spark, baseline, target):
    row = psi_report(sides(spark, baseline, target), "fare_amount", BASE, TARGET).collect()[0]
    assert row["total_psi"] == brute_psi(list(baseline), list(target))
    assert (row["baseline_rows"], row["target_rows"]) == (len(baseline), len(target))


def test_empty_sides(spark):
    row = psi_report(sides(spark, [], [1.0, 2.0]), "fare_amount", BASE, TARGET).collect()[0]
    assert (row["total_psi"], row["baseline_rows"]) == (0.0, 0)
    row = psi_report(sides(spark, range(100), []), "fare_amount", BASE, TARGET).collect()[0]
    assert row["total_psi"] > 0.25 and row["target_rows"] == 0


def test_null_and_nan_are_left_out_and_counted(spark):
    clean = psi_report(sides(spark, range(100), range(60)), "fare_amount", BASE, TARGET).collect()[0]
    dirty = sides(spark, [*range(100), None, math.nan], [*range(60), math.nan, None])
    row = psi_report(dirty, "fare_amount", BASE, TARGET).collect()[0]
    assert row["total_psi"] == clean["total_psi"]
    assert (row["baseline_unusable"], row["target_unusable"]) == (2, 2)


def test_all_ten_bins_are_reported(spark):
    rows = bin_report(sides(spark, [5.0] * 20, [5.0]), "fare_amount", BASE, TARGET).orderBy("bin_id").collect()
    assert [r["bin_id"] for r in rows] == list(range(10))
    assert [r["baseline_cnt"] for r in rows] == [0] * 9 + [20]


def test_matrix_agrees_with_single_reports(spark):
    rng = np.random.default_rng(3)
    rows = [(dt.date(2022, 1, 1 + i % 20), float(x), float(y)) for i, (x, y) in enumerate(rng.normal(size=(600, 2)))]
    df = spark.createDataFrame(rows, "scoring_date date, a double, b double")
    matrix = {(r["feature"], r["scoring_date"]): r for r in psi_matrix(df, ["a", "b"], BASE).collect()}
    assert len(matrix) == 40
    for column in ("a", "b"):
        day = dt.date(2022, 1, 18)
        one = psi_report(df, column, BASE, day).collect()[0]
        assert matrix[column, day]["total_psi"] == one["total_psi"]


def test_categorical_psi_with_one_sided_categories(spark):
    base = ["x"] * 60 + ["y"] * 30 + ["z"] * 10
    target = ["x"] * 5 + ["new"] * 15
    rows = [(BASE[0], c) for c in base] + [(TARGET, c) for c in target]
    df = spark.createDataFrame(rows, "scoring_date date, c string")
    got = {r["scoring_date"]: r["total_psi"] for r in categorical_psi(df, "c", BASE).collect()}
    want = 0.0
    for c in {"x", "y", "z", "new"}:
        e = base.count(c) / len(base) or 1e-4
        a = target.count(c) / len(target) or 1e-4
        want += (a - e) * math.log(a / e)
    assert got[TARGET] == round(want, 4)
    assert got[BASE[0]] == 0.0


def test_guard_thresholds():
    cfg = JobConfig(target_date="2022-02-10", min_row_count=1000)
    for value in (0.3412, 0.25):
        with pytest.raises(DriftDetected, match=f"{value:.4f}"):
            require_stable(value, cfg)
    assert require_stable(0.0412, cfg) == 0.0412
    assert require_stable(None, cfg) == 0.0
    for count in (0, 12, 999):
        with pytest.raises(InsufficientData):
            require_volume(count, cfg, cfg.target)
    require_volume(1000, cfg, cfg.target)
    require_volume(5000, cfg, cfg.target)


def test_bands(spark):
    df = spark.createDataFrame([(0.0999,), (0.10,), (0.25,), (0.2501,)], "p double")
    assert [r[0] for r in df.select(drift_band(F.col("p"))).collect()] == ["none", "moderate", "moderate", "significant"]


@pytest.mark.parametrize("n,accuracy", [(1, 100), (39, 100), (500, 100), (5000, 100), (30000, 1000)])
def test_quantiles_are_exact(spark, n, accuracy):
    """Also when a third of the rows share a value and the sketch is far too coarse."""
    rng = np.random.default_rng(n)
    x, hot = np.round(rng.normal(size=n) * 10, 1), rng.random(n)
    hot[: n // 3] = 0.5
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, hot)], "x double, hot double").repartition(5)
    from tidegate.operators.quantiles import exact_quantiles

    probs = [i / 10 for i in range(11)]
    got = exact_quantiles(df, {"x": probs, "hot": probs}, accuracy)
    for name, values in (("x", x), ("hot", hot)):
        ordered = np.sort(values)
        assert got[name] == [ordered[max(1, -(-i * n // 10)) - 1] for i in range(11)]


def test_edges_of_nothing(spark):
    df = spark.createDataFrame([], "x double")
    assert decile_edges(df, ["x"]) == {"x": None}
