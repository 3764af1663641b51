"""Quantiles, bins, PSI and the guards."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.operators.drift import bin_report, categorical_psi, decile_edges, psi_matrix, psi_report
from tidegate.operators.guards import volume_report
from tidegate.queries.base import (
    BASELINE,
    IN_BASELINE,
    IN_TARGET,
    SCORED,
    TARGET,
    VIEW,
    plain,
    scored,
    view,
)
from tidegate.registry import query
from tidegate.schemas import NUMERIC_FEATURES
from tidegate.sources.tables import partitions

PROBS = "[0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]"
GUARD_AT = 0.02
MIN_ROWS = 410


def _two_dates(spark, sf_dir):
    return view(spark, sf_dir, BASELINE[0], TARGET)


def _long(features, source="v"):
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, scoring_date, CAST({f} AS DOUBLE) AS x FROM {source} WHERE {f} IS NOT NULL" for f in features
    )


def _matrix_sql(features, source="v"):
    """PSI of each feature at each date, from the literal range join."""
    return f"""
long AS ({_long(features, source)}),
edges AS (SELECT feature, quantile_disc(x, {PROBS}) AS q FROM long WHERE {IN_BASELINE} GROUP BY feature),
bins AS (SELECT feature, k AS bin_id, q[k + 1] AS lo, q[k + 2] AS hi FROM edges, range(10) r(k)),
placed AS (SELECT l.feature, l.scoring_date, b.bin_id, count(*) AS n FROM long l JOIN bins b ON l.feature = b.feature
  AND (l.x >= b.lo OR b.bin_id = 0) AND (l.x < b.hi OR b.bin_id = 9) GROUP BY ALL),
totals AS (SELECT feature, scoring_date, sum(n) AS t FROM placed GROUP BY ALL),
base AS (SELECT feature, bin_id, sum(n) AS n FROM placed WHERE {IN_BASELINE} GROUP BY ALL),
base_total AS (SELECT feature, sum(n) AS t FROM base GROUP BY feature),
shares AS (SELECT t.feature, t.scoring_date, t.t AS target_rows, bt.t AS baseline_rows,
    coalesce(p.n / t.t, 0.0001::DOUBLE) AS a, coalesce(b.n / bt.t, 0.0001::DOUBLE) AS e
  FROM totals t JOIN base_total bt USING (feature) JOIN bins k USING (feature)
  LEFT JOIN placed p ON p.feature = t.feature AND p.scoring_date = t.scoring_date AND p.bin_id = k.bin_id
  LEFT JOIN base b ON b.feature = t.feature AND b.bin_id = k.bin_id),
psi AS (SELECT feature, scoring_date, CAST(min(baseline_rows) AS BIGINT) AS baseline_rows,
    CAST(min(target_rows) AS BIGINT) AS target_rows, round(sum((a - e) * ln(a / e)), 4) AS total_psi
  FROM shares GROUP BY feature, scoring_date)"""


BAND = "CASE WHEN total_psi < 0.10 THEN 'none' WHEN total_psi <= 0.25 THEN 'moderate' ELSE 'significant' END"


@query(
    "decile_edges",
    f"""WITH {VIEW}, long AS ({_long(NUMERIC_FEATURES)}),
    edges AS (SELECT feature, quantile_disc(x, {PROBS}) AS q FROM long WHERE {IN_BASELINE} GROUP BY feature)
    SELECT feature, CAST(k AS BIGINT) AS decile, q[k + 1] AS edge FROM edges, range(11) r(k)""",
)
def decile_edge_rows(spark, sf_dir):
    """A3: the baseline deciles of every numeric feature."""
    found = decile_edges(partitions(view(spark, sf_dir, *BASELINE), *BASELINE), list(NUMERIC_FEATURES))
    rows = [(c, k, float(e)) for c, edges in found.items() for k, e in enumerate(edges or ())]
    return spark.createDataFrame(rows, "feature string, decile long, edge double")


@query(
    "psi_bins",
    f"""WITH {VIEW}, edges AS (SELECT quantile_disc(fare_amount, {PROBS}) AS q FROM v WHERE {IN_BASELINE}),
    bins AS (SELECT k AS bin_id, q[k + 1] AS lo, q[k + 2] AS hi FROM edges, range(10) r(k))
    SELECT CAST(b.bin_id AS BIGINT) AS bin_id, count(*) FILTER (WHERE {IN_BASELINE}) AS baseline_cnt,
      count(*) FILTER (WHERE {IN_TARGET}) AS target_cnt
    FROM bins b LEFT JOIN v ON (fare_amount >= b.lo OR b.bin_id = 0) AND (fare_amount < b.hi OR b.bin_id = 9)
    GROUP BY b.bin_id""",
)
def psi_bins(spark, sf_dir):
    """J2, J4, J5, A2."""
    out = bin_report(_two_dates(spark, sf_dir), "fare_amount", BASELINE, TARGET)
    return out.withColumn("bin_id", F.col("bin_id").cast("long"))


@query(
    "psi_target",
    f"""WITH {VIEW}, {_matrix_sql(["fare_amount"])}
    SELECT feature, CAST(scoring_date AS VARCHAR) AS scoring_date, baseline_rows, target_rows,
    0::BIGINT AS baseline_unusable, 0::BIGINT AS target_unusable, total_psi, {BAND} AS band FROM psi WHERE {IN_TARGET}""",
)
def psi_target(spark, sf_dir):
    """The canary of one partition."""
    return plain(psi_report(_two_dates(spark, sf_dir), "fare_amount", BASELINE, TARGET))


@query(
    "psi_matrix",
    f"""WITH {VIEW}, {_matrix_sql(NUMERIC_FEATURES)}
    SELECT feature, CAST(scoring_date AS VARCHAR) AS scoring_date, baseline_rows, target_rows, total_psi, {BAND} AS band FROM psi""",
)
def psi_every_date(spark, sf_dir):
    """X4."""
    return plain(psi_matrix(view(spark, sf_dir), list(NUMERIC_FEATURES), BASELINE))


@query(
    "psi_categorical",
    f"""WITH {VIEW}, n AS (SELECT scoring_date, vendor_id AS c, count(*) AS n FROM v GROUP BY ALL),
    base AS (SELECT c, sum(n) AS n FROM n WHERE {IN_BASELINE} GROUP BY c),
    bt AS (SELECT sum(n) AS t FROM base), tt AS (SELECT scoring_date, sum(n) AS t FROM n GROUP BY ALL),
    grid AS (SELECT tt.scoring_date, tt.t AS target_rows, bt.t AS baseline_rows, c.c FROM tt, bt, (SELECT DISTINCT c FROM n) c),
    shares AS (SELECT g.*, n.n AS n, base.n AS m, coalesce(n.n / g.target_rows, 0.0001::DOUBLE) AS a,
      coalesce(base.n / g.baseline_rows, 0.0001::DOUBLE) AS e FROM grid g
      LEFT JOIN n ON n.scoring_date = g.scoring_date AND n.c = g.c LEFT JOIN base ON base.c = g.c)
    SELECT 'vendor_id' AS feature, CAST(scoring_date AS VARCHAR) AS scoring_date, CAST(min(baseline_rows) AS BIGINT) AS baseline_rows,
      CAST(min(target_rows) AS BIGINT) AS target_rows, round(sum((a - e) * ln(a / e)), 4) AS total_psi
    FROM shares WHERE n IS NOT NULL OR m IS NOT NULL GROUP BY scoring_date""",
)
def psi_categorical(spark, sf_dir):
    """X1."""
    return plain(categorical_psi(view(spark, sf_dir), "vendor_id", BASELINE))


@query(
    "psi_predictions",
    f"""WITH {SCORED}, {_matrix_sql(["p1"], "scored")}
    SELECT feature, CAST(scoring_date AS VARCHAR) AS scoring_date, baseline_rows, target_rows, total_psi, {BAND} AS band FROM psi""",
)
def psi_predictions(spark, sf_dir):
    """Drift of the predicted probability."""
    return plain(psi_matrix(scored(spark, sf_dir), ["p1"], BASELINE))


@query(
    "volume_preflight",
    f"""WITH {VIEW} SELECT CAST(scoring_date AS VARCHAR) AS scoring_date, count(*) AS row_count,
    count(*) >= {MIN_ROWS} AS sufficient FROM v GROUP BY scoring_date""",
)
def volume_preflight(spark, sf_dir):
    """A1, G1."""
    return plain(volume_report(view(spark, sf_dir), MIN_ROWS))


@query(
    "drift_guard",
    f"""WITH {VIEW}, {_matrix_sql(["fare_amount"])}
    SELECT CAST(scoring_date AS VARCHAR) AS scoring_date, total_psi,
    CASE WHEN target_rows < {MIN_ROWS} THEN 'insufficient data' WHEN total_psi >= {GUARD_AT} THEN 'drift' ELSE 'pass' END AS decision
    FROM psi""",
)
def drift_guard(spark, sf_dir):
    """The decision for every date; volume first, then PSI at the threshold."""
    matrix = psi_matrix(view(spark, sf_dir), ["fare_amount"], BASELINE)
    decision = (
        F.when(F.col("target_rows") < MIN_ROWS, "insufficient data")
        .when(F.coalesce("total_psi", F.lit(0.0)) >= GUARD_AT, "drift")
        .otherwise("pass")
    )
    return plain(matrix.select("scoring_date", "total_psi", decision.alias("decision")))
