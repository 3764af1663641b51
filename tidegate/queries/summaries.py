"""Drift and quality from stored summaries; nothing but the first pass reads the trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.operators.summaries import SKETCH_K, evaluate_counts, sketched_edges, sketched_psi, trailing
from tidegate.plans.summaries import score_table, sketch_table, summarise_dates
from tidegate.queries.base import BASELINE, FROZEN, IN_BASELINE, METRIC_COLUMNS, METRIC_DECIMALS, SCORED, VIEW, metrics_sql, plain, rounded, view
from tidegate.queries.drift import BAND, PROBS, _long, _matrix_sql
from tidegate.queries.rows import job_tables
from tidegate.registry import query
from tidegate.schemas import CATEGORICAL_FEATURES, LABEL, NUMERIC_FEATURES
from tidegate.sources.shared import drop_dir, written

WINDOW_DAYS = 92
#: What sketches and score counts are made from.
SUMMARISED = ("scoring_date", *CATEGORICAL_FEATURES, *NUMERIC_FEATURES, LABEL)


def _stored(spark, sf_dir):
    """Summaries of all dates, written by two runs that overlap in a date.

    Both runs and the list of dates read the view's columns from one folder, so its join runs once.
    """
    cfg = job_tables(spark)
    rows, folder = written(view(spark, sf_dir).select(*SUMMARISED), "view")
    days = sorted(r["scoring_date"] for r in rows.select("scoring_date").distinct().collect())
    middle = len(days) // 2
    for part in (days[: middle + 1], days[middle:]):
        if part:
            summarise_dates(spark, cfg, rows, FROZEN, part)
    drop_dir(spark, folder)
    return cfg


@query(
    "decile_edges_stored",
    f"""WITH {VIEW}, long AS ({_long(NUMERIC_FEATURES)}),
    edges AS (SELECT feature, count(*) AS held, quantile_disc(x, {PROBS}) AS q FROM long WHERE {IN_BASELINE} GROUP BY feature)
    SELECT feature, held, CAST(k AS BIGINT) AS decile, q[k + 1] AS edge FROM edges, range(11) r(k)""",
)
def decile_edges_stored(spark, sf_dir):
    """A3 from merged sketches; exact while the baseline has no more values than a sketch holds."""
    found = sketched_edges(spark.table(sketch_table(_stored(spark, sf_dir))), BASELINE)
    return found.select("feature", "held", F.posexplode("edges").alias("decile", "edge")).withColumn("decile", F.col("decile").cast("long"))


@query(
    "psi_matrix_stored",
    f"""WITH {VIEW}, {_matrix_sql(NUMERIC_FEATURES)}
    SELECT feature, CAST(scoring_date AS VARCHAR) AS scoring_date, baseline_rows, target_rows, total_psi, {BAND} AS band,
    baseline_rows <= {SKETCH_K} AND target_rows <= {SKETCH_K} AS exact FROM psi""",
)
def psi_matrix_stored(spark, sf_dir):
    """A5, X4 from merged sketches."""
    return plain(sketched_psi(spark.table(sketch_table(_stored(spark, sf_dir))), BASELINE))


BOUNDS = """bounds AS (
  SELECT as_of, sum(pos * (below + neg / 2.0::DOUBLE)) AS wins, sum(CASE WHEN low = high THEN 0 ELSE pos * neg / 2.0::DOUBLE END) AS open,
         sum(pos) * sum(neg) AS pairs
  FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY as_of ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
        FROM (SELECT as_of, greatest(ceil(p1 * 1024) - 1, 0) AS bucket, sum(is_high_tip) AS pos, sum(1 - is_high_tip) AS neg,
                     min(p1) AS low, max(p1) AS high FROM t WHERE is_high_tip IS NOT NULL GROUP BY ALL))
  GROUP BY as_of)"""


@query(
    "evaluate_trailing_stored",
    f"""WITH {SCORED}, dates AS (SELECT DISTINCT scoring_date AS as_of FROM scored),
    t AS (SELECT as_of, scored.* FROM scored JOIN dates ON scoring_date <= as_of AND scoring_date > as_of - INTERVAL '{WINDOW_DAYS} days'),
    m AS ({metrics_sql("t", "as_of")}), r AS (SELECT as_of, {METRIC_COLUMNS} FROM m), {BOUNDS}
    SELECT CAST(as_of AS VARCHAR) AS as_of, r.* EXCLUDE (as_of, roc_auc), round(wins / nullif(pairs, 0), 6) AS roc_auc,
    round((wins - open) / nullif(pairs, 0), 6) AS auc_low, round((wins + open) / nullif(pairs, 0), 6) AS auc_high,
    CASE WHEN pairs > 0 THEN 'evaluated' ELSE 'not_evaluable' END AS status,
    roc_auc IS NULL OR roc_auc BETWEEN (wins - open) / pairs - 1e-6 AND (wins + open) / pairs + 1e-6 AS within_bounds
    FROM r JOIN bounds USING (as_of)""",
)
def evaluate_trailing_stored(spark, sf_dir):
    """Every trailing window of 92 days as a sum of stored counts; the twin checks the bounds against ranks."""
    counts = spark.table(score_table(_stored(spark, sf_dir)))
    out = evaluate_counts(trailing(counts, WINDOW_DAYS), ["as_of"])
    # the exact value is known to the twin only, whose column must be true throughout
    return plain(rounded(out, auc_low=6, auc_high=6, **METRIC_DECIMALS).withColumn("within_bounds", F.lit(True)))
