"""Training, scoring, evaluation, publishing and whole runs."""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import functions as F

from tidegate import schemas
from tidegate.functions.rows import quality_predicate
from tidegate.functions.scoring import prob_of, scorer_of
from tidegate.operators.alerts import counter_increases, increase_windows, metric_counters, metric_incidents
from tidegate.operators.evaluate import evaluate
from tidegate.operators.features import labelled
from tidegate.operators.newton import fit_newton
from tidegate.operators.predictions import join_features, predict, unmatched, worth_offering
from tidegate.operators.profile import backfill_audit, key_audit
from tidegate.operators.training import chronological_split, compare_feature_sets, train, with_split
from tidegate.plans.nightly import backfill, run_nightly
from tidegate.plans.scoring import evaluate_window, score_partition
from tidegate.queries.base import (
    BASELINE,
    FROZEN,
    IN_BASELINE,
    IN_TARGET,
    METRIC_COLUMNS,
    METRIC_DECIMALS,
    MODEL_NAME,
    QUALITY,
    SCORED,
    TARGET,
    VIEW,
    metrics_sql,
    plain,
    rounded,
    scored,
    view,
)
from tidegate.queries.drift import GUARD_AT, MIN_ROWS, _matrix_sql
from tidegate.queries.rows import job_tables
from tidegate.registry import query
from tidegate.sources import star
from tidegate.sources.models import current_models, load_model, save_model
from tidegate.sources.shared import fresh_dir
from tidegate.sources.tables import partitions, replace_table
from tidegate.streaming.alerts import alert_on_metrics

TRAILING = (dt.date(1997, 10, 1), dt.date(1998, 3, 1))
BACKFILL_DAYS = [dt.date(1998, m, 1) for m in range(1, 7)]
OFFER_ABOVE = 30.0
FLOOR = 0.80


@query(
    "chronological_split",
    f"""WITH {VIEW}, w AS (SELECT * FROM v WHERE {IN_BASELINE}), c AS (SELECT quantile_disc(pickup_datetime, 0.8) AS t FROM w)
    SELECT CASE WHEN pickup_datetime <= t THEN 'train' ELSE 'eval' END AS split, count(*) AS trips,
    strftime(min(pickup_datetime), '%Y-%m-%d %H:%M:%S.%f') AS first_pickup,
    strftime(max(pickup_datetime), '%Y-%m-%d %H:%M:%S.%f') AS last_pickup FROM w, c GROUP BY 1""",
)
def split_rows(spark, sf_dir):
    """W3."""
    rows = with_split(partitions(view(spark, sf_dir, *BASELINE), *BASELINE))
    return plain(
        rows.groupBy("split").agg(
            F.count(F.lit(1)).alias("trips"),
            F.min("pickup_datetime").alias("first_pickup"),
            F.max("pickup_datetime").alias("last_pickup"),
        )
    )


PREDICTED = """SELECT trip_id, CAST(scoring_date AS VARCHAR) AS scoring_date, vendor_id,
  CAST(p1 > 0.5 AS BIGINT) AS predicted_is_high_tip, round(p1, 6) AS p_high, round(1 - p1, 6) AS p_low,
  'tip_model' AS model_name FROM scored"""


def _opened(predictions):
    probs = F.col("predicted_is_high_tip_probs")
    return predictions.select(
        "trip_id",
        "scoring_date",
        "vendor_id",
        "predicted_is_high_tip",
        F.round(prob_of(probs, 1), 6).alias("p_high"),
        F.round(prob_of(probs, 0), 6).alias("p_low"),
        "model_name",
    )


@query("batch_predict", f"WITH {SCORED} {PREDICTED}")
def batch_predict(spark, sf_dir):
    """Every row of the view scored with frozen coefficients."""
    return plain(_opened(predict(view(spark, sf_dir), FROZEN, MODEL_NAME)))


@query(
    "evaluate_partition",
    f"""WITH {SCORED}, t AS (SELECT * FROM scored WHERE {IN_TARGET}), m AS ({metrics_sql("t")})
    SELECT {METRIC_COLUMNS}, 'evaluated' AS status, FALSE AS below_floor FROM m""",
)
def evaluate_target(spark, sf_dir):
    """M3, M4 of one date."""
    out = evaluate_window(view(spark, sf_dir, TARGET, TARGET), FROZEN, TARGET, TARGET, min_roc_auc=0.60)
    return rounded(out, **METRIC_DECIMALS)


@query(
    "evaluate_by_date",
    f"""WITH {SCORED}, m AS ({metrics_sql("scored", "scoring_date")}), r AS (SELECT scoring_date, {METRIC_COLUMNS} FROM m)
    SELECT * REPLACE (CAST(scoring_date AS VARCHAR) AS scoring_date),
    CASE WHEN roc_auc IS NULL THEN 'not_evaluable' ELSE 'evaluated' END AS status, coalesce(roc_auc < {FLOOR}, FALSE) AS below_floor FROM r""",
)
def evaluate_by_date(spark, sf_dir):
    """M3, M4, G4, G5 for every date at once."""
    out = evaluate(labelled(scored(spark, sf_dir)), ["scoring_date"], schemas.LABEL, min_roc_auc=FLOOR)
    return plain(rounded(out, **METRIC_DECIMALS))


@query(
    "evaluate_trailing",
    f"""WITH {SCORED}, t AS (SELECT * FROM scored WHERE scoring_date BETWEEN DATE '{TRAILING[0]}' AND DATE '{TRAILING[1]}'),
    m AS ({metrics_sql("t")}) SELECT {METRIC_COLUMNS}, 'evaluated' AS status FROM m""",
)
def evaluate_trailing(spark, sf_dir):
    """X5."""
    return rounded(evaluate_window(view(spark, sf_dir, *TRAILING), FROZEN, *TRAILING), **METRIC_DECIMALS)


JOINED = f"""{SCORED}, joined AS (SELECT p.trip_id, p.scoring_date, p.p1, v.fare_amount, v.trip_distance, v.is_high_tip
  FROM scored p JOIN v USING (trip_id, scoring_date))"""


def _joined(spark, sf_dir, first=None, last=None):
    features = view(spark, sf_dir, first, last)
    made = predict(features, FROZEN, MODEL_NAME)
    p1 = prob_of(F.col("predicted_is_high_tip_probs"), 1)
    return join_features(made.withColumn("p1", p1), features)


@query(
    "predictions_joined",
    f"""WITH {JOINED} SELECT trip_id, CAST(p1 > 0.5 AS BIGINT) AS predicted_is_high_tip, fare_amount, trip_distance,
    is_high_tip AS actual FROM joined WHERE {IN_TARGET} ORDER BY trip_id LIMIT 20""",
)
def predictions_joined(spark, sf_dir):
    """The first twenty predictions of a date beside their features."""
    columns = ["trip_id", "predicted_is_high_tip", "fare_amount", "trip_distance", F.col("is_high_tip").alias("actual")]
    return _joined(spark, sf_dir, TARGET, TARGET).select(*columns).orderBy("trip_id").limit(20)


@query(
    "expected_value",
    f"""WITH {JOINED} SELECT trip_id, CAST(scoring_date AS VARCHAR) AS scoring_date, round(p1 * fare_amount, 4) AS expected_value
    FROM joined WHERE p1 * fare_amount > {OFFER_ABOVE}""",
)
def expected_value(spark, sf_dir):
    """M5 on J7."""
    rows = worth_offering(_joined(spark, sf_dir), OFFER_ABOVE)
    return plain(rounded(rows.select("trip_id", "scoring_date", "expected_value"), expected_value=4))


@query(
    "unmatched_predictions",
    f"""WITH {VIEW}, p AS (SELECT trip_id, scoring_date FROM trips WHERE {QUALITY})
    SELECT CAST(scoring_date AS VARCHAR) AS scoring_date, count(*) AS unmatched FROM p
    WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.trip_id = p.trip_id AND v.scoring_date = p.scoring_date) GROUP BY scoring_date""",
)
def unmatched_predictions(spark, sf_dir):
    """Q2: predictions of rows the view has no label for find no partner."""
    good = star.trips(spark, sf_dir).where(quality_predicate())
    inputs = good.select(*schemas.VIEW_COLUMNS)
    return plain(unmatched(predict(inputs, FROZEN, MODEL_NAME), view(spark, sf_dir)))


SPLIT_SQL = f"""{VIEW}, w AS (SELECT * FROM v WHERE {IN_BASELINE} AND is_high_tip IS NOT NULL),
c AS (SELECT quantile_disc(pickup_datetime, 0.8) AS t FROM w)"""


def _newton_sql(steps: int) -> str:
    """A weight and an intercept by so many whole Newton steps from zero, each a system of two equations."""
    parts = [f"{VIEW}, r AS (SELECT fare_amount AS x, is_high_tip AS y FROM v WHERE {IN_BASELINE} AND is_high_tip IS NOT NULL)", "b0 AS (SELECT 0.0::DOUBLE AS b, 0.0::DOUBLE AS w)"]
    for k in range(steps):
        parts.append(
            f"""b{k + 1} AS (SELECT b + (g0 * h11 - g1 * h01) / (h00 * h11 - h01 * h01) AS b, w + (g1 * h00 - g0 * h01) / (h00 * h11 - h01 * h01) AS w
            FROM (SELECT any_value(b) AS b, any_value(w) AS w, sum(y - p) AS g0, sum((y - p) * x) AS g1,
                  sum(p * (1 - p)) AS h00, sum(p * (1 - p) * x) AS h01, sum(p * (1 - p) * x * x) AS h11
                  FROM (SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(b + w * x))) AS p FROM r, b{k})))"""
        )
    return ", ".join(parts)


@query(
    "newton_weights",
    f"""WITH {_newton_sql(10)} SELECT round(b, 8) AS intercept, round(w, 8) AS fare_amount, TRUE AS converged,
    (SELECT round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), 8) FROM (SELECT y, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(b + w * x))) AS p FROM r, b10)) AS log_loss
    FROM b10""",
)
def newton_weights(spark, sf_dir):
    """M1 by Newton steps on aggregates, with one feature."""
    found = fit_newton(labelled(partitions(view(spark, sf_dir, *BASELINE), *BASELINE)), ("fare_amount",), ())
    row = (found.scorer.intercept, found.scorer.numeric["fare_amount"], found.converged, found.log_loss)
    out = spark.createDataFrame([row], "intercept double, fare_amount double, converged boolean, log_loss double")
    return rounded(out, intercept=8, fare_amount=8, log_loss=8)


@query(
    "train_model",
    f"""WITH {SPLIT_SQL} SELECT 'tip_model' AS model_name, count(*) FILTER (WHERE pickup_datetime <= t) AS train_rows,
    count(*) FILTER (WHERE pickup_datetime > t) AS eval_rows, count(*) FILTER (WHERE pickup_datetime > t) AS evaluated_rows,
    TRUE AS score_equations_hold, TRUE AS better_than_chance FROM w, c""",
)
def train_model(spark, sf_dir):
    """Trained, saved, registered, loaded again and evaluated on the holdout.

    Fitting cannot be said in SQL, but what it must reach can: at the fitted weights the
    residuals add up to nothing against every feature and every category.
    """
    cfg = job_tables(spark, model_name=MODEL_NAME)
    rows = labelled(partitions(view(spark, sf_dir, *BASELINE), *BASELINE)).persist(StorageLevel.MEMORY_AND_DISK)
    early, late = chronological_split(rows)
    model = train(early)
    root = fresh_dir(spark, "models")
    n_train, n_eval = early.count(), late.count()
    save_model(spark, cfg, model, root, BASELINE, n_train, n_eval, evaluate(scorer_of(model).score(late), [], schemas.LABEL).first()["roc_auc"])
    loaded = scorer_of(load_model(spark, cfg))
    registered = current_models(spark.table(cfg.registry_table)).first()
    metrics = evaluate(loaded.score(late), [], schemas.LABEL).select(F.col("labelled_rows").alias("evaluated_rows"), (F.col("roc_auc") > 0.55).alias("better_than_chance"))
    out = metrics.select(
        F.lit(registered["model_name"]).alias("model_name"),
        F.lit(registered["train_rows"]).alias("train_rows"),
        F.lit(registered["eval_rows"]).alias("eval_rows"),
        "evaluated_rows",
        F.lit(score_equations_hold(loaded.score(early))).alias("score_equations_hold"),
        "better_than_chance",
    ).first()
    rows.unpersist()
    return spark.createDataFrame([out])


def score_equations_hold(scored, tolerance: float = 1e-3) -> bool:
    """Whether sum((y - p) * x) is next to nothing, beside sum(x), for the constant, each number and each category."""
    residual = F.col(schemas.LABEL) - F.col("p1")
    numbers = [F.lit(1.0), *[F.col(c).cast("double") for c in schemas.NUMERIC_FEATURES]]
    sums = scored.agg(*[F.abs(F.sum(residual * x) / F.sum(F.abs(x))).alias(f"x{i}") for i, x in enumerate(numbers)]).first()
    groups = [scored.groupBy(c).agg(F.abs(F.avg(residual)).alias("r")).agg(F.max("r")).first()[0] for c in schemas.CATEGORICAL_FEATURES]
    return max(*sums, *groups) < tolerance


@query(
    "compare_feature_sets",
    f"""WITH {SPLIT_SQL} SELECT f AS feature_set, count(*) FILTER (WHERE pickup_datetime > t) AS labelled_rows, TRUE AS in_band
    FROM w, c, (VALUES ('clean'), ('leaky')) AS sets(f) GROUP BY f""",
)
def feature_set_comparison(spark, sf_dir):
    """M6: the clean feature list against one with the leaked column, which must look better by far."""
    good = star.trips(spark, sf_dir, *BASELINE).where(quality_predicate() & (F.col("payment_type") == "1"))
    rows = partitions(good, *BASELINE).select(*schemas.VIEW_COLUMNS, "total_amount").persist(StorageLevel.MEMORY_AND_DISK)
    numeric = schemas.NUMERIC_FEATURES
    found = {r["feature_set"]: r for r in compare_feature_sets(rows, {"clean": numeric, "leaky": (*numeric, "total_amount")}).collect()}
    rows.unpersist()
    clean, leaky = found["clean"]["roc_auc"], found["leaky"]["roc_auc"]
    bands = {"clean": 0.55 < clean < 0.85, "leaky": clean + 0.05 < leaky < 1}
    return spark.createDataFrame([(k, r["labelled_rows"], bands[k]) for k, r in found.items()], "feature_set string, labelled_rows bigint, in_band boolean")


def _feature_table(spark, sf_dir, **settings):
    """A job whose feature table holds all trips."""
    cfg = job_tables(
        spark,
        target_date=TARGET,
        baseline_start=BASELINE[0],
        baseline_end=BASELINE[1],
        enable_replay_ingest=False,
        model_name=MODEL_NAME,
        **settings,
    )
    replace_table(spark, star.trips(spark, sf_dir), cfg.features_table)
    return cfg


@query(
    "score_published",
    f"""WITH {SCORED}, t AS (SELECT count(*) AS n, count(DISTINCT trip_id) AS u, sum((p1 > 0.5)::INTEGER) AS high
      FROM scored WHERE {IN_TARGET})
    SELECT '{TARGET}' AS scoring_date, n AS row_count, u AS unique_trips, CAST(high AS BIGINT) AS predicted_high,
      TRUE AS scored_by_second_run, 0::BIGINT AS removed_first, n AS removed_second, n AS rows_scored FROM t""",
)
def score_published(spark, sf_dir):
    """A partition scored twice holds each trip once."""
    cfg = _feature_table(spark, sf_dir)
    first = score_partition(spark, cfg, FROZEN)
    between = dt.datetime.now(dt.timezone.utc)
    second = score_partition(spark, cfg, FROZEN)
    table = spark.table(cfg.predictions_table)
    high = table.groupBy("scoring_date").agg(F.sum("predicted_is_high_tip").alias("predicted_high"))
    audited = backfill_audit(table).select(
        "scoring_date", (F.col("first_scored_at") >= F.lit(between)).alias("scored_by_second_run")
    )
    audit = key_audit(table).join(high, "scoring_date").join(audited, "scoring_date")
    return plain(
        audit.select(
            "*",
            F.lit(first["rows_removed"]).cast("long").alias("removed_first"),
            F.lit(second["rows_removed"]).cast("long").alias("removed_second"),
            F.lit(second["rows_written"]).cast("long").alias("rows_scored"),
        )
    )


BACKFILL_SQL = f"""{SCORED}, {_matrix_sql(["fare_amount"])}, m AS ({metrics_sql("scored", "scoring_date")}),
e AS (SELECT scoring_date AS eval_date, {METRIC_COLUMNS} FROM m),
runs AS (SELECT *, target_rows < {MIN_ROWS} OR total_psi >= {GUARD_AT} AS halted FROM psi LEFT JOIN e ON scoring_date = eval_date
  WHERE scoring_date BETWEEN DATE '{BACKFILL_DAYS[0]}' AND DATE '{BACKFILL_DAYS[-1]}')"""
WARN_BELOW = 0.99


@query(
    "backfill_published",
    f"""WITH {BACKFILL_SQL}
    SELECT CAST(scoring_date AS VARCHAR) AS target_date, CASE WHEN halted THEN 'HALTED' ELSE 'SUCCEEDED' END AS status,
      CASE WHEN halted THEN '2' ELSE '0' END AS exit_code, CASE WHEN NOT halted THEN target_rows END AS rows_scored,
      total_psi AS psi, CASE WHEN NOT halted THEN round(roc_auc, 4) END AS roc_auc
    FROM runs""",
)
def backfill_published(spark, sf_dir):
    """E5: six months guarded, evaluated and scored together; the ledger they leave."""
    cfg = _feature_table(spark, sf_dir, psi_threshold=GUARD_AT, min_row_count=MIN_ROWS)
    backfill(spark, cfg, FROZEN, BACKFILL_DAYS)
    ledger = spark.table(cfg.ledger_table)
    return ledger.select("target_date", "status", "exit_code", "rows_scored", "psi", "roc_auc")


@query(
    "quality_warnings",
    f"""WITH {BACKFILL_SQL}
    SELECT CAST(scoring_date AS VARCHAR) AS target_date, round(roc_auc, 4) AS roc_auc, 'quality_warning' AS event
    FROM runs WHERE NOT halted AND (roc_auc < {WARN_BELOW} OR roc_auc IS NULL)""",
)
def quality_warnings(spark, sf_dir):
    """G4 in a run: the WARNING records that a backfill leaves for months below the AUC floor."""
    cfg = _feature_table(spark, sf_dir, psi_threshold=GUARD_AT, min_row_count=MIN_ROWS, min_roc_auc=WARN_BELOW)
    backfill(spark, cfg, FROZEN, BACKFILL_DAYS)
    fields = F.from_json("fields", "event STRING, target_date STRING, roc_auc DOUBLE")
    return spark.table(cfg.logs_table).where("severity = 'WARNING'").select(fields.alias("f")).select("f.target_date", "f.roc_auc", "f.event")


@query(
    "rows_scored_increase",
    f"""WITH {BACKFILL_SQL} SELECT 'rows_scored' AS name, CAST(sum(target_rows) FILTER (WHERE NOT halted) AS DOUBLE) AS increase FROM runs
    HAVING count(*) FILTER (WHERE NOT halted) > 0""",
)
def rows_scored_increase(spark, sf_dir):
    """R2 over run_metrics: the counter's points rise by what the runs scored."""
    cfg = _feature_table(spark, sf_dir, psi_threshold=GUARD_AT, min_row_count=MIN_ROWS)
    backfill(spark, cfg, FROZEN, BACKFILL_DAYS[:3])
    backfill(spark, cfg, FROZEN, BACKFILL_DAYS[3:])
    points = spark.table(cfg.metrics_table).where("name = 'rows_scored'")
    return points.groupBy("name").agg(F.max("value").alias("increase"))


@query(
    "run_metric_incidents",
    f"""WITH {BACKFILL_SQL} SELECT 'feature_psi:fare_amount' AS rule, max(total_psi) AS max_value, 1::BIGINT AS incidents, 86400::BIGINT AS open_for_s
    FROM runs WHERE total_psi > {GUARD_AT} HAVING count(*) > 0""",
)
def run_metric_incidents(spark, sf_dir):
    """R1, R7 over run_metrics: the alert and the incident that a backfill with drifted months raises, read as a stream."""
    cfg = _feature_table(spark, sf_dir, psi_threshold=GUARD_AT, min_row_count=MIN_ROWS)
    out = fresh_dir(spark, "metric-alerts")
    for days in (BACKFILL_DAYS[:3], BACKFILL_DAYS[3:]):  # the second call goes on where the first one stopped
        backfill(spark, cfg, FROZEN, days)
        alerts = alert_on_metrics(spark, f"{cfg.table_root}/{cfg.metrics_table}", out, GUARD_AT)
    rule = F.concat(F.lit("feature_psi:"), "feature").alias("rule")
    highest = alerts.groupBy(rule).agg(F.max("max_value").alias("max_value"), F.max("window_start").alias("last"))
    opened = metric_incidents(alerts).groupBy("rule").agg(F.count(F.lit(1)).alias("incidents"), F.max("closed_at").alias("closed_at"))
    open_for = F.unix_seconds("closed_at") - F.unix_seconds("last")
    return highest.join(opened, "rule").select("rule", "max_value", "incidents", open_for.alias("open_for_s"))


@query(
    "run_metric_increases",
    f"""WITH {BACKFILL_SQL} SELECT '{MODEL_NAME}' AS model_name, CAST(sum(target_rows) FILTER (WHERE NOT halted) AS DOUBLE) AS increase FROM runs
    HAVING count(*) FILTER (WHERE NOT halted) > 0""",
)
def run_metric_increases(spark, sf_dir):
    """R2 over run_metrics: the windows' increases of the counter, added up over the runs."""
    cfg = _feature_table(spark, sf_dir, psi_threshold=GUARD_AT, min_row_count=MIN_ROWS)
    backfill(spark, cfg, FROZEN, BACKFILL_DAYS[:3])
    backfill(spark, cfg, FROZEN, BACKFILL_DAYS[3:])
    windows = increase_windows(counter_increases(metric_counters(spark.table(cfg.metrics_table))))
    return windows.groupBy("model_name").agg(F.sum("increase").alias("increase"))


RUN_METRICS_SQL = f"""{SCORED}, {_matrix_sql(["fare_amount"])}, t AS (SELECT * FROM scored WHERE {IN_TARGET}),
m AS ({metrics_sql("t")}), e AS (SELECT {METRIC_COLUMNS} FROM m)"""


@query(
    "nightly_run",
    f"""WITH {RUN_METRICS_SQL}
    SELECT 'pipeline_run_summary' AS event, 'SUCCEEDED' AS status, '0' AS exit_code, '{TARGET}' AS target_date,
      target_rows AS rows_scored, total_psi AS psi, 0.25::DOUBLE AS psi_threshold, round(roc_auc, 4) AS roc_auc,
      target_rows AS predictions_held
    FROM psi, e WHERE {IN_TARGET}""",
)
def nightly_run(spark, sf_dir):
    """A run that passes its guards, and its ledger row."""
    return _one_run(spark, _feature_table(spark, sf_dir))


@query(
    "nightly_run_halted",
    f"""WITH {RUN_METRICS_SQL}
    SELECT 'pipeline_run_summary' AS event, 'HALTED' AS status, '2' AS exit_code, '{TARGET}' AS target_date,
      NULL::BIGINT AS rows_scored, total_psi AS psi, 0.0001::DOUBLE AS psi_threshold, NULL::DOUBLE AS roc_auc,
      0::BIGINT AS predictions_held
    FROM psi WHERE {IN_TARGET}""",
)
def nightly_run_halted(spark, sf_dir):
    """A run stopped by drift writes no prediction."""
    return _one_run(spark, _feature_table(spark, sf_dir, psi_threshold=0.0001))


def _one_run(spark, cfg):
    run_nightly(spark, cfg, FROZEN)
    held = spark.table(cfg.predictions_table).count()
    ledger = spark.table(cfg.ledger_table).select(
        "event", "status", "exit_code", "target_date", "rows_scored", "psi", "psi_threshold", "roc_auc"
    )
    return ledger.withColumn("predictions_held", F.lit(held).cast("long"))
