"""Model quality from a histogram of scores."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.functions.scoring import clipped
from tidegate.functions.rows import above
from tidegate.operators.quantiles import near_quantiles

METRICS = ("precision", "recall", "accuracy", "f1_score", "log_loss", "roc_auc")


def score_histogram(scored: DataFrame, by: list[str], label: str, score: str = "p1") -> DataFrame:
    """Positives and negatives per distinct score: all any metric below needs.

    Map-side aggregation folds tied scores, so a score shared by a third of the
    rows reaches the shuffle as one row per task.
    """
    y = F.col(label)
    return (
        scored.where(y.isNotNull() & F.col(score).isNotNull())
        .groupBy(*by, F.col(score).alias("score"))
        .agg(F.sum(y.cast("long")).alias("pos"), F.sum((1 - y).cast("long")).alias("neg"))
    )


def score_edges(scored: DataFrame, score: str = "p1", buckets: int | None = None) -> list[float]:
    """Inner bucket limits that spread the scores, as many as there are shuffle partitions."""
    if buckets is None:
        buckets = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(2, buckets)
    found = near_quantiles(scored, {score: (F.col(score), [i / buckets for i in range(1, buckets)])})[score]
    return sorted(set(found or ()))


def evaluate(
    scored: DataFrame,
    by: list[str],
    label: str,
    score: str = "p1",
    min_roc_auc: float | None = None,
    edges: list[float] | None = None,
) -> DataFrame:
    """Six metrics per group of ``by``.

    ROC-AUC needs, for every positive, the negatives scored lower. A running
    count over all scores would be one task; here it runs inside score buckets,
    and each bucket adds the negatives of the buckets below through a second
    running count over one row per bucket. Confusion counts and log loss come
    from the same histogram rows.
    """
    if edges is None:
        edges = score_edges(scored, score)
    histogram = score_histogram(scored, by, label, score)
    limits = [-float("inf"), *(edges or [0.5]), float("inf")]
    bucketed = Bucketizer(splits=limits, inputCol="score", outputCol="bucket", handleInvalid="keep").transform(histogram)
    pos, neg, p = F.col("pos"), F.col("neg"), clipped(F.col("score"))
    below = Window.partitionBy(*by, "bucket").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    ranked = bucketed.withColumn("neg_below", F.coalesce(F.sum("neg").over(below), F.lit(0)))
    hit = above(F.col("score"), 0.5)
    per_bucket = ranked.groupBy(*by, "bucket").agg(
        F.sum(pos * (F.col("neg_below") + neg / 2)).alias("wins"),
        F.sum("pos").alias("pos"),
        F.sum("neg").alias("neg"),
        F.sum(F.when(hit, pos).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, neg).otherwise(0)).alias("fp"),
        F.sum(-(pos * F.log(p) + neg * F.log(1 - p))).alias("loss"),
    )
    lower = Window.partitionBy(*(by or [F.lit(0)])).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    with_lower = per_bucket.withColumn("neg_lower", F.coalesce(F.sum("neg").over(lower), F.lit(0)))
    totals = with_lower.groupBy(*by).agg(
        F.sum(F.col("wins") + pos * F.col("neg_lower")).alias("wins"),
        F.sum("pos").alias("pos"),
        F.sum("neg").alias("neg"),
        F.sum("tp").alias("tp"),
        F.sum("fp").alias("fp"),
        F.sum("loss").alias("loss"),
    )
    return metrics_of_totals(totals, by, min_roc_auc)


def metrics_of_totals(totals: DataFrame, by: list[str], min_roc_auc: float | None) -> DataFrame:
    """The metrics of rows with wins, pos, neg, tp, fp and loss."""
    pos, neg, tp, fp = (F.col(c) for c in ("pos", "neg", "tp", "fp"))
    rows = pos + neg
    tn = neg - fp

    def ratio(top, bottom):
        return F.when(bottom > 0, top / bottom)

    empty = F.coalesce(rows, F.lit(0)) == 0
    undefined_as_zero = {
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, pos),
        "accuracy": ratio(tp + tn, rows),
        "f1_score": ratio(2 * tp, 2 * tp + fp + (pos - tp)),
        "log_loss": ratio(F.col("loss"), rows),
    }
    out = totals.select(
        *by,
        F.coalesce(rows, F.lit(0)).alias("labelled_rows"),
        *[F.when(~empty, F.coalesce(v, F.lit(0.0))).alias(k) for k, v in undefined_as_zero.items()],
        ratio(F.col("wins"), pos * neg).alias("roc_auc"),
    )
    evaluable = F.col("roc_auc").isNotNull()
    out = out.withColumn("status", F.when(evaluable, "evaluated").otherwise("not_evaluable"))
    if min_roc_auc is None:
        return out
    # A value equal to the floor does not warn, and a missing one never does.
    return out.withColumn("below_floor", evaluable & (F.col("roc_auc") < F.lit(min_roc_auc)))
