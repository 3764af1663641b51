"""Small mergeable summaries of each date, kept so that windows need no second look at the rows.

Two kinds: a quantile sketch for each (date, feature), and counts of labels by score bucket
for each date. A window of dates is a merge of theirs, so a baseline or a trailing
evaluation may move at the cost of a few rows a date.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.config import PSI_BINS
from tidegate.functions.rows import usable
from tidegate.functions.scoring import clipped
from tidegate.operators.drift import psi_of_counts
from tidegate.operators.evaluate import metrics_of_totals
from tidegate.sources.tables import partitions

#: Size of a sketch: exact up to so many values, beyond that a rank error of some 0.07 %; at most some 200 kB.
SKETCH_K = 8_192
#: Score buckets; a power of two, so that a score's bucket, and 0.5 as a limit, are exact.
SCORE_BUCKETS = 1_024
#: Below a tenth of the step between the ranks of 65,535 values, the most a sketch can hold one by one,
#: and above the millionth of a step to which the sketch rounds.
HAIR = 1e-6

FEATURE_SKETCHES = T.StructType(
    [
        T.StructField("feature", T.StringType()),
        T.StructField("held", T.LongType()),
        T.StructField("sketch", T.BinaryType()),
        T.StructField("scoring_date", T.DateType()),
    ]
)
SCORE_COUNTS = T.StructType(
    [
        T.StructField("bucket", T.IntegerType()),
        T.StructField("pos", T.LongType()),
        T.StructField("neg", T.LongType()),
        T.StructField("loss", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("scoring_date", T.DateType()),
    ]
)


def feature_sketches(rows: DataFrame, columns: list[str], k: int = SKETCH_K) -> DataFrame:
    """A3 to be stored: one sketch for each date and column, of the values that are neither NULL nor NaN.

    Tasks sketch the rows they read and only sketches are shuffled. The values are
    negated: a sketch tells the share at or below a value, the bins of PSI ask for the
    share at or above one.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in columns])
    long = rows.select("scoring_date", F.inline(pairs)).where(usable(F.col("x")))
    found = long.groupBy("scoring_date", "feature").agg(
        F.count(F.lit(1)).alias("held"), F.kll_sketch_agg_double(F.lit(0.0) - F.col("x"), k).alias("sketch")
    )
    return found.select("feature", "held", "sketch", "scoring_date")


def sketched_edges(sketches: DataFrame, baseline: tuple[dt.date, dt.date], bins: int = PSI_BINS) -> DataFrame:
    """A3 from stored sketches: (feature, held, edges), ``bins`` + 1 edges from minimum to maximum.

    The value at rank ceil(k held / bins) from below is asked for from above, where a rank
    that falls on a value exactly has to be passed by a hair.
    """
    ranks = [min(1.0, 1.0 - k / bins + HAIR) for k in range(bins + 1)]
    merged = (
        partitions(sketches, *baseline)
        .groupBy("feature")
        .agg(F.sum("held").alias("held"), F.kll_merge_agg_double("sketch").alias("sketch"))
    )
    negated = F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, ranks)))
    return merged.select("feature", "held", F.transform(negated, lambda x: F.lit(0.0) - x).alias("edges"))


def sketched_psi(sketches: DataFrame, baseline: tuple[dt.date, dt.date], k: int = SKETCH_K) -> DataFrame:
    """X4 from stored sketches, and whether they held every value one by one (``exact``).

    The edges, eleven numbers a feature, come to the driver; each date's sketch is asked for
    its share at or above each inner one. A feature without a baseline is not reported.
    """
    shares = F.lit(None).cast("array<double>")
    edges = {r["feature"]: r["edges"] for r in sketched_edges(sketches, baseline).collect()}
    for feature, limits in edges.items():
        inner = F.array(*[F.lit(0.0 - e) for e in limits[1:-1]])
        shares = F.when(F.col("feature") == feature, F.kll_sketch_get_rank_double("sketch", inner)).otherwise(shares)
    asked = sketches.where(F.col("feature").isin(list(edges))).withColumn("shares", shares)
    inside = [F.round(F.col("shares")[b] * F.col("held")).cast("long") for b in range(PSI_BINS - 1)]
    at_least = [F.col("held"), *inside, F.lit(0).cast("long")]
    bins = F.array(*[F.struct(F.lit(b).alias("bin"), (at_least[b] - at_least[b + 1]).alias("n")) for b in range(PSI_BINS)])
    counts = asked.select("feature", "scoring_date", F.lit(True).alias("ok"), F.inline(bins))
    found = psi_of_counts(counts.where("n > 0"), "feature", baseline)
    return found.withColumn("exact", (F.col("baseline_rows") <= k) & (F.col("target_rows") <= k))


def score_counts(scored: DataFrame, label: str, score: str = "p1", buckets: int = SCORE_BUCKETS) -> DataFrame:
    """M3 to be stored: labels, log loss and the range of scores by date and bucket ``(b, b + 1] / buckets``."""
    y, p = F.col(label), F.col(score)
    bucket = F.greatest(F.ceil(p * buckets) - 1, F.lit(0)).cast("int")
    known = scored.where(y.isNotNull() & usable(p))
    found = known.groupBy("scoring_date", bucket.alias("bucket")).agg(
        F.sum(y.cast("long")).alias("pos"),
        F.sum((1 - y).cast("long")).alias("neg"),
        F.sum(-(y * F.log(clipped(p)) + (1 - y) * F.log(1 - clipped(p)))).alias("loss"),
        F.min(p).alias("low"),
        F.max(p).alias("high"),
    )
    return found.select(*SCORE_COUNTS.fieldNames())


def trailing(summaries: DataFrame, days: int) -> DataFrame:
    """Each summary once for every stored date ``as_of`` whose window of ``days`` days holds it."""
    dates = summaries.select(F.col("scoring_date").alias("as_of")).distinct()
    reach = F.explode(F.sequence("scoring_date", F.date_add("scoring_date", days - 1))).alias("as_of")
    return summaries.select("*", reach).join(dates, "as_of", "left_semi")


def evaluate_counts(counts: DataFrame, by: list[str], buckets: int = SCORE_BUCKETS, min_roc_auc: float | None = None) -> DataFrame:
    """M3, M4, X5 from stored counts: the six metrics of each group, and bounds of ROC-AUC.

    All but ROC-AUC are exact. Pairs inside a bucket are counted as ties: exactly so where
    the bucket holds one score only; else the truth lies between ``auc_low`` and
    ``auc_high``, where all of them are lost or won, and ``roc_auc`` is the middle. A group
    has at most ``buckets`` rows behind the first aggregate.
    """
    pos, neg = F.col("pos"), F.col("neg")
    merged = counts.groupBy(*by, "bucket").agg(
        *[F.sum(c).alias(c) for c in ("pos", "neg", "loss")], F.min("low").alias("low"), F.max("high").alias("high")
    )
    lower = Window.partitionBy(*(by or [F.lit(0)])).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ranked = merged.withColumn("neg_below", F.coalesce(F.sum("neg").over(lower), F.lit(0)))
    tied = F.col("low") == F.col("high")
    hit = F.col("bucket") >= buckets // 2
    totals = ranked.groupBy(*by).agg(
        F.sum(pos * (F.col("neg_below") + neg / 2)).alias("wins"),
        F.sum(F.when(tied, 0.0).otherwise(pos * neg / 2)).alias("open"),
        *[F.sum(c).alias(c) for c in ("pos", "neg", "loss")],
        F.sum(F.when(hit, pos).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, neg).otherwise(0)).alias("fp"),
    )
    half_width = F.col("open") / F.nullif(pos * neg, F.lit(0))
    wide = totals.withColumn("half_width", half_width)
    out = metrics_of_totals(wide, [*by, "half_width"], min_roc_auc)
    return out.withColumns({"auc_low": F.col("roc_auc") - F.col("half_width"), "auc_high": F.col("roc_auc") + F.col("half_width")}).drop("half_width")
