"""Distribution drift: decile edges, bins and PSI."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.config import PSI_BINS, PSI_DECIMALS, PSI_EMPTY_BIN_SHARE
from tidegate.functions.psi import DECILES, bin_of, count_if, drift_band, psi, psi_term, share
from tidegate.functions.rows import usable
from tidegate.operators.quantiles import SKETCH_ACCURACY, exact_quantiles
from tidegate.sources.tables import partitions


def decile_edges(
    baseline: DataFrame, columns: list[str], accuracy: int = SKETCH_ACCURACY
) -> dict[str, list[float] | None]:
    """A3: 11 edges, minimum to maximum, per column of the baseline rows."""
    return exact_quantiles(baseline, {c: list(DECILES) for c in columns}, accuracy)


def psi_report(
    view: DataFrame,
    column: str,
    baseline: tuple[dt.date, dt.date],
    target: dt.date,
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """A2, A4, A5: PSI of one column, target partition against baseline window.

    Both sides are counted in one pass over the two pruned date ranges, folded
    map-side to one row per bin. Rows with a NULL or NaN value are left
    out and counted.
    """
    edges = decile_edges(partitions(view, *baseline).select(column), [column], accuracy)[column]
    date, value = F.col("scoring_date"), F.col(column)
    in_baseline = date.between(F.lit(baseline[0]), F.lit(baseline[1]))
    in_target = date == F.lit(target)
    ok = usable(value)
    counts = (
        view.where(in_baseline | in_target)
        .groupBy(ok.alias("ok"), F.when(ok, bin_of(value, edges)).alias("bin"))
        .agg(count_if(in_baseline).alias("b"), count_if(in_target).alias("t"))
    )
    # At most a dozen rows from here on. A bin without rows on either side adds nothing.
    everything = Window.partitionBy(F.lit(0))
    sums = {
        name: F.coalesce(F.sum(F.when(F.col("ok") == kept, F.col(side))).over(everything), F.lit(0).cast("long"))
        for name, side, kept in (
            ("baseline_rows", "b", True),
            ("target_rows", "t", True),
            ("baseline_unusable", "b", False),
            ("target_unusable", "t", False),
        )
    }
    term = psi_term(share(F.col("t"), F.col("target_rows")), share(F.col("b"), F.col("baseline_rows")))
    total = F.round(F.coalesce(F.sum(F.when(F.col("bin").isNotNull(), term)), F.lit(0.0)), PSI_DECIMALS)
    return (
        counts.withColumns(sums)
        .agg(*[F.coalesce(F.max(name), F.lit(0).cast("long")).alias(name) for name in sums], total.alias("total_psi"))
        .select(
            F.lit(column).alias("feature"),
            F.lit(target).alias("scoring_date"),
            *sums,
            "total_psi",
            drift_band(F.col("total_psi")).alias("band"),
        )
    )


def _rows_where(condition: Column) -> Column:
    """Rows behind the pre-counted groups that meet a condition."""
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0).cast("long"))


def bin_report(
    view: DataFrame, column: str, baseline: tuple[dt.date, dt.date], target: dt.date
) -> DataFrame:
    """All ten bins with both counts, empty bins included."""
    edges = decile_edges(partitions(view, *baseline).select(column), [column])[column]
    date, value = F.col("scoring_date"), F.col(column)
    in_baseline = date.between(F.lit(baseline[0]), F.lit(baseline[1]))
    in_target = date == F.lit(target)
    counts = (
        view.where((in_baseline | in_target) & usable(value))
        .groupBy(bin_of(value, edges).alias("bin_id"))
        .agg(count_if(in_baseline).alias("baseline_cnt"), count_if(in_target).alias("target_cnt"))
    )
    spark = view.sparkSession
    bins = spark.range(1).select(
        F.explode(F.sequence(F.lit(0), F.lit(PSI_BINS - 1))).alias("bin_id")
    )
    zero = F.lit(0).cast("long")
    return bins.join(counts, "bin_id", "left").select(
        "bin_id",
        F.coalesce("baseline_cnt", zero).alias("baseline_cnt"),
        F.coalesce("target_cnt", zero).alias("target_cnt"),
    )


def psi_matrix(
    view: DataFrame,
    columns: list[str],
    baseline: tuple[dt.date, dt.date],
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """PSI of every column at every logical date, in one pass over the view.

    Each row turns into one (feature, bin) pair per column, which map-side
    aggregation folds into counts per (feature, date, bin) before anything is
    shuffled. The window behind them sees one row per calendar date and feature.
    """
    edges = decile_edges(partitions(view, *baseline).select(*columns), columns, accuracy)
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.when(usable(F.col(c)), bin_of(F.col(c), edges[c])).alias("bin"),
                usable(F.col(c)).alias("ok"),
            )
            for c in columns
        ]
    )
    binned = view.select("scoring_date", F.inline(pairs))
    return _psi_by_date(binned, "feature", baseline)


def _psi_by_date(binned: DataFrame, key: str, baseline: tuple[dt.date, dt.date]) -> DataFrame:
    counts = binned.groupBy(key, "scoring_date", "bin", "ok").agg(F.count(F.lit(1)).alias("n"))
    return psi_of_counts(counts, key, baseline)


def psi_of_counts(counts: DataFrame, key: str, baseline: tuple[dt.date, dt.date]) -> DataFrame:
    """PSI of every key and date from the rows ``n`` of each (key, date, bin, ok)."""
    per_date = counts.groupBy(key, "scoring_date").agg(
        *[_rows_where(F.col("bin") == k).alias(f"t{k}") for k in range(PSI_BINS)],
        _rows_where(F.col("ok")).alias("target_rows"),
    )
    in_baseline = F.col("scoring_date").between(F.lit(baseline[0]), F.lit(baseline[1]))
    over_key = Window.partitionBy(key)

    def base(column):
        return F.coalesce(F.sum(F.when(in_baseline, F.col(column))).over(over_key), F.lit(0).cast("long"))

    both = per_date.select(
        "*",
        *[base(f"t{k}").alias(f"b{k}") for k in range(PSI_BINS)],
        base("target_rows").alias("baseline_rows"),
    )
    value = psi(
        [F.col(f"t{k}") for k in range(PSI_BINS)],
        F.col("target_rows"),
        [F.col(f"b{k}") for k in range(PSI_BINS)],
        F.col("baseline_rows"),
    )
    return both.select(
        key, "scoring_date", "baseline_rows", "target_rows", value.alias("total_psi"), drift_band(value).alias("band")
    )


def categorical_psi(view: DataFrame, column: str, baseline: tuple[dt.date, dt.date]) -> DataFrame:
    """PSI over the categories of a column, at every logical date.

    A category seen on one side only has the floor share on the other. Counting
    by (date, category) folds map-side and everything behind it works on those
    counts. Baseline categories a date lacks are not materialised: their summed
    terms are one driver-side number, less the part the date does hold.
    """
    in_baseline = F.col("scoring_date").between(F.lit(baseline[0]), F.lit(baseline[1]))
    counts = (
        view.where(F.col(column).isNotNull())
        .groupBy("scoring_date", F.col(column).alias("category"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    baseline_rows, all_missing = _baseline_scalars(partitions(counts, *baseline))
    base_n = F.coalesce(
        F.sum(F.when(in_baseline, F.col("n"))).over(Window.partitionBy("category")), F.lit(0).cast("long")
    )
    totals = counts.groupBy("scoring_date").agg(F.sum("n").alias("target_rows"))
    expected = share(F.col("base_n"), F.lit(baseline_rows))
    lacking = psi_term(F.lit(PSI_EMPTY_BIN_SHARE), expected)
    return (
        counts.withColumn("base_n", base_n)
        .join(totals, "scoring_date")
        .groupBy("scoring_date", "target_rows")
        .agg(
            F.sum(psi_term(share(F.col("n"), F.col("target_rows")), expected)).alias("held"),
            F.sum(F.when(F.col("base_n") > 0, lacking).otherwise(0.0)).alias("not_missing"),
        )
        .select(
            F.lit(column).alias("feature"),
            "scoring_date",
            F.lit(baseline_rows).cast("long").alias("baseline_rows"),
            "target_rows",
            F.round(F.col("held") + F.lit(all_missing) - F.col("not_missing"), PSI_DECIMALS).alias("total_psi"),
        )
    )


def _baseline_scalars(counts: DataFrame) -> tuple[int, float]:
    """Baseline rows, and the PSI terms of a date holding none of its categories.

    With floor f, total T and category count n the term (f - n/T) ln(f T / n)
    sums from four plain aggregates, so the total is not needed beforehand.
    """
    per_category = counts.groupBy("category").agg(F.sum("n").alias("n"))
    row = per_category.agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("total"),
        F.sum(F.log("n")).alias("log_n"),
        F.sum(F.col("n") * F.log("n")).alias("n_log_n"),
    ).collect()[0]
    if not row["total"]:
        return 0, 0.0
    floor, total = PSI_EMPTY_BIN_SHARE, row["total"]
    scale = math.log(floor) + math.log(total)
    terms = floor * (row["k"] * scale - row["log_n"]) - scale + row["n_log_n"] / total
    return int(total), terms
