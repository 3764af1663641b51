"""Exact discrete quantiles in bounded memory."""

from __future__ import annotations

import math
from dataclasses import dataclass
from fractions import Fraction
from functools import reduce
from operator import add, or_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Points that a group of rows is summed up by, and the number of groups.
SKETCH_ACCURACY = 512
GROUPS = 64
#: Rows of a bracket that one task may order.
EXACT_ROWS = 20_000


@dataclass
class _Search:
    """One wanted order statistic, somewhere from ``low`` to ``high``."""

    column: str
    rank: int
    low: float
    high: float
    slack: float
    found: float | None = None
    below: int = 0
    between: int = 0


def _rank(prob: float, count: int) -> int:
    """1-based rank of the discrete quantile: least value with cume_dist >= prob."""
    return max(1, math.ceil(Fraction(str(prob)) * count))


def near_quantiles(
    df: DataFrame, wanted: dict[str, tuple[Column, list[float]]], accuracy: int = SKETCH_ACCURACY
) -> dict[str, list[float] | None]:
    """Quantiles of several columns, off by some 1 / accuracy of the rows, in two levels.

    Tasks fall into ``GROUPS`` groups, whose sketches merge in as many reducers; each
    group is left with ``accuracy`` evenly spaced values. The last task orders those
    alone, each with its group's count as its weight, whatever the size of the table.
    A column without values gives None.
    """
    points = [(i + 0.5) / accuracy for i in range(accuracy)]
    grouped = df.withColumn("sketch_group", F.spark_partition_id() % GROUPS).groupBy("sketch_group")
    names = {name: f"ask{i}" for i, name in enumerate(wanted)}
    level = grouped.agg(
        *[
            F.struct(F.count(value).alias("n"), F.percentile_approx(value, points, 4 * accuracy).cast("array<double>").alias("q")).alias(names[name])
            for name, (value, _) in wanted.items()
        ]
    )
    each = level.select(F.inline(F.array(*[F.struct(F.lit(n).alias("ask"), F.col(f"{n}.n").alias("n"), F.col(f"{n}.q").alias("q")) for n in names.values()])))
    flat = each.where("n > 0").select("ask", "n", F.explode("q").alias("value"))
    answers = [
        F.percentile(F.when(F.col("ask") == names[name], F.col("value")), [min(1.0, max(0.0, f)) for f in fractions], F.col("n")).alias(names[name])
        for name, (_, fractions) in wanted.items()
    ]
    row = flat.agg(*answers).collect()[0]
    return {name: None if row[names[name]] is None else list(row[names[name]]) for name in wanted}


def exact_quantiles(
    df: DataFrame, probs: dict[str, list[float]], accuracy: int = SKETCH_ACCURACY
) -> dict[str, list[float] | None]:
    """A3: ``percentile_disc`` of several columns without sorting the data.

    ``near_quantiles`` brackets each quantile, a counting pass checks the bracket,
    and quantiles of the bracket alone narrow it again, until its rows are at most
    ``EXACT_ROWS``, which one task orders. Nothing but counts and bracket values
    reaches the driver. Each round shrinks a bracket some hundredfold, so three
    passes do up to some hundred million rows and five do the rest. They share one
    spillable copy of the value columns; a lost executor's part of it is read
    again. NULL and NaN are ignored; a column without values gives None.
    """
    usable = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c)).alias(c) for c in probs]
    values = df.select(*usable).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _search_all(values, probs, accuracy)
    finally:
        values.unpersist()


def _search_all(values: DataFrame, probs: dict[str, list[float]], accuracy: int) -> dict[str, list[float] | None]:
    slack = 2.0 / accuracy
    row = values.agg(*[f(c).alias(f"{n}_{c}") for c in probs for n, f in (("n", F.count), ("min", F.min), ("max", F.max))]).collect()[0]
    around = {c: (F.col(c), [f for p in ps for f in (p - slack, p + slack)]) for c, ps in probs.items()}
    sketched = near_quantiles(values, around, accuracy)
    searches: dict[str, list[_Search]] = {}
    for c, ps in probs.items():
        count = row[f"n_{c}"]
        searches[c] = []
        for i, p in enumerate(ps if count else ()):
            low, high = sketched[c][2 * i : 2 * i + 2]
            s = _Search(c, _rank(p, count), low, high, slack)
            if s.rank == 1:
                s.found = row[f"min_{c}"]
            elif s.rank == count:
                s.found = row[f"max_{c}"]
            searches[c].append(s)
    limits = {c: (row[f"min_{c}"], row[f"max_{c}"]) for c in probs}
    every = [s for each in searches.values() for s in each]
    while open_ := [s for s in every if s.found is None]:
        _place(values, limits, open_)
        _narrow(values, [s for s in open_ if s.found is None], accuracy)
    whole = {c for c, kind in values.dtypes if kind in ("tinyint", "smallint", "int", "bigint")}
    return {c: [int(s.found) if c in whole else s.found for s in each] or None for c, each in searches.items()}


def _place(values: DataFrame, limits: dict, searches: list[_Search]) -> None:
    """Find which end or inside of its bracket each rank falls on.

    Rows are counted by where they stand among all bracket ends of their column:
    position 2k is strictly between two ends, 2k+1 is on an end. A rank on an
    end is answered at once, so a value holding a large part of the rows never
    stays inside a bracket. A bracket the sketch placed wrongly is opened to the
    whole column and narrowed more carefully.
    """
    ends = {}
    for s in searches:
        ends.setdefault(s.column, set()).update((s.low, s.high))
    ends = {c: sorted(found) for c, found in ends.items()}
    positions = [
        F.struct(
            F.lit(c).alias("column"),
            reduce(add, [(F.col(c) >= e).cast("int") + (F.col(c) > e).cast("int") for e in found]).alias("position"),
        )
        for c, found in ends.items()
    ]
    counted = values.select(F.inline(F.array(*positions))).groupBy("column", "position").count()
    rows: dict[str, dict[int, int]] = {c: {} for c in ends}
    for r in counted.where(F.col("position").isNotNull()).collect():
        rows[r["column"]][r["position"]] = r["count"]
    for s in searches:
        found, held = ends[s.column], rows[s.column]
        low, high = 2 * found.index(s.low) + 1, 2 * found.index(s.high) + 1
        under = sum(n for at, n in held.items() if at < low)
        s.below = under + held.get(low, 0)
        s.between = sum(n for at, n in held.items() if low < at < high)
        upto = sum(n for at, n in held.items() if at <= high)
        if not under < s.rank <= upto:
            s.low, s.high = limits[s.column]
            s.slack, s.between = s.slack * 2, 0
        elif s.rank <= s.below:
            s.found = s.low
        elif s.rank > s.below + s.between:
            s.found = s.high


def _narrow(values: DataFrame, searches: list[_Search], accuracy: int) -> None:
    """Sketch the rows strictly between each bracket's ends."""
    asked = [s for s in searches if s.between]
    if not asked:
        return
    inside = [F.when((F.col(s.column) > s.low) & (F.col(s.column) < s.high), F.col(s.column)) for s in asked]
    rows = values.where(reduce(or_, [value.isNotNull() for value in inside]))
    few = [i for i, s in enumerate(asked) if s.between <= EXACT_ROWS]
    if few:
        ordered = [F.sort_array(F.collect_list(inside[i]))[asked[i].rank - asked[i].below - 1].alias(f"q{i}") for i in few]
        row = rows.agg(*ordered).collect()[0]
        for i in few:
            asked[i].found = row[f"q{i}"]
    many = {}
    for i, s in enumerate(asked):
        if i not in few:
            at = (s.rank - s.below) / s.between
            many[str(i)] = (inside[i], [at - s.slack, at + s.slack])
    if many:
        for i, (low, high) in near_quantiles(rows, many, accuracy).items():
            asked[int(i)].low, asked[int(i)].high = low, high

