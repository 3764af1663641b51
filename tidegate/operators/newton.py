"""Logistic regression by Newton steps on aggregates: one pass over the model's columns a step, none in memory."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import combinations_with_replacement
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate import schemas
from tidegate.functions.rows import usable
from tidegate.functions.scoring import LinearScorer, clipped
from tidegate.sources.shared import drop_dir, written

#: Weights of a model; a step aggregates half the square of it in sums.
MOST_WEIGHTS = 40
STEPS = 30
#: A step that moves no standardised weight by more than this is the last.
STILL = 1e-10


@dataclass(frozen=True)
class Fit:
    scorer: LinearScorer
    steps: int
    converged: bool
    log_loss: float


def fit_newton(
    rows: DataFrame,
    numeric: tuple[str, ...] = schemas.NUMERIC_FEATURES,
    categorical: tuple[str, ...] = schemas.CATEGORICAL_FEATURES,
    label: str = schemas.LABEL,
    steps: int = STEPS,
) -> Fit | None:
    """M1: the weights ``train`` looks for, unregularised, without holding rows in memory.

    A step is one aggregate of the gradient and of the weighted Gram matrix, folded in each
    task to a row of sums; the driver solves a system as large as the model. Rows without a
    label or with a NULL or NaN number are left out, as in ``train``. A NULL category has
    no weight; where there is none among the rows, the category with the fewest rows (of
    equal ones the last by name) has none either, since with an intercept one is free.
    A constant number gets no weight. Where the loss rises, the step is halved. Labels that
    can be told apart fully have no finite weights: the fit then ends unconverged after
    ``steps``. None if no rows are left; more than ``MOST_WEIGHTS`` weights are refused,
    ``train`` fits those.

    The columns asked for are written to the shared folder for the time of the fit: steps
    read them there, and whatever joins make the rows run once.
    """
    known = reduce(lambda a, b: a & b, [usable(F.col(c).cast("double")) for c in numeric], F.col(label).isNotNull())
    kept, folder = written(rows.where(known).select(*dict.fromkeys((*numeric, *categorical, label))), "newton")
    try:
        return _fit(kept, numeric, categorical, label, steps)
    finally:
        drop_dir(rows.sparkSession, folder)


def _fit(kept: DataFrame, numeric: tuple[str, ...], categorical: tuple[str, ...], label: str, steps: int) -> Fit | None:
    numbers = [F.col(c).cast("double") for c in numeric]
    first = kept.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(x).alias(f"mean{i}") for i, x in enumerate(numbers)],
        *[F.stddev_pop(x).alias(f"sd{i}") for i, x in enumerate(numbers)],
    ).first()
    if not first["n"]:
        return None
    spread = [(i, c) for i, c in enumerate(numeric) if first[f"sd{i}"] > 0]
    levels = {c: _levels(kept, c) for c in categorical}
    design: list[Column] = [F.lit(1.0)]
    design += [(numbers[i] - F.lit(first[f"mean{i}"])) / F.lit(first[f"sd{i}"]) for i, _ in spread]
    design += [F.coalesce(F.col(c) == v, F.lit(False)).cast("double") for c in categorical for v in levels[c]]
    if len(design) > MOST_WEIGHTS:
        raise ValueError(f"{len(design)} weights; fit more than {MOST_WEIGHTS} with train")

    weights, done, loss = _climb(kept, design, F.col(label).cast("double"), first["n"], steps)
    scaled = iter(weights[1:].tolist())
    own = {c: next(scaled) / first[f"sd{i}"] for i, c in spread}
    intercept = float(weights[0]) - sum(own[c] * first[f"mean{i}"] for i, c in spread)
    categories = {c: {v: next(scaled) for v in levels[c]} for c in categorical}
    scorer = LinearScorer(intercept, {c: own.get(c, 0.0) for c in numeric}, categories)
    return Fit(scorer, done, done < steps, loss)


def _levels(rows: DataFrame, column: str) -> list[str]:
    """The categories that get a weight, by name; refused beyond the bound before they are fetched."""
    counts = rows.groupBy(F.col(column).cast("string").alias("v")).count()
    found = counts.limit(MOST_WEIGHTS + 2).collect()
    if len(found) > MOST_WEIGHTS + 1:
        raise ValueError(f"{column} has more than {MOST_WEIGHTS} categories; fit it with train")
    held = {r["v"]: r["count"] for r in found}
    if None in held:
        del held[None]
    elif held:
        del held[max(held, key=lambda v: (-held[v], v))]
    return sorted(held)


def _climb(rows: DataFrame, design: list[Column], y: Column, n: int, steps: int) -> tuple[np.ndarray, int, float]:
    """Weights, steps taken and mean loss; every pass gives the loss of the weights it was asked for."""
    width = len(design)
    pairs = list(combinations_with_replacement(range(width), 2))
    named = rows.select(y.alias("y"), *[x.alias(f"x{i}") for i, x in enumerate(design)])
    at, move, best = np.zeros(width), np.zeros(width), np.inf
    for step in range(steps):
        tried = at + move
        z = reduce(add, [F.col(f"x{i}") * F.lit(float(b)) for i, b in enumerate(tried)])
        scored = named.withColumn("p", 1 / (1 + F.exp(-z))).withColumn("w", F.col("p") * (1 - F.col("p")))
        p = clipped(F.col("p"))
        sums = scored.agg(
            F.sum(-(F.col("y") * F.log(p) + (1 - F.col("y")) * F.log(1 - p))).alias("loss"),
            *[F.sum((F.col("y") - F.col("p")) * F.col(f"x{i}")).alias(f"g{i}") for i in range(width)],
            *[F.sum(F.col("w") * F.col(f"x{i}") * F.col(f"x{j}")).alias(f"h{i}_{j}") for i, j in pairs],
        ).first()
        if sums["loss"] > best * (1 + 1e-12):
            move = move / 2
            continue
        at, best = tried, sums["loss"]
        gram = np.zeros((width, width))
        for i, j in pairs:
            gram[i, j] = gram[j, i] = sums[f"h{i}_{j}"]
        move = np.linalg.lstsq(gram, np.array([sums[f"g{i}"] for i in range(width)]), rcond=None)[0]
        if np.abs(move).max() <= STILL:
            return at + move, step + 1, best / n
    return at, steps, best / n
