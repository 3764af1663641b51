"""Population Stability Index expressions."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate.config import (
    PSI_BINS,
    PSI_DECIMALS,
    PSI_EMPTY_BIN_SHARE,
    PSI_HALT_AT,
    PSI_NONE_BELOW,
)

DECILES = tuple(i / PSI_BINS for i in range(PSI_BINS + 1))


def bin_of(value: Column, edges: list[float] | None) -> Column:
    """Decile bin 0..9 from the 11 baseline edges, outer bins open-ended.

    Counting the inner edges at or below the value equals the range join for any
    nondecreasing edges, ties included, and needs no join. Without a baseline
    (no edges) no value has a bin.
    """
    if edges is None:
        return F.lit(None).cast("int")
    return reduce(add, [(value >= F.lit(float(e))).cast("int") for e in edges[1:-1]])


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def share(count: Column, total: Column) -> Column:
    """Share of rows in a bin; the floor replaces empty bins only."""
    return F.coalesce(F.nullif(count, F.lit(0)) / F.nullif(total, F.lit(0)), F.lit(PSI_EMPTY_BIN_SHARE))


def psi_term(actual: Column, expected: Column) -> Column:
    return (actual - expected) * F.log(actual / expected)


def psi(actual: list[Column], total_actual: Column, expected: list[Column], total_expected: Column) -> Column:
    """A5 over bin counts laid out as columns."""
    terms = [
        psi_term(share(a, total_actual), share(e, total_expected))
        for a, e in zip(actual, expected, strict=True)
    ]
    return F.round(reduce(add, terms), PSI_DECIMALS)


def drift_band(value: Column) -> Column:
    """G3."""
    return (
        F.when(value < PSI_NONE_BELOW, "none")
        .when(value <= PSI_HALT_AT, "moderate")
        .otherwise("significant")
    )
