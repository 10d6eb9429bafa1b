"""Test statistics and tail probabilities as column arithmetic."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F


# Terms of the series and depth of the fraction, enough for 15 digits on either side of the change.
SERIES, DEPTH, CHANGE = 80, 60, 2.5


def _erfc(x: Column) -> Column:
    """Complementary error function of ``x >= 0``.

    Up to ``CHANGE``, 1 less the series of the error function, whose terms are all positive; beyond, the
    continued fraction x + (1/2) / (x + 1 / (x + (3/2) / (x + ..))) from its far end.
    """
    x = x.cast("double")
    front = F.exp(-x * x) / math.sqrt(math.pi)
    terms = F.aggregate(
        F.sequence(F.lit(1), F.lit(SERIES)),
        F.struct(x.alias("term"), x.alias("total")),
        lambda state, k: F.struct(
            (state["term"] * 2 * x * x / (2 * k + 1)).alias("term"),
            (state["total"] + state["term"] * 2 * x * x / (2 * k + 1)).alias("total"),
        ),
        lambda state: state["total"],
    )
    fraction = F.aggregate(F.sequence(F.lit(DEPTH), F.lit(1), F.lit(-1)), x, lambda below, k: x + k / 2 / below)
    return F.when(x <= CHANGE, 1 - 2 * front * terms).otherwise(front / fraction)


def normal_two_sided(z: Column) -> Column:
    """Probability of a standard normal value at least as far from zero as ``z``."""
    return _erfc(F.abs(z) / math.sqrt(2))


def chi2_one_degree(statistic: Column) -> Column:
    """Upper tail of the chi-squared distribution with one degree of freedom."""
    return _erfc(F.sqrt(statistic / 2))


def normal_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


def _cells(a: Column, b: Column, c: Column, d: Column) -> list[tuple[Column, Column]]:
    """Continuity-corrected and expected counts of the table ``[[a, b], [c, d]]``."""
    a, b, c, d = (x.cast("double") for x in (a, b, c, d))
    n = a + b + c + d
    cells = []
    for observed, row, column in ((a, a + b, a + c), (b, a + b, b + d), (c, c + d, a + c), (d, c + d, b + d)):
        expected = row * column / n
        off = expected - observed
        corrected = observed + F.least(F.lit(0.5), F.abs(off)) * F.signum(off)
        cells.append((corrected, expected))
    return cells


def chi2_statistic(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Pearson's statistic of a 2x2 table with Yates' correction."""
    total = F.lit(0.0)
    for observed, expected in _cells(a, b, c, d):
        total = total + (observed - expected) * (observed - expected) / expected
    return total


def g_statistic(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Log-likelihood statistic of a 2x2 table with Yates' correction."""
    total = F.lit(0.0)
    for observed, expected in _cells(a, b, c, d):
        term = F.when(observed == 0, F.lit(0.0)).otherwise(observed * F.ln(observed / expected))
        total = total + term
    return total * 2
