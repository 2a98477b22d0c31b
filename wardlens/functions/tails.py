"""Tail probabilities.  Spark has no error function, so the few result rows of a test
go through a vectorised helper; nothing here ever sees data rows."""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


# ship these helpers to the workers themselves, so the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def doubled_upper_tail(z: float) -> float:
    """Twice the tail above z; 1 where a continuity correction has made z negative."""
    return min(1.0, math.erfc(z / math.sqrt(2.0)))


def chi_square_tail(x: float, df: int) -> float:
    """P(X > x) for a whole number of degrees of freedom, by the finite series."""
    if x <= 0:
        return 1.0
    half = x / 2.0
    if df % 2 == 0:
        term, total = math.exp(-half), math.exp(-half)
        for k in range(1, df // 2):
            term *= half / k
            total += term
        return total
    total = math.erfc(math.sqrt(half))
    term = math.exp(-half) * math.sqrt(half) / math.gamma(1.5)
    for k in range(1, (df - 1) // 2 + 1):
        total += term
        term *= half / (k + 0.5)
    return total


@F.pandas_udf(DoubleType())
def doubled_upper_tail_p(z: pd.Series) -> pd.Series:
    return z.map(doubled_upper_tail, na_action="ignore")


EXACT_SMALLER, EXACT_LARGER = 8, 5000  # sizes up to which the rank test's p is exact


def rank_sum_tail(u: float, n: int, m: int) -> float:
    """P(U >= u) for samples of n and m values without ties.

    The number of orders with each U are the coefficients of the product over i of
    (1 - q^(larger + i)) / (1 - q^i); each factor is a recurrence over the coefficients.
    """
    small, large = sorted((n, m))
    counts = [1] + [0] * (small * large)
    for i in range(1, small + 1):
        for at in range(len(counts) - 1, large + i - 1, -1):
            counts[at] -= counts[at - large - i]
        for at in range(i, len(counts)):
            counts[at] += counts[at - i]
    return sum(counts[max(0, math.ceil(u)) :]) / math.comb(n + m, n)


def rank_test_p(u: float, n: int, m: int, z: float | None, tied: int) -> float | None:
    """Two-sided p of the rank test: exact for small samples without ties, else from z."""
    if min(n, m) == 0:
        return None
    if not tied and min(n, m) <= EXACT_SMALLER and max(n, m) <= EXACT_LARGER:
        return min(1.0, 2 * rank_sum_tail(max(u, n * m - u), n, m))
    return 1.0 if z is None or math.isnan(z) else doubled_upper_tail(z)


@F.pandas_udf(DoubleType())
def two_sided_rank_p(u: pd.Series, n: pd.Series, m: pd.Series, z: pd.Series, tied: pd.Series) -> pd.Series:
    return pd.Series([rank_test_p(a, int(b), int(c), d, int(e)) for a, b, c, d, e in zip(u, n, m, z, tied)], dtype="float64")


@F.pandas_udf(DoubleType())
def chi_square_p(x: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([chi_square_tail(a, int(b)) for a, b in zip(x, df)], dtype="float64")


def stars(p: Column) -> Column:
    return F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise("")
