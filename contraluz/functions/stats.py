"""Statistics as Columns; exact tails as Arrow UDFs over aggregated rows."""

from __future__ import annotations

import math
import sys
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contraluz.functions import fixed_values as V
from contraluz.session import stored


def normal_quantile(confidence: float) -> float:
    """z with P(|Z| <= z) = confidence: the table, else halving on erf."""
    if confidence in V.NORMAL_QUANTILES:
        return V.NORMAL_QUANTILES[confidence]
    low, high = 0.0, 8.0
    while high - low > 1e-14:
        middle = (low + high) / 2
        if math.erf(middle / math.sqrt(2)) < confidence:
            low = middle
        else:
            high = middle
    return (low + high) / 2


def wilson(hits: Column, n: Column, confidence: float = 0.95) -> Column:
    """Wilson interval of hits/n as struct(low, high), clamped to [0, 1]."""
    z = normal_quantile(confidence)
    k, size = hits.cast("double"), n.cast("double")
    p = F.try_divide(k, size)
    scale = 1 + F.try_divide(F.lit(z * z), size)
    centre = (p + F.try_divide(F.lit(z * z), 2 * size)) / scale
    half = (z / scale) * F.sqrt(
        F.try_divide(p * (1 - p), size)
        + F.try_divide(F.lit(z * z), 4 * size * size))
    empty = n <= 0
    low = F.when(empty, 0.0).otherwise(F.greatest(F.lit(0.0), centre - half))
    high = F.when(empty, 0.0).otherwise(F.least(F.lit(1.0), centre + half))
    return F.struct(low.alias("low"), high.alias("high"))


def benford_first() -> list[float]:
    """Expected share of first digit 1..9."""
    return [math.log10(1 + 1 / d) for d in range(1, 10)]


def benford_second() -> list[float]:
    """Expected share of second digit 0..9."""
    return [math.fsum(math.log10(1 + 1 / (10 * k + d)) for k in range(1, 10))
            for d in range(10)]


def digit_z(observed: Column, n: Column, expected: float | Column) -> Column:
    """Z of a digit share with a continuity correction smaller than the gap."""
    size = n.cast("double")
    share = expected if isinstance(expected, Column) else F.lit(expected)
    gap = F.abs(F.try_divide(observed.cast("double"), size) - share)
    correction = F.try_divide(F.lit(0.5), size)
    error = F.sqrt(F.try_divide(share * (1 - share), size))
    z = F.try_divide(
        gap - F.when(correction < gap, correction).otherwise(0.0), error)
    return F.when(n <= 0, 0.0).otherwise(z)


def mean_abs_deviation(counts: list[Column], n: Column,
                       expected: list[float]) -> Column:
    gaps = [F.abs(F.try_divide(c.cast("double"), n.cast("double")) - e)
            for c, e in zip(counts, expected)]
    total = gaps[0]
    for gap in gaps[1:]:
        total = total + gap
    return F.when(n <= 0, 0.0).otherwise(total / len(expected))


def chi_square(counts: list[Column], n: Column,
               expected: list[float]) -> Column:
    total = None
    for count, share in zip(counts, expected):
        mean = n.cast("double") * share
        term = F.try_divide(F.pow(count.cast("double") - mean, F.lit(2.0)), mean)
        total = term if total is None else total + term
    return total


def chi_square_tail8(x: Column) -> Column:
    """Upper tail of chi-square with 8 degrees of freedom, in closed form."""
    half = x / 2
    series = 1 + half + half * half / 2 + half * half * half / 6
    return F.exp(-half) * series


def band(value: Column, bands: tuple[tuple[float, str], ...]) -> Column:
    result = None
    for limit, name in bands:
        result = (F.when(value <= limit, name) if result is None
                  else result.when(value <= limit, name))
    return result.otherwise(V.OUTSIDE_BANDS)


# ------------------------------------------- exact tails on aggregated rows

def _log_choose(n: int, k: int) -> float:
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)


def _falling_sum(first: float, ratio: Callable[[int], float], terms: int) -> float:
    """first + first * ratio(0) + first * ratio(0) * ratio(1) + …, while it grows."""
    total, term = first, first
    for i in range(terms):
        term *= ratio(i)
        if term <= total * 1e-18:
            break
        total += term
    return total


def binomial_half_tail(k: int, n: int) -> float:
    """P(X >= k) for n fair coin tosses.

    The shorter tail is summed by the ratio of neighbouring terms, so the work
    stays near sqrt(n) terms however large the window count is; a first term
    too small for a float ends it at once.
    """
    if k < 0 or n < 0:
        raise ValueError("negative counts")
    if k == 0:
        return 1.0
    if k > n:
        return 0.0
    if 2 * k <= n:
        return max(0.0, 1.0 - binomial_half_tail(n - k + 1, n))
    first = math.exp(_log_choose(n, k) - n * math.log(2))
    return min(1.0, _falling_sum(first, lambda i: (n - k - i) / (k + i + 1), n - k))


def fisher_right_tail(a: int, b: int, c: int, d: int) -> float:
    """P(table at least as extreme as [[a, b], [c, d]]), hypergeometric.

    Terms follow from each other by their ratio.  From the observed cell they
    are summed away from the mode, so that they fall and the sum ends early: to
    the right, or to the left for the complement.
    """
    if min(a, b, c, d) < 0:
        raise ValueError("negative counts")
    n, row, column = a + b + c + d, a + b, a + c
    if n == 0:
        return 1.0
    top, bottom, rest = min(row, column), max(0, column + row - n), n - row - column

    def first(x: int) -> float:
        return math.exp(_log_choose(row, x) + _log_choose(n - row, column - x)
                        - _log_choose(n, column))

    if a * n >= row * column:
        return min(1.0, _falling_sum(
            first(a), lambda i: (row - a - i) * (column - a - i) / (
                (a + i + 1) * (rest + a + i + 1)), top - a))
    if a <= bottom:
        return 1.0
    x = a - 1
    left = _falling_sum(first(x), lambda i: (x - i) * (rest + x - i) / (
        (row - x + i + 1) * (column - x + i + 1)), x - bottom)
    return max(0.0, 1.0 - left)


@F.pandas_udf(T.DoubleType())
def binomial_tail_udf(k: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([binomial_half_tail(int(x), int(y)) for x, y in zip(k, n)],
                     dtype="float64")


@F.pandas_udf(T.DoubleType())
def fisher_tail_udf(a: pd.Series, b: pd.Series, c: pd.Series,
                    d: pd.Series) -> pd.Series:
    return pd.Series([fisher_right_tail(int(w), int(x), int(y), int(z))
                      for w, x, y, z in zip(a, b, c, d)], dtype="float64")


# ---------------------------------------------------- false discovery control

def flag_discoveries(tests: DataFrame, p: str, flag: str,
                     q: float = 0.05) -> DataFrame:
    """Benjamini-Hochberg flag at rate q without sorting all tests in one task.

    The tests are stored first: they are few aggregated rows, and all branches
    below would otherwise repeat the scan behind them.
    The rank of a p-value is the count of tests with a p no larger.  Distinct
    p-values are counted first, then grouped by order of magnitude; only the
    magnitude table (at most about 33,000 rows, as doubles end near 1e-308) is
    summed up in order, and ranks inside a magnitude are local to it.
    """
    tests = stored(tests)
    value = F.col(p)
    magnitude = (F.when(value.isNull(), F.lit(None))
                 .when(value <= 0, F.lit(-40_000))
                 .otherwise(F.floor(F.log10(value) * 100).cast("int")))
    distinct = (tests.where(value.isNotNull()).groupBy(value.alias("_p"))
                .agg(F.count("*").alias("_n"), F.first(magnitude).alias("_m")))
    in_order = Window.orderBy("_m")
    levels = (distinct.groupBy("_m").agg(F.sum("_n").alias("_level"))
              .select("_m",
                      (F.sum("_level").over(in_order) - F.col("_level"))
                      .alias("_before"),
                      F.sum("_level").over(
                          Window.partitionBy(F.lit(1))).alias("_all")))
    inside = Window.partitionBy("_m").orderBy("_p")
    ranked = (distinct.withColumn("_inside", F.sum("_n").over(inside))
              .join(levels, "_m")
              .withColumn("_rank", F.col("_before") + F.col("_inside")))
    cut = (ranked.where(F.col("_p") <= q * F.col("_rank") / F.col("_all"))
           .agg(F.max("_p").alias("cut")))
    return tests.withColumn(
        flag, F.coalesce(value <= cut.scalar(), F.lit(False)))


# tasks receive the helpers themselves, so workers need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
