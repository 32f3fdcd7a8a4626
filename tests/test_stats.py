import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contraluz.functions import stats as S


def test_wilson(spark):
    row = spark.sql("SELECT 1L AS k, 10L AS n").select(
        S.wilson(F.col("k"), F.col("n")).alias("w"),
        S.wilson(F.lit(0), F.lit(0)).alias("e")).first()
    assert row["w"]["low"] == pytest.approx(0.0179, abs=1e-4)
    assert row["w"]["high"] == pytest.approx(0.4042, abs=1e-3)
    assert tuple(row["e"]) == (0.0, 0.0)
    assert S.normal_quantile(0.8) == pytest.approx(1.2815515655, abs=1e-8)


def test_fisher_and_binomial():
    assert S.fisher_right_tail(3, 1, 1, 3) == pytest.approx(0.2429, abs=1e-4)
    assert S.fisher_right_tail(5, 5, 5, 5) == pytest.approx(0.6718, abs=1e-4)
    assert S.fisher_right_tail(0, 0, 0, 0) == 1.0
    assert S.binomial_half_tail(6, 10) == pytest.approx(0.376953125)
    assert S.binomial_half_tail(8, 10) == pytest.approx(0.0546875)
    assert S.binomial_half_tail(0, 5) == 1.0 and S.binomial_half_tail(6, 5) == 0.0
    for wrong in ((-1, 5), (1, -5)):
        with pytest.raises(ValueError):
            S.binomial_half_tail(*wrong)
    with pytest.raises(ValueError):
        S.fisher_right_tail(-1, 1, 1, 1)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 300), st.integers(0, 300))
def test_binomial_matches_exact_counts(n, k):
    exact = sum(math.comb(n, i) for i in range(k, n + 1)) / 2 ** n
    assert S.binomial_half_tail(k, n) == pytest.approx(min(1.0, exact), rel=1e-9)


def test_chi_square_tail(values):
    found = values(S.chi_square_tail8(F.col("x")), 15.507, 20.090, kind="double")
    assert found == [pytest.approx(0.05, abs=1e-3), pytest.approx(0.01, abs=1e-3)]
    assert math.fsum(S.benford_first()) == pytest.approx(1)
    assert math.fsum(S.benford_second()) == pytest.approx(1)


def plain_discoveries(ps, q):
    ordered = sorted(ps)
    passing = [p for i, p in enumerate(ordered, 1) if p <= q * i / len(ps)]
    return [bool(passing) and p <= max(passing) for p in ps]


@pytest.mark.parametrize("seed", range(3))
def test_discoveries_match_a_plain_sort(spark, seed):
    rng = random.Random(seed)
    ps = [rng.choice([0.0, rng.random(), rng.random() ** 6, 0.01, 1e-300])
          for _ in range(200)]
    rows = spark.createDataFrame(list(enumerate(ps)), "i int, p double")
    found = {r["i"]: r["f"] for r in
             S.flag_discoveries(rows, "p", "f", 0.05).collect()}
    assert [found[i] for i in range(len(ps))] == plain_discoveries(ps, 0.05)


def test_discoveries_small_and_empty(spark):
    rows = spark.createDataFrame(
        list(enumerate([.7, .001, .8, .01, .5])), "i int, p double")
    found = S.flag_discoveries(rows, "p", "f").orderBy("i").collect()
    assert [r["f"] for r in found] == [False, True, False, True, False]
    assert S.flag_discoveries(rows.where("i < 0"), "p", "f").count() == 0


def test_tails_of_huge_counts_end_early():
    import time
    start = time.perf_counter()
    assert S.binomial_half_tail(10**9, 10**9) == 0.0
    assert S.binomial_half_tail(6 * 10**8, 10**9) == 0.0
    high, low = (S.binomial_half_tail(k, 10**9) for k in (500020000, 499980001))
    assert abs(high + low - 1) < 1e-9 and 0.10 < high < 0.11
    assert 0.49 < S.fisher_right_tail(10**6, 10**9, 10**6, 10**9) < 0.51
    assert time.perf_counter() - start < 1
