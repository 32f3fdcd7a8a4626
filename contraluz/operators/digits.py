"""Digit-law conformity of amounts per group, federal and state alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contraluz.functions import columns as C
from contraluz.functions import fixed_values as V
from contraluz.functions import stats as S

MIN_AMOUNT = 100


def digit_profile(df: DataFrame, group: str, where: Column | None = None,
                  min_n: int = 300) -> DataFrame:
    """Counts of first digits 1-9 and second digits 0-9 for each large group.

    Digits are taken once per row and counted per (group, digit, digit) in the
    map tasks, so at most 100 rows per group and task are shuffled.
    """
    rows = df.where((F.col("importe") >= MIN_AMOUNT) & F.col(group).isNotNull())
    if where is not None:
        rows = rows.where(where)
    cells = (rows.select(group, C.first_digit("importe").alias("_d1"),
                         C.second_digit("importe").alias("_d2"))
             .groupBy(group, "_d1", "_d2").agg(F.count("*").alias("_n")))

    def counts(digit: str, values: range) -> Column:
        return F.array(*[
            F.coalesce(F.sum(F.when(F.col(digit) == v, F.col("_n"))), F.lit(0))
            for v in values])

    return (cells.groupBy(group)
            .agg(F.sum("_n").alias("n_contratos"),
                 counts("_d1", range(1, 10)).alias("digitos_1"),
                 counts("_d2", range(10)).alias("digitos_2"))
            .where(F.col("n_contratos") >= min_n))


def conformity(profile: DataFrame, group: str, q: float = 0.05) -> DataFrame:
    n = F.col("n_contratos")
    first = [F.get("digitos_1", F.lit(i)) for i in range(9)]
    second = [F.get("digitos_2", F.lit(i)) for i in range(10)]
    measured = profile.select(
        group, "n_contratos",
        S.mean_abs_deviation(first, n, S.benford_first()).alias("_mad1"),
        S.mean_abs_deviation(second, n, S.benford_second()).alias("_mad2"),
        S.chi_square(first, n, S.benford_first()).alias("_chi2"))
    table = measured.select(
        group, "n_contratos",
        C.round_sql(F.col("_mad1"), 4).alias("mad"),
        S.band(F.col("_mad1"), V.FIRST_DIGIT_BANDS).alias("banda_nigrini"),
        C.round_sql(F.col("_mad2"), 4).alias("mad_segundo_digito"),
        S.band(F.col("_mad2"), V.SECOND_DIGIT_BANDS)
        .alias("banda_segundo_digito"),
        C.round_sql(F.col("_chi2"), 1).alias("chi2"),
        S.chi_square_tail8(F.col("_chi2")).alias("p_value"))
    return S.flag_discoveries(table, "p_value", "no_conforme_fdr05", q)


def worst_group_digits(profile: DataFrame, group: str) -> DataFrame:
    """Digit table of the group with the largest first-digit deviation."""
    n = F.col("n_contratos")
    first = [F.get("digitos_1", F.lit(i)) for i in range(9)]
    mad = C.round_sql(S.mean_abs_deviation(first, n, S.benford_first()), 4)
    worst = (profile.withColumn("_mad", mad)
             .orderBy(F.desc("_mad"), group).limit(1))
    expected = F.array(*[F.lit(p) for p in S.benford_first()])
    digits = worst.select("n_contratos", F.posexplode("digitos_1").alias(
        "_i", "observado")).withColumn("_p", F.get(expected, F.col("_i")))
    z = S.digit_z(F.col("observado"), n, F.col("_p"))
    return digits.select(
        (F.col("_i") + 1).alias("digito"), "observado",
        C.share_pct(F.col("observado"), n, 1).alias("pct_observado"),
        C.round_sql(F.col("_p") * 100, 1).alias("pct_benford"),
        C.round_sql(z, 2).alias("z_nigrini"), (z > 1.96).alias("anomalo"))
