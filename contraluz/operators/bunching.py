"""Amounts bunched just under round thresholds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contraluz.functions import columns as C
from contraluz.functions import fixed_values as V
from contraluz.functions import stats as S


def bunching(contracts: DataFrame, cut_points: tuple[int, ...] = V.CUT_POINTS,
             width: float = 0.05, min_window: int = 30,
             q: float = 0.05) -> DataFrame:
    """One row per (institution, cut) with the local sign test.

    A single scan: each amount meets only the cuts whose window holds it, so
    most rows are dropped before the aggregate and none is copied 13 times.
    """
    amount = F.col("importe")
    cuts = F.array(*[F.struct(F.lit(t).alias("t"),
                              F.lit(t * (1 - width)).alias("low"),
                              F.lit(t * (1 + width)).alias("high"))
                     for t in cut_points])
    near = F.filter(cuts, lambda c: (amount >= c["low"]) & (amount <= c["high"]))
    rows = contracts.where(
        amount.between(min(cut_points) * (1 - width),
                       max(cut_points) * (1 + width))
        & C.mxn_ok()
        & ~F.upper("tipo_procedimiento").contains("LICITACI"))
    met = rows.select("institucion", "importe", F.explode(near).alias("_cut"))
    counted = met.groupBy("institucion", F.col("_cut.t").alias("umbral")).agg(
        F.count_if(amount < F.col("_cut.t")).alias("bajo"),
        F.count_if(amount > F.col("_cut.t")).alias("sobre"),
        F.count_if(amount == F.col("_cut.t")).alias("exacto"))
    tested = (counted.withColumn("n_ventana", F.col("bajo") + F.col("sobre"))
              .where(F.col("n_ventana") >= min_window)
              .withColumn("p_binomial",
                          S.binomial_tail_udf("bajo", "n_ventana")))
    flagged = S.flag_discoveries(tested, "p_binomial", "q_fdr05", q)
    below, above = F.col("bajo").cast("double"), F.col("sobre").cast("double")
    exact = F.col("exacto").cast("double")
    return flagged.select(
        "institucion", "umbral", "bajo", "sobre", "exacto", "n_ventana",
        C.round_sql(F.try_divide(below, above), 2).alias("razon"),
        C.round_sql(F.col("p_binomial"), 6).alias("p_binomial"), "q_fdr05",
        C.round_sql(100.0 * exact / (F.col("n_ventana") + exact), 1)
        .alias("pct_exacto"))
