"""Leakage-free backtest: do flagged firms get sanctioned later?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contraluz.functions import columns as C
from contraluz.functions import fixed_values as V
from contraluz.functions import stats as S

ALL_SIGNALS = (*sorted(V.SIGNAL_LABELS), V.COMPOSITE_SIGNAL)


def sanction_dates(efos: DataFrame, sfp: DataFrame | None = None) -> DataFrame:
    """Earliest sanction per key over both lists."""
    dates = efos.select("rfc_norm", F.least("fecha_presunto", "fecha_definitivo")
                        .alias("_day"))
    if sfp is not None:
        dates = dates.unionByName(sfp.select("rfc_norm", F.col("inicio").alias("_day")))
    return (dates.where(F.col("_day").isNotNull() & F.col("rfc_norm").isNotNull())
            .groupBy("rfc_norm").agg(F.min("_day").alias("fecha_sancion")))


def supplier_universe(contracts: DataFrame) -> DataFrame:
    """Legal persons that won anything, anchored at their first contract."""
    rows = contracts.where(F.col("es_persona_moral")
                           & F.col("fecha_efectiva").isNotNull())
    return rows.groupBy("rfc_norm").agg(F.min("fecha_efectiva").alias("t0"))


def evaluate(flags: DataFrame, universe: DataFrame, sanctions: DataFrame,
             signals: Sequence[str] = ALL_SIGNALS) -> DataFrame:
    """One row per signal, all signals in one job.

    A sanction counts only strictly after the flag.  The base of a signal is
    the universe without its flagged keys: the flagged keys' own universe rows
    (anchored at the first contract) are taken out of the universe totals, so
    no anti join per signal is needed and the groups stay disjoint by key.
    """
    anchored = universe.join(sanctions, "rfc_norm", "left").select(
        "rfc_norm", C.after("fecha_sancion", "t0").alias("_base_hit"))
    firsts = flags.groupBy("senal", "rfc_norm").agg(
        F.min("flag_date").alias("flag_date"))
    judged = firsts.join(sanctions, "rfc_norm", "left").join(
        anchored, "rfc_norm", "left")
    hit = C.after("fecha_sancion", "flag_date")
    counted = judged.groupBy("senal").agg(
        F.count("*").alias("_n"), F.count_if(hit).alias("_hits"),
        F.count_if(F.col("_base_hit").isNotNull()).alias("_in"),
        F.count_if("_base_hit").alias("_in_hits"),
        F.median(F.when(hit, F.date_diff("fecha_sancion", "flag_date")))
        .alias("_days"))
    names = flags.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(s) for s in signals])).alias("senal"))
    totals = anchored.agg(F.struct(
        F.count("*").alias("n"), F.count_if("_base_hit").alias("hits"))
        .alias("t"))
    filled = names.join(counted, "senal", "left").withColumn("_t", totals.scalar())

    def zero(name: str):
        return F.coalesce(name, F.lit(0))

    table = filled.select(
        "senal", zero("_n").alias("n"), zero("_hits").alias("k"),
        (F.col("_t.n") - zero("_in")).alias("base_n"),
        (F.col("_t.hits") - zero("_in_hits")).alias("base_k"),
        F.floor("_days").cast("int").alias("mediana_dias_a_sancion"))
    n, k, bn, bk = (F.col(c) for c in ("n", "k", "base_n", "base_k"))
    flag_rate, base_rate = F.try_divide(k, n), F.try_divide(bk, bn)
    flag_band, base_band = S.wilson(k, n), S.wilson(bk, bn)
    low = F.try_divide(flag_band["low"], base_band["high"])
    high = F.try_divide(flag_band["high"], base_band["low"])
    some = n > 0
    compared = some & (bk > 0)
    return table.select(
        "senal", n.alias("empresas_flag"), k.alias("sancionadas_despues"),
        C.round_sql(1e4 * flag_rate, 1).alias("tasa_flag_x10k"),
        F.when(some, F.format_string("%.0f–%.0f", 1e4 * flag_band["low"],
                                     1e4 * flag_band["high"]))
        .alias("tasa_flag_ic95"),
        bn.alias("base_empresas"), bk.alias("base_sancionadas"),
        C.round_sql(1e4 * base_rate, 1).alias("tasa_base_x10k"),
        F.when(compared, C.round_sql(F.try_divide(flag_rate, base_rate), 1))
        .alias("lift"),
        F.when(compared & low.isNotNull() & high.isNotNull(),
               F.format_string("%.1f–%.1f", low, high)).alias("lift_ic95"),
        F.when(some, C.round_sql(
            S.fisher_tail_udf(k, n - k, bk, bn - bk), 4)).alias("p_fisher"),
        "mediana_dias_a_sancion")
