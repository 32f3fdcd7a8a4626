"""Concentration of direct awards: suppliers, institutions, dependence.

Totals of a group are aggregated from the (group, supplier) totals and joined
back.  A window over the group would pull a hot institution into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contraluz.functions import columns as C


def _direct_mxn():
    return F.coalesce(C.direct_award("tipo_procedimiento"), F.lit(False)) & C.mxn_ok()


def direct_suppliers(contracts: DataFrame, min_direct: int = 10,
                     min_pct: float = 80.0, min_amount: float = 20e6) -> DataFrame:
    """Suppliers living off direct awards, per (supplier, key)."""
    direct = C.direct_award("tipo_procedimiento")
    totals = contracts.groupBy("proveedor", F.col("rfc_norm").alias("rfc")).agg(
        F.count("*").alias("contratos"), F.count_if(direct).alias("directas"),
        F.countDistinct("institucion").alias("instituciones"),
        C.money_sum("importe", C.mxn_ok()).alias("_all"),
        C.money_sum("importe", _direct_mxn()).alias("_direct"))
    kept = totals.where(
        (F.col("directas") >= min_direct)
        & (F.lit(100.0) * F.col("directas") / F.col("contratos") >= min_pct)
        & (F.col("_direct") >= min_amount))
    return kept.select(
        "proveedor", "rfc",
        F.coalesce(C.supplier_context("proveedor"), F.lit("")).alias("contexto"),
        "contratos", "directas",
        C.share_pct(F.col("directas"), F.col("contratos"), 1).alias("pct_directas"),
        "instituciones", C.millions(F.col("_all"), 1).alias("monto_mxn_millones"),
        C.millions(F.col("_direct"), 1).alias("monto_directas_mxn_m"))


def leaning_institutions(contracts: DataFrame, min_contracts: int = 100,
                         min_amount: float = 100e6, n: int = 40) -> DataFrame:
    """Institutions by the share of money they award directly."""
    direct = C.direct_award("tipo_procedimiento")
    totals = contracts.groupBy("institucion").agg(
        F.count("*").alias("contratos"), F.count_if(direct).alias("_n"),
        C.money_sum("importe", C.mxn_ok()).alias("_all"),
        C.money_sum("importe", _direct_mxn()).alias("_direct"))
    kept = totals.where((F.col("contratos") >= min_contracts)
                        & (F.col("_all") >= min_amount))
    table = kept.select(
        "institucion", "contratos",
        C.share_pct(F.col("_n"), F.col("contratos"), 1).alias("pct_directas_n"),
        C.millions(F.col("_all"), 1).alias("monto_mxn_millones"),
        C.share_pct(F.col("_direct"), F.col("_all"), 1)
        .alias("pct_directas_monto"))
    return table.orderBy(F.desc_nulls_last("pct_directas_monto"),
                         "institucion").limit(n)


def supplier_dependence(contracts: DataFrame, buyer: str = "institucion",
                        min_total: float = 50e6, min_awards: int = 50,
                        min_share: float = 0.5, n: int = 30) -> DataFrame:
    """Buyers whose direct spending hangs on a single supplier."""
    direct = contracts.where(C.direct_award("tipo_procedimiento")
                             & F.col(buyer).isNotNull())
    pairs = direct.groupBy(buyer, "proveedor").agg(
        C.money_sum("importe", C.mxn_ok()).alias("_paid"),
        F.count("*").alias("n_directas"))
    totals = (pairs.groupBy(buyer)
              .agg(F.sum("_paid").alias("_total"), F.sum("n_directas").alias("_n"))
              .where((F.col("_total") >= min_total) & (F.col("_n") >= min_awards)))
    kept = pairs.join(totals, buyer).where(
        F.col("_paid").cast("double") >= min_share * F.col("_total").cast("double"))
    return (kept.orderBy(F.desc("_paid"), buyer, "proveedor").limit(n)
            .select(buyer, "proveedor",
                    C.millions(F.col("_paid"), 1).alias("monto_directas_mxn_m"),
                    "n_directas",
                    C.share_pct(F.col("_paid"), F.col("_total"), 1)
                    .alias("pct_del_gasto_directo")))


def direct_award_flags(contracts: DataFrame, min_direct: int = 10,
                       min_pct: float = 0.8, min_amount: float = 20e6) -> DataFrame:
    """Date of the N-th direct award of each qualifying key.

    Only the first N awards of a key leave a map task (window group limit), so
    a key with a third of all contracts does not gather in one place.
    """
    keyed = contracts.where(F.col("rfc_norm").isNotNull())
    direct = C.direct_award("tipo_procedimiento")
    totals = keyed.groupBy("rfc_norm").agg(
        F.count("*").alias("_all"), F.count_if(direct).alias("_direct"),
        C.money_sum("importe", _direct_mxn()).alias("_paid"))
    qualified = totals.where((F.col("_direct") >= min_direct)
                             & (F.col("_direct") >= min_pct * F.col("_all"))
                             & (F.col("_paid") >= min_amount)).select("rfc_norm")
    rank = F.row_number().over(
        Window.partitionBy("rfc_norm").orderBy("fecha_efectiva"))
    nth = (keyed.where(direct & F.col("fecha_efectiva").isNotNull())
           .select("rfc_norm", "fecha_efectiva").withColumn("_rank", rank)
           .where(F.col("_rank") == min_direct))
    return nth.join(qualified, "rfc_norm", "left_semi").select(
        "rfc_norm", F.col("fecha_efectiva").alias("flag_date"))
