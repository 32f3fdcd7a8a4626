"""Contracts that grew past the legal cap by modification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contraluz.functions import columns as C
from contraluz.functions import fixed_values as V


def over_cap(contracts: DataFrame, cap_acquisitions: float = V.CAP_ACQUISITIONS,
             cap_works: float = V.CAP_WORKS) -> DataFrame:
    """Strictly above cap plus margin; a narrow filter without any shuffle."""
    before, last = F.col("monto_original"), F.col("monto_ultimo_convenio")
    cap = C.legal_cap("ley", cap_acquisitions, cap_works)
    rows = contracts.where(C.mxn_ok() & (before > 0) & (
        last > before * (1 + cap + V.CAP_MARGIN)))
    return rows.select(
        "file_year", "institucion", "nombre_uc", "proveedor",
        F.col("rfc_norm").alias("rfc"), "codigo_contrato", "num_contrato",
        "titulo_contrato", "ley", "tipo_procedimiento", "monto_original",
        "monto_ultimo_convenio",
        C.round_sql(100.0 * (last - before) / before, 1).alias("pct_incremento"),
        C.round_sql(100.0 * cap, 1).alias("tope_legal_pct"),
        C.iso_text("fecha_efectiva").alias("fecha_contrato"),
        "fecha_firma_ultimo_conv", "direccion_anuncio")


def total_increase(table: DataFrame) -> DataFrame:
    return table.agg(
        F.count("*").alias("contratos"),
        C.millions(F.sum(C.money(F.col("monto_ultimo_convenio"))
                         - C.money(F.col("monto_original"))), 1)
        .alias("incremento_mxn_millones"))


def largest(table: DataFrame, n: int = 10) -> DataFrame:
    return table.orderBy(F.desc_nulls_last("monto_ultimo_convenio"),
                         "codigo_contrato", "rfc").limit(n)


def flags(table: DataFrame) -> DataFrame:
    return table.groupBy(F.col("rfc").alias("rfc_norm")).agg(
        F.min(F.to_date("fecha_contrato")).alias("flag_date"))
