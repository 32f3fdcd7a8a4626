"""Contracts of debarred suppliers, with the window test."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contraluz.functions import columns as C


def universe(sfp: DataFrame, today: dt.date | None = None) -> DataFrame:
    live = F.when(F.col("fin") >= C.day_literal(today), F.col("rfc_norm"))
    return sfp.agg(F.count("*").alias("sanciones"),
                   F.countDistinct("rfc_norm").alias("empresas"),
                   F.countDistinct(live).alias("vigentes_aprox"))


def by_year(hits: DataFrame) -> DataFrame:
    return hits.groupBy("file_year").agg(
        F.count("*").alias("contratos"),
        F.countDistinct("rfc_norm").alias("empresas"),
        C.millions(C.money_sum("importe", C.mxn_ok()), 1)
        .alias("monto_mxn_millones"))


def during(hits: DataFrame) -> DataFrame:
    return hits.where(F.col("durante_inhabilitacion") & C.mxn_ok()).select(
        "proveedor", F.col("rfc_norm").alias("rfc"),
        C.iso_text("inicio").alias("inhabilitado_desde"),
        C.iso_text("fin").alias("hasta"),
        C.iso_text("fecha_efectiva").alias("fecha_contrato"), "institucion",
        "orden_gobierno", "estado_comprador", "tipo_procedimiento", "importe",
        C.amount_millions("importe", 2).alias("monto_mxn_millones"),
        "direccion_anuncio")


def detail(hits: DataFrame) -> DataFrame:
    return hits.select(
        "file_year", "codigo_contrato", "proveedor",
        F.col("rfc_norm").alias("rfc"), "nombre_sfp",
        C.iso_text("inicio").alias("inhab_desde"),
        C.iso_text("fin").alias("inhab_hasta"),
        C.iso_text("fecha_efectiva").alias("fecha_contrato"),
        "durante_inhabilitacion", "institucion", "orden_gobierno",
        "estado_comprador", "tipo_procedimiento", "importe",
        "moneda_efectiva", "multa", "institucion_sancionadora",
        "direccion_anuncio")
