"""Sanction lists: the tax-fraud list and the debarment directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contraluz.functions import columns as C
from contraluz.functions import fixed_values as V
from contraluz.operators.matching import latest_per_key
from contraluz.sources.contracts import read_positional

_SFP_SCHEMA = """
    rfc string, nombre_razon_social string, multa string,
    leyes_infringidas string, institucion_dependencia string,
    plazo struct<fecha_inicial: string, fecha_final: string,
                 fecha_fin: string, plazo_inha: string>
"""


def read_efos(spark: SparkSession, path: str) -> DataFrame:
    """The list file; its preamble and header rows carry no full key."""
    raw = read_positional(spark, path, V.EFOS_COLUMNS, header=False)
    return canonical_efos(raw)


def canonical_efos(raw: DataFrame) -> DataFrame:
    """One row per key, the latest definitive date first."""
    typed = raw.where(F.length(F.trim("rfc")) >= 12).select(
        C.rfc_norm("rfc").alias("rfc_norm"), "nombre", "situacion",
        F.coalesce(C.parse_day("pub_dof_definitivos", iso=False),
                   C.parse_day("pub_sat_definitivos", iso=False))
        .alias("fecha_definitivo"),
        F.coalesce(C.parse_day("pub_dof_presuntos", iso=False),
                   C.parse_day("pub_sat_presuntos", iso=False))
        .alias("fecha_presunto"))
    return latest_per_key(
        typed, ["rfc_norm"],
        [F.col("fecha_definitivo").desc_nulls_last(),
         F.col("fecha_presunto").desc_nulls_last(), F.col("situacion"),
         F.col("nombre")])


def read_sfp(spark: SparkSession, path: str) -> DataFrame:
    """The directory as a JSON array; the fine stays JSON text as published."""
    raw = spark.read.schema(_SFP_SCHEMA).option("multiLine", True).json(path)
    return canonical_sfp(raw)


def canonical_sfp(raw: DataFrame) -> DataFrame:
    """Every debarment record of a key; an open or fine-only record has no end."""
    rfc = F.upper(F.trim(F.coalesce("rfc", F.lit(""))))

    def day(*fields: str):
        text = F.coalesce(*[F.nullif(F.col(f), F.lit("")) for f in fields])
        return F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")

    return raw.select(
        rfc.alias("rfc_norm"),
        F.trim(F.coalesce("nombre_razon_social", F.lit(""))).alias("nombre"),
        "multa", F.col("institucion_dependencia")
        .alias("institucion_sancionadora"),
        F.col("plazo.plazo_inha").alias("plazo_txt"),
        day("plazo.fecha_inicial").alias("inicio"),
        day("plazo.fecha_final", "plazo.fecha_fin").alias("fin"),
    ).where(F.length("rfc_norm") >= 12)
