"""Contracts of firms on the tax-fraud list: by key and, for the archive, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contraluz.functions import columns as C
from contraluz.operators import matching as M


def sanity(contracts: DataFrame) -> DataFrame:
    return contracts.groupBy("file_year").agg(
        F.count("*").alias("contratos"), F.count("rfc_norm").alias("con_rfc"),
        F.count("fecha_efectiva").alias("con_fecha"),
        F.count("importe").alias("con_importe"))


def _volume(amount: str = "importe"):
    return [F.count("*").alias("contratos"),
            F.countDistinct("rfc_norm").alias("empresas"),
            C.millions(C.money_sum(amount, C.mxn_ok()), 1)
            .alias("monto_mxn_millones")]


def by_status_year(hits: DataFrame) -> DataFrame:
    return hits.groupBy("situacion", "file_year").agg(*_volume())


def after_definitive(hits: DataFrame) -> DataFrame:
    return (hits.where("situacion = 'Definitivo' AND firmado_despues_definitivo")
            .groupBy("file_year").agg(*_volume()))


def top_definitive(hits: DataFrame, n: int = 25) -> DataFrame:
    rows = hits.where((F.col("situacion") == "Definitivo")
                      & F.col("importe").isNotNull() & C.mxn_ok())
    top = rows.orderBy(F.desc("importe"), "rfc_norm", "fecha_efectiva",
                       "institucion", "codigo_contrato").limit(n)
    return top.select(
        "proveedor", F.col("rfc_norm").alias("rfc"), "situacion",
        C.iso_text("fecha_definitivo").alias("definitivo_dof"),
        C.iso_text("fecha_efectiva").alias("fecha_contrato"),
        F.col("firmado_despues_definitivo").alias("post_definitivo"),
        "institucion", "tipo_procedimiento",
        C.amount_millions("importe", 2).alias("monto_mxn_millones"),
        "moneda_efectiva")


def by_procedure(hits: DataFrame) -> DataFrame:
    return (hits.where("situacion = 'Definitivo'").groupBy("tipo_procedimiento")
            .agg(F.count("*").alias("contratos"),
                 C.millions(C.money_sum("importe", C.mxn_ok()), 1)
                 .alias("monto_mxn_millones")))


def detail(hits: DataFrame) -> DataFrame:
    return hits.where(F.col("situacion").isin("Definitivo", "Presunto")).select(
        "file_year", "codigo_contrato", "num_contrato", "titulo_contrato",
        "proveedor", F.col("rfc_norm").alias("rfc"), "situacion",
        C.iso_text("fecha_definitivo").alias("definitivo_dof"),
        C.iso_text("fecha_efectiva").alias("fecha_contrato"),
        "firmado_despues_definitivo", "institucion", "nombre_uc",
        "orden_gobierno", "estado_comprador", "tipo_procedimiento", "importe",
        "moneda_efectiva", "direccion_anuncio")


# ------------------------------------------------------------ archive by name

def archive_contracts(archive: DataFrame, keep_null_codes: bool = False) -> DataFrame:
    """One archive row per contract code, the highest amount.

    Rows without a code count as one contract unless `keep_null_codes` is set.
    """
    order = [F.col("importe_num").desc_nulls_last(), F.col("fecha"),
             F.col("proveedor"), F.col("codigo_expediente")]
    if not keep_null_codes:
        return M.latest_per_key(archive, ["codigo_contrato"], order)
    coded = archive.where(F.col("codigo_contrato").isNotNull())
    bare = archive.where(F.col("codigo_contrato").isNull())
    return M.latest_per_key(coded, ["codigo_contrato"], order).unionByName(bare)


def archive_hits(archive: DataFrame, efos: DataFrame) -> DataFrame:
    listed = M.fraud_latest_by_name(efos).select(
        "nombre_norm", "situacion", "fecha_definitivo",
        F.col("rfc_norm").alias("rfc_69b"), F.col("nombre").alias("nombre_69b"))
    keyed = M.keyed_by_name(archive, "proveedor")
    return keyed.join(listed, "nombre_norm").withColumn(
        "iniciado_despues_definitivo", C.after("fecha", "fecha_definitivo"))


def _archive_volume():
    pesos = F.col("moneda") == "MXN"
    return [F.count("*").alias("contratos"),
            F.countDistinct("nombre_norm").alias("empresas"),
            C.millions(C.money_sum("importe_num", pesos), 1)
            .alias("monto_mxn_millones")]


def archive_universe(archive: DataFrame) -> DataFrame:
    total = C.money_sum("importe_num", F.col("moneda") == "MXN")
    return archive.agg(
        F.count("*").alias("contratos"), F.min("fecha").alias("desde"),
        F.max("fecha").alias("hasta"),
        C.round_sql(C.millions(total, 6) / 1e3, 1).alias("total_mxn_mmd"))


def archive_by_status(hits: DataFrame) -> DataFrame:
    return hits.groupBy("situacion").agg(*_archive_volume())


_STARTED_AFTER = "situacion = 'Definitivo' AND iniciado_despues_definitivo"


def archive_after_by_year(hits: DataFrame) -> DataFrame:
    return (hits.where(_STARTED_AFTER).groupBy(F.year("fecha").alias("anio"))
            .agg(*_archive_volume()))


def archive_top(hits: DataFrame, n: int = 25) -> DataFrame:
    top = (hits.where(_STARTED_AFTER + " AND moneda = 'MXN'")
           .orderBy(F.desc_nulls_last("importe_num"), "codigo_contrato").limit(n))
    return top.select(
        "proveedor", "rfc_69b",
        C.iso_text("fecha_definitivo").alias("definitivo_dof"),
        C.iso_text("fecha").alias("inicio_contrato"), "titulo_contrato",
        C.amount_millions("importe_num", 2).alias("monto_mxn_millones"),
        "codigo_contrato")


def archive_detail(hits: DataFrame) -> DataFrame:
    return hits.where(F.col("situacion").isin("Definitivo", "Presunto")).select(
        F.lit("name_match").alias("match_method"), "proveedor", "nombre_69b",
        "rfc_69b", "situacion",
        C.iso_text("fecha_definitivo").alias("definitivo_dof"),
        C.iso_text("fecha").alias("inicio_contrato"),
        "iniciado_despues_definitivo", "titulo_contrato",
        "descripcion_contrato", "importe_num", "moneda", "codigo_contrato",
        "codigo_expediente")
