"""Young firms winning large contracts; age from the taxpayer key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contraluz.functions import columns as C

MAX_AGE_DAYS = 365
MIN_AMOUNT = 5e6
_CLASS_NAMES = ("ADJUDICACION DIRECTA", "INVITACION RESTRINGIDA",
                "LICITACION PUBLICA", "OTRO")


def with_age(contracts: DataFrame) -> DataFrame:
    """Legal persons with a known age at award of 0 to 36,500 days."""
    aged = contracts.where(F.col("es_persona_moral")).withColumn(
        "edad_dias", C.age_days("fecha_constitucion_rfc", "fecha_efectiva"))
    return aged.where(F.col("edad_dias").between(0, 36500))


def _young(max_days: int):
    return F.col("edad_dias") < max_days


def by_year(aged: DataFrame, max_days: int = MAX_AGE_DAYS,
            min_amount: float = MIN_AMOUNT) -> DataFrame:
    young = _young(max_days)
    large = young & (F.col("importe") >= min_amount) & C.mxn_ok()
    return aged.groupBy("file_year").agg(
        F.count("*").alias("contratos_pm"),
        F.count_if(young).alias("a_empresas_menores_1a"),
        F.count_if(large).alias("jovenes_y_grandes"),
        C.millions(C.money_sum("importe", young & C.mxn_ok()), 1)
        .alias("monto_a_menores_1a_mxn_m"))


def top_young(aged: DataFrame, n: int = 30, max_days: int = MAX_AGE_DAYS,
              min_amount: float = MIN_AMOUNT) -> DataFrame:
    rows = aged.where(_young(max_days) & (F.col("importe") >= min_amount)
                      & C.mxn_ok())
    top = rows.orderBy(F.desc("importe"), "rfc_norm", "fecha_efectiva",
                       "institucion", "codigo_contrato").limit(n)
    return top.select(
        "proveedor", F.col("rfc_norm").alias("rfc"),
        C.iso_text("fecha_constitucion_rfc").alias("constituida"),
        C.iso_text("fecha_efectiva").alias("fecha_contrato"), "edad_dias",
        "institucion", "tipo_procedimiento",
        C.amount_millions("importe", 2).alias("monto_mxn_millones"),
        "tipo_monto", "direccion_anuncio")


def age_by_class(aged: DataFrame, max_days: int = MAX_AGE_DAYS) -> DataFrame:
    """Median age per procedure class.

    The exact median keeps counts per distinct day of age, at most 36,501.
    """
    kind = C.procedure_class("tipo_procedimiento", _CLASS_NAMES)
    return aged.groupBy(kind.alias("procedimiento")).agg(
        F.count("*").alias("contratos"),
        C.round_sql(F.median("edad_dias") / 365.25, 1)
        .alias("edad_mediana_anios"),
        C.share_pct(F.count_if(_young(max_days)), F.count("*"), 2)
        .alias("pct_a_menores_1a"))


def enrichment(aged: DataFrame, efos: DataFrame,
               max_days: int = MAX_AGE_DAYS) -> DataFrame:
    """Later definitive listing of firms first seen young against old ones."""
    firms = aged.groupBy("rfc_norm").agg(F.min("edad_dias").alias("_age"))
    listed = efos.select("rfc_norm", (F.col("situacion") == "Definitivo")
                         .alias("_definitive"))
    base = firms.join(listed, "rfc_norm", "left")
    young = F.col("_age") < max_days
    shell = F.coalesce(F.col("_definitive"), F.lit(False))
    counts = base.agg(
        F.count_if(young).alias("empresas_jovenes"),
        F.count_if(~young).alias("empresas_viejas"),
        F.count_if(young & shell).alias("jovenes_definitivo"),
        F.count_if(~young & shell).alias("viejas_definitivo"))

    def rate(part: str, whole: str):
        return C.round_sql(F.try_divide(
            F.lit(10000.0) * F.col(part), F.col(whole).cast("double")), 2)

    return counts.select(
        "*", rate("jovenes_definitivo", "empresas_jovenes")
        .alias("tasa_jovenes_x10k"),
        rate("viejas_definitivo", "empresas_viejas").alias("tasa_viejas_x10k"))


def young_flags(contracts: DataFrame, max_days: int = MAX_AGE_DAYS,
                min_amount: float = MIN_AMOUNT) -> DataFrame:
    """First contract that makes a key young and large."""
    age = C.age_days("fecha_constitucion_rfc", "fecha_efectiva")
    rows = contracts.where(F.col("es_persona_moral")
                           & age.between(0, max_days - 1)
                           & (F.col("importe") >= min_amount) & C.mxn_ok())
    return rows.groupBy("rfc_norm").agg(
        F.min("fecha_efectiva").alias("flag_date"))
