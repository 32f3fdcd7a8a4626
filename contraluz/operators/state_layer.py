"""Screens of the state layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contraluz.functions import columns as C
from contraluz.operators import ages, collusion
from contraluz.operators import matching as M
from contraluz.session import stored

BUYER = ["estado_comprador", "sujeto_obligado"]


def dedupe(typed: DataFrame) -> DataFrame:
    """One row per contract re-reported by quarter or in a mirror format.

    Identity is the contract number, else the file number, else a hash of the
    description, so contracts without any number stay apart.  It comes first among
    the keys, as rows are sorted by them and the others have few values.
    """
    identity = F.coalesce("num_contrato", "expediente", F.md5(F.concat_ws(
        "|", F.coalesce("descripcion", F.lit("")),
        F.coalesce("objeto", F.lit("")))))
    keys = [identity, "importe", "rfc_norm", "fecha_efectiva", "id_sujeto",
            "id_entidad", "ejercicio"]
    order = [F.col("fecha_actualizacion").desc_nulls_last(),
             F.col("formato").desc_nulls_last(), F.col("direccion_anuncio"),
             F.col("proveedor")]
    return M.latest_per_key(typed, keys, order)


def coverage(state: DataFrame) -> DataFrame:
    return state.groupBy("estado_comprador", "ejercicio").agg(
        F.count("*").alias("contratos"),
        C.share_pct(F.count_if("rfc_valido"), F.count("*"), 1)
        .alias("pct_rfc_valido"),
        C.share_pct(F.count("fecha_efectiva"), F.count("*"), 1)
        .alias("pct_con_fecha"),
        C.millions(C.money_sum("importe", C.plausible_amount()), 1)
        .alias("monto_mxn_millones"),
        F.countDistinct("id_sujeto").alias("sujetos_obligados"))


def fraud_by_rfc(state: DataFrame, efos: DataFrame) -> DataFrame:
    hits = M.fraud_hits(state.where("rfc_valido"), efos.where(
        F.col("situacion").isin("Definitivo", "Presunto")))
    return hits.select(
        *BUYER, "proveedor", F.col("rfc_norm").alias("rfc"), "situacion",
        C.iso_text("fecha_definitivo").alias("definitivo_dof"),
        C.iso_text("fecha_efectiva").alias("fecha_contrato"),
        "firmado_despues_definitivo", "tipo_procedimiento", "ejercicio",
        "importe", C.amount_millions("importe", 2).alias("monto_mxn_millones"),
        C.plausible_amount().alias("importe_plausible"), "direccion_anuncio")


def debarred(state: DataFrame, sfp: DataFrame) -> DataFrame:
    return M.debarment_hits(state.where("rfc_valido"), sfp)


def fraud_by_name(state: DataFrame, efos: DataFrame) -> DataFrame:
    """Name tier for rows without a valid key; kept apart, may fan out."""
    unkeyed = M.keyed_by_name(
        state.where(~F.col("rfc_valido") & F.col("proveedor").isNotNull()),
        "proveedor")
    listed = efos.where((F.col("situacion") == "Definitivo")
                        & (F.length("nombre") >= 8)).select(
        C.name_norm("nombre").alias("nombre_norm"),
        F.col("rfc_norm").alias("rfc_69b"), "situacion", "fecha_definitivo")
    return unkeyed.join(listed, "nombre_norm").select(
        *BUYER, "proveedor", "rfc_69b", "situacion",
        C.iso_text("fecha_definitivo").alias("definitivo_dof"),
        C.iso_text("fecha_efectiva").alias("fecha_contrato"), "ejercicio",
        "importe", C.amount_millions("importe", 2).alias("monto_mxn_millones"),
        "direccion_anuncio")


def young(state: DataFrame, max_days: int = ages.MAX_AGE_DAYS,
          min_amount: float = ages.MIN_AMOUNT) -> DataFrame:
    age = C.age_days("fecha_constitucion_rfc", "fecha_efectiva")
    rows = state.where(
        F.col("rfc_valido") & F.col("es_persona_moral")
        & age.between(0, max_days - 1) & C.plausible_amount()
        & (F.col("importe") >= min_amount))
    return rows.select(
        *BUYER, "proveedor", F.col("rfc_norm").alias("rfc"),
        C.iso_text("fecha_constitucion_rfc").alias("constituida"),
        C.iso_text("fecha_efectiva").alias("fecha_contrato"),
        age.alias("edad_dias"), "tipo_procedimiento", "ejercicio", "importe",
        C.amount_millions("importe", 2).alias("monto_mxn_millones"),
        "direccion_anuncio")


def concentration(state: DataFrame, min_total: float = 10e6,
                  min_awards: int = 15, min_share: float = 0.5) -> DataFrame:
    """A named supplier holding most of a buyer's direct spending.

    The totals of pairs are read twice, so they are stored; so are the few pairs kept,
    as a later test of their names would else be run on every report.
    """
    rows = state.where(
        C.direct_award("tipo_procedimiento") & C.plausible_supplier()
        & C.plausible_amount() & F.col("sujeto_obligado").isNotNull())
    pairs = stored(rows.groupBy(*BUYER, "proveedor").agg(
        F.count("*").alias("contratos"), C.money_sum("importe").alias("_paid")))
    totals = (pairs.groupBy("sujeto_obligado")
              .agg(F.sum("_paid").alias("_total"),
                   F.sum("contratos").alias("directas_del_sujeto"))
              .where((F.col("_total") >= min_total)
                     & (F.col("directas_del_sujeto") >= min_awards)))
    kept = pairs.join(totals, "sujeto_obligado").where(
        F.col("_paid").cast("double") >= min_share * F.col("_total").cast("double"))
    return stored(kept).select(
        *BUYER, "proveedor", "contratos",
        C.millions(F.col("_paid"), 2).alias("monto_mxn_millones"),
        C.share_pct(F.col("_paid"), F.col("_total"), 1)
        .alias("pct_del_gasto_directo"), "directas_del_sujeto")


def rings(state: DataFrame, window_days: int = 30, min_companies: int = 3,
          min_share: float = 0.25) -> DataFrame:
    """Rings that are a real part of the buyer's dated legal-person suppliers."""
    firms = stored(collusion.ring_firms(
        state.where("rfc_valido"), BUYER, C.plausible_amount()))
    suppliers = firms.groupBy("sujeto_obligado").agg(
        F.countDistinct("rfc_norm").alias("proveedores_del_sujeto"))
    members = collusion.widest_incorporation_run(
        firms, BUYER, window_days, min_companies)
    table = collusion.summarise_rings(members, BUYER).join(
        suppliers, "sujeto_obligado")
    share = F.col("empresas") / F.col("proveedores_del_sujeto")
    return table.where(share >= min_share).select(
        *BUYER, "empresas", "proveedores_del_sujeto",
        C.share_pct(F.col("empresas"), F.col("proveedores_del_sujeto"), 1)
        .alias("pct_del_sujeto"), "dias_entre_constituciones",
        "constituidas_desde", "constituidas_hasta", "contratos",
        "monto_mxn_millones", "proveedores")
