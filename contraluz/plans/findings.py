"""All findings as one catalogue, and the batch run that writes them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contraluz.operators import (ages, bunching, collusion, concentration,
                                 debarment, digits, fraud_list, modifications,
                                 other_buyer, state_layer)
from contraluz.operators import matching as M
from contraluz.functions import columns as C
from contraluz.plans import backtest, signals
from contraluz.sources import sinks


@dataclass(frozen=True)
class Tables:
    """Canonical inputs; absent ones leave out the findings that need them."""
    contracts: DataFrame
    efos: DataFrame
    sfp: DataFrame
    states: DataFrame | None = None
    archive: DataFrame | None = None
    utility: DataFrame | None = None


def _order(*columns: str) -> tuple[Column, ...]:
    return tuple(F.desc_nulls_last(c[1:]) if c.startswith("-")
                 else F.asc_nulls_last(c) for c in columns)


def build(tables: Tables, thresholds: Mapping[str, Mapping] | None = None
          ) -> dict[str, tuple[DataFrame, tuple[Column, ...]]]:
    """Every finding as (table, presentation order).

    Tables are lazy but for small totals that several branches read, which are
    stored while the catalogue is built.
    """
    options = {**signals.DEFAULTS, **(thresholds or {})}
    contracts, efos, sfp = tables.contracts, tables.efos, tables.sfp
    hits = M.fraud_hits(contracts, efos)
    barred = M.debarment_hits(contracts, sfp)
    aged = ages.with_age(contracts)
    profile = digits.digit_profile(contracts, "institucion", C.mxn_ok())
    flags = signals.signal_flags(contracts, options)
    out = {
        "f01_resumen_por_situacion": (
            fraud_list.by_status_year(hits), _order("situacion", "file_year")),
        "f01_despues_de_definitivo": (
            fraud_list.after_definitive(hits), _order("file_year")),
        "f01_top25_definitivos": (
            fraud_list.top_definitive(hits), _order("-monto_mxn_millones")),
        "f01_definitivos_por_procedimiento": (
            fraud_list.by_procedure(hits), _order("-contratos")),
        "f01_detalle_completo": (
            fraud_list.detail(hits), _order("situacion", "-importe")),
        "f02_proveedores_concentracion_directas": (
            concentration.direct_suppliers(contracts),
            _order("-monto_directas_mxn_m", "rfc")),
        "f02_instituciones_pct_directas": (
            concentration.leaning_institutions(contracts),
            _order("-pct_directas_monto")),
        "f02_dependencia_proveedor_unico": (
            concentration.supplier_dependence(contracts),
            _order("-monto_directas_mxn_m")),
        "f03_benford_instituciones": (
            digits.conformity(profile, "institucion"), _order("-mad")),
        "f03_peor_institucion_digitos": (
            digits.worst_group_digits(profile, "institucion"), _order("digito")),
        "f04_resumen": (ages.by_year(aged), _order("file_year")),
        "f04_top30_jovenes_grandes": (
            ages.top_young(aged), _order("-monto_mxn_millones")),
        "f04_edad_por_procedimiento": (
            ages.age_by_class(aged), _order("-contratos")),
        "f04_validacion_enriquecimiento": (ages.enrichment(aged, efos), ()),
        "f05_resumen": (debarment.by_year(barred), _order("file_year")),
        "f05_durante_inhabilitacion": (
            debarment.during(barred), _order("-importe")),
        "f05_detalle_completo": (debarment.detail(barred), _order(
            "-durante_inhabilitacion", "-importe", "codigo_contrato")),
        "f06_rotacion_licitaciones": (
            collusion.rotation_candidates(contracts, **options["rotation"]),
            _order("-monto_mxn_millones")),
        "f06_anillos_constitucion": (
            collusion.rings(contracts, **options["rings"]),
            _order("-monto_mxn_millones")),
        "f06_fraccionamiento_mismo_dia": (
            collusion.same_day_splits(contracts, **options["splits"]),
            _order("-total_mxn", "rfc_norm", "dia")),
        "f07_convenios_inflados": (
            modifications.over_cap(contracts, **options["over_cap"]),
            _order("-pct_incremento")),
        "f08_backtest_precision": (
            backtest.evaluate(
                signals.with_composite(flags),
                backtest.supplier_universe(contracts),
                backtest.sanction_dates(efos, sfp)), _order("-lift")),
        "f11_umbrales_bunching": (
            bunching.bunching(contracts), _order("p_binomial")),
        "f12_riesgo_proveedor": (
            signals.supplier_ensemble(contracts, flags, efos, sfp),
            _order("-n_senales", "-monto_mxn_millones")),
    }
    if tables.archive is not None:
        archive = fraud_list.archive_contracts(tables.archive)
        found = fraud_list.archive_hits(archive, efos)
        out |= {
            "f01h_resumen_por_situacion": (
                fraud_list.archive_by_status(found),
                _order("-monto_mxn_millones")),
            "f01h_despues_de_definitivo_por_anio": (
                fraud_list.archive_after_by_year(found), _order("anio")),
            "f01h_top25_post_definitivo": (
                fraud_list.archive_top(found), _order("-monto_mxn_millones")),
            "f01h_detalle_completo": (fraud_list.archive_detail(found), _order(
                "-iniciado_despues_definitivo", "-importe_num",
                "codigo_contrato")),
        }
    if tables.utility is not None:
        out["f09_cfe_riesgo"] = (
            other_buyer.name_screen(tables.utility, efos, sfp), _order("numero"))
    if tables.states is not None:
        state = tables.states
        state_profile = digits.digit_profile(
            state, "sujeto_obligado", C.plausible_amount(), 200)
        out |= {
            "f10_cobertura_estatal": (
                state_layer.coverage(state),
                _order("estado_comprador", "ejercicio")),
            "f10_efos_estatal": (state_layer.fraud_by_rfc(state, efos), _order(
                "situacion", "-firmado_despues_definitivo", "-importe")),
            "f10_inhabilitados_estatal": (state_layer.debarred(state, sfp), ()),
            "f10_efos_estatal_por_nombre": (
                state_layer.fraud_by_name(state, efos), _order("-importe")),
            "f10_jovenes_estatal": (
                state_layer.young(state), _order("-importe")),
            "f10_concentracion_estatal": (
                state_layer.concentration(state),
                _order("-monto_mxn_millones")),
            "f10_anillos_estatal": (
                state_layer.rings(state), _order("-monto_mxn_millones")),
            "f13_benford_estatal": (
                digits.conformity(state_profile, "sujeto_obligado"),
                _order("-mad")),
            "f13_benford_estatal_peor": (
                digits.worst_group_digits(state_profile, "sujeto_obligado"),
                _order("digito")),
        }
    return out


def write_all(tables: Tables, folder: str, fmt: str = "parquet",
              thresholds: Mapping[str, Mapping] | None = None) -> list[str]:
    """Writes every finding; the canonical inputs should be stored tables."""
    return [sinks.write_finding(table, folder, name, order, fmt)
            for name, (table, order) in build(tables, thresholds).items()]
