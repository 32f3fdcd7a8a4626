"""Predictive signals in long form, their composite and the supplier ensemble."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contraluz.functions import columns as C
from contraluz.functions import fixed_values as V
from contraluz.operators import ages, collusion, concentration, modifications
from contraluz.session import few, stored

DEFAULTS: dict[str, dict] = {
    "direct": {}, "young": {}, "splits": {}, "rings": {}, "rotation": {},
    "over_cap": {},
}


def signal_flags(contracts: DataFrame,
                 thresholds: Mapping[str, Mapping] = DEFAULTS,
                 wins: DataFrame | None = None) -> DataFrame:
    """(senal, rfc_norm, flag_date), one row per signal and key.

    `wins` are stored `tender_wins` of the contracts, where a caller has them.

    The criteria are the screens' own functions, so a threshold moves the
    screen, the backtest and the ensemble together.
    """
    options = {**DEFAULTS, **thresholds}

    def first_date(rows: DataFrame, day: str) -> DataFrame:
        return rows.groupBy("rfc_norm").agg(F.min(day).alias("flag_date"))

    parts = {
        "d04_joven_y_grande": ages.young_flags(contracts, **options["young"]),
        "d02_concentracion_directas": concentration.direct_award_flags(
            contracts, **options["direct"]),
        "d06_fraccionamiento": first_date(
            collusion.same_day_splits(contracts, **options["splits"]), "dia"),
        "d06_anillo_constitucion": first_date(
            collusion.ring_dates(contracts, **options["rings"]),
            "primer_contrato"),
        "d06_rotacion": first_date(
            collusion.rotation_members(contracts, **options["rotation"], wins=wins),
            "primer_contrato"),
        "d07_convenio_inflado": modifications.flags(
            modifications.over_cap(contracts, **options["over_cap"])),
    }
    long = None
    for name, rows in parts.items():
        part = rows.where(F.col("rfc_norm").isNotNull()).select(
            F.lit(name).alias("senal"), "rfc_norm", "flag_date")
        long = part if long is None else long.unionByName(part)
    return long


def composite_flags(flags: DataFrame, min_signals: int = 2) -> DataFrame:
    """Keys with several distinct signals, dated by the earliest."""
    per_key = flags.groupBy("rfc_norm").agg(
        F.countDistinct("senal").alias("_n"), F.min("flag_date").alias("flag_date"))
    return per_key.where(F.col("_n") >= min_signals).select(
        "rfc_norm", "flag_date")


def with_composite(flags: DataFrame, min_signals: int = 2) -> DataFrame:
    stacked = composite_flags(flags, min_signals).withColumn(
        "senal", F.lit(V.COMPOSITE_SIGNAL))
    return flags.unionByName(stacked)


def _labels(codes):
    table = F.create_map(*[F.lit(x) for pair in V.SIGNAL_LABELS.items()
                           for x in pair])
    return F.array_join(F.transform(
        F.array_sort(codes),
        lambda code: F.coalesce(F.try_element_at(table, code), code)), "; ")


def supplier_ensemble(contracts: DataFrame, flags: DataFrame, efos: DataFrame,
                      sfp: DataFrame) -> DataFrame:
    """One row per flagged key: how many signals, which, and its context.

    The context is aggregated only for flagged keys (semi join first), which contracts
    look up while they are few.
    """
    per_key = few(stored(flags.groupBy("rfc_norm").agg(
        F.collect_set("senal").alias("_codes"),
        F.min("flag_date").alias("primera_marca"))))
    context = (contracts.join(per_key.select("rfc_norm"), "rfc_norm", "left_semi")
               .groupBy("rfc_norm").agg(
                   F.min("proveedor").alias("proveedor"),
                   F.count("*").alias("contratos"),
                   C.millions(C.money_sum("importe", C.mxn_ok()), 2)
                   .alias("monto_mxn_millones"),
                   F.countDistinct("institucion").alias("dependencias")))
    listed = efos.groupBy("rfc_norm").agg(F.max("situacion").alias("situacion_69b"))
    barred = sfp.select("rfc_norm", F.lit(True).alias("_barred")).dropDuplicates()
    joined = (per_key.join(context, "rfc_norm", "left")
              .join(listed, "rfc_norm", "left").join(barred, "rfc_norm", "left"))
    return joined.select(
        F.col("rfc_norm").alias("rfc"), "proveedor",
        F.size("_codes").alias("n_senales"), _labels(F.col("_codes")).alias("senales"),
        "primera_marca", "contratos", "monto_mxn_millones", "dependencias",
        F.col("situacion_69b").isNotNull().alias("en_69b"), "situacion_69b",
        F.coalesce("_barred", F.lit(False)).alias("inhabilitado_sfp"))


def ensemble_distribution(ensemble: DataFrame) -> DataFrame:
    return ensemble.groupBy("n_senales").agg(
        F.count("*").alias("proveedores"),
        F.count_if("en_69b").alias("ya_sancionados"),
        C.share_pct(F.count_if("en_69b"), F.count("*"), 1)
        .alias("pct_ya_sancionado"))
