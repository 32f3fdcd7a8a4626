"""Structural marks of collusion: rotation, incorporation rings, splitting.

Rotation and rings read their per-office totals in several branches, so the
totals are stored once and the contracts behind them are scanned once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contraluz.functions import columns as C
from contraluz.operators import matching as M
from contraluz.session import stored

OFFICE = ["institucion", "nombre_uc"]


def _known(keys: list[str]) -> Column:
    test = F.col(keys[0]).isNotNull()
    for key in keys[1:]:
        test = test & F.col(key).isNotNull()
    return test


def _joined_list(order: list[Column], text: Column) -> Column:
    """Ordered concatenation of a group that is small by construction."""
    fields = [c.alias(f"o{i}") for i, c in enumerate(order)]
    rows = F.array_sort(F.collect_list(F.struct(*fields, text.alias("text"))))
    return F.array_join(F.transform(rows, lambda r: r["text"]), " | ")


# ----------------------------------------------------------------- rotation

def tender_wins(contracts: DataFrame, keys: list[str] = OFFICE) -> DataFrame:
    """Public-tender wins per office and (supplier, key)."""
    return _wins(contracts.where(C.tender("tipo_procedimiento") & _known(keys)), keys)


def _wins(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys, "proveedor", "rfc_norm").agg(
        F.count("*").alias("n"),
        C.money_sum("importe", C.mxn_ok()).alias("monto"),
        F.countDistinct("file_year").alias("anios"),
        F.min("fecha_efectiva").alias("primer_contrato"))


def _rotating_offices(wins: DataFrame, keys: list[str], min_contracts: int,
                      max_suppliers: int, min_evenness: float) -> DataFrame:
    """Offices whose few suppliers share all wins almost evenly.

    Normalised entropy from sums alone, (ln N - sum(n ln n) / N) / ln k, so it
    needs a plain aggregate and no pass over the members of a group.
    """
    n = F.col("n").cast("double")
    offices = wins.groupBy(*keys).agg(
        F.sum("n").alias("contratos"), F.count("*").alias("n_proveedores"),
        F.sum(n * F.ln(n)).alias("_nlogn"), F.max("anios").alias("anios_activos"),
        F.sum("monto").alias("_paid"))
    return _even(offices, min_contracts, max_suppliers, min_evenness)


def _even(offices: DataFrame, min_contracts: int, max_suppliers: int,
          min_evenness: float) -> DataFrame:
    """Rows whose office passes, by its `contratos`, `n_proveedores` and `_nlogn`."""
    small = offices.where((F.col("contratos") >= min_contracts)
                          & F.col("n_proveedores").between(2, max_suppliers))
    total = F.col("contratos").cast("double")
    evenness = ((F.ln(total) - F.col("_nlogn") / total)
                / F.ln(F.col("n_proveedores").cast("double")))
    return small.withColumn("_evenness", evenness).where(
        F.col("_evenness") >= min_evenness - 1e-12)


def rotating_wins(contracts: DataFrame, min_contracts: int = 12, max_suppliers: int = 5,
                  min_evenness: float = 0.75, keys: list[str] = OFFICE) -> DataFrame:
    """The `tender_wins` of the offices that rotate; what reads wins finds the same in them.

    Tenders are dealt by their office in narrow columns, so wins, offices and the test of
    an office move nothing more.
    """
    rows = contracts.where(C.tender("tipo_procedimiento") & _known(keys)).select(
        *keys, "proveedor", "rfc_norm", "importe", "moneda_efectiva", "file_year",
        "fecha_efectiva").repartition(*keys)
    wins, office, n = _wins(rows, keys), Window.partitionBy(*keys), F.col("n").cast("double")
    marked = wins.withColumns({
        "contratos": F.sum("n").over(office), "n_proveedores": F.count("*").over(office),
        "_nlogn": F.sum(n * F.ln(n)).over(office)})
    # what reads the wins tests again; a last digit of a sum in another order decides nothing
    return _even(marked, min_contracts, max_suppliers, min_evenness - 1e-9).select(
        *wins.columns)


def rotation_candidates(contracts: DataFrame, min_contracts: int = 12,
                        max_suppliers: int = 5, min_evenness: float = 0.75,
                        keys: list[str] = OFFICE,
                        wins: DataFrame | None = None) -> DataFrame:
    """`wins` are the contracts' `tender_wins` or `rotating_wins`, where they are stored."""
    wins = stored(tender_wins(contracts, keys)) if wins is None else wins
    offices = _rotating_offices(wins, keys, min_contracts, max_suppliers,
                                min_evenness)
    # at most max_suppliers rows per office reach this list
    names = wins.join(offices.select(*keys), keys).groupBy(*keys).agg(
        _joined_list([-F.col("n"), F.col("proveedor"), F.col("rfc_norm")],
                     F.format_string("%s (%d)", "proveedor", "n"))
        .alias("proveedores"))
    return offices.join(names, keys).select(
        *keys, "contratos", "n_proveedores",
        C.round_sql(F.col("_evenness"), 3).alias("evenness"), "anios_activos",
        F.coalesce(C.millions(F.col("_paid"), 1), F.lit(0.0))
        .alias("monto_mxn_millones"), "proveedores")


def rotation_members(contracts: DataFrame, min_contracts: int = 12,
                     max_suppliers: int = 5, min_evenness: float = 0.75,
                     keys: list[str] = OFFICE,
                     wins: DataFrame | None = None) -> DataFrame:
    wins = stored(tender_wins(contracts, keys)) if wins is None else wins
    offices = _rotating_offices(wins, keys, min_contracts, max_suppliers,
                                min_evenness)
    return wins.join(offices.select(*keys), keys, "left_semi").select(
        *keys, "rfc_norm", "proveedor", "primer_contrato")


# -------------------------------------------------------------------- rings

def widest_incorporation_run(firms: DataFrame, keys: list[str],
                             window_days: int = 30,
                             min_companies: int = 3) -> DataFrame:
    """Per group, the firms of the fullest run of incorporation dates.

    `firms` holds one row per group and key.  Firms are counted per group and
    day first: the sliding window then sees at most one row per calendar day,
    however many firms a hot buyer has.  The earliest of equal runs wins.
    """
    per_day = (firms.where(_known(keys)).groupBy(*keys, "constituida")
               .agg(F.count("*").alias("_n")))
    span = (Window.partitionBy(*keys).orderBy(F.unix_date("constituida"))
            .rangeBetween(0, window_days))
    runs = (per_day.withColumn("_size", F.sum("_n").over(span))
            .where(F.col("_size") >= min_companies))
    widest = runs.groupBy(*keys).agg(
        F.max(F.struct("_size", (-F.unix_date("constituida")).alias("_start")))
        .alias("_best"))
    start = F.date_from_unix_date(-F.col("_best._start"))
    bounds = widest.select(*keys, start.alias("_from"))
    return (firms.join(bounds, keys)
            .where(F.col("constituida").between(
                F.col("_from"), F.date_add("_from", window_days)))
            .drop("_from"))


def _dated(contracts: DataFrame, keys: list[str]) -> DataFrame:
    """Contracts of dated legal persons of known buyers."""
    return contracts.where(F.col("es_persona_moral") & _known(keys)
                           & F.col("fecha_constitucion_rfc").isNotNull())


def ring_firms(contracts: DataFrame, keys: list[str],
               counted: Column) -> DataFrame:
    """Dated legal persons per buyer, with their volume."""
    return _dated(contracts, keys).groupBy(*keys, "rfc_norm").agg(
        F.min("proveedor").alias("proveedor"),
        F.min("fecha_constitucion_rfc").alias("constituida"),
        F.min("fecha_efectiva").alias("primer_contrato"),
        F.count("*").alias("contratos"),
        C.money_sum("importe", counted).alias("monto"))


def ring_dates(contracts: DataFrame, window_days: int = 30, min_companies: int = 3,
               keys: list[str] = OFFICE) -> DataFrame:
    """Key and first contract of every ring member.

    As `ring_members`, without what a reader of rings wants: dates alone are aggregated
    by hash, names and sums would be sorted and moved for every firm of every buyer.  The
    run that starts at each firm is counted among the buyer's firms, one row each.  Key and
    dates of a contract are dealt by its buyer, so they move once and nothing is stored.
    """
    rows = _dated(contracts, keys).select(
        *keys, "rfc_norm", "fecha_constitucion_rfc", "fecha_efectiva").repartition(*keys)
    firms = rows.groupBy(*keys, "rfc_norm").agg(
        F.min("fecha_constitucion_rfc").alias("constituida"),
        F.min("fecha_efectiva").alias("primer_contrato"))
    day = F.unix_date("constituida")
    buyer = Window.partitionBy(*keys)
    runs = firms.withColumn("_size", F.count("*").over(
        buyer.orderBy(day).rangeBetween(0, window_days)))
    best = runs.withColumn("_best", F.max(F.struct("_size", (-day).alias("_start"))).over(buyer))
    start = -F.col("_best._start")
    return best.where((F.col("_best._size") >= min_companies)
                      & day.between(start, start + window_days)).select(
        "rfc_norm", "primer_contrato")


def ring_members(contracts: DataFrame, window_days: int = 30,
                 min_companies: int = 3, keys: list[str] = OFFICE) -> DataFrame:
    firms = stored(ring_firms(contracts, keys, C.mxn_ok()))
    return widest_incorporation_run(firms, keys, window_days, min_companies)


def summarise_rings(members: DataFrame, keys: list[str]) -> DataFrame:
    """One row per ring; the supplier list holds one ring, not one buyer."""
    label = F.format_string("%s (%s, %s)", "proveedor", "rfc_norm",
                            C.iso_text("constituida"))
    return members.groupBy(*keys).agg(
        F.count("*").alias("empresas"),
        F.date_diff(F.max("constituida"), F.min("constituida"))
        .alias("dias_entre_constituciones"),
        C.iso_text(F.min("constituida")).alias("constituidas_desde"),
        C.iso_text(F.max("constituida")).alias("constituidas_hasta"),
        F.sum("contratos").alias("contratos"),
        F.coalesce(C.millions(F.sum("monto"), 1), F.lit(0.0))
        .alias("monto_mxn_millones"),
        _joined_list([F.col("constituida"), F.col("rfc_norm")], label)
        .alias("proveedores"))


def rings(contracts: DataFrame, window_days: int = 30, min_companies: int = 3,
          keys: list[str] = OFFICE) -> DataFrame:
    return summarise_rings(
        ring_members(contracts, window_days, min_companies, keys), keys)


# ---------------------------------------------------------------- splitting

def same_day_splits(contracts: DataFrame, min_contracts: int = 3,
                    min_total: float = 5e6,
                    keys: list[str] = OFFICE) -> DataFrame:
    """Several direct awards to one supplier by one buyer on one day."""
    rows = contracts.where(
        C.direct_award("tipo_procedimiento") & C.mxn_ok()
        & F.col("fecha_efectiva").isNotNull() & F.col("importe").isNotNull()
        & F.col(keys[-1]).isNotNull())
    day = [*keys, "proveedor", "rfc_norm", F.col("fecha_efectiva").alias("dia")]
    groups = M.repeated(rows, day, min_contracts).groupBy(*day).agg(
        F.count("*").alias("contratos"), C.money_sum("importe").alias("_total"),
        F.max("importe").alias("_largest"))
    kept = groups.where((F.col("contratos") >= min_contracts)
                        & (F.col("_total") >= min_total))
    total = F.col("_total").cast("double")
    return kept.select(
        *keys, "proveedor", "rfc_norm", "dia", "contratos",
        total.alias("total_mxn"),
        C.round_sql(F.try_divide(F.col("_largest"), total), 2)
        .alias("pct_mayor"))
