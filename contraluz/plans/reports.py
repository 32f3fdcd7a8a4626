"""Published figures, unified lists, complaints with folios, data quality."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contraluz.functions import columns as C
from contraluz.functions import fixed_values as V
from contraluz.operators.ranks import rank_in_groups
from contraluz.session import stored


# ------------------------------------------------------------------- figures

def one_row(parts: Mapping[str, tuple[DataFrame | None, Column]]) -> DataFrame:
    """Scalars of many tables in one row.

    Each scalar becomes one (name, value) row and the rows are pivoted; a
    missing finding, or one without rows, counts as zero.
    """
    long = None
    for name, (rows, value) in parts.items():
        if rows is None:
            continue
        part = rows.agg(value.cast("double").alias("v")).select(
            F.lit(name).alias("k"), "v")
        long = part if long is None else long.unionByName(part)
    if long is None:
        raise ValueError("no finding given")
    return long.agg(*[
        F.coalesce(F.max(F.when(F.col("k") == name, F.col("v"))), F.lit(0.0))
        .alias(name) for name in parts])


def _exact_sum(column: str, digits: int = 1, where: Column | None = None) -> Column:
    value = F.col(column).cast("decimal(24,6)")
    value = value if where is None else F.when(where, value)
    return F.round(F.sum(value), digits)


def headline_figures(findings: Mapping[str, DataFrame]) -> DataFrame:
    """The ten published scalars."""
    get = findings.get
    definitive = F.col("situacion") == "Definitivo"
    return one_row({
        "d01_monto": (get("fraud_by_status"),
                      _exact_sum("monto_mxn_millones", where=definitive)),
        "d01h_monto": (get("archive_by_status"),
                       _exact_sum("monto_mxn_millones", where=definitive)),
        "d01h_contratos": (get("archive_by_status"),
                           F.sum(F.when(definitive, F.col("contratos")))),
        "d01h_empresas": (get("archive_by_status"),
                          F.sum(F.when(definitive, F.col("empresas")))),
        "d04_monto": (get("young_by_year"),
                      _exact_sum("monto_a_menores_1a_mxn_m")),
        "d05_gun": (get("debarred_federal"), F.count("*")),
        "d03_noconf": (get("digits"), F.count_if(
            F.col("banda_nigrini") == V.OUTSIDE_BANDS)),
        "d03_total": (get("digits"), F.count("*")),
        "d07_n": (get("modifications"), F.count("*")),
        "best_lift": (get("backtest"), F.max("lift")),
    })


def derived_figures(findings: Mapping[str, DataFrame]) -> DataFrame:
    """Joint federal and state totals."""
    get = findings.get
    definitive = F.col("situacion") == "Definitivo"
    plausible = definitive & F.col("importe_plausible")
    during = F.col("durante_inhabilitacion")
    state_money = C.millions(C.money_sum("importe", plausible), 6)
    year = F.year(C.parse_moment("fecha_contrato"))
    parts = {
        "_fed_debarred": (get("debarred_federal"), F.count("*")),
        "estatal_durante_n": (get("debarred_state"), F.count_if(during)),
        "_fed_fraud": (get("fraud_by_status"),
                       _exact_sum("monto_mxn_millones", 6, definitive)),
        "_state_fraud": (get("fraud_state"), state_money),
        "_fed_fraud_n": (get("fraud_federal"), F.count_if(definitive)),
        "estatal_facturera_n": (get("fraud_state"), F.count_if(plausible)),
        "facturera_hist_contratos": (get("archive_by_status"), F.sum(
            F.when(definitive, F.col("contratos")))),
        "facturera_hist_monto": (get("archive_by_status"),
                                 _exact_sum("monto_mxn_millones", where=definitive)),
        "facturera_hist_empresas": (get("archive_by_status"), F.sum(
            F.when(definitive, F.col("empresas")))),
        "_first_year": (get("fraud_federal"), F.min(F.when(definitive, year))),
        "_last_year": (get("fraud_federal"), F.max(F.when(definitive, year))),
        "sobrecostos_n": (get("modifications"), F.count("*")),
        "jovenes_monto": (get("young_by_year"),
                          _exact_sum("monto_a_menores_1a_mxn_m")),
        "estatal_estados_n": (get("coverage"),
                              F.countDistinct("estado_comprador")),
    }
    row = one_row(parts)
    return row.select(
        (F.col("_fed_debarred") + F.col("estatal_durante_n"))
        .alias("inhabilitadas_n"),
        C.round_sql(F.col("_fed_fraud") + F.col("_state_fraud"), 1)
        .alias("facturera_rfc_monto"),
        (F.col("_fed_fraud_n") + F.col("estatal_facturera_n"))
        .alias("facturera_rfc_contratos"),
        _years(F.col("_first_year"), F.col("_last_year")).alias("facturera_rfc_rango"),
        *[n for n in parts if not n.startswith("_")])


def _years(low: Column, high: Column) -> Column:
    """'2010–2023'; a dash where no year is known (NULL or 0)."""
    low, high = (c.cast("int").cast("string") for c in (low, high))
    return F.when(low.isNull() | (low == "0"), "—").when(low == high, low).otherwise(
        F.concat_ws("–", low, high))


def year_range(rows: DataFrame, day: str) -> DataFrame:
    """The range of years of an ISO date column."""
    year = F.year(C.parse_moment(day))
    return rows.agg(_years(F.min(year), F.max(year)).alias("rango"))


def affected_offices(*tables: DataFrame) -> DataFrame:
    """Distinct (institution, office) over several collusion findings."""
    rows = None
    for table in tables:
        part = table.select("institucion", "nombre_uc")
        rows = part if rows is None else rows.unionByName(part)
    return rows.dropDuplicates().agg(F.count("*").alias("oficinas_total"))


def direct_money(institutions: DataFrame) -> DataFrame:
    """Money awarded directly by the listed institutions."""
    return institutions.agg(
        F.count("*").alias("instituciones_total"),
        C.round_sql(F.sum(F.col("monto_mxn_millones")
                          * F.col("pct_directas_monto") / 100), 1)
        .alias("monto_directas_mxn_m"),
        F.sum("contratos").alias("contratos_total"))


def status_distribution(detail: DataFrame) -> DataFrame:
    return detail.groupBy("situacion").agg(F.count("*").alias("contratos"))


def sums_by_supplier(during: DataFrame) -> DataFrame:
    return during.groupBy("rfc").agg(
        F.min("proveedor").alias("proveedor"), F.count("*").alias("contratos"),
        C.money_sum("importe").cast("double").alias("total_mxn"))


def doubled_contracts(modifications: DataFrame) -> DataFrame:
    """Contracts that at least doubled."""
    return modifications.agg(
        F.count_if(F.col("pct_incremento") >= 100).alias("al_doble"),
        F.count("*").alias("contratos"))


def without_tender(young: DataFrame) -> DataFrame:
    """Share of young large awards made without a public tender."""
    return young.agg(
        F.count("*").alias("contratos"),
        C.share_pct(F.count_if(~F.coalesce(
            C.tender("tipo_procedimiento"), F.lit(False))), F.count("*"), 1)
        .alias("pct_sin_licitacion"))


def report_table(rows: DataFrame, columns: Sequence[str],
                 order: Sequence[Column] = (), n: int | None = None) -> DataFrame:
    """Column subset of a finding, optionally its first n rows in order."""
    kept = [c for c in columns if c in rows.columns]
    ordered = rows.orderBy(*order) if order else rows
    return (ordered.limit(n) if n else ordered).select(*kept)


# ------------------------------------------------------------- unified lists

def _money_millions() -> Column:
    return F.coalesce(C.amount_millions("importe", 2), F.lit(0.0))


def unified_debarred(federal: DataFrame, state_hits: DataFrame) -> DataFrame:
    """Contracts during a debarment, federal and state in one list."""
    fed = federal.select(
        "proveedor", "rfc", F.lit("federal").alias("ambito"),
        F.col("inhabilitado_desde").alias("desde"), "hasta", "fecha_contrato",
        F.col("institucion").alias("comprador"),
        _money_millions().alias("monto_mxn_millones"), "direccion_anuncio")
    state = state_hits.where("durante_inhabilitacion").select(
        "proveedor", F.col("rfc_norm").alias("rfc"),
        F.initcap("estado_comprador").alias("ambito"),
        C.iso_text("inicio").alias("desde"), C.iso_text("fin").alias("hasta"),
        C.iso_text("fecha_efectiva").alias("fecha_contrato"),
        F.col("sujeto_obligado").alias("comprador"),
        _money_millions().alias("monto_mxn_millones"), "direccion_anuncio")
    return fed.unionByName(state)


def unified_fraud(federal: DataFrame, state: DataFrame) -> DataFrame:
    """Contracts of definitive-list firms, federal and plausible state ones."""
    def part(rows: DataFrame, scope: Column, buyer: str) -> DataFrame:
        return rows.where("situacion = 'Definitivo'").select(
            "proveedor", "rfc", scope.alias("ambito"), "definitivo_dof",
            "fecha_contrato", F.col(buyer).alias("comprador"),
            _money_millions().alias("monto_mxn_millones"), "direccion_anuncio")

    return part(federal, F.lit("federal"), "institucion").unionByName(part(
        state.where("importe_plausible"), F.initcap("estado_comprador"),
        "sujeto_obligado"))


# --------------------------------------------------------- complaints, folios

def case_names(during: DataFrame) -> DataFrame:
    """Draft name per contract: key and date, numbered where they repeat."""
    base = F.concat_ws("_", F.lit("inhabilitado"), "rfc", "fecha_contrato")
    safe = F.regexp_replace(F.trim(base), "[^A-Za-z0-9._-]+", "_")
    numbered = rank_in_groups(during.withColumn("_name", safe), ["_name"], [
        F.desc_nulls_last("importe"), F.col("institucion"), F.col("direccion_anuncio"),
        F.col("tipo_procedimiento")], "_n")
    return numbered.withColumn("nombre_caso", F.when(
        F.col("_n") > 1, F.concat_ws("-", "_name", F.col("_n").cast("string")))
        .otherwise(F.col("_name"))).drop("_name", "_n")


def complaints_with_folios(during: DataFrame, filed: DataFrame) -> DataFrame:
    """Contracts covered by a filed complaint, with its folio.

    First by exact draft name; then each complaint that carries only a key
    takes the next uncovered contract of that key; then a folio covers its
    whole (key, institution) group, as complaints are filed per group.
    """
    named = stored(case_names(during))
    files = (filed.where("estado = 'denunciado'")
             .withColumn("folio", C.complaint_folio("nota"))
             .where(F.col("folio").isNotNull()))
    by_name = files.groupBy(F.col("numero").alias("nombre_caso")).agg(
        F.max("folio").alias("_folio"))
    first = named.join(by_name, "nombre_caso", "left")
    known = named.select(F.col("nombre_caso").alias("numero"))
    waiting = files.join(known, "numero", "left_anti").withColumn(
        "rfc", C.bracketed_rfc("nombre")).where(F.col("rfc").isNotNull())
    queued = rank_in_groups(waiting.select("rfc", "folio", "numero"), ["rfc"],
                            [F.col("folio"), F.col("numero")], "_turn").select(
                                "rfc", "_turn", F.col("folio").alias("_next"))
    free = (first.where(F.col("_folio").isNull()).select("rfc", "nombre_caso")
            .join(queued.select("rfc").dropDuplicates(), "rfc", "left_semi"))
    taken = rank_in_groups(free, ["rfc"], [F.col("nombre_caso")], "_turn").join(
        queued, ["rfc", "_turn"]).select("nombre_caso", "_next")
    second = first.join(taken, "nombre_caso", "left").withColumn(
        "_own", F.coalesce("_folio", "_next"))
    groups = second.where(F.col("_own").isNotNull()).groupBy(
        "rfc", "institucion").agg(
            F.max_by("_own", "nombre_caso").alias("_group"))
    covered = second.join(groups, ["rfc", "institucion"], "left")
    return (covered.withColumn("folio", F.coalesce("_own", "_group"))
            .where(F.col("folio").isNotNull())
            .drop("_folio", "_next", "_own", "_group"))


def _covered_amount() -> Column:
    return C.money_sum(F.coalesce("importe", F.col("monto_mxn_millones") * 1e6)).cast("double")


def complaints_by_company(covered: DataFrame) -> DataFrame:
    """Companies with filed complaints; their folios are rows of `company_folios`."""
    return covered.groupBy("rfc").agg(
        F.min("proveedor").alias("empresa"),
        F.min("inhabilitado_desde").alias("inhabilitada_desde"),
        F.max("hasta").alias("inhabilitada_hasta"),
        F.count("*").alias("contratos"), _covered_amount().alias("importe_mxn"),
        F.countDistinct("folio").alias("folios"))


def company_folios(covered: DataFrame) -> DataFrame:
    """The folios of each company, a row each, with what they cover."""
    return covered.groupBy("rfc", "folio").agg(
        F.count("*").alias("contratos"), _covered_amount().alias("importe_mxn"))


# ------------------------------------------------------------------ freshness

def freshness_limits(spark: SparkSession, now: dt.datetime) -> DataFrame:
    rows = [(name.format(year=now.year), days)
            for name, days in V.FRESHNESS_LIMITS.items()]
    return spark.createDataFrame(rows, "archivo string, limite_dias int")


def freshness(retrievals: DataFrame, limits: DataFrame,
              now: dt.datetime) -> DataFrame:
    """Age of every source against its limit; a missing source is stale.

    `now` and the retrieval times are compared as UTC.
    """
    moment = F.lit(int(now.replace(tzinfo=dt.timezone.utc).timestamp()))
    joined = retrievals.select("archivo", "descargado").join(
        limits, "archivo", "full_outer")
    age = F.floor((moment - F.unix_timestamp("descargado")) / 86400).cast("int")
    known = F.col("descargado").isNotNull()
    return joined.select(
        "archivo", F.date_format("descargado", "yyyy-MM-dd'T'HH:mm:ss")
        .alias("descargado"), age.alias("edad_dias"), "limite_dias",
        (known & F.coalesce(age <= F.col("limite_dias"), F.lit(True)))
        .alias("vigente"),
        F.when(~known, "fuente esperada sin descarga registrada").alias("nota"))


def newest_delivery(state_manifest: DataFrame, gazette: DataFrame) -> DataFrame:
    """State and gazette sources by their own newest timestamp."""
    state = state_manifest.agg(F.max("ts").alias("descargado")).select(
        F.lit("pnt/manifiesto.json").alias("archivo"), "descargado")
    index = gazette.agg(F.max("generado").alias("descargado")).select(
        F.lit("dof_circulares.json").alias("archivo"), "descargado")
    return state.unionByName(index).where(F.col("descargado").isNotNull())


def pending_deliveries(offered: DataFrame, ingested: DataFrame) -> DataFrame:
    """Deliveries never ingested, grown since, or with failed parts."""
    done = ingested.select("clave", F.col("filas").alias("_rows"),
                           F.col("fallidos").alias("_failed"))
    joined = offered.join(done, "clave", "left")
    reason = (F.when(F.col("_rows").isNull(), "nueva")
              .when(F.col("filas") > F.col("_rows"), "creció")
              .when(F.col("_failed") > 0, "partes fallidas"))
    return joined.withColumn("motivo", reason).where(
        F.col("motivo").isNotNull()).select("clave", "filas", "motivo")


def inventory(findings: Mapping[str, DataFrame]) -> DataFrame:
    """Name and record count of every finding."""
    rows = None
    for name, table in findings.items():
        part = table.agg(F.count("*").alias("filas")).select(
            F.lit(name).alias("nombre"), "filas")
        rows = part if rows is None else rows.unionByName(part)
    return rows
