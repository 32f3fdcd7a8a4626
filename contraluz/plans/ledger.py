"""Case ledger: findings to cases, gates, score, merge, decisions, evidence.

A case row carries aggregates only.  The contracts behind it stay in a long
evidence table, so a case of a huge supplier is never gathered in one row; the
set of its procedure ids enters the change hash as an order-free sum.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contraluz.functions import columns as C
from contraluz.functions import fixed_values as V
from contraluz.operators.matching import latest_per_key, parted
from contraluz.session import few, stored

EVIDENCE_SCHEMA = {
    "case_id": "string", "pattern": "string", "scope": "string",
    "ambito": "string", "estado_geo": "string", "rfc": "string",
    "sujeto": "string", "institucion": "string", "source_file": "string",
    "fecha": "date", "importe": "double", "n": "bigint", "uuid": "string",
    "url": "string", "en_ventana": "boolean", "ventana": "string",
    "desde": "string", "hasta": "string", "rfc_valido": "boolean",
    "definitivo_dof": "string", "pct_incremento": "double",
    "tope_legal_pct": "double", "n_senales": "int", "detalle": "string",
}


def _evidence(df: DataFrame, **values: Column) -> DataFrame:
    """One evidence row per contract (or per group finding) in common columns."""
    return df.select(*[
        values.get(name, F.lit(None)).cast(kind).alias(name)
        for name, kind in EVIDENCE_SCHEMA.items()])


def _window_columns(start: Column, end: Column, day: Column) -> dict[str, Column]:
    a, b = C.parse_moment(start), C.parse_moment(end)
    return {"en_ventana": C.inside_window(day, a, b),
            "ventana": F.concat_ws("/", F.coalesce(start, F.lit("")),
                                   F.coalesce(end, F.lit(""))),
            "desde": start, "hasta": end}


def from_debarred_federal(during: DataFrame) -> DataFrame:
    day, scope = C.parse_moment("fecha_contrato"), C.scope_of_order("orden_gobierno")
    federal = scope == "federal"
    buyer, state = F.col("institucion"), F.col("estado_comprador")
    key = F.when(federal, C.stable_case_id(
        F.lit("fed"), F.lit("inhabilitado"), F.col("rfc"), buyer)).otherwise(
            C.stable_case_id(F.lit("est"), F.lit("inhabilitado"), state, buyer,
                             F.col("rfc")))
    return _evidence(
        during, case_id=key, pattern=F.lit("inhabilitado"),
        scope=F.when(federal, "contrato").otherwise("estatal"), ambito=scope,
        estado_geo=F.when(~federal, state), rfc=C.rfc_norm("rfc"),
        sujeto=F.col("proveedor"), institucion=buyer,
        source_file=F.lit("f05_durante_inhabilitacion"), fecha=day,
        importe=F.coalesce("importe", F.lit(0.0)), n=F.lit(1),
        uuid=C.procedure_id("direccion_anuncio"),
        url=C.portal_url("direccion_anuncio"), detalle=F.col("tipo_procedimiento"),
        **_window_columns(F.col("inhabilitado_desde"), F.col("hasta"), day))


def from_debarred_state(hits: DataFrame) -> DataFrame:
    state, buyer = F.col("estado_comprador"), F.col("sujeto_obligado")
    rfc = C.rfc_norm("rfc_norm")
    return _evidence(
        hits.where("durante_inhabilitacion"),
        case_id=C.stable_case_id(F.lit("est"), F.lit("inhabilitado"), state,
                                 buyer, rfc),
        pattern=F.lit("inhabilitado"), scope=F.lit("estatal"),
        ambito=F.lit("estatal"), estado_geo=state, rfc=rfc,
        sujeto=F.col("proveedor"), institucion=buyer,
        source_file=F.lit("f10_inhabilitados_estatal"),
        fecha=F.col("fecha_efectiva"), importe=F.coalesce("importe", F.lit(0.0)),
        n=F.lit(1), url=F.coalesce("direccion_anuncio", F.lit("")),
        rfc_valido=F.col("rfc_valido"),
        detalle=F.col("institucion_sancionadora"),
        **_window_columns(C.iso_text("inicio"), C.iso_text("fin"),
                          F.col("fecha_efectiva")))


def from_fraud_federal(detail: DataFrame) -> DataFrame:
    rfc = C.rfc_norm("rfc")
    return _evidence(
        detail.where("situacion = 'Definitivo' AND firmado_despues_definitivo"),
        case_id=C.stable_case_id(F.lit("fed"), F.lit("efos"), rfc),
        pattern=F.lit("efos"), scope=F.lit("proveedor"), ambito=F.lit("federal"),
        rfc=rfc, sujeto=F.col("proveedor"), institucion=F.col("institucion"),
        source_file=F.lit("f01_detalle_completo"),
        fecha=C.parse_moment("fecha_contrato"),
        importe=F.coalesce("importe", F.lit(0.0)), n=F.lit(1),
        uuid=C.procedure_id("direccion_anuncio"),
        url=C.portal_url("direccion_anuncio"),
        definitivo_dof=F.col("definitivo_dof"))


def from_fraud_state(hits: DataFrame) -> DataFrame:
    state, buyer, rfc = (F.col("estado_comprador"), F.col("sujeto_obligado"),
                         C.rfc_norm("rfc"))
    return _evidence(
        hits.where("firmado_despues_definitivo AND importe_plausible"),
        case_id=C.stable_case_id(F.lit("est"), F.lit("efos"), state, buyer, rfc),
        pattern=F.lit("efos"), scope=F.lit("estatal"), ambito=F.lit("estatal"),
        estado_geo=state, rfc=rfc, sujeto=F.col("proveedor"), institucion=buyer,
        source_file=F.lit("f10_efos_estatal"),
        fecha=C.parse_moment("fecha_contrato"),
        importe=F.coalesce("importe", F.lit(0.0)), n=F.lit(1),
        url=F.coalesce("direccion_anuncio", F.lit("")),
        definitivo_dof=F.col("definitivo_dof"))


def from_modifications(table: DataFrame) -> DataFrame:
    """One case per (key, contract); of repeated rows the largest counts."""
    rfc = C.rfc_norm("rfc")
    code = F.coalesce("codigo_contrato", "num_contrato")
    keyed = table.withColumn("_id", C.stable_case_id(
        F.lit("fed"), F.lit("convenio"), rfc, code))
    order = [F.desc_nulls_last("monto_ultimo_convenio"),
             F.desc_nulls_last("pct_incremento"), F.col("fecha_contrato"),
             F.col("institucion"), F.col("direccion_anuncio")]
    # almost every contract has one row, which stays in place
    often, once = parted(keyed, ["_id"], 2)
    first = latest_per_key(often, ["_id"], order).unionByName(once)
    return _evidence(
        first, case_id=F.col("_id"), pattern=F.lit("convenio"),
        scope=F.lit("contrato"), ambito=F.lit("federal"), rfc=rfc,
        sujeto=F.col("proveedor"), institucion=F.col("institucion"),
        source_file=F.lit("f07_convenios_inflados"),
        fecha=C.parse_moment("fecha_contrato"),
        importe=F.coalesce("monto_ultimo_convenio", F.lit(0.0)), n=F.lit(1),
        uuid=C.procedure_id("direccion_anuncio"),
        url=C.portal_url("direccion_anuncio"),
        pct_incremento=F.coalesce("pct_incremento", F.lit(0.0)),
        tope_legal_pct=F.coalesce("tope_legal_pct", F.lit(0.0)),
        detalle=F.col("ley"))


def from_rotation(table: DataFrame) -> DataFrame:
    buyer, office = F.col("institucion"), F.col("nombre_uc")
    return _evidence(
        table, case_id=C.stable_case_id(F.lit("fed"), F.lit("rotacion"), buyer,
                                        office),
        pattern=F.lit("rotacion"), scope=F.lit("institucion"),
        ambito=F.lit("federal"), sujeto=office, institucion=buyer,
        source_file=F.lit("f06_rotacion_licitaciones"),
        importe=F.col("monto_mxn_millones") * 1e6, n=F.col("contratos"),
        detalle=F.col("proveedores"))


def from_risk(ensemble: DataFrame, min_signals: int = 4) -> DataFrame:
    rfc = C.rfc_norm("rfc")
    return _evidence(
        ensemble.where(F.col("n_senales") >= min_signals),
        case_id=C.stable_case_id(F.lit("fed"), F.lit("riesgo"), rfc),
        pattern=F.lit("riesgo"), scope=F.lit("proveedor"),
        ambito=F.lit("federal"), rfc=rfc, sujeto=F.col("proveedor"),
        source_file=F.lit("f12_riesgo_proveedor"),
        importe=F.coalesce("monto_mxn_millones", F.lit(0.0)) * 1e6,
        n=F.coalesce("contratos", F.lit(0)), n_senales=F.col("n_senales"),
        detalle=F.col("senales"))


def from_state_concentration(table: DataFrame) -> DataFrame:
    state, buyer, name = (F.col("estado_comprador"), F.col("sujeto_obligado"),
                          F.col("proveedor"))
    return _evidence(
        table.where(~C.placeholder_supplier("proveedor")),
        case_id=C.stable_case_id(F.lit("est"), F.lit("concentracion"), state,
                                 buyer, name),
        pattern=F.lit("concentracion"), scope=F.lit("estatal"),
        ambito=F.lit("estatal"), estado_geo=state, sujeto=name,
        institucion=buyer, source_file=F.lit("f10_concentracion_estatal"),
        importe=F.col("monto_mxn_millones") * 1e6, n=F.col("contratos"),
        detalle=F.col("pct_del_gasto_directo").cast("string"))


_ADAPTERS = {
    "debarred_federal": from_debarred_federal,
    "debarred_state": from_debarred_state,
    "fraud_federal": from_fraud_federal,
    "fraud_state": from_fraud_state,
    "modifications": from_modifications,
    "rotation": from_rotation,
    "risk": from_risk,
    "state_concentration": from_state_concentration,
}


def evidence(findings: Mapping[str, DataFrame]) -> DataFrame:
    """Long evidence of all findings at hand; absent findings add nothing."""
    rows = None
    for name, adapt in _ADAPTERS.items():
        if name not in findings:
            continue
        part = adapt(findings[name])
        rows = part if rows is None else rows.unionByName(part)
    if rows is None:
        raise ValueError(f"no finding given; known are {sorted(_ADAPTERS)}")
    return rows


# ------------------------------------------------------------- filed complaints

def filed_ids(complaints: DataFrame) -> DataFrame:
    return (complaints.select(C.procedure_id("url").alias("uuid"))
            .where(F.col("uuid").isNotNull()).dropDuplicates())


def filed_pairs(complaints: DataFrame) -> DataFrame:
    return complaints.select(
        "rfc", F.coalesce(C.name_norm("institucion"), F.lit(""))
        .alias("_buyer")).dropDuplicates()


def no_complaints(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [], "rfc string, empresa string, institucion string, fecha string, "
            "folio string, url string")


def _id_number(uuid: str) -> Column:
    """60 bits of an id's hash as an exact number for order-free sums."""
    return F.conv(F.substring(F.md5(uuid), 1, 15), 16, 10).cast("decimal(38,0)")


def _has_link() -> Column:
    return F.coalesce("url", F.lit("")) != ""


def without_links(rows: DataFrame) -> DataFrame:
    """Evidence with whether it has a link in place of the link, as `cases` reads it."""
    return rows.withColumn("_cited", _has_link()).drop("url")


def cases(rows: DataFrame, complaints: DataFrame) -> DataFrame:
    """Evidence folded to one row per case, with the already-filed test.

    Filed ids and pairs are looked up while they are few, so that neither evidence nor
    cases move for the test.
    """
    known = few(stored(filed_ids(complaints))).withColumn("_filed", F.lit(True))
    marked = rows.join(known, "uuid", "left")
    filed = F.col("_filed")
    cited = "_cited" if "_cited" in rows.columns else _has_link()
    # ids move as bytes; the least of them is the least of bytes and of other texts
    uuid = C.packed("uuid")
    folded = marked.groupBy(C.packed("case_id").alias("_case")).agg(
        *[F.min(c).alias(c) for c in (
            "scope", "pattern", "ambito", "estado_geo", "rfc", "sujeto",
            "institucion")],
        F.min(uuid["raw"]).alias("_raw"), F.min(uuid["text"]).alias("_text"),
        F.min("source_file").alias("source_file"),
        C.money_sum("importe").cast("double").alias("monto"),
        F.sum("n").alias("n_contratos"), F.max("fecha").alias("fecha"),
        F.min("desde").alias("desde"), F.max("hasta").alias("hasta"),
        F.bool_and("en_ventana").alias("ventana_ok"),
        # bounded: one debarment window per calendar day and key at most
        F.array_join(F.sort_array(F.collect_set("ventana")), ";")
        .alias("ventanas"),
        F.bool_or("rfc_valido").alias("_rfc_given"),
        F.min("definitivo_dof").alias("definitivo_dof"),
        F.max("pct_incremento").alias("pct_incremento"),
        F.max("tope_legal_pct").alias("tope_legal_pct"),
        F.max("n_senales").alias("n_senales"),
        F.min("detalle").alias("detalle"),
        F.bool_or(cited).alias("_cited"),
        F.coalesce(F.sum(_id_number("uuid")), F.lit(0).cast("decimal(38,0)"))
        .alias("_ids"),
        F.count("uuid").alias("_with_id"),
        F.count_if(F.col("uuid").isNotNull() & filed.isNull()).alias("_open_ids")).withColumns({
            "case_id": C.unpacked("_case"),
            "procedure_uuid": F.least(F.lower(F.hex("_raw")), F.col("_text"))}).drop(
                "_case", "_raw", "_text")
    first = known.withColumnsRenamed(
        {"uuid": "procedure_uuid", "_filed": "_first_filed"})
    pairs = few(stored(filed_pairs(complaints))).withColumn("_pair", F.lit(True))
    buyer = folded.withColumn(
        "_buyer", F.coalesce(C.name_norm("institucion"), F.lit("")))
    judged = (buyer.join(first, "procedure_uuid", "left")
              .join(pairs, ["rfc", "_buyer"], "left"))
    filed_case = (F.col("_first_filed").isNotNull()
                  | (F.col("_pair").isNotNull() & F.col("institucion").isNotNull())
                  | ((F.col("_with_id") > 0) & (F.col("_open_ids") == 0)))
    digest = F.sha1(F.concat_ws(
        "|", "scope", "pattern", F.coalesce("rfc", F.lit("")), "_buyer",
        F.col("monto").cast("decimal(24,2)").cast("string"),
        F.col("n_contratos").cast("string"), F.col("_ids").cast("string"),
        "ventanas"))
    return judged.withColumns({
        "already_filed": filed_case, "content_hash": digest}).drop(
            "_first_filed", "_pair", "_with_id", "_open_ids", "_ids", "_buyer")


# ------------------------------------------------------------- gates and score

def coverage_quality(coverage: DataFrame, scale: float = 100.0) -> DataFrame:
    """Best share of valid keys per state as 0..1.

    The coverage table holds percentages; `scale` turns them into shares.
    """
    return coverage.groupBy(C.name_norm("estado_comprador").alias("_state")).agg(
        (F.max("pct_rfc_valido") / scale).alias("_quality"))


def gated(case_rows: DataFrame, today: dt.date) -> DataFrame:
    """Hard and soft gates as a map, failed hard gates as quarantine list."""
    now, pattern = F.lit(today), F.col("pattern")
    dated = F.col("fecha").isNotNull()
    not_future = F.coalesce(F.col("fecha") <= now, F.lit(False))
    paid = F.col("monto") > 0
    valid = F.when(F.col("ambito") == "federal", C.rfc_valid("rfc")).otherwise(
        F.coalesce("_rfc_given", C.rfc_valid("rfc")))
    cited = F.col("procedure_uuid").isNotNull() | F.coalesce("_cited", F.lit(False))
    later = C.after("fecha", C.parse_moment("definitivo_dof"))
    over = F.coalesce(F.col("pct_incremento") > F.col("tope_legal_pct"), F.lit(False))

    def table(**gates: Column) -> Column:
        return F.create_map(*[
            x for name, value in gates.items() for x in (F.lit(name), value)])

    soft = {"rfc_valido": valid, "fuente_citable": cited}
    timed = {"fecha_presente": dated, "no_futura": not_future,
             "monto_positivo": paid}
    inside = F.coalesce("ventana_ok", F.lit(False))
    gates = (F.when(pattern == "inhabilitado",
                    table(**timed, ventana_ok=inside, **soft))
             .when(pattern == "efos", table(**timed, post_definitivo=later, **soft))
             .when(pattern == "convenio",
                   table(monto_positivo=paid, sobre_tope=over, **soft))
             .otherwise(table(monto_positivo=paid, **soft)))
    held = F.when(
        pattern.isin("inhabilitado", "efos", "convenio"),
        F.map_keys(F.map_filter("gates", lambda k, v: ~v & ~k.isin(
            "rfc_valido", "fuente_citable")))).otherwise(
                F.array().cast("array<string>"))
    with_gates = case_rows.withColumn("gates", gates).withColumn("_held", held)
    soft_ok = F.col("gates")["rfc_valido"] & F.col("gates")["fuente_citable"]
    return with_gates.withColumns({
        "cuarentena": F.array_join("_held", ","),
        "auto_ok": (F.size("_held") == 0) & soft_ok,
        "recomendacion": F.when(F.col("already_filed"), "suppress")
        .when(F.size("_held") > 0, "cuarentena").otherwise("revisar")})


def scored(case_rows: DataFrame, coverage: DataFrame, today: dt.date,
           coverage_scale: float = 100.0) -> DataFrame:
    """Tier, corroboration, score 0..100 and legal route of gated cases."""
    gated_rows = gated(case_rows, today)
    # one narrow row for a key: looked up while they are few, so that cases stay in place
    repeats = few(stored(case_rows.where(F.col("rfc") != "").groupBy("rfc").agg(
        (F.count("*") - 1).alias("corrobora"))))
    rows = (gated_rows.join(repeats, "rfc", "left")
            .withColumn("_state", C.name_norm("estado_geo"))
            .join(few(stored(coverage_quality(coverage, coverage_scale))), "_state", "left"))
    tiers = F.create_map(*[F.lit(x) for t in V.PATTERN_TIERS.items() for x in t])
    tier = F.coalesce(F.try_element_at(tiers, F.col("pattern")), F.lit("T3"))
    held = F.size("_held") > 0
    number = {True: F.lit(1.0), False: F.lit(0.0)}

    def one(test: Column) -> Column:
        return F.when(test, number[True]).otherwise(number[False])

    documents = (one(F.col("gates")["rfc_valido"])
                 + one(F.col("gates")["fuente_citable"])) / 2
    documents = F.when(F.col("pattern").isin("inhabilitado", "efos"),
                       (documents + one(~held)) / 2).otherwise(documents)
    size = F.least(F.lit(1.0), F.log10(F.greatest("monto", F.lit(1.0))) / 7)
    age = F.date_diff(F.lit(today), "fecha")
    recency = (F.when(age.isNull() | (age <= 365), F.lit(1.0)).otherwise(
        F.greatest(F.lit(0.3), 1 - (age - 365) / F.lit(1825.0))))
    quality = F.when(F.col("ambito") == "estatal", 0.7 + 0.3 * F.coalesce(
        "_quality", F.lit(0.6))).otherwise(1.0)
    support = 1 + 0.05 * F.least(F.coalesce("corrobora", F.lit(0)), F.lit(3))
    lead = 30 + 50 * size + F.when(
        F.col("pattern") == "riesgo", 5 * F.least(
            F.coalesce("n_senales", F.lit(4)) - 3, F.lit(4))).otherwise(0)
    base = F.when(tier == "T1", 100.0).otherwise(80.0)
    raw = F.when(tier == "T3", lead * quality * support).otherwise(
        base * documents * quality * (0.6 + 0.4 * size) * (0.7 + 0.3 * recency)
        * support)
    final = F.when(F.col("already_filed"), 0.0).when(held, raw * 0.4).otherwise(raw)
    graded = rows.withColumns({
        "tier": tier, "corrobora": F.coalesce("corrobora", F.lit(0)),
        "score": F.rint(F.least(F.lit(100.0), final)).cast("int")})
    return with_route(graded).drop(
        "_state", "_quality", "_held", "_rfc_given", "_cited")


def with_route(rows: DataFrame) -> DataFrame:
    """Authority and legal basis by pattern and scope.

    Falls back to the pattern's federal route, then to the default.
    """
    table = F.create_map(*[x for pattern, scope, who, law in V.LEGAL_ROUTES
                           for x in (F.lit(f"{pattern}/{scope}"), F.struct(
                               F.lit(who).alias("autoridad"),
                               F.lit(law).alias("fundamento")))])
    default = F.struct(F.lit(V.DEFAULT_ROUTE[0]).alias("autoridad"),
                       F.lit(V.DEFAULT_ROUTE[1]).alias("fundamento"))
    route = F.coalesce(
        F.try_element_at(table, F.concat_ws("/", "pattern", "ambito")),
        F.try_element_at(table, F.concat_ws("/", "pattern", F.lit("federal"))),
        default)
    return rows.withColumn("_route", route).withColumns({
        "autoridad": F.col("_route.autoridad"),
        "fundamento": F.col("_route.fundamento")}).drop("_route")


# ------------------------------------------------------- snapshot, merge, states

ENGINE_COLUMNS = (
    "scope", "pattern", "ambito", "estado_geo", "rfc", "sujeto", "institucion",
    "procedure_uuid", "source_file", "monto", "n_contratos", "tier", "score",
    "recomendacion", "auto_ok", "already_filed", "cuarentena", "content_hash")
#: what a scan refreshes in a standing row although its content hash is the same
REFRESHED = ("tier", "score", "recomendacion", "auto_ok", "already_filed", "cuarentena")
HUMAN_COLUMNS = {"estado": "string", "nota": "string", "folio": "string",
                 "first_seen": "string", "last_seen": "string",
                 "last_changed": "string", "decided_at": "string"}


def empty_snapshot(found: DataFrame) -> DataFrame:
    rows = found.where(F.lit(False)).select("case_id", *ENGINE_COLUMNS)
    return rows.withColumns({n: F.lit(None).cast(k) for n, k in HUMAN_COLUMNS.items()})


def merge(snapshot: DataFrame, found: DataFrame, now: str,
          keys: tuple[str, ...] = ("case_id",), seen_only: bool = False) -> DataFrame:
    """Next snapshot: engine columns refreshed, human columns never touched.

    Adds `is_new` and `changed` for the emission step, and `refreshed` where a value
    outside the content hash is other than it stood.  Columns stay apart, so those that
    nobody reads do not move.  `keys` may name what both sides are dealt by beside the id.
    `seen_only` leaves out the standing cases that were not found, and with them what
    standing rows say that the found ones say anew.
    """
    fresh = found.select(*keys, F.lit(True).alias("_seen"),
                         *[F.col(c).alias(f"_f_{c}") for c in ENGINE_COLUMNS])
    old = snapshot.select(*keys, F.lit(True).alias("_stood"), *HUMAN_COLUMNS,
                          *[F.col(c).alias(f"_o_{c}") for c in ENGINE_COLUMNS])
    joined = old.join(fresh, list(keys), "right" if seen_only else "full_outer")
    is_new, seen = F.col("_stood").isNull(), F.col("_seen").isNotNull()
    changed = ~is_new & seen & ~F.col("_o_content_hash").eqNullSafe(
        F.col("_f_content_hash"))
    other = F.lit(False)
    for name in REFRESHED:
        other = other | ~F.col(f"_o_{name}").eqNullSafe(F.col(f"_f_{name}"))
    engine = {c: F.col(f"_f_{c}") if seen_only else F.when(seen, F.col(f"_f_{c}")).otherwise(
        F.col(f"_o_{c}")) for c in ENGINE_COLUMNS}
    stamp = F.lit(now)
    return joined.select(
        *keys, *[value.alias(c) for c, value in engine.items()],
        F.when(is_new, "nuevo").otherwise(F.col("estado")).alias("estado"),
        "nota", "folio",
        F.when(is_new, stamp).otherwise(F.col("first_seen")).alias("first_seen"),
        F.when(seen, stamp).otherwise(F.col("last_seen")).alias("last_seen"),
        F.when(is_new | changed, stamp).otherwise(F.col("last_changed"))
        .alias("last_changed"), "decided_at",
        (is_new & seen).alias("is_new"), changed.alias("changed"),
        seen.alias("seen"), (~is_new & seen & other).alias("refreshed"))


def emissions(merged: DataFrame) -> DataFrame:
    """Cases that surface: new ones, and changed ones nobody resolved yet."""
    surfaced = merged.where(~F.col("already_filed") & (
        F.col("is_new") | (F.col("changed")
                           & F.col("estado").isin(*V.OPEN_STATES))))
    return surfaced.select("case_id", F.when(F.col("is_new"), "nuevo")
                           .otherwise("cambiado").alias("reason"), "score")


def run_counters(merged: DataFrame) -> DataFrame:
    live = ~F.col("already_filed")
    return merged.where("seen").agg(
        F.count("*").alias("scanned"),
        F.count_if(F.col("is_new") & live).alias("nuevos"),
        F.count_if(F.col("changed") & live).alias("cambiados"),
        F.count_if("already_filed").alias("suprimidos"))


def snapshot_of(merged: DataFrame) -> DataFrame:
    return merged.drop("is_new", "changed", "seen", "refreshed")


def valid_decision() -> Column:
    return F.coalesce(F.col("estado").isin(*V.CASE_STATES), F.lit(False))


def rejected_decisions(decisions: DataFrame, table: DataFrame,
                       key: str = "case_id") -> DataFrame:
    """Decisions with an unknown state or an unknown case, with the reason."""
    known = table.select(key, F.lit(True).alias("_known"))
    judged = decisions.join(known, key, "left")
    reason = (F.when(~valid_decision(), "estado inválido")
              .when(F.col("_known").isNull(), "caso desconocido"))
    return judged.withColumn("motivo", reason).where(
        F.col("motivo").isNotNull()).drop("_known")


def apply_decisions(table: DataFrame, decisions: DataFrame,
                    key: str | list[str] = "case_id", decided_only: bool = False) -> DataFrame:
    """State of the latest valid decision per case; note and folio of the latest
    one that gives them, else as they stand.  Decisions of one time are ordered
    by their values, so the result does not depend on the order of rows.  On demand
    only the cases with a valid decision are returned."""
    keys = [key] if isinstance(key, str) else key
    def latest(name: str) -> Column:
        order = F.when(F.col(name).isNotNull(), F.struct("decided_at", name))
        return F.max(order)[name].alias(f"_{name}")
    valid = decisions.where(valid_decision()).groupBy(*keys).agg(
        *[latest(name) for name in ("estado", "nota", "folio")],
        F.max("decided_at").alias("_decided_at"))
    joined = table.join(valid, keys, "inner" if decided_only else "left")
    names = [c for c in ("estado", "nota", "folio", "decided_at") if c in table.columns]
    return joined.withColumns({c: F.coalesce(f"_{c}", c) for c in names}).select(
        *table.columns)


def case_list(table: DataFrame, with_filed: bool = False,
              **equals: str | None) -> DataFrame:
    """Cases by estado, ambito, tier or recomendacion; filed ones hidden."""
    rows = table if with_filed else table.where(~F.col("already_filed"))
    for column, value in equals.items():
        if value is not None:
            rows = rows.where(F.col(column) == value)
    return rows


def review_order() -> list[Column]:
    """Tier first, then score, for presentation."""
    return [F.col("tier"), F.desc("score"), F.col("case_id")]


# --------------------------------------------------------------- alert to case

def new_alerts(log: DataFrame, alerts: DataFrame) -> DataFrame:
    """Alerts not yet logged; one per (procedure, time)."""
    rest = [c for c in alerts.columns if c not in ("uuid", "ts")]
    once = alerts.groupBy("uuid", "ts").agg(
        F.max(F.struct("score", *[c for c in rest if c != "score"]))
        .alias("_a")).select("uuid", "ts", "_a.*")
    return once.join(log.select("uuid", "ts"), ["uuid", "ts"], "left_anti")


def ingest_alerts(case_table: DataFrame, fresh: DataFrame) -> DataFrame:
    """Case table after new alerts; human state and note stay untouched."""
    first = F.min_by(F.struct("numero", "nombre", "dependencia"), "ts")
    summary = fresh.groupBy("uuid").agg(
        first.alias("_a"), F.max("score").alias("_score"),
        F.min("ts").alias("_first"), F.max("ts").alias("_last"))
    joined = case_table.join(summary, "uuid", "full_outer")
    return joined.select(
        "uuid", *[F.coalesce(c, f"_a.{c}").alias(c)
                  for c in ("numero", "nombre", "dependencia")],
        F.greatest("max_score", "_score").alias("max_score"),
        F.coalesce("estado", F.lit("nuevo")).alias("estado"), "nota",
        F.coalesce("first_seen", "_first").alias("first_seen"),
        F.coalesce("_last", "last_alert").alias("last_alert"),
        F.coalesce("_last", "updated_at").alias("updated_at"))


# ------------------------------------------------------- lookups and complaints

def footprint(findings: Mapping[str, DataFrame]) -> DataFrame:
    """Every contract or signal of every entity across the findings.

    Long form for all entities at once; filter by `rfc` or `nombre_norm`.
    """
    def part(name: str, origin: str, scope: str, day: str | None, amount: str,
             factor: float = 1.0, rfc: str | None = "rfc",
             buyer: str | None = "institucion", state: str | None = None):
        none = F.lit(None).cast("string")
        return findings[name].select(
            F.lit(origin).alias("origen"), F.lit(scope).alias("ambito"),
            (F.col(state) if state else none).alias("estado"),
            (F.col(buyer) if buyer else none).alias("institucion"),
            "proveedor", (C.rfc_norm(rfc) if rfc else none).alias("rfc"),
            (F.col(day).cast("string") if day else none).alias("fecha"),
            (F.col(amount).cast("double") * factor).alias("importe"))

    state = {"buyer": "sujeto_obligado", "state": "estado_comprador"}
    layout = {
        "debarred_federal": ("f05_durante_inhabilitacion", "federal",
                             "fecha_contrato", "importe", {}),
        "fraud_federal": ("f01_detalle_completo", "federal", "fecha_contrato",
                          "importe", {}),
        "modifications": ("f07_convenios_inflados", "federal",
                          "fecha_contrato", "monto_ultimo_convenio", {}),
        "risk": ("f12_riesgo_proveedor", "federal", None, "monto_mxn_millones",
                 {"factor": 1e6, "buyer": None}),
        "debarred_state": ("f10_inhabilitados_estatal", "estatal",
                           "fecha_efectiva", "importe",
                           {**state, "rfc": "rfc_norm"}),
        "fraud_state": ("f10_efos_estatal", "estatal", "fecha_contrato",
                        "importe", state),
        "young_state": ("f10_jovenes_estatal", "estatal", "fecha_contrato",
                        "importe", state),
        "state_concentration": ("f10_concentracion_estatal", "estatal", None,
                                "monto_mxn_millones",
                                {**state, "factor": 1e6, "rfc": None}),
    }
    rows = None
    for name, (origin, scope, day, amount, extra) in layout.items():
        if name in findings:
            piece = part(name, origin, scope, day, amount, **extra)
            rows = piece if rows is None else rows.unionByName(piece)
    if rows is None:
        raise ValueError(f"no finding given; known are {sorted(layout)}")
    return rows.withColumn("nombre_norm", C.name_norm("proveedor"))


def of_entity(rows: DataFrame, rfc: str | None = None,
              name: str | None = None) -> DataFrame:
    test = F.lit(False)
    if rfc:
        test = test | (F.col("rfc") == rfc.strip().upper())
    if name:
        test = test | (F.col("nombre_norm") == C.name_norm(F.lit(name)))
    return rows.where(F.coalesce(test, F.lit(False)))


def complaint_groups(during: DataFrame, bounded_only: bool = True,
                     excluded_ids: DataFrame | None = None) -> DataFrame:
    """Complaints per (key, institution); their contracts stay in long form."""
    rows = during.where(F.col("hasta").isNotNull()) if bounded_only else during
    if excluded_ids is not None:
        rows = rows.withColumn("uuid", C.procedure_id("direccion_anuncio")).join(
            excluded_ids.select("uuid"), "uuid", "left_anti")
    return rows.groupBy("rfc", "institucion").agg(
        F.min("proveedor").alias("proveedor"),
        F.min("inhabilitado_desde").alias("inhabilitado_desde"),
        F.max("hasta").alias("hasta"), F.count("*").alias("contratos"),
        C.money_sum(F.coalesce("importe", F.lit(0.0))).cast("double")
        .alias("total_mxn"))


def evidence_chain(case_rows: DataFrame, retrievals: DataFrame,
                   sources: DataFrame) -> DataFrame:
    """Downloaded files behind each case: (case_id, archivo, fecha, sha256).

    `sources` maps a source_file to the files it cites.
    """
    cited = case_rows.select("case_id", "source_file").join(
        sources, "source_file")
    return cited.join(retrievals, "archivo").select(
        "case_id", "archivo", "retrieved_at", "sha256")


def evidence_held(case_rows: DataFrame, versions: DataFrame,
                  sources: DataFrame) -> DataFrame:
    """The version of each cited file that was held when the case was seen.

    `case_rows` has (case_id, source_file, seen); `versions` a row for each retrieval of a
    file (`retrieval_versions`).  The version is the last one retrieved by then.  A file
    first retrieved later was not held and gives no row; one that is downloaded again
    later changes nothing.

    Each moment at which cases were seen is answered once for a file: it stands in the
    line of the file's retrievals, sorted inside hours, and the last version of an hour
    goes on to the hours behind it.
    """
    cited = case_rows.select("case_id", "source_file", "seen").join(sources, "source_file")
    moments = cited.select("archivo", "seen").distinct()
    version = F.struct("descargado", "sha256")
    line = versions.select(
        "archivo", F.col("descargado").alias("_at"), version.alias("_v")).unionByName(
            moments.select("archivo", F.col("seen").alias("_at"), "seen"),
            allowMissingColumns=True).withColumn("_hour", F.date_trunc("hour", "_at"))
    inside = Window.partitionBy("archivo", "_hour").orderBy(
        "_at", F.col("seen").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    across = Window.partitionBy("archivo").orderBy("_hour").rowsBetween(
        Window.unboundedPreceding, -1)
    opening = line.groupBy("archivo", "_hour").agg(F.max("_v").alias("_end")).select(
        "archivo", "_hour", F.last("_end", ignorenulls=True).over(across).alias("_earlier"))
    own = line.withColumn("_own", F.last("_v", ignorenulls=True).over(inside)).where(
        F.col("seen").isNotNull())
    held = stored(own.join(opening, ["archivo", "_hour"]).select(
        "archivo", "seen", F.coalesce("_own", "_earlier").alias("_held")).where(
            F.col("_held").isNotNull()))
    return cited.join(held, ["archivo", "seen"]).select(
        "case_id", "archivo", "_held.descargado", "_held.sha256",
        F.datediff("seen", "_held.descargado").alias("dias"))


def cited_sources(retrievals: DataFrame) -> DataFrame:
    """Files each finding cites; contract years come from the manifest."""
    retrievals = retrievals.select("archivo").distinct()
    years = retrievals.where(
        F.col("archivo").rlike(r"^contratos_\d{4}\.csv$")).select("archivo")
    lists = retrievals.where(F.col("archivo").isin(*V.LIST_FILES.values())).select(
        "archivo")
    by_file = {V.LIST_FILES["SFP"]: ["f05_durante_inhabilitacion",
                                     "f10_inhabilitados_estatal"],
               V.LIST_FILES["69-B"]: ["f01_detalle_completo", "f10_efos_estatal"]}
    listed = None
    for file, findings in by_file.items():
        part = lists.where(F.col("archivo") == file).select(
            F.explode(F.array(*[F.lit(f) for f in findings]))
            .alias("source_file"), "archivo")
        listed = part if listed is None else listed.unionByName(part)
    federal = ["f05_durante_inhabilitacion", "f01_detalle_completo",
               "f07_convenios_inflados", "f06_rotacion_licitaciones",
               "f12_riesgo_proveedor"]
    yearly = years.select(F.explode(F.array(*[F.lit(f) for f in federal]))
                          .alias("source_file"), "archivo")
    return yearly.unionByName(listed)
