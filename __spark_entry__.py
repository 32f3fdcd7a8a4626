"""Registered queries, each over the whole driver tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle
from contraluz.functions import columns as C
from contraluz.functions import fixed_values as V
from contraluz.operators import (ages, bunching, collusion, concentration,
                                 debarment, digits, fraud_list, modifications,
                                 other_buyer, state_layer)
from contraluz.operators import matching as M
from contraluz.plans import backtest, case_store, ledger, reports, signals
from contraluz.session import checkpoint_folder, few, stored
from contraluz.sources import contracts as contract_source
from contraluz.sources import driver_tables as D
from contraluz.sources import gazette, other, procedures, sanctions, sinks, states
from contraluz.sources.other import last_retrievals
from contraluz.streaming import monitor, rules, seen

try:  # the training-data operators can be left out
    import corpus_pipeline
    from contraluz.llm import queries as training
except ModuleNotFoundError as missing:
    if (missing.name or "") not in ("corpus_pipeline", "contraluz.llm"):
        raise  # another module is missing, which must not hide the queries
    training = None

Query = Callable[[SparkSession, str], DataFrame]

# thresholds that leave rows on the driver's tables
YOUNG = {"min_amount": 1e6}
ROTATION = {"min_contracts": 4}
RINGS = {"min_companies": oracle.RING_LEAST}
SPLITS = {"min_contracts": 2, "min_total": 1e6, "keys": ["institucion"]}
DIRECT = {"min_pct": 0.4}
THRESHOLDS = {"young": YOUNG, "rotation": ROTATION, "rings": RINGS,
              "splits": SPLITS, "direct": DIRECT, "over_cap": {}}
TODAY = dt.date(2002, 1, 1)
#: an age limit that the events' month shows
SEEN_DAYS = oracle.SEEN_DAYS


def _hits(spark: SparkSession, sf: str) -> DataFrame:
    return M.fraud_hits(D.contracts(spark, sf), D.efos(spark, sf))


def _barred(spark: SparkSession, sf: str) -> DataFrame:
    return M.debarment_hits(D.contracts(spark, sf), D.sfp(spark, sf))


def _aged(spark: SparkSession, sf: str) -> DataFrame:
    return ages.with_age(D.contracts(spark, sf))


def _archive(spark: SparkSession, sf: str) -> DataFrame:
    return fraud_list.archive_contracts(D.archive(spark, sf))


def _archive_hits(spark: SparkSession, sf: str) -> DataFrame:
    return fraud_list.archive_hits(_archive(spark, sf), D.efos(spark, sf))


def _contract_digits(contracts: DataFrame) -> DataFrame:
    return digits.digit_profile(contracts, "institucion", C.mxn_ok())


def _digits(spark: SparkSession, sf: str) -> DataFrame:
    return _contract_digits(D.contracts(spark, sf))


def _state_digits(spark: SparkSession, sf: str) -> DataFrame:
    return digits.digit_profile(D.states(spark, sf), "sujeto_obligado",
                                C.plausible_amount(), 200)


class Run:
    """Tables that one query reads several times, each stored once."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf
        self.efos, self.sfp = few(D.efos(spark, sf)), few(D.sfp(spark, sf))

    @cached_property
    def lines(self) -> DataFrame:
        """What contracts and state reports are made of: joined once, in narrow columns."""
        return stored(D.with_reports(self.spark, self.sf, D.sold(self.spark, self.sf)))

    @cached_property
    def contracts(self) -> DataFrame:
        return D.contracts(self.spark, self.sf, self.lines)

    @cached_property
    def states(self) -> DataFrame:
        """The state layer: texts of the reports that the lines name, made where they are read."""
        return D.states(self.spark, self.sf, self.lines)

    @cached_property
    def flags(self) -> DataFrame:
        return stored(signals.signal_flags(self.contracts, THRESHOLDS, self.wins))

    @cached_property
    def wins(self) -> DataFrame:
        """Tender wins of the offices that rotate, which is all that is read of them."""
        return stored(collusion.rotating_wins(self.contracts, **ROTATION))

    @property
    def archive_hits(self) -> DataFrame:
        rows = fraud_list.archive_contracts(D.archive(self.spark, self.sf, self.lines))
        return fraud_list.archive_hits(rows, self.efos)

    @property
    def fraud_hits(self) -> DataFrame:
        return M.fraud_hits(self.contracts, self.efos)

    @cached_property
    def during(self) -> DataFrame:
        return stored(debarment.during(
            M.debarment_hits(self.contracts, self.sfp)))

    @property
    def ensemble(self) -> DataFrame:
        return signals.supplier_ensemble(
            self.contracts, self.flags, self.efos, self.sfp)

    @property
    def state_debarred(self) -> DataFrame:
        return state_layer.debarred(self.states, self.sfp)

    @property
    def state_fraud(self) -> DataFrame:
        return state_layer.fraud_by_rfc(self.states, self.efos)

    @property
    def findings(self) -> dict[str, DataFrame]:
        return {
            "debarred_federal": self.during,
            "fraud_federal": fraud_list.detail(self.fraud_hits),
            "modifications": modifications.over_cap(self.contracts),
            "debarred_state": self.state_debarred,
            "fraud_state": self.state_fraud,
            "rotation": collusion.rotation_candidates(
                self.contracts, **ROTATION, wins=self.wins),
            "risk": self.ensemble,
            "state_concentration": state_layer.concentration(
                self.states, min_share=0.02)}

    @cached_property
    def evidence(self) -> DataFrame:
        return stored(ledger.without_links(ledger.evidence(self.findings)))

    @property
    def complaints(self) -> DataFrame:
        """Two institutions whose debarment cases count as filed."""
        return self.during.where(
            F.col("institucion").isin("NATION_1", "NATION_7")).select(
                "rfc", F.col("proveedor").alias("empresa"), "institucion",
                F.col("fecha_contrato").alias("fecha"),
                F.lit(None).cast("string").alias("folio"),
                F.col("direccion_anuncio").alias("url"))

    def cases(self, rows: DataFrame) -> DataFrame:
        return ledger.cases(rows, self.complaints)

    def scored(self, rows: DataFrame) -> DataFrame:
        """Folded cases are stored, as the score reads them twice."""
        return ledger.scored(stored(self.cases(rows)),
                             self.coverage, TODAY)

    @cached_property
    def coverage(self) -> DataFrame:
        return stored(state_layer.coverage(self.states))


def _over_cap(spark: SparkSession, sf: str) -> DataFrame:
    return modifications.over_cap(D.contracts(spark, sf))


def _p_rounded(table: DataFrame) -> DataFrame:
    return table.withColumn("p_value", C.round_sql(F.col("p_value"), 9))


def _state_concentration(spark: SparkSession, sf: str) -> DataFrame:
    return state_layer.concentration(D.states(spark, sf), min_share=0.02)


def _evaluate(run: Run) -> DataFrame:
    return backtest.evaluate(
        signals.with_composite(run.flags),
        backtest.supplier_universe(run.contracts),
        backtest.sanction_dates(run.efos, run.sfp))


def _detector_queries() -> dict[str, Query]:
    con = D.contracts
    return {
        "d01_sanity": lambda s, d: fraud_list.sanity(con(s, d)),
        "d01_by_status_year": lambda s, d: fraud_list.by_status_year(_hits(s, d)),
        "d01_after_definitive":
            lambda s, d: fraud_list.after_definitive(_hits(s, d)),
        "d01_top25": lambda s, d: fraud_list.top_definitive(_hits(s, d)),
        "d01_by_procedure": lambda s, d: fraud_list.by_procedure(_hits(s, d)),
        "d01_detail": lambda s, d: fraud_list.detail(_hits(s, d)),
        "d01h_universe":
            lambda s, d: fraud_list.archive_universe(_archive(s, d)),
        "d01h_by_status":
            lambda s, d: fraud_list.archive_by_status(_archive_hits(s, d)),
        "d01h_after_by_year":
            lambda s, d: fraud_list.archive_after_by_year(_archive_hits(s, d)),
        "d01h_top": lambda s, d: fraud_list.archive_top(_archive_hits(s, d)),
        "d01h_detail":
            lambda s, d: fraud_list.archive_detail(_archive_hits(s, d)),
        "d02_suppliers":
            lambda s, d: concentration.direct_suppliers(con(s, d), min_pct=40.0),
        "d02_institutions":
            lambda s, d: concentration.leaning_institutions(con(s, d)),
        "d02_dependence": lambda s, d: concentration.supplier_dependence(
            con(s, d), "nombre_uc", 1e6, 5, 0.25),
        "d02_flags": lambda s, d: concentration.direct_award_flags(
            con(s, d), **DIRECT),
        "d03_benford": lambda s, d: _p_rounded(
            digits.conformity(_digits(s, d), "institucion")),
        "d03_worst_digits": lambda s, d: digits.worst_group_digits(
            _digits(s, d), "institucion"),
        "d04_by_year": lambda s, d: ages.by_year(_aged(s, d), **YOUNG),
        "d04_top30": lambda s, d: ages.top_young(_aged(s, d), **YOUNG),
        "d04_age_by_class": lambda s, d: ages.age_by_class(_aged(s, d)),
        "d04_enrichment":
            lambda s, d: ages.enrichment(_aged(s, d), D.efos(s, d)),
        "d04_flags": lambda s, d: ages.young_flags(con(s, d), **YOUNG),
        "d05_universe":
            lambda s, d: debarment.universe(D.sfp(s, d), dt.date(1999, 6, 1)),
        "d05_by_year": lambda s, d: debarment.by_year(_barred(s, d)),
        "d05_during": lambda s, d: debarment.during(_barred(s, d)),
        "d05_detail": lambda s, d: debarment.detail(_barred(s, d)),
        "d06_rotation":
            lambda s, d: collusion.rotation_candidates(con(s, d), **ROTATION),
        "d06_rotation_members":
            lambda s, d: collusion.rotation_members(con(s, d), **ROTATION),
        "d06_rings": lambda s, d: collusion.rings(con(s, d), **RINGS),
        "d06_ring_members": lambda s, d: collusion.ring_members(
            con(s, d), **RINGS).withColumn("monto", F.col("monto").cast("double")),
        "d06_splits": lambda s, d: collusion.same_day_splits(con(s, d), **SPLITS),
        "d07_over_cap": _over_cap,
        "d07_total_increase":
            lambda s, d: modifications.total_increase(_over_cap(s, d)),
        "d08_other_buyer": lambda s, d: other_buyer.name_screen(
            D.utility(s, d), D.efos(s, d), D.sfp(s, d)),
        "d09_ensemble": lambda s, d: Run(s, d).ensemble,
        "d09_distribution":
            lambda s, d: signals.ensemble_distribution(
                Run(s, d).ensemble),
        "d10_coverage": lambda s, d: state_layer.coverage(D.states(s, d)),
        "d10_list_rfc":
            lambda s, d: state_layer.fraud_by_rfc(D.states(s, d), D.efos(s, d)),
        "d10_windows": lambda s, d: state_layer.debarred(
            D.states(s, d), D.sfp(s, d)).select(
                "estado_comprador", "sujeto_obligado", "proveedor", "rfc_norm",
                "fecha_efectiva", "importe", "tipo_monto", "nombre_sfp", "multa",
                "institucion_sancionadora", "inicio", "fin", "plazo_txt",
                "durante_inhabilitacion"),
        "d10_by_name":
            lambda s, d: state_layer.fraud_by_name(D.states(s, d), D.efos(s, d)),
        "d10_young": lambda s, d: state_layer.young(D.states(s, d), **YOUNG),
        "d10_concentration": _state_concentration,
        "d10_rings":
            lambda s, d: state_layer.rings(D.states(s, d), min_share=0.04),
        "d10_dedupe": lambda s, d: state_layer.dedupe(
            D.state_reports(s, d)).groupBy(
                "estado_comprador", "ejercicio", "formato").agg(
                    F.count("*").alias("contratos"),
                    C.money_sum("importe").cast("double").alias("importe")),
        "d11_bunching": lambda s, d: bunching.bunching(con(s, d)),
        "d12_benford": lambda s, d: _p_rounded(
            digits.conformity(_state_digits(s, d), "sujeto_obligado")),
        "d12_worst_digits": lambda s, d: digits.worst_group_digits(
            _state_digits(s, d), "sujeto_obligado"),
        "bt_signals": lambda s, d: Run(s, d).flags,
        "bt_composite": lambda s, d: signals.composite_flags(Run(s, d).flags),
        "bt_sanctions":
            lambda s, d: backtest.sanction_dates(D.efos(s, d), D.sfp(s, d)),
        "bt_universe": lambda s, d: backtest.supplier_universe(con(s, d)),
        "bt_evaluate": lambda s, d: _evaluate(Run(s, d)),
    }


def _raw_keys(spark: SparkSession, sf: str) -> DataFrame:
    line, rfc = F.col("l_linenumber"), F.col("rfc")
    dirty = (F.when(line == 1, F.concat(F.lit(" "), F.lower(rfc), F.lit(" ")))
             .when(line == 2, "").when(line == 3, "NA")
             .when(line == 4, "XAXX010101000")
             .when(line == 5, F.concat(F.substring(rfc, 1, 3), F.lit(" "),
                                       F.substring(rfc, 4, 20))).otherwise(rfc))
    region = D.table(spark, sf, "region")
    return D.sales(spark, sf).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("r_name").alias("estado"), dirty.alias("raw"))


def _canonical(spark: SparkSession, sf: str) -> DataFrame:
    rows = contract_source.canonical_contracts(D.raw_contracts(spark, sf))
    return rows.groupBy(
        "file_year", "tipo_monto", "moneda_efectiva", "estado_comprador").agg(
            F.count("*").alias("contratos"),
            F.count("fecha_efectiva").alias("con_fecha"),
            F.countDistinct("rfc_norm").alias("empresas"),
            F.min("fecha_efectiva").alias("desde"),
            F.max("fecha_constitucion_rfc").alias("joven"),
            C.money_sum("importe").cast("double").alias("importe"))


def _name_keys(spark: SparkSession, sf: str) -> DataFrame:
    key = C.name_norm("text")
    return D.facts(spark, sf, "documents").select(
        "doc_id", F.md5(key).alias("clave"), F.length(key).alias("largo"))


def _circulars(spark: SparkSession, sf: str) -> DataFrame:
    return gazette.circulars(D.gazette_notes(spark, sf))


def _recent(spark: SparkSession, sf: str) -> DataFrame:
    rows = _circulars(spark, sf).withColumns({
        "rfc": F.lit(None).cast("string"), "plazo_txt": F.lit(None).cast("string")})
    return gazette.recent_index(rows, dt.date(1999, 1, 1))


def _bodies(spark: SparkSession, sf: str) -> DataFrame:
    return D.facts(spark, sf, "pages").select(
        "page_id", F.md5(gazette.body_text("html")).alias("cuerpo"),
        gazette.body_rfc("html").alias("rfc"),
        gazette.body_term("html").alias("plazo_txt"))


def _fired(spark: SparkSession, sf: str, full: bool = False) -> DataFrame:
    return rules.fired_rules(
        D.procedures(spark, sf), D.procedure_records(spark, sf),
        D.awards(spark, sf), D.efos(spark, sf), D.sfp(spark, sf),
        _recent(spark, sf), big_mxn=5e6, full=full)


def _scores(spark: SparkSession, sf: str) -> DataFrame:
    codes = F.transform("codes", lambda c: F.format_string(
        "%s:%d", c["code"], c["n"]))
    return rules.assess(D.procedures(spark, sf), _fired(spark, sf)).select(
        "uuid", "numero", "score", "n_flags",
        F.coalesce(F.array_join(codes, ","), F.lit("")).alias("codes"))


def _alerts(spark: SparkSession, sf: str) -> DataFrame:
    rows = rules.assess(D.procedures(spark, sf), _fired(spark, sf)).withColumn(
        "change", F.lit("new"))
    return rules.alerts(rows, F.lit("2002-01-01"), threshold=4)


def _alert_table(spark: SparkSession, sf: str) -> DataFrame:
    return _alerts(spark, sf).select(
        "ts", "uuid", "nombre", "score", F.col("n_flags").alias("razones"),
        F.col("n_evidence").alias("senaladas"),
        "url", "change", "orden_gobierno", "estado_comprador")


SEEN_COLUMNS = ("uuid", "estatus", "ts", "event_id", "previous", "change", "first_seen")


def _seen_stream(spark: SparkSession, sf: str, **limits: float) -> DataFrame:
    """The stateful diff run over the event table until it is drained."""
    for key, value in seen.STATE_STORE.items():
        spark.conf.set(key, value)
    home = f"{checkpoint_folder(spark)}/seen-{uuid.uuid4().hex}"
    schema = D.table(spark, sf, "events").schema
    events = (spark.readStream.schema(schema)
              .option("pathGlobFilter", "events.parquet").parquet(sf))
    feed = events.select(F.col("user_id").cast("string").alias("uuid"),
                         F.col("event_type").alias("estatus"), "ts", "event_id")
    query = (seen.stream_changes(feed, **limits).writeStream.format("parquet")
             .option("path", f"{home}/changes")
             .option("checkpointLocation", f"{home}/checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.parquet(f"{home}/changes").withColumns({
        c: F.col(c).cast("timestamp_ntz") for c in ("ts", "first_seen")}).select(*SEEN_COLUMNS)


def _monitor_run(spark: SparkSession, sf: str) -> str:
    """Two polls of the monitor over landed pages; the folder it wrote.

    The second poll lands every procedure again, some with another status.
    """
    home = f"{checkpoint_folder(spark)}/monitor-{uuid.uuid4().hex}"
    rows = D.procedures(spark, sf)
    repealed = F.conv(F.substring("uuid", 1, 1), 16, 10).cast("int") < 4
    polls = (rows, rows.withColumn("estatus", F.when(
        repealed, "CANCELADO").otherwise(F.col("estatus"))))
    for poll in polls:
        procedures.as_pages(poll).write.mode("append").text(f"{home}/pages", compression="gzip")
        monitor.start_monitor(
            spark, f"{home}/pages", home, f"{home}/checkpoint",
            lambda s: (D.procedure_records(s, sf), D.awards(s, sf)),
            lambda s: (D.efos(s, sf), D.sfp(s, sf), _recent(s, sf)),
            threshold=4, interval=None, big_mxn=5e6).awaitTermination()
    return home


def _monitor_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return other.read_alerts(spark, _monitor_run(spark, sf)).select(
        "uuid", "nombre", "estatus", "score", F.col("n_flags").alias("razones"),
        F.col("n_evidence").alias("senaladas"), "url", "change", "orden_gobierno",
        "estado_comprador")


def _alert_rules(spark: SparkSession, sf: str) -> DataFrame:
    """The rules of the alerts, counted by text; texts of awards name their evidence."""
    alerts = _alerts(spark, sf)
    return rules.alert_rules(alerts, _fired(spark, sf, full=True)).groupBy(
        "code", "weight").agg(F.count("*").alias("reglas"),
                              F.countDistinct("uuid").alias("procedimientos"),
                              F.count("evidence.rfc").alias("con_rfc"))


def _case_table(spark: SparkSession, sf: str) -> DataFrame:
    run = Run(spark, sf)
    return run.cases(run.evidence).select(
        "case_id", "scope", "pattern", "ambito", "estado_geo", "rfc", "sujeto",
        "institucion", "procedure_uuid", "source_file", "monto", "n_contratos",
        "fecha", "ventana_ok", "ventanas", "already_filed", "content_hash")


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    run = Run(spark, sf)
    return run.scored(run.evidence)


def _score_table(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).select(
        "case_id", "pattern", "tier", "score", "recomendacion", "auto_ok",
        "already_filed", "corrobora")


def _routes(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).groupBy("pattern", "ambito", "autoridad").agg(
        F.count("*").alias("casos"))


def _merged(spark: SparkSession, sf: str) -> DataFrame:
    """A first scan, human decisions on some of its cases, a second scan."""
    run = Run(spark, sf)
    rows = run.evidence
    first = run.scored(rows.where("fecha < DATE '2000-01-01'"))
    snapshot = ledger.snapshot_of(
        ledger.merge(ledger.empty_snapshot(first), first, "t0"))
    mark = F.substring("case_id", 1, 1)
    decisions = first.select(
        "case_id", F.when(mark < "4", "descartado").when(mark < "8", "verificando")
        .alias("estado"), F.lit(None).cast("string").alias("nota"),
        F.lit(None).cast("string").alias("folio"), F.lit("t0").alias("decided_at"))
    decided = ledger.apply_decisions(snapshot, decisions)
    return ledger.merge(decided, run.scored(rows), "t1")


def _case_store(spark: SparkSession, sf: str) -> case_store.CaseStore:
    """A scan, human decisions, a compaction and a second scan, in a store of their own."""
    run = Run(spark, sf)
    rows = run.evidence
    first = run.scored(rows.where("fecha < DATE '2000-01-01'"))
    store = case_store.CaseStore(spark, f"{_home(spark)}-cases", first)
    store.scan(first, "t0")
    mark = F.substring("case_id", 1, 1)
    store.decide(first.select(
        "case_id", F.when(mark < "4", "descartado").when(mark < "8", "verificando")
        .alias("estado"), F.lit(None).cast("string").alias("nota"),
        F.lit(None).cast("string").alias("folio"), F.lit("t0").alias("decided_at")), "t0")
    store.compact()
    store.scan(run.scored(rows), "t1")
    return store


def _evidence_held(spark: SparkSession, sf: str) -> DataFrame:
    """Cases seen during a month in which their files are downloaded again and again."""
    kind = F.col("event_type")
    name = (F.when(kind == "view", V.LIST_FILES["69-B"])
            .when(kind == "click", V.LIST_FILES["SFP"])
            .otherwise(F.concat(F.lit("contratos_200"), F.length(kind).cast("string"),
                                F.lit(".csv"))))
    manifest = D.facts(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("retrieved_at"),
        F.md5(F.col("event_id").cast("string")).alias("sha256"),
        F.floor("value").cast("string").alias("bytes"), name.alias("file"))
    versions = stored(other.retrieval_versions(manifest))
    minutes = F.conv(F.substring("case_id", 1, 4), 16, 10).cast("int")
    run = Run(spark, sf)
    cases = run.evidence.groupBy("case_id").agg(F.min("source_file").alias("source_file"))
    seen = F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval(mins=minutes)
    held = ledger.evidence_held(cases.withColumn("seen", seen), versions,
                                stored(ledger.cited_sources(versions)))
    return held.withColumn("descargado", F.date_format("descargado", "yyyy-MM-dd HH:mm:ss"))


def _footprint(spark: SparkSession, sf: str) -> DataFrame:
    run = Run(spark, sf)
    return ledger.footprint({
        **run.findings, "young_state": state_layer.young(run.states, **YOUNG)})


def _alert_log(spark: SparkSession, sf: str) -> DataFrame:
    """The alerts of three polls, the last one with lower scores."""
    found = _alerts(spark, sf)
    return found.unionByName(found.where("estatus = 'VIGENTE'").withColumns({
        "ts": F.lit("2002-01-02"), "score": F.col("score") + 2})).unionByName(
            found.withColumns({"ts": F.lit("2002-01-03"), "score": F.col("score") - 1}))


def _alert_cases(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts of two polls taken into the case table."""
    found = _alerts(spark, sf).select("ts", "uuid", "numero", "nombre",
                                      "dependencia", "estatus", "score")
    first = found.where("estatus = 'ADJUDICADO'")
    later = found.where("score >= 6").withColumns({
        "ts": F.lit("2002-02-01"), "score": F.col("score") + 1})
    cases = first.where(F.lit(False)).select(
        "uuid", "numero", "nombre", "dependencia",
        F.col("score").alias("max_score"), *[
            F.lit(None).cast("string").alias(c) for c in (
                "estado", "nota", "first_seen", "last_alert", "updated_at")])
    log = first.where(F.lit(False))
    cases = ledger.ingest_alerts(cases, ledger.new_alerts(log, first))
    cases = ledger.ingest_alerts(cases, ledger.new_alerts(first, later))
    return cases.select("uuid", "nombre", "max_score", "estado", "first_seen",
                        "last_alert")


def _figures(run: Run) -> dict[str, DataFrame]:
    return {
        "fraud_by_status": fraud_list.by_status_year(run.fraud_hits),
        "archive_by_status": fraud_list.archive_by_status(run.archive_hits),
        "young_by_year": ages.by_year(ages.with_age(run.contracts)),
        "debarred_federal": run.during,
        "modifications": modifications.over_cap(run.contracts),
        "debarred_state": run.state_debarred,
        "fraud_state": run.state_fraud,
        "fraud_federal": fraud_list.detail(run.fraud_hits),
        "coverage": state_layer.coverage(run.states),
    }


def _headline(run: Run) -> DataFrame:
    return reports.headline_figures({
        **_figures(run), "backtest": _evaluate(run),
        "digits": digits.conformity(_contract_digits(run.contracts), "institucion")})


def _offices(run: Run) -> DataFrame:
    return reports.affected_offices(
        collusion.rotation_candidates(run.contracts, **ROTATION),
        collusion.rings(run.contracts, **RINGS),
        collusion.same_day_splits(run.contracts, 2, 1e6))


def _unified_debarred(run: Run) -> DataFrame:
    return reports.unified_debarred(
        debarment.during(M.debarment_hits(run.contracts, run.sfp)), run.state_debarred)


def _unified_fraud(run: Run) -> DataFrame:
    return reports.unified_fraud(fraud_list.detail(run.fraud_hits), run.state_fraud)


def _inventory(spark: SparkSession, sf: str) -> DataFrame:
    run = Run(spark, sf)
    return reports.inventory({
        "f01_detalle_completo": fraud_list.detail(run.fraud_hits),
        "f05_durante_inhabilitacion": run.during,
        "f07_convenios_inflados": modifications.over_cap(run.contracts),
        "f10_efos_estatal": run.state_fraud,
        "f06_anillos_constitucion": collusion.rings(run.contracts, **RINGS)})


def _freshness(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    name = (F.when(kind == "view", "sat_69b_completo.csv")
            .when(kind == "click", "sfp_sancionados.json")
            .when(kind == "error", "dof_circulares.json")
            .otherwise(F.concat(F.lit("otro_"), kind, F.lit(".csv"))))
    now = dt.datetime(2024, 2, 20)
    manifest = D.facts(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("retrieved_at"),
        F.lit("").alias("sha256"),
        F.floor("value").cast("string").alias("bytes"), name.alias("file"))
    return reports.freshness(last_retrievals(manifest),
                             reports.freshness_limits(spark, now), now)


def _pending(spark: SparkSession, sf: str) -> DataFrame:
    orders = D.table(spark, sf, "orders").withColumn(
        "clave", F.concat(F.lit("C"), F.col("o_custkey").cast("string")))
    done = orders.where("o_orderdate < TIMESTAMP_NTZ '1998-01-01'")
    return reports.pending_deliveries(
        orders.groupBy("clave").agg(F.count("*").alias("filas")),
        done.groupBy("clave").agg(
            F.count("*").alias("filas"),
            F.count_if(F.col("o_orderstatus") == "P").alias("fallidos")))


def _covered(spark: SparkSession, sf: str) -> DataFrame:
    """Filed drafts by name for one institution, by key alone for another."""
    during = stored(debarment.during(_barred(spark, sf)))
    named = stored(reports.case_names(during))
    number = F.conv(F.substring(F.md5("nombre_caso"), 1, 7), 16, 10)
    nota = F.concat(F.lit("SIDEC folio "), number, F.lit("/2001"))
    exact = named.where("institucion = 'NATION_1'").select(
        F.col("nombre_caso").alias("numero"), F.col("proveedor").alias("nombre"),
        F.lit("denunciado").alias("estado"), nota.alias("nota"))
    by_key = named.where("institucion = 'NATION_7'").select(
        F.lit("alerta").alias("numero"),
        F.concat_ws("", F.lit("Caso ("), "rfc", F.lit(")")).alias("nombre"),
        F.lit("denunciado").alias("estado"), nota.alias("nota"))
    return reports.complaints_with_folios(during, exact.unionByName(by_key))


def _home(spark: SparkSession) -> str:
    return f"{checkpoint_folder(spark)}/files-{uuid.uuid4().hex}"


def _laid_out(rows: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """The named columns in order, NULL where the rows have none."""
    return rows.select(*(F.col(n) if n in rows.columns else F.lit(None).cast("string").alias(n)
                         for n in names))


def _contract_files(spark: SparkSession, sf: str) -> DataFrame:
    """The federal layout written as quoted Latin text with line breaks, and read back."""
    title = F.concat(F.lit('OBRA "Ñ", '), F.trim("rfc"), F.lit("\nfase\n1"))
    raw = D.raw_contracts(spark, sf).withColumn("titulo_contrato", title)
    path = sinks.write_quoted(_laid_out(raw, V.CONTRACT_COLUMNS), _home(spark), "ISO-8859-1")
    rows = contract_source.read_contracts(spark, path)
    return rows.groupBy("tipo_monto", "moneda_efectiva", "estado_comprador").agg(
        F.count("*").alias("contratos"), F.count("fecha_efectiva").alias("con_fecha"),
        F.countDistinct("rfc_norm").alias("empresas"), F.min("fecha_efectiva").alias("desde"),
        F.max("fecha_constitucion_rfc").alias("joven"),
        C.money_sum("importe").cast("double").alias("importe"),
        F.countDistinct("titulo_contrato").alias("titulos"),
        F.sum(F.length("titulo_contrato")).alias("largo"),
        F.min(F.substring("titulo_contrato", 1, 10)).alias("titulo"))


def _fraud_file(spark: SparkSession, sf: str) -> DataFrame:
    """The fraud list in its layout, behind preamble rows, read back."""
    listed = D.efos(spark, sf).select(
        F.lower("rfc_norm").alias("rfc"), "nombre", "situacion",
        F.date_format("fecha_definitivo", "d/M/yyyy").alias("pub_dof_definitivos"),
        F.date_format("fecha_presunto", "dd/MM/yyyy").alias("pub_sat_presuntos"))
    preamble = spark.range(2).select(F.lit("Información").alias("rfc"))
    rows = _laid_out(listed, V.EFOS_COLUMNS).unionByName(_laid_out(preamble, V.EFOS_COLUMNS))
    return sanctions.read_efos(spark, sinks.write_quoted(rows, _home(spark), "ISO-8859-1"))


def _state_files(spark: SparkSession, sf: str) -> DataFrame:
    """State reports under two header variants, some rows too long, read back."""
    home, reports_ = _home(spark), D.state_reports(spark, sf)
    text = {"estado": "estado_comprador", "razon_social": "proveedor", "rfc": "rfc_norm",
            "monto_con_imp": "importe", "objeto": "objeto"}
    exact = reports_.withColumn("importe", F.col("importe").cast("decimal(18,2)"))
    raw = exact.select(*(F.col(text.get(n, n)).cast("string").alias(n) for n in (
        "estado", "id_entidad", "id_sujeto", "sujeto_obligado", "ejercicio",
        "tipo_procedimiento", "expediente", "num_contrato", "razon_social", "rfc",
        "monto_con_imp", "moneda", "objeto")), *(F.date_format(source, "dd/MM/yyyy").alias(n)
            for n, source in (("fecha_contrato", "fecha_efectiva"),
                              ("fecha_actualizacion", "fecha_actualizacion"))))
    late = F.col("id_entidad").cast("int") % 2 == 0
    for name, part, order in (("a", raw.where(late), raw.columns),
                              ("b", raw.where(~late), raw.columns[::-1])):
        titled = part.select(*(F.col(n).alias(f"{V.STATE_FIELDS[n].capitalize()} (nota)")
                               for n in order))
        sinks.write_quoted(titled, f"{home}/{name}")
    rows = states.typed_states(states.read_state_files(
        spark, [f"{home}/a", f"{home}/b"]), TODAY, min_year=1990)
    return rows.groupBy("estado_comprador", "ejercicio", "tipo_monto").agg(
        F.count("*").alias("contratos"), F.count("fecha_efectiva").alias("con_fecha"),
        F.count_if("rfc_valido").alias("validos"), F.countDistinct("proveedor").alias("empresas"),
        F.max("fecha_actualizacion").alias("hasta"), F.max("objeto").alias("objeto"),
        C.money_sum("importe").cast("double").alias("importe"))


def _layer_queries() -> dict[str, Query]:
    merged_columns = ("case_id", "estado", "first_seen", "last_seen",
                      "last_changed", "is_new", "changed")
    return {
        "canon_contracts": _canonical,
        "src_contracts": _contract_files,
        "src_efos": _fraud_file,
        "src_states": _state_files,
        "name_norm": _name_keys,
        "rfc_quality":
            lambda s, d: states.key_quality(_raw_keys(s, d), "raw", ["estado"]),
        "buyer_states": lambda s, d: D.procedures(s, d).groupBy(
            C.number_state("numero").alias("estado")).agg(
                F.count("*").alias("procedimientos")),
        "dof_parse": _circulars,
        "dof_recent": lambda s, d: _recent(s, d).select(
            "nombre_norm", "cod_nota", "fecha_dof", "quien"),
        "dof_bodies": _bodies,
        "rt_seen_diff": lambda s, d: seen.status_changes(D.feed(s, d)).select(*SEEN_COLUMNS),
        "rt_seen_expiry": lambda s, d: seen.status_changes(
            D.feed(s, d), max_age_days=SEEN_DAYS).select(*SEEN_COLUMNS),
        "rt_stream": _seen_stream,
        "rt_stream_expiry": lambda s, d: _seen_stream(s, d, max_age_days=SEEN_DAYS),
        "rt_monitor": _monitor_alerts,
        "rt_alert_rules": _alert_rules,
        "rt_best_alerts": lambda s, d: rules.best_alerts(_alert_log(s, d)).select(
            "ts", "uuid", "score"),
        "rt_rules": _scores,
        "rt_alerts": _alert_table,
        "lg_cases": _case_table,
        "lg_scored": _score_table,
        "lg_routes": _routes,
        "lg_merge": lambda s, d: _merged(s, d).select(*merged_columns),
        "lg_emissions": lambda s, d: ledger.emissions(_merged(s, d)),
        "lg_counters": lambda s, d: ledger.run_counters(_merged(s, d)),
        "lg_runs": lambda s, d: _case_store(s, d).runs(),
        "lg_history": lambda s, d: _case_store(s, d).history().where(
            "event <> 'actualizado'").select("run", "case_id", "at", "event", "estado",
                                             "first_seen", "last_changed"),
        "lg_decisions": lambda s, d: _case_store(s, d).snapshot().groupBy("estado").agg(
            F.count("*").alias("casos"), F.count("decided_at").alias("decididos"),
            F.min("first_seen").alias("desde")),
        "lg_evidence_chain": _evidence_held,
        "lg_case_list": lambda s, d: ledger.case_list(
            _scored(s, d), ambito="federal", tier="T1").select(
                "case_id", "pattern", "score", "recomendacion"),
        "rp_doubled": lambda s, d: reports.doubled_contracts(_over_cap(s, d)),
        "rp_largest": lambda s, d: modifications.largest(_over_cap(s, d)).select(
            "codigo_contrato", "rfc", "proveedor", "monto_ultimo_convenio"),
        "rp_without_tender": lambda s, d: reports.without_tender(
            state_layer.young(D.states(s, d), **YOUNG)),
        "lg_footprint": _footprint,
        "lg_name_candidates": lambda s, d: M.name_candidates(
            D.table(s, d, "supplier").withColumnRenamed("s_name", "razon_social"),
            D.efos(s, d), D.sfp(s, d)).drop("nombre_norm"),
        "lg_complaint_groups": lambda s, d: ledger.complaint_groups(
            debarment.during(_barred(s, d))),
        "lg_alert_cases": _alert_cases,
        "rp_figures": lambda s, d: _headline(Run(s, d)),
        "rp_derived_figures": lambda s, d: reports.derived_figures(_figures(Run(s, d))),
        "rp_unified_debarred": lambda s, d: _unified_debarred(Run(s, d)),
        "rp_unified_fraud": lambda s, d: _unified_fraud(Run(s, d)),
        "rp_offices": lambda s, d: _offices(Run(s, d)),
        "rp_status_distribution": lambda s, d: reports.status_distribution(
            fraud_list.detail(_hits(s, d))),
        "rp_by_supplier": lambda s, d: reports.sums_by_supplier(
            debarment.during(_barred(s, d))),
        "rp_inventory": _inventory,
        "rp_freshness": _freshness,
        "rp_pending": _pending,
        "rp_folios": lambda s, d: reports.company_folios(_covered(s, d)),
        "rp_complaints": lambda s, d: reports.complaints_by_company(_covered(s, d)),
    }


def entry(spark: SparkSession) -> DataFrame:
    """Contracts of listed firms by status and year, on the smallest tables."""
    return fraud_list.by_status_year(_hits(spark, "/root/testdata/sf0.001"))


def queries() -> dict[str, Query]:
    own = {**_detector_queries(), **_layer_queries()}
    if training is None:
        return own
    return {**own, **training.QUERIES, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    own = {name: oracle.statement(body) if not body.startswith("WITH ") else body
           for name, body in oracle.SQL.items()}
    return own if training is None else {**own, **training.SQL}
