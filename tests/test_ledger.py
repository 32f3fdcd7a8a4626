import datetime as dt

import pytest
from pyspark.sql import functions as F

from contraluz.plans import ledger, reports
from contraluz.sources import other
from tests.helpers import D

TODAY = D(2026, 6, 13)
UUID = "0123456789abcdef0123456789abcde"
DURING = """
    proveedor string, rfc string, inhabilitado_desde string, hasta string,
    fecha_contrato string, institucion string, orden_gobierno string,
    estado_comprador string, tipo_procedimiento string, importe double,
    monto_mxn_millones double, direccion_anuncio string
"""
COVERAGE = "estado_comprador string, ejercicio string, pct_rfc_valido double"


def link(n):
    return f"http://x/#/detalle/{UUID}{n}/procedimiento"


def during(spark, *rows):
    base = {"proveedor": "ACME", "rfc": "AAA101010AB1",
            "inhabilitado_desde": "2026-01-01", "hasta": "2027-01-01",
            "fecha_contrato": "2026-05-01", "institucion": "IMSS",
            "orden_gobierno": "APF", "importe": 1e6, "monto_mxn_millones": 1.0,
            "direccion_anuncio": link(1)}
    names = [c.split()[0] for c in DURING.split(",")]
    return spark.createDataFrame(
        [tuple({**base, **r}.get(n) for n in names) for r in rows], DURING)


def scored(spark, findings, complaints=None, coverage=()):
    rows = ledger.evidence(findings)
    filed = ledger.no_complaints(spark) if complaints is None else complaints
    return ledger.scored(ledger.cases(rows, filed),
                         spark.createDataFrame(list(coverage), COVERAGE), TODAY)


def filed(spark, *rows):
    return spark.createDataFrame(
        [(r, "e", i, None, None, u) for r, i, u in rows],
        "rfc string, empresa string, institucion string, fecha string, "
        "folio string, url string")


def test_case_grain_and_windows(spark):
    table = during(
        spark, {}, {"importe": 2e6, "fecha_contrato": "2026-06-01",
                    "direccion_anuncio": link(2)},
        {"inhabilitado_desde": "2020-01-01", "hasta": "2020-12-31",
         "fecha_contrato": "2020-05-05"},
        {"institucion": "ISSSTE", "orden_gobierno": "Gobierno del Estado de X",
         "estado_comprador": "X"})
    rows = {r["ambito"]: r for r in scored(spark, {"debarred_federal": table}).collect()}
    fed = rows["federal"]
    assert (fed["monto"], fed["n_contratos"], fed["fecha"]) == (4e6, 3, D(2026, 6, 1))
    assert (fed["desde"], fed["hasta"], fed["ventana_ok"]) == (
        "2020-01-01", "2027-01-01", True)
    assert fed["ventanas"] == "2020-01-01/2020-12-31;2026-01-01/2027-01-01"
    assert fed["tier"] == "T1" and fed["recomendacion"] == "revisar" and fed["auto_ok"]
    assert fed["corrobora"] == 1 and fed["autoridad"].startswith("SIDEC")
    assert rows["estatal"]["estado_geo"] == "X"
    assert rows["estatal"]["autoridad"].startswith("OIC / Contraloría")


@pytest.mark.parametrize("complaint", [
    ("ZZZ", "OTHER", link(1)), ("AAA101010AB1", "I.M.S.S.", None)])
def test_filed_cases_are_suppressed(spark, complaint):
    rfc, buyer, url = complaint
    buyer = "imss" if url is None else buyer
    row = scored(spark, {"debarred_federal": during(spark, {})},
                 filed(spark, (rfc, buyer, url))).first()
    assert row["already_filed"] and row["score"] == 0
    assert row["recomendacion"] == "suppress"


def test_partly_filed_ids_do_not_suppress(spark):
    table = during(spark, {}, {"direccion_anuncio": link(2)})
    row = scored(spark, {"debarred_federal": table},
                 filed(spark, ("Z", "Z", link(2)))).first()
    assert not row["already_filed"]
    row = scored(spark, {"debarred_federal": table},
                 filed(spark, ("Z", "Z", link(1)), ("Z", "Z", link(2)))).first()
    assert row["already_filed"]


def test_hard_gates_quarantine_and_soft_gates_do_not(spark):
    rows = scored(spark, {"debarred_federal": during(
        spark, {"institucion": "FUTURE", "fecha_contrato": "2026-12-01"},
        {"institucion": "OUTSIDE", "fecha_contrato": "2025-01-01"},
        {"institucion": "SOFT", "rfc": "BAD", "direccion_anuncio": "http://dead"})})
    found = {r["institucion"]: r for r in rows.collect()}
    assert found["FUTURE"]["cuarentena"] == "no_futura"
    assert found["OUTSIDE"]["cuarentena"] == "ventana_ok"
    assert found["FUTURE"]["recomendacion"] == "cuarentena"
    soft = found["SOFT"]
    assert soft["recomendacion"] == "revisar" and not soft["auto_ok"]
    assert soft["gates"]["rfc_valido"] is False


def test_score_formula(spark):
    row = scored(spark, {"debarred_federal": during(spark, {})}).first()
    size = 6 / 7
    assert row["score"] == round(100 * (0.6 + 0.4 * size))
    old = scored(spark, {"debarred_federal": during(
        spark, {"fecha_contrato": "2024-01-01", "inhabilitado_desde": "2023-01-01"})}
    ).first()
    recency = 0.7 + 0.3 * (1 - ((TODAY - D(2024, 1, 1)).days - 365) / 1825)
    assert old["score"] == round(100 * (0.6 + 0.4 * size) * recency)


def test_state_quality_and_leads(spark):
    conc = spark.createDataFrame(
        [("SINALOA", "SO", "ACME SA DE CV", 20, 10.0, 60.0),
         ("SINALOA", "SO", "NO APLICA", 20, 10.0, 60.0)],
        "estado_comprador string, sujeto_obligado string, proveedor string, "
        "contratos long, monto_mxn_millones double, pct_del_gasto_directo double")
    rows = scored(spark, {"state_concentration": conc},
                  coverage=[("Sinaloa", "2024", 50.0), ("Sinaloa", "2025", 80.0)])
    found = rows.collect()
    assert [(r["tier"], r["score"]) for r in found] == [
        ("T3", round((30 + 50 * 1.0) * (0.7 + 0.3 * 0.8)))]


def state_of(merged, column):
    return {r["institucion"]: r[column] for r in merged.collect()}


def test_merge_keeps_human_work_and_resurfaces_changes(spark):
    first = scored(spark, {"debarred_federal": during(
        spark, {}, {"institucion": "ISSSTE"}, {"institucion": "GONE"})})
    merged = ledger.merge(ledger.empty_snapshot(first), first, "t0")
    assert ledger.emissions(merged).count() == 3
    snapshot = ledger.snapshot_of(merged)
    ids = {r["institucion"]: r["case_id"] for r in snapshot.collect()}
    decisions = spark.createDataFrame(
        [(ids["IMSS"], "verificando", "mine", "7-2026", "d1"),
         (ids["ISSSTE"], "descartado", None, None, "d1"),
         (ids["GONE"], "bogus", None, None, "d1"), ("?", "nuevo", None, None, "d1")],
        "case_id string, estado string, nota string, folio string, decided_at string")
    bad = {r["motivo"] for r in ledger.rejected_decisions(decisions, snapshot).collect()}
    assert bad == {"estado inválido", "caso desconocido"}
    decided = ledger.apply_decisions(snapshot, decisions)
    silent = ledger.merge(decided, first, "t1")
    assert ledger.emissions(silent).count() == 0
    more = scored(spark, {"debarred_federal": during(
        spark, {}, {"importe": 5.0}, {"institucion": "ISSSTE", "importe": 2.0})})
    again = ledger.merge(decided, more, "t2")
    assert state_of(again, "estado") == {
        "IMSS": "verificando", "ISSSTE": "descartado", "GONE": "nuevo"}
    assert state_of(again, "last_changed") == {"IMSS": "t2", "ISSSTE": "t2", "GONE": "t0"}
    assert state_of(again, "last_seen")["GONE"] == "t0"
    assert state_of(again, "first_seen") == dict.fromkeys(ids, "t0")
    found = [(r["case_id"], r["reason"]) for r in ledger.emissions(again).collect()]
    assert found == [(ids["IMSS"], "cambiado")]
    assert tuple(ledger.run_counters(again).first()) == (2, 0, 2, 0)
    imss = again.where("institucion = 'IMSS'").first()
    assert (imss["nota"], imss["folio"]) == ("mine", "7-2026")
    listed = ledger.case_list(ledger.snapshot_of(again), estado="verificando")
    assert [r["institucion"] for r in listed.collect()] == ["IMSS"]
    assert [r["tier"] for r in listed.orderBy(*ledger.review_order()).collect()] == ["T1"]


def test_alert_ingest_is_idempotent(spark):
    schema = "uuid string, ts string, numero string, nombre string, dependencia string, score int"
    alerts = spark.createDataFrame(
        [("u", "t1", "N", "n", "d", 3), ("u", "t1", "N", "n", "d", 3),
         ("u", "t2", "N", "n", "d", 2)], schema)
    empty = spark.createDataFrame([], schema)
    cases = spark.createDataFrame(
        [("u", "N", "n", "d", 5, "verificado", "mine", "t0", "t0", "t0")],
        "uuid string, numero string, nombre string, dependencia string, max_score int, "
        "estado string, nota string, first_seen string, last_alert string, "
        "updated_at string")
    fresh = ledger.new_alerts(empty, alerts)
    assert fresh.count() == 2 and ledger.new_alerts(alerts, alerts).count() == 0
    row = ledger.ingest_alerts(cases, fresh).first()
    assert (row["max_score"], row["estado"], row["nota"], row["first_seen"],
            row["last_alert"]) == (5, "verificado", "mine", "t0", "t2")


def test_footprint_and_complaint_groups(spark):
    table = during(spark, {}, {"hasta": None, "institucion": "OPEN"},
                   {"proveedor": "Acme", "direccion_anuncio": link(9)})
    rows = ledger.footprint({"debarred_federal": table})
    assert ledger.of_entity(rows, rfc=" aaa101010ab1 ").count() == 3
    assert ledger.of_entity(rows, name="ACMÉ S.A. de C.V.").count() == 3
    assert ledger.of_entity(rows).count() == 0
    groups = ledger.complaint_groups(
        table, excluded_ids=spark.createDataFrame([(UUID + "9",)], "uuid string"))
    assert [(g["institucion"], g["contratos"], g["total_mxn"])
            for g in groups.collect()] == [("IMSS", 1, 1e6)]


def test_evidence_chain(spark):
    retrievals = spark.createDataFrame(
        [("contratos_2026.csv", "2026-06-01", "aa"),
         ("sfp_sancionados.json", "2026-06-01", "bb"), ("other.csv", "2026-06-01", "cc")],
        "archivo string, retrieved_at string, sha256 string")
    cases = scored(spark, {"debarred_federal": during(spark, {})})
    chain = ledger.evidence_chain(cases, retrievals, ledger.cited_sources(retrievals))
    assert sorted(r["archivo"] for r in chain.collect()) == [
        "contratos_2026.csv", "sfp_sancionados.json"]


def test_folios_reach_their_whole_group(spark):
    table = during(
        spark, {"importe": 3.0}, {"importe": 2.0}, {"fecha_contrato": "2026-05-02"},
        {"institucion": "ISSSTE", "fecha_contrato": "2026-05-03"},
        {"rfc": "BBB101010AB1", "institucion": "X"})
    names = {r["nombre_caso"] for r in reports.case_names(table).collect()}
    assert "inhabilitado_AAA101010AB1_2026-05-01-2" in names
    cases = spark.createDataFrame(
        [("inhabilitado_AAA101010AB1_2026-05-01", "x", "denunciado",
          "SIDEC folio 1/2026"), ("L", "Caso (AAA101010AB1)", "denunciado",
                                  "SIDEC folio 2/2026"),
         ("M", "Caso (BBB101010AB1)", "verificado", "SIDEC folio 3/2026")],
        "numero string, nombre string, estado string, nota string")
    covered = reports.complaints_with_folios(table, cases)
    found = {(r["nombre_caso"][-4:], r["folio"]) for r in covered.collect()}
    assert found == {("5-01", "1-2026"), ("01-2", "2-2026"), ("5-02", "2-2026")}
    company = reports.complaints_by_company(covered).first()
    assert (company["contratos"], company["folios"]) == (3, 2)
    by_folio = reports.company_folios(covered).collect()
    assert {r["folio"] for r in by_folio} == {"1-2026", "2-2026"}
    assert sum(r["contratos"] for r in by_folio) == 3


def test_figures_and_ranges(spark):
    status = spark.createDataFrame(
        [("Definitivo", 10.5), ("Definitivo", 1.0), ("Presunto", 9.0)],
        "situacion string, monto_mxn_millones double")
    row = reports.headline_figures({"fraud_by_status": status}).first()
    assert row["d01_monto"] == 11.5 and row["d07_n"] == 0.0
    days = spark.createDataFrame([("2010-01-01",), ("2023-05-01",), (None,)], "d string")
    assert reports.year_range(days, "d").first()[0] == "2010–2023"
    assert reports.year_range(days.where("d < '2011'"), "d").first()[0] == "2010"
    assert reports.year_range(days.where("d IS NULL"), "d").first()[0] == "—"
    over = spark.createDataFrame([(150.0,), (25.0,)], "pct_incremento double")
    assert reports.doubled_contracts(over).first()["al_doble"] == 1
    young = spark.createDataFrame([("LICITACIÓN",), (None,)], "tipo_procedimiento string")
    assert reports.without_tender(young).first()["pct_sin_licitacion"] == 50.0


def test_freshness_and_pending(spark):
    now = dt.datetime(2026, 6, 12)
    last = spark.createDataFrame(
        [("sat_69b_completo.csv", dt.datetime(2026, 6, 1), "a"),
         ("sfp_sancionados.json", dt.datetime(2026, 6, 1), "b"),
         ("contratos_2020.csv", dt.datetime(2020, 6, 1), "c")],
        "archivo string, descargado timestamp, sha256 string")
    rows = {r["archivo"]: r for r in reports.freshness(
        last, reports.freshness_limits(spark, now), now).collect()}
    assert rows["sat_69b_completo.csv"]["vigente"]
    assert not rows["sfp_sancionados.json"]["vigente"]
    assert rows["sfp_sancionados.json"]["edad_dias"] == 11
    assert rows["contratos_2020.csv"]["vigente"]
    assert rows["contratos_2026.csv"]["nota"] and not rows["contratos_2026.csv"]["vigente"]
    offered = spark.createDataFrame(
        [("a", 5), ("b", 5), ("c", 5), ("d", 5)], "clave string, filas long")
    done = spark.createDataFrame(
        [("b", 4, 0), ("c", 5, 1), ("d", 5, 0)], "clave string, filas long, fallidos long")
    found = reports.pending_deliveries(offered, done).collect()
    assert {(r["clave"], r["motivo"]) for r in found} == {
        ("a", "nueva"), ("b", "creció"), ("c", "partes fallidas")}


def test_offices_are_counted_once(spark):
    a = spark.createDataFrame([("I", "U"), ("I", "V")], "institucion string, nombre_uc string")
    assert reports.affected_offices(a, a.where(F.col("nombre_uc") == "U")).first()[0] == 2


def test_evidence_is_the_version_held_when_the_case_was_seen(spark):
    manifest = spark.createDataFrame(
        [("2026-01-01T00:00:00Z", "a", "5", "sfp_sancionados.json"),
         ("2026-02-01T00:00:00Z", "b", "5", "sfp_sancionados.json"),
         ("2026-03-01T00:00:00Z", "c", "0", "sfp_sancionados.json"),
         ("junk", "d", "5", "sfp_sancionados.json"),
         ("2026-02-15T00:00:00Z", "e", "5", "contratos_2025.csv")],
        "retrieved_at string, sha256 string, bytes string, file string")
    versions = other.retrieval_versions(manifest)
    sources = ledger.cited_sources(versions)
    seen = [("before", dt.datetime(2025, 12, 31)), ("first", dt.datetime(2026, 1, 1)),
            ("between", dt.datetime(2026, 2, 14)), ("after", dt.datetime(2026, 4, 1))]
    cases = spark.createDataFrame(
        [(c, "f05_durante_inhabilitacion", t) for c, t in seen],
        "case_id string, source_file string, seen timestamp")
    found = {(r["case_id"], r["archivo"][:3]): (r["sha256"], r["dias"])
             for r in ledger.evidence_held(cases, versions, sources).collect()}
    assert found == {("first", "sfp"): ("a", 0), ("between", "sfp"): ("b", 13),
                     ("after", "sfp"): ("b", 59), ("after", "con"): ("e", 45)}


def test_a_scan_writes_only_what_changed(spark, tmp_path):
    from contraluz.plans import case_store

    def found(rows):
        return spark.createDataFrame(
            [("f", "efos", "federal", None, None, "s", "i", None, "x", float(m), 1, "T2", score,
              "revisar", True, False, [], f"h{m}", f"case{i}") for i, m, score in rows],
            "scope string, pattern string, ambito string, estado_geo string, rfc string, "
            "sujeto string, institucion string, procedure_uuid string, source_file string, "
            "monto double, n_contratos long, tier string, score int, recomendacion string, "
            "auto_ok boolean, already_filed boolean, cuarentena array<string>, "
            "content_hash string, case_id string")

    many = [(i, 1, 50) for i in range(200)]
    store = case_store.CaseStore(spark, str(tmp_path / "store"), found(many), buckets=32)
    assert store.snapshot().count() == 0 and store.compact() == []
    store.scan(found(many), "t1")
    assert store.buckets_of(1).count() == 32 and len(store.compact()) == 32
    base = {p.parent.name: p.name for p in (tmp_path / "store" / "base").rglob("*.parquet")}
    store.decide(spark.createDataFrame(
        [("case3", "verificando", "n", None, "d"), ("case4", "bogus", None, None, "d"),
         ("nobody", "descartado", None, None, "d")],
        "case_id string, estado string, nota string, folio string, decided_at string"), "t2")
    # one case changes its content, one its score alone, one is new
    store.scan(found([(3, 2, 50), (4, 1, 60), *many[5:], (500, 1, 50)]), "t3")
    assert store.buckets_of(3).count() <= 3
    now = {r["case_id"]: r for r in store.snapshot().collect()}
    assert len(now) == 201
    assert (now["case3"]["estado"], now["case3"]["nota"], now["case3"]["monto"]) == (
        "verificando", "n", 2.0)
    assert (now["case4"]["estado"], now["case4"]["score"], now["case4"]["last_changed"]) == (
        "nuevo", 60, "t1")
    assert now["case0"]["first_seen"] == "t1" and now["case500"]["first_seen"] == "t3"
    events = {(r["case_id"], r["run"]): r["event"] for r in store.history().collect()}
    assert [events.get(("case3", n)) for n in (1, 2, 3)] == ["nuevo", "decidido", "cambiado"]
    assert events["case4", 3] == "actualizado" and ("case9", 3) not in events
    assert {(r["case_id"], r["motivo"]) for r in store.rejected().collect()} == {
        ("case4", "estado inválido"), ("nobody", "caso desconocido")}
    assert {(r["case_id"], r["reason"]) for r in store.emissions(3).collect()} == {
        ("case3", "cambiado"), ("case500", "nuevo")}
    before = store.snapshot().orderBy("case_id").collect()
    touched = store.compact()
    assert 1 <= len(touched) <= 4 and store.snapshot().orderBy("case_id").collect() == before
    after = {p.parent.name: p.name for p in (tmp_path / "store" / "base").rglob("*.parquet")}
    assert {b for b in base if base[b] != after[b]} <= {f"bucket={b}" for b in touched}
    assert [r["scanned"] for r in store.runs().orderBy("run").collect()] == [200, None, 198]


def test_a_run_without_its_record_does_not_show(spark, tmp_path, monkeypatch):
    from contraluz.plans import case_store
    rows = spark.createDataFrame([("c1", "h")], "case_id string, content_hash string")
    for name in ledger.ENGINE_COLUMNS:
        if name != "content_hash":
            kind = {"score": "int", "monto": "double", "n_contratos": "long", "auto_ok": "boolean",
                    "already_filed": "boolean", "cuarentena": "array<string>"}.get(name, "string")
            value = F.lit(False) if kind == "boolean" else F.lit(None)
            rows = rows.withColumn(name, value.cast(kind))
    store = case_store.CaseStore(spark, str(tmp_path), rows, buckets=2)
    with monkeypatch.context() as patched:
        patched.setattr(store, "_finish", lambda *_: (_ for _ in ()).throw(OSError("killed")))
        try:
            store.scan(rows, "t1")
        except OSError:
            pass
    assert store.snapshot().count() == store.history().count() == store.runs().count() == 0
    assert store.scan(rows, "t2") == 1 and store.snapshot().first()["first_seen"] == "t2"


def test_versions_of_a_file_are_rows_and_answer_across_hours(spark):
    manifest = spark.createDataFrame(
        [(f"2026-01-01T0{h}:{m:02d}:00Z", f"{h}-{m}", "5", "sfp_sancionados.json")
         for h in (1, 4) for m in range(0, 60, 7)],
        "retrieved_at string, sha256 string, bytes string, file string")
    versions = other.retrieval_versions(manifest)
    assert versions.count() == 18 and "versiones" not in versions.columns
    seen = [("early", 0, 59), ("at", 1, 7), ("behind", 1, 13), ("later", 3, 30), ("next", 4, 0)]
    cases = spark.createDataFrame(
        [(c, "f05_durante_inhabilitacion", dt.datetime(2026, 1, 1, h, m)) for c, h, m in seen],
        "case_id string, source_file string, seen timestamp")
    held = ledger.evidence_held(cases, versions, ledger.cited_sources(versions))
    assert {r["case_id"]: r["sha256"] for r in held.collect()} == {
        "at": "1-7", "behind": "1-7", "later": "1-56", "next": "4-0"}


def test_a_bucket_of_the_log_is_few_files(spark, tmp_path):
    from contraluz.plans import case_store
    rows = spark.range(4000).select(
        F.col("id").cast("string").alias("case_id"),
        *(F.lit(None).cast("string").alias(c) for c in ledger.ENGINE_COLUMNS)).repartition(16)
    store = case_store.CaseStore(spark, str(tmp_path / "cases"), rows, buckets=4)
    store._write_log(rows.withColumn("event", F.lit("nuevo")), 1, "t0")
    assert len(list((tmp_path / "cases" / "log").rglob("*.parquet"))) == 4


def test_filed_ids_and_repeated_keys_move_no_case(spark):
    """Evidence moves once, to be folded; cases do not move to be judged and scored."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(50).select(*(
            F.concat(F.lit("c"), F.col("id") % 7).alias(name) if name == "case_id"
            else F.lit(1).cast(kind).alias(name) if name in ("importe", "n")
            else F.concat(F.lit("u"), F.col("id")).alias(name) if name == "uuid"
            else F.lit("R").alias(name) if name == "rfc"
            else F.lit(None).cast(kind).alias(name)
            for name, kind in ledger.EVIDENCE_SCHEMA.items()))
        folded = ledger.cases(rows, ledger.no_complaints(spark))
        scored = ledger.scored(folded, spark.createDataFrame(
            [("E", 50.0)], "estado_comprador string, pct_rfc_valido double"), dt.date(2026, 1, 1))
        plan = scored._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning(") == 1
        assert {(r["case_id"], r["n_contratos"], r["corrobora"]) for r in scored.collect()} == {
            (f"c{i}", 8 if i == 0 else 7, 6) for i in range(7)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _bare_cases(spark, n):
    kinds = {"score": "int", "monto": "double", "n_contratos": "long", "auto_ok": "boolean",
             "already_filed": "boolean", "cuarentena": "string"}
    return spark.range(n).select(
        F.concat(F.lit("case"), "id").alias("case_id"), *(
            (F.lit(False) if kinds.get(c) == "boolean" else F.lit("1")).cast(
                kinds.get(c, "string")).alias(c) for c in ledger.ENGINE_COLUMNS))


def test_a_merge_moves_only_columns_that_are_read(spark):
    found = _bare_cases(spark, 5)
    merged = ledger.merge(ledger.snapshot_of(ledger.merge(
        ledger.empty_snapshot(found), found, "t0")), found, "t1")
    plan = ledger.emissions(merged)._jdf.queryExecution().optimizedPlan().toString()
    assert "institucion" not in plan and "procedure_uuid" not in plan


def test_cases_move_once_for_each_write_of_the_store(spark, tmp_path):
    """A lone run or base is read as it stands; rows dealt by bucket are written as they lie."""
    from contraluz.plans import case_store
    found = _bare_cases(spark, 400)
    store = case_store.CaseStore(spark, str(tmp_path / "s"), found, buckets=4)
    store.scan(found, "t0")
    assert "Window" not in store.snapshot()._jdf.queryExecution().optimizedPlan().toString()
    assert store.snapshot().count() == 400
    store.decide(found.where("case_id < 'case2'").select(
        "case_id", F.lit("verificando").alias("estado"), F.lit(None).cast("string").alias("nota"),
        F.lit(None).cast("string").alias("folio"), F.lit("d").alias("decided_at")), "t1")
    decided = found.where("case_id < 'case2'").count()
    assert store.snapshot().where("estado = 'verificando'").count() == decided
    assert len(list((tmp_path / "s" / "log").rglob("*.parquet"))) == 8
    assert len(store.compact()) == 4
    assert len(list((tmp_path / "s" / "base").rglob("*.parquet"))) == 4
    assert "Window" not in store.snapshot()._jdf.queryExecution().optimizedPlan().toString()
    assert store.snapshot().count() == 400
    # a compaction that stopped before its record: base and log are compared again
    (tmp_path / "s" / "compactions").rename(tmp_path / "s" / "unfinished")
    assert store.snapshot().count() == 400
    assert store.snapshot().where("estado = 'verificando'").count() == decided
    store.scan(found, "t2")
    assert [(r["scanned"], r["nuevos"], r["cambiados"])
            for r in store.runs().orderBy("run").collect()] == [
        (400, 400, 0), (None, None, None), (400, 0, 0)]


def test_ids_move_as_bytes_and_come_back(spark):
    """Hexadecimal ids and others; the least id of a case is that of the texts."""
    from contraluz.functions import columns as C
    texts = ["0" * 32, "ab" * 16, "AB" * 16, "abc", "", "u-1", None, "9f" * 20]
    table = spark.createDataFrame([(t,) for t in texts], "t string")
    packed = table.select("t", C.packed("t").alias("p"))
    assert packed.where("p.raw IS NOT NULL").count() == 4
    assert packed.where(~F.col("t").eqNullSafe(C.unpacked("p"))).isEmpty()
    for ids in (["ab" * 16, "9f" * 16], ["u-1", "ab" * 16], ["Z", "0a"], [None, "0a"], [None]):
        rows = spark.createDataFrame([("case", i, "l" if i else None) for i in ids],
                                     "case_id string, uuid string, url string")
        rows = rows.select(*(F.col(n) if n in rows.columns else F.lit(None).cast(k).alias(n)
                             for n, k in ledger.EVIDENCE_SCHEMA.items()))
        expected = min((i for i in ids if i is not None), default=None)
        for table in (rows, ledger.without_links(rows)):
            found = ledger.cases(table, ledger.no_complaints(spark)).first()
            assert (found["case_id"], found["procedure_uuid"], found["_cited"]) == (
                "case", expected, expected is not None)
