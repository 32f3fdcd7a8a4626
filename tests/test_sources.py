import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from contraluz.functions import fixed_values as V
from contraluz.operators import state_layer
from contraluz.session import stored
from contraluz.sources import contracts as S
from contraluz.sources import (driver_tables, gazette, other, procedures, records, sanctions,
                               sinks, states)
from tests.helpers import D


def write_csv(path, header, rows, encoding="utf-8", preamble=()):
    with open(path, "w", encoding=encoding, newline="") as out:
        writer = csv.writer(out)
        for row in preamble:
            writer.writerow(row)
        writer.writerow(header)
        writer.writerows(rows)
    return str(path)


def by_name(names, **cells):
    return [cells.get(n, "") for n in names]


def test_federal_file(spark, tmp_path):
    names = V.CONTRACT_COLUMNS
    rows = [
        by_name(names, rfc=" aaa101010ab1 ", proveedor="Áurea – ñ", clave_ramo="60",
                fecha_firma_contrato="15/03/2025", importe_drc="1,000,000",
                moneda_drc="MXN", institucion="IMSS", titulo_contrato="dos\nlíneas"),
        by_name(names, rfc="BBB991231AB1", monto_max_con_imp="2,000,000",
                moneda="USD", moneda_drc="MXN", fecha_fallo="2025-01-02"),
        ["APF", "7"],
    ]
    path = write_csv(tmp_path / "contratos_2025.csv", names, rows, "cp1252")
    found = S.read_contracts(spark, [path], D(2026, 1, 1)).collect()
    assert len(found) == 3
    a, b, c = found
    assert (a["proveedor"], a["file_year"], a["importe"], a["tipo_monto"]) == (
        "Áurea – ñ", "2025", 1e6, "ejercido")
    assert a["rfc_norm"] == "AAA101010AB1" and a["fecha_efectiva"] == D(2025, 3, 15)
    assert a["estado_comprador"] == "AGUASCALIENTES" and a["es_persona_moral"]
    assert (b["importe"], b["moneda_efectiva"], b["tipo_monto"]) == (
        2e6, "USD", "techo_maximo")
    assert b["fecha_efectiva"] == D(2025, 1, 2)
    assert b["fecha_constitucion_rfc"] == D(1999, 12, 31)
    assert c["rfc"] is None and c["importe"] is None


def test_fraud_list_skips_its_preamble_and_keeps_one_row(spark, tmp_path):
    names = V.EFOS_COLUMNS
    rows = [
        by_name(names, rfc="AAA101010AB1", nombre="Ñandú", situacion="Presunto",
                pub_dof_presuntos="01/02/2020"),
        by_name(names, rfc="aaa101010ab1 ", nombre="Ñandú", situacion="Definitivo",
                pub_sat_definitivos="05/06/2021"),
        by_name(names, rfc="XXX", nombre="short"),
    ]
    path = write_csv(tmp_path / "list.csv", names, rows, "cp1252",
                     preamble=(["Información al día"] + [""] * 19, [""] * 20))
    found = sanctions.read_efos(spark, path).collect()
    assert [(r["rfc_norm"], r["nombre"], r["situacion"], r["fecha_definitivo"])
            for r in found] == [
        ("AAA101010AB1", "Ñandú", "Definitivo", D(2021, 6, 5))]


def test_debarment_json(spark, tmp_path):
    path = tmp_path / "sfp.json"
    path.write_text(json.dumps([
        {"rfc": " aaa101010ab1", "nombre_razon_social": " ACME ",
         "multa": {"monto": 5}, "institucion_dependencia": "OIC",
         "plazo": {"fecha_inicial": "2020-01-01T00:00:00", "fecha_fin": "2021-01-01",
                   "plazo_inha": "1 AÑO"}},
        {"rfc": "BBB101010AB1", "nombre_razon_social": "B", "plazo": None},
        {"rfc": None}]), encoding="utf-8")
    found = {r["rfc_norm"]: r for r in sanctions.read_sfp(spark, str(path)).collect()}
    assert set(found) == {"AAA101010AB1", "BBB101010AB1"}
    first = found["AAA101010AB1"]
    assert (first["inicio"], first["fin"], first["nombre"]) == (
        D(2020, 1, 1), D(2021, 1, 1), "ACME")
    assert json.loads(first["multa"]) == {"monto": 5}
    assert found["BBB101010AB1"]["inicio"] is None


STATE_HEADERS = [
    "Entidad federativa", "Id entidad federativa", "Id sujeto obligado",
    "Sujeto obligado", "Ejercicio", "Tipo de procedimiento (catálogo)",
    "Número de expediente, folio o nomenclatura",
    "Descripción de las obras públicas",
    "Nombre(s) de la persona física ganadora", "Primer apellido de la persona",
    "Segundo apellido de la persona", "Denominación o razón social",
    "Registro Federal de Contribuyentes (RFC)", "Número que identifique al contrato ",
    "Fecha del contrato expresada con el formato día/mes/año",
    "Monto total del contrato con impuestos incluidos (MXN)", "Objeto del contrato",
    "Hipervínculo al acta de fallo", "Fecha de actualización", "Nota"]


def state_row(**cells):
    base = {"Entidad": "Nayarit", "Id entidad": "18", "Id sujeto": "77",
            "Sujeto": "Junta de Caminos", "Ejercicio": "2021", "Tipo": "Invitación",
            "Número de exp": "JC/9", "Denominación": "PUENTES Y VADOS SC",
            "Registro": "PVA050817QX2", "Monto": "$ 80,500.5",
            "Fecha del": "30/11/2021", "Fecha de act": "10/01/2022"}
    base |= cells
    return [next((v for k, v in base.items() if h.startswith(k)), "")
            for h in STATE_HEADERS]


def read_state(spark, tmp_path, **files):
    paths = [write_csv(tmp_path / f"{n}.csv", STATE_HEADERS, rows)
             for n, rows in files.items()]
    return states.read_states(spark, paths, D(2026, 1, 1))


def test_header_resolution():
    assert states.resolve_header(STATE_HEADERS, "sujeto obligado") == "Sujeto obligado"
    assert states.resolve_header(STATE_HEADERS, "id sujeto") == "Id sujeto obligado"
    assert states.resolve_header(STATE_HEADERS, "no existe") is None
    try:
        states.resolve_fields(["Ejercicio"])
    except ValueError as error:
        assert "estado" in str(error)
    else:
        raise AssertionError("a missing required field must stop the read")


def test_state_rows_and_identity(spark, tmp_path):
    weaver = state_row(**{
        "Denominación": "", "Registro": " qutl 880229-k07", "Número de exp": "JC/10",
        "Nombre(s)": "Lía", "Primer": "Quintero", "Segundo": "Tun"})
    later = state_row(**{"Fecha de act": "11/03/2022"})
    other_years = [state_row(**{"Ejercicio": y}) for y in ("1821", "9999")]
    nobody = state_row(**{"Denominación": "", "Registro": ""})
    federal = state_row(**{"Entidad": "Federación"})
    unnumbered = [state_row(**{"Número de exp": "", "Objeto": o}) for o in ("grava", "cal")]
    rows = read_state(
        spark, tmp_path, pnt_18_2021_59729=[
            later, state_row(), weaver, *other_years, nobody, federal, *unnumbered],
        pnt_18_2021_59730=[state_row()]).collect()
    by_file = {r["expediente"]: r for r in rows}
    assert len(rows) == 4 and set(by_file) >= {"JC/9", "JC/10"}
    firm, person = by_file["JC/9"], by_file["JC/10"]
    assert (firm["estado_comprador"], firm["importe"]) == ("NAYARIT", 80500.5)
    assert firm["fecha_actualizacion"] == D(2022, 3, 11) and firm["rfc_valido"]
    assert firm["es_persona_moral"] and not person["es_persona_moral"]
    assert person["proveedor"] == "Lía Quintero Tun"
    assert person["rfc_norm"] == "QUTL880229K07" and person["rfc_valido"]


def test_ragged_rows_are_repaired_not_cut(spark, tmp_path):
    short = state_row(**{"Número de exp": "SHORT"})[:-1]
    long = state_row(**{"Número de exp": "LONG", "Nota": "a"}) + ["b", 'c "q", d']
    path = write_csv(tmp_path / "pnt_18_2021_59729.csv", STATE_HEADERS,
                     [state_row(), short, long])
    raw = states.read_state_files(spark, [path]).collect()
    assert sorted(r["expediente"] for r in raw) == ["JC/9", "LONG", "SHORT"]
    assert {r["fecha_actualizacion"] for r in raw} == {"10/01/2022"}
    assert states.fold_record('1,2,"x, y",z', 3) == ["1", "2", "x, y z"]
    assert states.fold_record("1", 3) == ["1", "", ""]


def test_archive_utility_manifest_and_complaints(spark, tmp_path):
    archive = write_csv(
        tmp_path / "archive.csv",
        ["codigo_contrato", "codigo_expediente", "proveedor", "importe", "moneda",
         "ff_fecha_inicio", "fecha_inicio", "titulo_contrato", "descripcion_contrato"],
        [["1", "e", "ACME", "10.5", "MXN", "", "2015-02-03 00:00:00", "t", "d"]])
    row = other.read_archive(spark, archive).first()
    assert (row["importe_num"], row["fecha"]) == (10.5, D(2015, 2, 3))
    utility = write_csv(tmp_path / "cfe.csv", V.UTILITY_COLUMNS, [
        by_name(V.UTILITY_COLUMNS, numero="1", nomb_proveedor_adjudicado=" Acme ",
                fecha_fallo="", fecha_publicacion="15/01/2025 10:30"),
        by_name(V.UTILITY_COLUMNS, numero="2", nomb_proveedor_adjudicado=" ")])
    rows = other.read_utility(spark, utility).collect()
    assert [(r["proveedor"], r["fecha"]) for r in rows] == [("Acme", D(2025, 1, 15))]
    manifest = tmp_path / "MANIFEST.tsv"
    manifest.write_text(
        "retrieved_at\tsha256\tbytes\tfile\turl\n"
        "2026-01-01T00:00:00Z\taa\t10\tf.csv\tu\n"
        "2026-02-01T00:00:00Z\tbb\t0\tf.csv\tu\nbroken\n", encoding="utf-8")
    last = other.last_retrievals(other.read_manifest(spark, str(manifest))).collect()
    assert [(r["archivo"], r["sha256"]) for r in last] == [("f.csv", "aa")]
    filed = tmp_path / "filed.json"
    filed.write_text(json.dumps([{"empresa": "A", "rfc": "aaa101010ab1", "contratos": [
        {"institucion": "IMSS", "url": "u", "folio": "1-2026"}], "folios": []}]))
    assert [r["rfc"] for r in other.read_complaints(spark, str(filed)).collect()] == [
        "AAA101010AB1"]


def test_findings_and_published_copies(spark, tmp_path):
    table = spark.createDataFrame([("a\nb", 2), ("c", 1)], "t string, n int")
    folder = str(tmp_path / "out")
    sinks.write_finding(table, folder, "f00", ["n"])
    assert other.read_finding(spark, folder, "f00", table.schema).count() == 2
    assert other.read_finding(spark, folder, "f99", table.schema).count() == 0
    sinks.write_finding(table.coalesce(1), folder, "f00_csv", fmt="csv")
    listed = sinks.published_inventory(spark, f"{folder}/f00_csv").collect()
    assert [r["filas"] for r in listed] == [2] and len(listed[0]["sha256"]) == 64
    sinks.write_canonical(table, f"{folder}/canon", ["n"])
    assert spark.read.parquet(f"{folder}/canon").count() == 2


def test_gazette_titles(values):
    lead = "Circular por la que se comunica que deberán abstenerse de aceptar propuestas o celebrar contratos con "
    firms = ["Hilos del Sureste, S.A. de C.V.", "Óptica Nube, S. de R.L.", "Tintas Orión, S.C"]
    found = values(
        gazette.title_names("x"), lead + "la empresa " + firms[1] + "",
        lead + f"las empresas {firms[0]} y {firms[2]}.",
        lead + "la persona física Ximena Ku Balam.", "Aviso de licencia", None)
    assert [f.rstrip(".") for f in found[0]] == [firms[1].rstrip(".")]
    assert [f.rstrip(".") for f in found[1]] == [f.rstrip(".") for f in (firms[0], firms[2])]
    assert found[2] == ["Ximena Ku Balam"] and found[3] == [] and found[4] == []


def test_gazette_days_accumulate(spark, tmp_path):
    note = {"codNota": 222, "titulo": "CIRCULAR: abstenerse de aceptar propuestas o "
            "celebrar contratos con la empresa Fantasma, S.A. de C.V."}
    for day in ("2026-06-08", "2026-06-09"):
        (tmp_path / f"{day}.json").write_text(json.dumps(
            {"NotasMatutinas": [note, {"codNota": 1, "titulo": "otra"}],
             "NotasVespertinas": None}), encoding="utf-8")
    rows = gazette.circulars(gazette.read_days(spark, str(tmp_path)))
    bodies = spark.createDataFrame(
        [(222, "<p>RFC FAN101010AAA por el plazo de <b>DOS (2) AÑOS</b>; x</p>")],
        "cod_nota long, html string")
    full = gazette.with_bodies(rows, bodies)
    once = gazette.accumulate(full.where("false"), full)
    again = gazette.accumulate(once, full).collect()
    assert len(again) == 1 and again[0]["rfc"] == "FAN101010AAA"
    assert again[0]["plazo_txt"] == "DOS (2) AÑOS" and "222" in again[0]["url"]
    live = gazette.recent_index(once, D(2026, 7, 1)).collect()
    assert [r["nombre_norm"] for r in live] == ["FANTASMA"]
    assert gazette.recent_index(once, D(2027, 7, 1)).count() == 0


def test_listing_and_detail_pages(spark, tmp_path):
    row = {"uuid_procedimiento": "u1", "estatus": None, "siglas": "IMSS"}
    (tmp_path / "a.json").write_text(json.dumps(
        {"success": True, "data": [{"registros": [row, row, {"siglas": "X"}]}]}))
    (tmp_path / "b.json").write_text(json.dumps({"success": False, "data": []}))
    rows = procedures.unique_rows(procedures.read_listing(spark, str(tmp_path)))
    assert sorted((r["uuid"], r["estatus"]) for r in rows.collect()) == [
        ("", ""), ("u1", "")]
    detail = tmp_path / "d.jsonl"
    detail.write_text(json.dumps({"uuid": "u1", "success": True, "data": [{
        "registro": [{"anticipo": "1"}], "drc": [
            {"licitante": "ACME", "importe": "1,000.5", "importe_max": None}]}]}))
    record, awards = procedures.read_details(spark, str(detail))
    assert record.first()["anticipo"] == "1"
    assert awards.first()["importe"] == 1000.5 and awards.first()["moneda"] == ""


def small_splits(spark, most="700"):
    """Settings under which a small file is read by many tasks; returns what undoes them."""
    names = {"spark.sql.files.maxPartitionBytes": most,
             "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    before = {n: spark.conf.get(n, None) for n in names}
    for name, value in names.items():
        spark.conf.set(name, value)

    def undo():
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    return undo


def test_records_of_one_file_are_cut_in_many_tasks(spark, tmp_path):
    rng = random.Random(1)
    cells = ["a\nb\n\nc", 'q"x', "é,€", "", "plain", '"', "\n", "x" * 30]
    expected = {}
    for name, end, encoding in (("one", "\n", "cp1252"), ("two", "\r\n", "cp1252"),
                                ("three", "\n", "cp1252")):
        rows = [["n"] + [rng.choice(cells) for _ in range(4)] for _ in range(200)]
        if name == "three":
            rows[40][2] = 'long "and"\n' * 900  # through several blocks
            rows[199][4] = "to the\nend"
        text = io.StringIO()
        csv.writer(text, lineterminator=end).writerows(rows)
        (tmp_path / f"{name}.csv").write_bytes(text.getvalue().encode(encoding))
        expected[name] = [[c or None for c in row] for row in rows]
    undo = small_splits(spark)
    try:
        found = records.read_records(spark, str(tmp_path))
        assert found.rdd.getNumPartitions() > 40
        parsed = records.parsed(found, list("abcde"), "bad").orderBy("file", "place").collect()
    finally:
        undo()
    for name, rows in expected.items():
        own = [r for r in parsed if r["file"].endswith(f"{name}.csv")]
        assert [[r[c] for c in "abcde"] for r in own] == rows
        assert own[0]["place"] == 0 and all(r["bad"] is None for r in own)


def test_bytes_that_stand_for_nothing_are_replaced(spark, tmp_path):
    (tmp_path / "f.csv").write_bytes(b'a,\x80\x9f\x81\xe9\n\n"open,\nto the end')
    rows = records.read_records(spark, str(tmp_path)).orderBy("place").collect()
    assert [r["record"] for r in rows] == ["a,€Ÿ�é", '"open,\nto the end']
    (tmp_path / "g.csv").write_bytes("é\n".encode() + b"\xff\n")
    rows = records.read_records(spark, str(tmp_path / "g.csv"), "utf-8").orderBy("place").collect()
    assert [r["record"] for r in rows] == ["é", "�"]
    with pytest.raises(ValueError):
        records.read_records(spark, str(tmp_path), "ebcdic")


def test_headers_of_many_files_take_one_job(spark, tmp_path):
    for i in range(30):
        (tmp_path / f"pnt_1_2026_{i}.csv").write_text(
            f'"x{i % 2}\ny",z\n1,2\n3\n' if i else "")
    context = spark.sparkContext
    context.setJobGroup("headers", "")
    groups = states.file_headers(spark, [str(tmp_path)])
    jobs = len(context.statusTracker().getJobIdsForGroup("headers"))
    context.setJobGroup("", "")
    assert sorted((k, len(v)) for k, v in groups.items()) == [
        (("x0\ny", "z"), 14), (("x1\ny", "z"), 15)]
    assert jobs < 8  # stages of one query, not jobs by file


def test_a_record_is_parsed_once_whatever_is_filtered(spark, tmp_path):
    row = {"estado": "X", "razon_social": "ACME", "ejercicio": "2024"}
    paths = [write_csv(tmp_path / f"pnt_1_2024_{i}.csv", list(V.STATE_FIELDS.values()), [
        [row.get(n, "") for n in V.STATE_FIELDS]]) for i in range(2)]
    typed = states.typed_states(states.read_state_files(spark, paths), D(2026, 1, 1))
    plan = typed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv(") == plan.count("repaired(") == 1
    assert typed.count() == 2


def test_first_records_read_on_only_where_quotes_stay_open(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"x\ny",z\r\n1,2\n')
    (tmp_path / "b.csv").write_text("p,q\r\n1,2\n")
    (tmp_path / "c.csv").write_text("\n1,2\n")
    (tmp_path / "d.csv").write_text('"never\nclosed')
    undo = small_splits(spark)
    try:
        found = records.first_records(spark, str(tmp_path))
    finally:
        undo()
    assert sorted((f[-5:], r) for f, r in found) == [
        ("a.csv", '"x\ny",z'), ("b.csv", "p,q"), ("d.csv", '"never\nclosed')]


def test_numbered_reports_fold_before_texts_are_made(spark, tmp_path):
    """As by `dedupe`, for repeated lines, equal keys of two suppliers and unnumbered lines."""
    folder = "/root/testdata/sf0.001"
    lines = stored(driver_tables.sold(spark, folder))
    again = lines.where("l_orderkey % 3 = 0")
    hashed = lines.where("l_linenumber = 2").withColumn("l_linenumber", F.lit(8))
    others = lines.where("l_linenumber IN (5, 7)").withColumn(
        "l_suppkey", (F.col("l_suppkey") + 1) % 10)
    bare = lines.where("l_linenumber = 3").withColumn("l_shipdate", F.lit(None).cast(
        "timestamp_ntz"))
    rows = stored(lines.unionByName(again).unionByName(hashed).unionByName(
        hashed.where("l_orderkey % 2 = 0")).unionByName(others).unionByName(bare))
    found = driver_tables.states(spark, folder, rows)
    reports = driver_tables._as_reports(driver_tables._report_rows(
        spark, folder, driver_tables.sales(spark, folder, rows)))
    expected = states.with_key_traits(state_layer.dedupe(reports))
    assert found.columns == expected.columns
    assert found.count() == expected.count() < reports.count()
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(l_orderkey" in plan  # lines move, not texts


def test_lines_tell_which_reports_stay(spark):
    """As by `dedupe`, for repeated lines, equal keys of two suppliers and unnumbered lines;
    the state layer is read off the lines and no line moves for it."""
    folder = "/root/testdata/sf0.001"
    lines = stored(driver_tables.sold(spark, folder))
    again = lines.where("l_orderkey % 3 = 0")
    files = lines.where("l_linenumber = 4").withColumn("l_linenumber", F.lit(12))
    hashed = lines.where("l_linenumber = 2").withColumn("l_linenumber", F.lit(8))
    others = lines.where("l_linenumber IN (5, 7)").withColumn(
        "l_suppkey", (F.col("l_suppkey") + 1) % 10)
    rows = stored(lines.unionByName(again).unionByName(files).unionByName(hashed).unionByName(
        hashed.where("l_orderkey % 2 = 0")).unionByName(others))
    told = stored(driver_tables.with_reports(spark, folder, rows))
    assert told.count() == rows.count()
    found = driver_tables.states(spark, folder, told)
    reports = driver_tables._as_reports(driver_tables._report_rows(
        spark, folder, driver_tables.sales(spark, folder, rows)))
    expected = states.with_key_traits(state_layer.dedupe(reports))
    assert found.columns == expected.columns and found.count() == expected.count()
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
    numbered = found.where("num_contrato IS NOT NULL OR expediente IS NOT NULL")
    assert numbered._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1
    assert "hashpartitioning(l_orderkey" not in found._jdf.queryExecution().executedPlan().toString()
