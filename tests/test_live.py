import datetime as dt
import json
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from contraluz.sources import other
from contraluz.sources import procedures as P
from contraluz.session import stored
from contraluz.streaming import monitor, rules, seen
from tests.helpers import D, efos, sfp

T = dt.datetime
PROCEDURE = ("uuid string, numero string, nombre string, siglas string, "
             "estatus string, tipo_procedimiento string, entidad string, "
             "fecha_apertura string")
RECORD = ("uuid string, plazo_proc_contratacion string, fecha_publicacion string, "
          "fecha_apertura string, contratacion_emergencia string, "
          "excepcion_fraccion string, descripcion_corta string, anticipo string, "
          "porcentaje_anticipo string")
AWARD = ("uuid string, licitante string, importe double, importe_max double, "
         "moneda string, institucion string, fecha_inicio string, "
         "fecha_publicacion string, cod_drc string")
GAZETTE = ("nombre_norm string, cod_nota long, quien string, rfc string, fecha date, "
           "fecha_dof string, plazo_txt string, url string")


def judged(spark, procedures, records=(), awards=(), fraud=(), barred=(), recent=()):
    listed = spark.createDataFrame(procedures, PROCEDURE)
    fired = rules.fired_rules(
        listed, spark.createDataFrame(list(records), RECORD),
        spark.createDataFrame(list(awards), AWARD), efos(spark, *fraud),
        sfp(spark, *barred), spark.createDataFrame(list(recent), GAZETTE))
    rows = rules.assess(listed, fired).withColumn("change", F.lit("new"))
    return rows, fired


def assessed(spark, *args, **kwargs):
    """Every procedure as an alert record, whatever its score."""
    rows, fired = judged(spark, *args, **kwargs)
    found = rules.alerts(rows, F.lit("t"), threshold=0)
    lists = rules.alert_rules(found, fired).groupBy("uuid").agg(F.sort_array(F.collect_list(
        F.struct("place", "reason", "evidence"))).alias("f"))
    return found.join(lists, "uuid", "left").withColumns({
        "reasons": F.col("f.reason"),
        "awards_flagged": F.array_compact("f.evidence")}).drop("f")


def procedure(uuid="u", kind="LICITACIÓN PÚBLICA", number="LA-66-1", opened=None):
    return (uuid, number, "n", "IMSS", "VIGENTE", kind, "e", opened)


def record(uuid="u", **cells):
    names = [c.split()[0] for c in RECORD.split(",")][1:]
    return (uuid, *[cells.get(n) for n in names])


def fired_weights(row):
    """code -> weight of a record's reasons 'CODE (+2): …'."""
    return {r.split(" ")[0]: int(r.split("(+")[1].split(")")[0])
            for r in row["reasons"] or []}


def codes(df):
    return {r["uuid"]: sorted(fired_weights(r)) for r in df.collect()}


def test_tender_window(spark):
    df = assessed(spark, [procedure(u) for u in "abc"] + [
        procedure("d", "ADJUDICACIÓN DIRECTA"), procedure("e", opened="05/01/2026")], [
        record("a", fecha_publicacion="2026-01-01", fecha_apertura="2026-01-06"),
        record("b", fecha_publicacion="2026-01-01", fecha_apertura="2026-01-21"),
        record("c", fecha_publicacion="basura", fecha_apertura="2026-01-06"),
        record("d", fecha_publicacion="2026-01-01", fecha_apertura="2026-01-02"),
        record("e", fecha_publicacion="2026-01-01")])
    assert codes(df) == {"a": ["PLAZO_COMPRIMIDO"], "b": [], "c": [],
                         "d": ["DIRECTA"], "e": ["PLAZO_COMPRIMIDO"]}


def test_additive_procedure_rules(spark):
    row = assessed(spark, [procedure(kind="Adjudicación Directa")], [record(
        plazo_proc_contratacion="Plazo RECORTADO", contratacion_emergencia="si",
        excepcion_fraccion="III", anticipo="1", porcentaje_anticipo="30")]).first()
    assert row["score"] == 2 + 2 + 2 + 1 + 1
    assert row["reasons"][-1] == "ANTICIPO (+1): anticipo 30%"


def award(name, when="2026-06-10", amount=1.0, code="X", currency="MXN", most=None):
    return ("u", name, amount, most, currency, "IMSS", when, when, code)


def test_award_rules_and_evidence(spark):
    df = assessed(
        spark, [procedure()], awards=[
            award("FANTASMA SA DE CV"),
            award("Barrida Norte, S.C.", amount=6e7, code="Y"),
            award("Reciente Sur SC", "2026-05-01", code="Z", most=9e7, currency="USD")],
        fraud=[("FAN101010AB1", "Fantasma", "Definitivo", D(2020, 1, 1), None)],
        barred=[("BAR101010AB1", "BARRIDA NORTE", D(2026, 1, 1), D(2026, 12, 31))],
        recent=[("RECIENTE SUR", 1, "x", None, D(2026, 6, 1), "2026-06-01", None, "x"),
                ("BARRIDA NORTE", 2, "x", None, D(2026, 6, 1), "2026-06-01", None, "x")])
    row = df.first()
    assert fired_weights(row) == {
        "EFOS_69B": 6, "SFP_SANCION": 8, "DOF_INHABILITACION": 3, "MONTO_ALTO": 1}
    assert row["score"] == 18
    assert {a["lista"] for a in row["awards_flagged"]} == {"69-B", "SFP", "DOF"}


def test_directory_hides_the_gazette(spark):
    row = assessed(
        spark, [procedure()], awards=[award("BARRIDA NORTE SA DE CV", "01/07/2020")],
        barred=[("BAR101010AB1", "BARRIDA NORTE", D(2026, 1, 1), D(2026, 12, 31))],
        recent=[("BARRIDA NORTE", 2, "x", None, D(2020, 6, 1), "2020-06-01", None, "x")]
    ).first()
    assert fired_weights(row) == {"SFP_SANCION": 3}
    assert row["awards_flagged"][0]["durante_inhabilitacion"] is False


def test_alert_record(spark):
    pair = judged(spark, [procedure(kind="ADJUDICACIÓN DIRECTA"), procedure("low")])
    rows = rules.alerts(pair[0], F.lit("t")).collect()
    assert len(rows) == 1
    alert = rows[0]
    assert [r["reason"] for r in rules.alert_rules(
        rules.alerts(pair[0], F.lit("t")), pair[1]).collect()] == [
        "DIRECTA (+2): adjudicación directa (ADJUDICACIÓN DIRECTA)"]
    assert (alert["orden_gobierno"], alert["estado_comprador"]) == ("GEM", "CHIAPAS")
    assert alert["url"].endswith("detalle/u/procedimiento")
    assert [(c["code"], c["n"]) for c in pair[0].where("uuid = 'u'").first()["codes"]] \
        == [("DIRECTA", 1)]
    log = spark.createDataFrame(
        [("u", "t1", 2), ("u", "t2", 5), ("u", "t3", 5)], "uuid string, ts string, score int")
    assert [tuple(r) for r in rules.best_alerts(log).select("ts", "score").collect()] == [
        ("t2", 5)]


FEED = "uuid string, estatus string, ts timestamp, event_id long"


def snapshots(seed, n=400):
    import random
    rng = random.Random(seed)
    start = T(2024, 1, 1)
    return [("hot" if rng.random() < .4 else f"u{rng.randrange(30)}",
             rng.choice("AB"), start + dt.timedelta(minutes=rng.randrange(4000)), i)
            for i in range(n)]


def plain_changes(rows, max_age_days=90):
    """(event, change, first_seen, previous) by a plain loop."""
    state, out = {}, set()
    for uuid, status, ts, i in sorted(rows, key=lambda r: (r[2], r[3])):
        known, first, last = state.get(uuid, (None, None, None))
        if known is not None and ts - last > dt.timedelta(days=max_age_days):
            known = None
        if known != status:
            first = ts if known is None else first
            out.add((i, "status_change" if known else "new", first, known))
            state[uuid] = (status, first, ts)
    return out


def as_set(rows):
    return {(r["event_id"], r["change"], r["first_seen"], r["previous"]) for r in rows}


def gaps(seed, n=500):
    """Snapshots over three years: long runs of a status, gaps, ties of time and a null id."""
    import random
    rng = random.Random(seed)
    start, status, out = T(2023, 1, 1), {}, []
    for i in range(n):
        uuid = rng.choice(["hot"] * 4 + ["u1", "u2", "u3", None])
        if rng.random() < .06 or uuid not in status:
            status[uuid] = rng.choice("ABC")
        day = rng.choice([rng.randrange(1000), 3 * rng.randrange(330)])
        out.append((uuid, status[uuid], start + dt.timedelta(days=day, hours=rng.choice([0, 0, 5])), i))
    return out


def test_batch_changes_match_a_plain_loop(spark):
    for rows in (snapshots(3), gaps(1)):
        found = seen.status_changes(spark.createDataFrame(rows, FEED))
        assert as_set(found.collect()) == plain_changes(rows)


@pytest.mark.parametrize("limit,time_slice", [(0.5, "hour"), (7, "day"), (45, "month")])
def test_entries_past_the_limit_are_new_again(spark, limit, time_slice):
    rows = [("hot", "A", T(2023, 1, 1) + dt.timedelta(hours=7 * i), i) for i in range(150)] + [
        (u, "AB"[s == "C"], t, 1000 + i) for u, s, t, i in gaps(2, 200)]
    found = seen.status_changes(spark.createDataFrame(rows, FEED), time_slice, limit).collect()
    assert as_set(found) == plain_changes(rows, limit)
    assert len(found) == len({r["event_id"] for r in found})


def test_exactly_at_the_limit_is_not_past_it(spark):
    rows = [("u", "A", T(2024, 1, 1) + dt.timedelta(days=90 * i), i) for i in range(4)]
    rows += [("v", "A", T(2024, 1, 1), 10), ("v", "A", T(2024, 3, 31, 0, 0, 1), 11)]
    found = seen.status_changes(spark.createDataFrame(rows, FEED)).collect()
    assert sorted((r["uuid"], r["event_id"]) for r in found) == [
        ("u", 0), ("u", 2), ("v", 10), ("v", 11)]


def run_stream(spark, folder, batches, max_age_days=90):
    for key, value in seen.STATE_STORE.items():
        spark.conf.set(key, value)
    source = folder / "in"
    source.mkdir()
    feed = spark.readStream.schema(FEED).parquet(str(source))
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, FEED).coalesce(1).write.mode("append").parquet(
            str(source))
        query = (seen.stream_changes(feed, max_age_days).writeStream.format("parquet")
                 .option("path", str(folder / "out"))
                 .option("checkpointLocation", str(folder / "state"))
                 .trigger(availableNow=True).start())
        query.awaitTermination()
    return spark.read.parquet(str(folder / "out")).collect()


def test_stream_matches_batch_over_restarts(spark, tmp_path):
    rows = sorted(snapshots(4, 120), key=lambda r: (r[2], r[3]))
    found = run_stream(spark, tmp_path, [rows[:60], rows[60:]])
    assert as_set(found) == plain_changes(rows)


def test_stream_matches_batch_on_a_feed_with_long_gaps(spark, tmp_path):
    rows = sorted((r for r in gaps(5, 240) if r[0]), key=lambda r: (r[2], r[3]))
    found = as_set(run_stream(spark, tmp_path, [rows[:100], rows[100:150], rows[150:]]))
    assert found == plain_changes(rows)
    assert found == as_set(seen.status_changes(spark.createDataFrame(rows, FEED)).collect())
    assert sum(change == "new" for _, change, _, _ in found) > 8


def test_stream_removes_the_state_of_forgotten_entries(spark, tmp_path):
    quiet = [(f"q{i}", "A", T(2024, 1, 1 + i), i) for i in range(5)]
    later = [("busy", "A", T(2024, 8, 1), 10)]
    run_stream(spark, tmp_path, [quiet, later, [("busy", "B", T(2024, 8, 2), 11)]])
    kept = spark.read.format("statestore").load(str(tmp_path / "state"))
    assert {r["key"]["uuid"] for r in kept.collect()} == {"busy"}


def test_stream_forgets_after_the_age_limit(spark, tmp_path):
    rows = [("u", "A", T(2024, 1, 1), 0), ("u", "A", T(2024, 2, 1), 1),
            ("u", "B", T(2024, 3, 1), 2), ("u", "B", T(2024, 7, 1), 3)]
    found = run_stream(spark, tmp_path, [rows])
    assert sorted((r["event_id"], r["change"], r["first_seen"]) for r in found) == [
        (0, "new", T(2024, 1, 1)), (2, "status_change", T(2024, 1, 1)),
        (3, "new", T(2024, 7, 1))]


def test_alerts_have_all_their_rules_in_long_form(spark):
    many = [award("FANTASMA SA DE CV", code=f"X{i}") for i in range(1200)]
    rows, fired = judged(spark, [procedure()], awards=many, fraud=[
        ("FAN101010AB1", "Fantasma", "Presunto", None, None)])
    found = rules.alerts(rows, F.lit("t"))
    alert = found.first()
    assert (alert["score"], alert["n_flags"], alert["n_evidence"]) == (2400, 1200, 1200)
    assert rules.alert_rules(found, fired).where("evidence.rfc = 'FAN101010AB1'").count() == 1200


def test_two_changes_of_a_procedure_are_judged_apart(spark):
    columns = f"{PROCEDURE}, event_id long"
    kind = "ADJUDICACIÓN DIRECTA"
    listed = spark.createDataFrame(
        [(*procedure("u", kind), 1), (*procedure("u", kind), 2), (*procedure("v", kind), 3)], columns)
    sources = (spark.createDataFrame([], RECORD), spark.createDataFrame(
        [award("FANTASMA SA DE CV")], AWARD), efos(
            spark, ("FAN101010AB1", "Fantasma", "Definitivo", D(2020, 1, 1), None)), sfp(spark),
        spark.createDataFrame([], GAZETTE))
    for full in (True, False):
        rows = rules.assess(listed, rules.fired_rules(listed, *sources, full=full)).collect()
        assert sorted((r["uuid"], r["event_id"], r["score"], r["n_flags"]) for r in rows) == [
            ("u", 1, 8, 2), ("u", 2, 8, 2), ("v", 3, 2, 1)]


def test_prune(spark):
    table = spark.createDataFrame(
        [("old", "2026-01-01T00:00:00"), ("new", "2026-06-01T00:00:00"), ("none", None),
         ("junk", "x")], "uuid string, last_seen string")
    kept = seen.prune(table, T(2026, 6, 10))
    assert {r["uuid"] for r in kept.collect()} == {"new", "none", "junk"}


def test_monitor_end_to_end(spark, tmp_path):
    landing = tmp_path / "pages"
    landing.mkdir()
    row = {"uuid_procedimiento": "a" * 32, "numero_procedimiento": "LA-60-1",
           "estatus": "VIGENTE", "tipo_procedimiento": "ADJUDICACIÓN DIRECTA"}

    def land(name, **change):
        (landing / f"{name}.json").write_text(json.dumps(
            {"success": True, "data": [{"registros": [{**row, **change}]}]}))

    def poll():
        monitor.start_monitor(
            spark, str(landing), str(tmp_path / "alerts"), str(tmp_path / "state"),
            lambda s: (s.createDataFrame([], RECORD), s.createDataFrame([], AWARD)),
            lambda s: (efos(s), sfp(s), s.createDataFrame([], GAZETTE)),
            interval=None).awaitTermination()
        return sorted((r["change"], r["score"]) for r in other.read_alerts(
            spark, str(tmp_path / "alerts")).collect())

    land("p1")
    assert poll() == [("new", 2)]
    land("p2")
    time.sleep(0.1)
    land("p3", estatus="ADJUDICADO")
    time.sleep(0.1)
    land("p4", estatus="CANCELADO")
    land("p5", uuid_procedimiento=None, numero_procedimiento="LA-60-2")
    # two changes in one batch do not add up; the row without an id is kept
    assert poll() == [("new", 2), ("new", 2), ("status_change", 2), ("status_change", 2)]
    fired = other.read_alert_rules(spark, str(tmp_path / "alerts"))
    assert fired.count() == 4 and {r["code"] for r in fired.collect()} == {"DIRECTA"}
    log = other.read_alert_log(spark, str(tmp_path / "alerts"))
    assert log.count() == 4 and {c["code"] for r in log.collect() for c in r["codes"]} == {"DIRECTA"}


def test_a_batch_becomes_visible_as_a_whole(spark, tmp_path, monkeypatch):
    pages, out = tmp_path / "pages", str(tmp_path / "out")
    pages.mkdir()
    (pages / "p.json").write_text(json.dumps({"success": True, "data": [{"registros": [
        {"uuid_procedimiento": "a" * 32, "estatus": "VIGENTE",
         "tipo_procedimiento": "ADJUDICACIÓN DIRECTA"}]}]}))

    def poll():
        monitor.start_monitor(
            spark, str(pages), out, str(tmp_path / "state"),
            lambda s: (s.createDataFrame([], RECORD), s.createDataFrame([], AWARD)),
            lambda s: (efos(s), sfp(s), s.createDataFrame([], GAZETTE)),
            interval=None).awaitTermination()

    def killed(*_):
        raise OSError("killed between the writes")

    with monkeypatch.context() as patched:
        patched.setattr(monitor.sinks, "write_alert_log", killed)
        with pytest.raises(Exception, match="killed"):
            poll()
    # headers and rules are written, but nothing shows
    assert spark.read.parquet(f"{out}/alerts").count() == 1
    assert other.read_alerts(spark, out).count() == other.read_alert_rules(spark, out).count() == 0
    poll()
    assert other.read_alerts(spark, out).count() == other.read_alert_rules(spark, out).count() == 1
    assert other.read_alert_log(spark, out).count() == 1
    # a batch that is tried again after its record is there changes nothing
    before = spark.read.parquet(f"{out}/alerts").inputFiles()
    for record in (tmp_path / "state" / "commits").glob("*0*"):
        record.unlink()
    poll()
    assert spark.read.parquet(f"{out}/alerts").inputFiles() == before
    assert P.LISTING_SCHEMA


def test_changes_since_earlier_batches_match_the_stateful_step(spark):
    """Batches that come in any order of time, against the step that the stream runs."""
    for seed, limit in ((7, 90), (8, 20), (9, 3)):
        rows = gaps(seed, 240)
        history, expected, state = None, set(), {}
        for batch, part in enumerate((rows[:80], rows[80:100], rows[100:])):
            for uuid in {r[0] for r in part}:
                own = pd.DataFrame(sorted((r for r in part if r[0] == uuid), key=lambda r: r[2:]),
                                   columns=["uuid", "estatus", "ts", "event_id"])
                status, first, last = state.get(uuid, (None, None, None))
                for at, change, first, previous in seen.changes(
                        own, status, first, last, pd.Timedelta(days=limit)):
                    status, last = own["estatus"][at], own["ts"][at]
                    expected.add((own["event_id"][at], change, first, previous))
                    state[uuid] = (status, first, last)
            before = history if history is not None else spark.createDataFrame(
                [], f"{FEED}, first_seen timestamp, batch long")
            found = spark.createDataFrame(seen.changes_since(
                spark.createDataFrame(part, FEED), before, limit).collect(),
                f"{FEED}, previous string, change string, first_seen timestamp").withColumn(
                    "batch", F.lit(batch).cast("long"))
            history = found if history is None else history.unionByName(found)
        assert as_set(history.collect()) == expected


def test_the_monitor_runs_no_python_for_a_procedure(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "p.json").write_text(json.dumps({"success": True, "data": [{"registros": [
        {"uuid_procedimiento": "a" * 32, "estatus": "VIGENTE"}]}]}))
    query = monitor.start_monitor(
        spark, str(pages), str(tmp_path / "out"), str(tmp_path / "state"),
        lambda s: (s.createDataFrame([], RECORD), s.createDataFrame([], AWARD)),
        lambda s: (efos(s), sfp(s), s.createDataFrame([], GAZETTE)), interval=None)
    query.awaitTermination()
    assert not query.lastProgress["stateOperators"]
    assert spark.read.parquet(str(tmp_path / "out" / "changes")).count() == 1


def test_rules_of_alerts_are_told_where_they_are_made(spark):
    """As by `alert_rules`, and nothing but one count for each event moves after the rules."""
    rows = [(u, e, "0/1", code, w, f"d{n}", None) for n, (u, e, code, w) in enumerate(
        [("a", 1, "DIRECTA", 2), ("a", 1, "DIRECTA", 2), ("a", 1, "ANTICIPO", 1), ("a", 2, "EMERGENCIA", 2),
         ("b", 1, "EFOS_69B", 6), ("c", 1, "MONTO_ALTO", 1), (None, 1, "SFP_SANCION", 8)])]
    fired = spark.createDataFrame(rows, "uuid string, event_id long, place string, code string, "
                                  f"weight int, detail string, evidence {rules._EVIDENCE_TYPE}")
    listed = spark.createDataFrame(
        [("a", 1), ("a", 2), ("b", 1), ("c", 1), (None, 1)], "uuid string, event_id long")
    assessed = rules.assess(listed, fired)
    assert {(r["uuid"], r["event_id"]): (r["score"], r["n_flags"], [tuple(c) for c in r["codes"] or ()])
            for r in assessed.collect()} == {
        ("a", 1): (5, 3, [("ANTICIPO", 1), ("DIRECTA", 2)]), ("a", 2): (2, 1, [("EMERGENCIA", 1)]),
        ("b", 1): (6, 1, [("EFOS_69B", 1)]), ("c", 1): (1, 1, [("MONTO_ALTO", 1)]), (None, 1): (0, 0, [])}
    over = assessed.where("score >= 5")
    expected = rules.alert_rules(over, fired)
    found = rules.rules_over(stored(rules.with_total(fired)), 5)
    assert found.columns == expected.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect())) != []
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        awards = spark.createDataFrame([], AWARD)
        matched = rules.match_awards(awards, efos(spark), sfp(spark), spark.createDataFrame([], GAZETTE))
        assert "SortMergeJoin" not in matched._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
