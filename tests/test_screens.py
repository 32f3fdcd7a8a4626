import pathlib

import pytest
from pyspark.sql import functions as F

from contraluz.functions import columns as C
from contraluz.operators import (ages, bunching, collusion, concentration, digits,
                                 fraud_list, modifications, other_buyer, state_layer)
from contraluz.operators import matching as M
from contraluz.plans import backtest, ledger, signals
from tests.helpers import D, contracts, efos, sfp


def test_time_test_of_fraud_hits(spark):
    table = contracts(spark, [
        {"fecha_efectiva": D(2024, 1, 1)}, {"fecha_efectiva": D(2020, 1, 1)},
        {"fecha_efectiva": None}, {"rfc_norm": "ZZZ"}, {"rfc_norm": None}])
    hits = M.fraud_hits(table, efos(
        spark, ("AAA101010AB1", "ACME", "Definitivo", D(2022, 1, 1), None)))
    assert sorted(r[0] for r in hits.select("firmado_despues_definitivo").collect()) \
        == [False, False, True]
    assert fraud_list.after_definitive(hits).first()["monto_mxn_millones"] == 1.0


def test_best_window_of_several(spark):
    table = contracts(spark, [
        {"fecha_efectiva": D(2015, 6, 15)}, {"fecha_efectiva": D(2018, 6, 15)},
        {"fecha_efectiva": D(2021, 1, 1)}, {"fecha_efectiva": None}])
    windows = sfp(spark,
                  ("AAA101010AB1", "ACME", D(2015, 1, 1), D(2016, 1, 1)),
                  ("AAA101010AB1", "ACME", D(2020, 1, 1), D(2022, 1, 1)),
                  ("AAA101010AB1", "ACME", D(2020, 1, 1), None))
    found = {r["codigo_contrato"]: (r["inicio"].year, r["durante_inhabilitacion"])
             for r in M.debarment_hits(table, windows).collect()}
    assert found == {"C0": (2015, True), "C1": (2020, False), "C2": (2020, True),
                     "C3": (2020, False)}


def test_open_window_never_counts(spark):
    table = contracts(spark, [{"fecha_efectiva": D(2025, 1, 1)}])
    windows = sfp(spark, ("AAA101010AB1", "ACME", D(2021, 1, 1), None))
    row = M.debarment_hits(table, windows).first()
    assert row["durante_inhabilitacion"] is False and row["fin"] is None


def test_many_windows_of_one_key_agree_with_brute_force(spark):
    spans = [(D(2000 + i % 20, 1 + i % 12, 1 + i % 28),
              D(2000 + i % 20 + i % 3, 1 + i % 12, 1 + i % 28) if i % 5 else None)
             for i in range(120)]
    days = [D(2000 + i % 22, 1 + (i * 7) % 12, 5) for i in range(60)]
    table = contracts(spark, [{"fecha_efectiva": d} for d in days])
    found = M.debarment_hits(table, sfp(spark, *[
        ("AAA101010AB1", "ACME", a, b) for a, b in spans])).collect()
    assert len(found) == len(days)
    for row in found:
        day = row["fecha_efectiva"]
        holding = [a for a, b in spans if b and a <= day <= b]
        assert row["durante_inhabilitacion"] == bool(holding)
        assert row["inicio"] == max(holding or [a for a, _ in spans])


def test_direct_award_flag_is_the_nth(spark):
    rows = [{"tipo_procedimiento": "ADJUDICACIÓN DIRECTA", "importe": 3e6,
             "fecha_efectiva": D(2024, 1, i + 1)} for i in range(12)]
    few = [{**r, "rfc_norm": "BBB101010AB1"} for r in rows[:9]]
    flags = concentration.direct_award_flags(contracts(spark, rows + few)).collect()
    assert [tuple(f) for f in flags] == [("AAA101010AB1", D(2024, 1, 10))]
    table = concentration.direct_suppliers(contracts(spark, rows + few)).collect()
    assert [(t["rfc"], t["directas"], t["pct_directas"]) for t in table] == [
        ("AAA101010AB1", 12, 100.0)]


def test_dependence_and_leaning(spark):
    rows = [{"tipo_procedimiento": "ADJUDICACIÓN DIRECTA", "importe": 2e6,
             "proveedor": "BIG" if i < 40 else f"S{i}"} for i in range(60)]
    table = contracts(spark, rows)
    found = concentration.supplier_dependence(table).collect()
    assert [(f["proveedor"], f["n_directas"], f["pct_del_gasto_directo"])
            for f in found] == [("BIG", 40, 66.7)]
    lean = concentration.leaning_institutions(table, 50, 1e6).first()
    assert lean["pct_directas_monto"] == 100.0


def test_planted_digits(spark):
    rows = [{"importe": 9000.0 + i, "institucion": "RARE"} for i in range(400)]
    few = [{"importe": 1000.0 + i, "institucion": "SMALL"} for i in range(50)]
    profile = digits.digit_profile(
        contracts(spark, rows + few), "institucion", C.mxn_ok(), 300)
    table = digits.conformity(profile, "institucion").collect()
    assert [(t["institucion"], t["banda_nigrini"], t["no_conforme_fdr05"])
            for t in table] == [("RARE", "NO CONFORME", True)]
    nine = digits.worst_group_digits(profile, "institucion").where("digito = 9").first()
    assert nine["anomalo"] and nine["pct_observado"] > 90


def test_young_and_large(spark):
    table = contracts(spark, [
        {"fecha_constitucion_rfc": D(2024, 1, 1), "importe": 6e6},
        {"fecha_constitucion_rfc": D(2024, 1, 1), "importe": 4e6},
        {"fecha_constitucion_rfc": D(2024, 6, 1), "importe": 9e6},
        {"fecha_constitucion_rfc": D(2023, 5, 2), "importe": 9e6,
         "moneda_efectiva": "USD"}])
    assert ages.top_young(ages.with_age(table)).count() == 1
    assert [tuple(r) for r in ages.young_flags(table).collect()] == [
        ("AAA101010AB1", D(2024, 5, 1))]
    counts = ages.enrichment(ages.with_age(table), efos(
        spark, ("AAA101010AB1", "x", "Definitivo", None, None))).first()
    assert counts["jovenes_definitivo"] == 1 and counts["tasa_viejas_x10k"] is None


def _tenders(names, each, office="UC1", years=("2023", "2024")):
    return [{"proveedor": n, "rfc_norm": f"{n:A<12}", "nombre_uc": office,
             "file_year": years[i % 2]} for n in names for i in range(each)]


def test_rotation_needs_a_small_even_group(spark):
    even = _tenders("XYZ", 8)
    uneven = _tenders("P", 22, "UC2") + _tenders("Q", 2, "UC2")
    broad = _tenders("ABCDEF", 4, "UC3")
    few = _tenders("MN", 2, "UC4")
    table = contracts(spark, even + uneven + broad + few)
    found = collusion.rotation_candidates(table).collect()
    assert [(f["nombre_uc"], f["contratos"], f["evenness"], f["anios_activos"],
             f["proveedores"]) for f in found] == [
        ("UC1", 24, 1.0, 2, "X (8) | Y (8) | Z (8)")]
    assert collusion.rotation_members(table).count() == 3


def test_ring_takes_the_fullest_earliest_run(spark):
    def firm(key, day, office="UC1"):
        return {"rfc_norm": f"{key}{day:%y%m%d}AB1", "proveedor": key,
                "fecha_constitucion_rfc": day, "nombre_uc": office}
    rows = [firm("AAA", D(2020, 1, 1)), firm("BBB", D(2020, 1, 5)),
            firm("CCC", D(2020, 1, 9)), firm("DDD", D(2021, 1, 1)),
            firm("EEE", D(2021, 1, 2)), firm("FFF", D(2021, 1, 31)),
            firm("GGG", D(2020, 1, 1), "UC2"), firm("HHH", D(2020, 3, 1), "UC2"),
            firm("III", D(2020, 1, 1), None)]
    rows += [rows[0]]
    found = collusion.rings(contracts(spark, rows)).collect()
    assert [(f["empresas"], f["dias_entre_constituciones"], f["contratos"])
            for f in found] == [(3, 8, 4)]
    assert found[0]["proveedores"].startswith("AAA (AAA200101AB1, 2020-01-01) | BBB")


def test_ring_runs_agree_with_brute_force(spark):
    import random
    rng = random.Random(5)
    firms = [(f"G{rng.randrange(4)}", f"K{i}",
              D(2020, 1, 1) + (D(2020, 1, 2) - D(2020, 1, 1)) * rng.randrange(200))
             for i in range(120)]
    table = spark.createDataFrame(firms, "g string, rfc_norm string, constituida date")
    found = {(r["g"], r["rfc_norm"]) for r in collusion.widest_incorporation_run(
        table, ["g"], 30, 3).collect()}
    expected = set()
    for g in {f[0] for f in firms}:
        group = [f for f in firms if f[0] == g]
        starts = sorted({f[2] for f in group})
        runs = [[f for f in group if 0 <= (f[2] - s).days <= 30] for s in starts]
        best = max(runs, key=len)
        if len(best) >= 3:
            expected |= {(g, f[1]) for f in best}
    assert found == expected


def test_same_day_splits(spark):
    rows = [{"tipo_procedimiento": "ADJUDICACIÓN DIRECTA", "importe": 2e6}] * 4
    small = [{**rows[0], "nombre_uc": "UC2", "importe": 1e5}] * 4
    found = collusion.same_day_splits(contracts(spark, rows + small)).collect()
    assert [(f["contratos"], f["total_mxn"], f["pct_mayor"]) for f in found] == [
        (4, 8e6, 0.25)]


def test_growth_exactly_at_the_cap_is_legal(spark):
    base = {"monto_original": 100.0, "ley": None}
    table = contracts(spark, [
        {**base, "monto_ultimo_convenio": 120.0},
        {**base, "monto_ultimo_convenio": 121.0},
        {**base, "monto_ultimo_convenio": 124.0, "ley": "Ley de Obras Públicas"},
        {**base, "monto_ultimo_convenio": 126.0, "ley": "Ley de Obras Públicas"},
        {**base, "monto_original": 0.0, "monto_ultimo_convenio": 10.0}])
    found = modifications.over_cap(table)
    assert sorted(r["codigo_contrato"] for r in found.collect()) == ["C1", "C3"]
    assert modifications.largest(found, 1).first()["codigo_contrato"] == "C3"


def test_bunching_counts_and_exclusions(spark):
    direct = "ADJUDICACIÓN DIRECTA"
    rows = [{"importe": 980_000.0 + i, "tipo_procedimiento": direct} for i in range(60)]
    rows += [{"importe": 1_010_000.0, "tipo_procedimiento": direct}] * 5
    rows += [{"importe": 1_000_000.0, "tipo_procedimiento": direct}] * 7
    rows += [{"importe": 990_000.0}] * 50
    rows += [{"importe": 990_000.0, "tipo_procedimiento": None}] * 50
    rows += [{"importe": 99_000.0, "tipo_procedimiento": direct}] * 10
    found = bunching.bunching(contracts(spark, rows)).collect()
    assert [(f["umbral"], f["bajo"], f["sobre"], f["exacto"], f["razon"],
             f["q_fdr05"]) for f in found] == [(1_000_000, 60, 5, 7, 12.0, True)]


def test_name_screen_of_another_buyer(spark):
    awards = spark.createDataFrame(
        [("1", "Fantasma, S.A. de C.V.", "x", "10", "a", D(2021, 6, 1)),
         ("2", "Limpia SA", "x", "10", "a", None)],
        "numero string, proveedor string, tipo_procedimiento string, monto string, "
        "area_contratante string, fecha date")
    found = other_buyer.name_screen(
        awards, efos(spark, ("FAN101010AB1", "FANTASMA SA DE CV", "Presunto", None, None)),
        sfp(spark, ("FAN101010AB1", "Fantasma", D(2021, 1, 1), D(2022, 1, 1))))
    rows = {r["lista"]: r for r in found.collect()}
    assert set(rows) == {"69-B", "SFP"} and rows["SFP"]["durante_inhabilitacion"]
    assert rows["SFP"]["detalle"] == "inhabilitada 2021-01-01 → 2022-01-01"


def test_backtest_has_no_leakage(spark):
    flags = spark.createDataFrame(
        [("s", "A", D(2023, 1, 1)), ("s", "B", D(2023, 1, 1)), ("s", "C", None)],
        "senal string, rfc_norm string, flag_date date")
    universe = spark.createDataFrame(
        [(k, D(2020, 1, 1)) for k in "ABCDE"], "rfc_norm string, t0 date")
    sanctions = spark.createDataFrame(
        [("A", D(2022, 1, 1)), ("B", D(2023, 2, 1)), ("D", D(2021, 1, 1)),
         ("Z", D(2021, 1, 1))], "rfc_norm string, fecha_sancion date")
    row = backtest.evaluate(flags, universe, sanctions, ["s", "none"]).where(
        "senal = 's'").first()
    assert (row["empresas_flag"], row["sancionadas_despues"]) == (3, 1)
    assert (row["base_empresas"], row["base_sancionadas"]) == (2, 1)
    assert row["mediana_dias_a_sancion"] == 31
    assert row["lift"] == pytest.approx(0.7)
    empty = backtest.evaluate(flags, universe, sanctions, ["none"]).first()
    assert empty["empresas_flag"] == 0 and empty["base_empresas"] == 5
    assert empty["tasa_flag_x10k"] is None and empty["p_fisher"] is None


def test_composite_and_ensemble(spark):
    flags = spark.createDataFrame(
        [("d02_concentracion_directas", "AAA101010AB1", D(2024, 1, 2)),
         ("d07_convenio_inflado", "AAA101010AB1", None),
         ("d06_rotacion", "AAA101010AB1", D(2023, 1, 2)),
         ("d06_rotacion", "BBB101010AB1", D(2023, 1, 2))],
        "senal string, rfc_norm string, flag_date date")
    assert [tuple(r) for r in signals.composite_flags(flags).collect()] == [
        ("AAA101010AB1", D(2023, 1, 2))]
    table = signals.supplier_ensemble(
        contracts(spark, [{}, {"institucion": "ISSSTE"}]), flags,
        efos(spark, ("AAA101010AB1", "x", "Presunto", None, None)),
        sfp(spark, ("BBB101010AB1", "y", None, None)))
    top = table.orderBy(F.desc("n_senales")).collect()
    assert top[0]["n_senales"] == 3 and top[0]["dependencias"] == 2
    assert top[0]["senales"].startswith("concentración de adjudicaciones directas; ")
    assert top[0]["en_69b"] and not top[0]["inhabilitado_sfp"]
    assert top[1]["contratos"] is None and top[1]["inhabilitado_sfp"]


def test_ranks_in_groups_of_any_size(spark):
    import random

    from contraluz.operators.ranks import rank_in_groups
    rng = random.Random(6)
    rows = [(rng.choice(["hot"] * 8 + ["a", "b", None]), rng.choice([None, *range(90)]), i)
            for i in range(900)]
    df = spark.createDataFrame(rows, "k string, v int, i int")
    for parts in (None, 1, 13):
        found = rank_in_groups(df, ["k"], [F.desc_nulls_last("v"), F.col("i")], "n", parts)
        assert found.columns == ["k", "v", "i", "n"]
        for key in ("hot", "a", "b", None):
            own = sorted((r for r in rows if r[0] == key),
                         key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
            got = {r["n"]: r["i"] for r in found.where(F.col("k").eqNullSafe(F.lit(key))).collect()}
            assert [got[n + 1] for n in range(len(own))] == [r[2] for r in own]


@pytest.mark.skipif(not pathlib.Path("/root/testdata/sf0.001").exists(),
                    reason="driver tables are not here")
def test_line_items_move_once_where_nothing_is_broadcast(spark):
    from contraluz.sources import driver_tables as D
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = D.sold(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # the join on the order has the joined orders and buyers beside it
    text = plan.toString()
    assert text.index("o_orderkey") < text.index("c_custkey")
    joins = [line for line in text.splitlines() if " Join " in f" {line}"]
    orders = next(i for i, line in enumerate(joins) if "l_orderkey" in line)
    buyers = next(i for i, line in enumerate(joins) if "o_custkey" in line)
    assert joins[buyers].index("Join") > joins[orders].index("Join")


def test_signals_keep_dates_of_firms_and_take_wins_at_hand(spark, monkeypatch):
    """Ring signals store no names or sums of firms; wins at hand are not made again."""
    rows = [{"rfc_norm": f"AAA10101{i}AB{j}", "proveedor": f"F{i}{j}", "nombre_uc": f"UC{i}",
             "fecha_constitucion_rfc": D(2010, 1, 1 + 9 * j), "fecha_efectiva": D(2024, 5, 9 - j)}
            for i in range(3) for j in range(4)]
    table = contracts(spark, rows + _tenders("XYZ", 8, "UC9"))
    members = collusion.ring_members(table).select("rfc_norm", "primer_contrato")
    wins = collusion.tender_wins(table)
    expected = sorted(map(tuple, signals.signal_flags(table).collect()))
    kept = []
    original = collusion.stored

    def noted(df):
        kept.append(df.columns)
        return original(df)
    monkeypatch.setattr(collusion, "stored", noted)
    found = collusion.ring_dates(table)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, members.collect()))
    flags = signals.signal_flags(table, wins=wins)
    assert sorted(map(tuple, flags.collect())) == expected
    assert kept == []


def test_names_of_kept_pairs_alone_are_tested(spark):
    """The test for stock phrases is not run on all state reports."""
    rows = [("E", "S", name, "ADJUDICACIÓN DIRECTA", 1e6, "MXN")
            for name in ("ACME SA", "ACME SA", "CONTRATISTA") for _ in range(20)]
    state = spark.createDataFrame(rows, "estado_comprador string, sujeto_obligado string, "
                                  "proveedor string, tipo_procedimiento string, "
                                  "importe double, moneda string")
    found = ledger.from_state_concentration(state_layer.concentration(state, min_share=0.02))
    assert [(r["sujeto"], r["n"]) for r in found.collect()] == [("ACME SA", 40)]
    assert "Aggregate" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_rows_of_frequent_keys_are_found_by_one_number(spark):
    from contraluz.operators import matching
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), ("b", 2), (None, 3), (None, 3)],
                                 "k string, v int")
    found = matching.repeated(rows, ["k", "v"], 2)
    assert sorted(map(tuple, found.collect()), key=repr) == [("a", 1), ("a", 1), (None, 3), (None, 3)]
    assert matching.repeated(rows, ["k"], 1).count() == 6
    assert matching.repeated(rows, ["k"], 4).isEmpty()


def test_wins_of_rotating_offices_are_enough(spark):
    """Candidates and members are the same, and tenders move once."""
    table = contracts(spark, _tenders("XYZ", 8, "UC9") + _tenders("AB", 3, "UC1")
                      + _tenders("ABCDEFG", 4, "UC2"))
    wins = collusion.rotating_wins(table)
    assert wins.select("nombre_uc").distinct().count() < collusion.tender_wins(
        table).select("nombre_uc").distinct().count()
    for found in (collusion.rotation_candidates, collusion.rotation_members):
        assert sorted(map(tuple, found(table, wins=wins).collect())) == sorted(
            map(tuple, found(table).collect())) != []
    for rows in (wins, collusion.ring_dates(table)):
        assert rows._jdf.queryExecution().executedPlan().toString().count(
            "Exchange hashpartitioning") == 1
