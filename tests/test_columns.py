import datetime as dt

from pyspark.sql import functions as F

from contraluz.functions import columns as C

D = dt.date


def test_numbers_and_junk(values):
    found = values(C.number("x"), "1,000,000", " 12.5 ", "1d", "NaN", "", None, "-3e2")
    assert found == [1e6, 12.5, None, None, None, None, -300.0]
    assert values(C.number("x", "$, "), "$ 1,234.50", "$") == [1234.5, None]


def test_dates(values):
    found = values(C.parse_day("x"), "29/02/2016", "29/02/2015", "1/12/1998", "1998-12-01",
                   " 07/07/2007 ", "00/01/2020", "2016-02-29T23:59", "7 de julio", None)
    assert found == [D(2016, 2, 29), None, D(1998, 12, 1), D(1998, 12, 1),
                     D(2007, 7, 7), None, None, None, None]
    assert values(C.parse_day("x", iso=False), "31/12/1999", "1999-12-31") == [
        D(1999, 12, 31), None]


def test_moments(values):
    found = values(C.parse_moment("x"), "2025-01-14", "2025-01-14T10:00:00Z",
                   "2025-01-14 10:00", "15/01/2025", "15/01/2025 10:30", "None", "")
    assert found == [D(2025, 1, 14)] * 3 + [D(2025, 1, 15)] * 2 + [None, None]


def test_century_follows_the_clock(values):
    def born(*keys, today):
        return values(C.incorporation_day("x", today), *keys)
    assert born("ABC100507XY9", "ABC990507XY9", today=D(2026, 6, 1)) == [
        D(2010, 5, 7), D(1999, 5, 7)]
    assert born("ABC270101XY9", "ABC280101XY9", today=D(2027, 1, 1)) == [
        D(2027, 1, 1), D(1928, 1, 1)]
    assert born("ABC991399XY9", "ABCD100507XY9", "XX", today=D(2026, 1, 1)) == [
        None, None, None]
    assert born("ABC090101XY9", "ABC100101XY9", today=D(2009, 1, 1)) == [
        D(2009, 1, 1), D(1910, 1, 1)]


def test_name_key(values):
    found = values(
        C.name_norm("x"), "Molinos Ibáñez del Río, S. de R.L. de C.V.",
        "S.A. DE TODO UN POCO", "  pingüino--azul  &  CÍA. S.C.", "Molinos ibañez del rio",
        "Tres S.C. Hermanas S.A. de C.V.", "", None)
    assert found[0] == found[3] == "MOLINOS IBANEZ DEL RIO"
    assert found[1].startswith("S A DE TODO") and found[2].startswith("PINGUINO AZUL")
    assert not found[2].endswith("S C") and found[4] == "TRES S C HERMANAS"
    assert not found[5] and found[6] is None


def test_key_quality_classes(values):
    assert values(C.rfc_class("x"), " aaa101010ab1 ", "NA", " ", None,
                  "XAXX010101000") == ["valido", "basura", "vacio", "vacio", "valido"]
    assert values(C.rfc_generic("x"), "xaxx010101000", "AAA101010AB1") == [True, False]
    assert values(C.rfc_compact("x"), " hebj 901114-8la ", " - ") == [
        "HEBJ9011148LA", None]


def test_digits(values):
    amounts = (193.0, 1900.0, 905.0, 40.5, 7.0)
    assert values(C.first_digit("x"), *amounts, kind="double") == [1, 1, 9, 4, 7]
    assert values(C.second_digit("x"), *amounts, kind="double") == [9, 9, 0, 0, 0]
    assert values(C.first_digit("x"), 0.0, -5.0, kind="double") == [None, None]


def test_procedure_and_state(values):
    assert values(C.procedure_class("x"), "Adjudicación directa", "INVITACIÓN A 3",
                  "LICITACIÓN", None) == ["directa", "invitacion", "licitacion", "otro"]
    assert values(C.number_state("x"), "LA-66-014-X", "AA-7-X", "AA-060-X", None) == [
        "CHIAPAS", None, "AGUASCALIENTES", None]
    assert values(C.branch_state("x"), "60", "12", "", "60.0") == [
        "AGUASCALIENTES", None, None, "AGUASCALIENTES"]
    assert values(C.scope_of_order("x"), "Gobierno Municipal", "APF", "GEM") == [
        "estatal", "federal", "federal"]


def test_supplier_predicates(values):
    assert values(C.plausible_supplier("x"), "ACME SA", "HOMBRE", "Juan Hombre",
                  "https://x.mx", "Ley de Obras", "N/A", None,
                  "ver tranparencia aqui") == [True] + [False] * 7
    assert values(C.placeholder_supplier("x"), "ACME SA DE CV", "Persona Física",
                  "[[x]] y", "NO SE ADJUDICO", "AAA101010AB1", None, "ABC") == [
        False] + [True] * 6
    assert values(C.supplier_context("x"), "Pfizer S.A.", "LICONSA", "ACME") == [
        "farmaceutica_patente", "entidad_estatal", ""]


def test_links_and_folios(values):
    uuid = "0123456789abcdef0123456789abcdef"
    link = f"http://old.gob.mx/#/detalle/{uuid}/procedimiento"
    assert values(C.procedure_id("x"), link, "http://x", None) == [uuid, None, None]
    rebuilt = values(C.portal_url("x"), link, "http://dead")
    assert uuid in rebuilt[0] and "old.gob.mx" not in rebuilt[0] and rebuilt[1] == ""
    assert values(C.complaint_folio("x"), "SIDEC folio 83017/2026 clave z", "no") == [
        "83017-2026", None]
    assert values(C.bracketed_rfc("x"), "Acme (AAA101010AB1)", "Acme") == [
        "AAA101010AB1", None]


def test_windows_are_closed_and_need_both_ends(values):
    test = C.inside_window("x", F.lit(D(2020, 1, 1)), F.lit(D(2020, 12, 31)))
    assert values(test, D(2020, 1, 1), D(2020, 12, 31), D(2021, 1, 1), None,
                  kind="date") == [True, True, False, False]
    open_end = C.inside_window("x", F.lit(D(2020, 1, 1)), F.lit(None).cast("date"))
    assert values(open_end, D(2025, 1, 1), kind="date") == [False]
