"""Small canonical tables for planted cases."""

import datetime as dt

CONTRACT_SCHEMA = """
    file_year string, codigo_contrato string, num_contrato string,
    titulo_contrato string, institucion string, nombre_uc string,
    orden_gobierno string, estado_comprador string, proveedor string,
    rfc_norm string, es_persona_moral boolean, fecha_constitucion_rfc date,
    fecha_efectiva date, importe double, tipo_monto string,
    moneda_efectiva string, tipo_procedimiento string, ley string,
    monto_original double, monto_ultimo_convenio double,
    fecha_firma_ultimo_conv string, direccion_anuncio string
"""
_NAMES = [part.split()[0] for part in CONTRACT_SCHEMA.split(",")]
EFOS_SCHEMA = ("rfc_norm string, nombre string, situacion string, "
               "fecha_definitivo date, fecha_presunto date")
SFP_SCHEMA = ("rfc_norm string, nombre string, multa string, "
              "institucion_sancionadora string, plazo_txt string, inicio date, fin date")

D = dt.date


def contracts(spark, rows):
    base = {"file_year": "2024", "institucion": "IMSS", "nombre_uc": "UC1",
            "proveedor": "ACME", "rfc_norm": "AAA101010AB1",
            "es_persona_moral": True, "fecha_constitucion_rfc": D(2010, 10, 10),
            "fecha_efectiva": D(2024, 5, 1), "importe": 1e6,
            "tipo_monto": "ejercido", "moneda_efectiva": "MXN",
            "tipo_procedimiento": "LICITACIÓN PÚBLICA"}
    data = [tuple({**base, "codigo_contrato": f"C{i}", **row}.get(n) for n in _NAMES)
            for i, row in enumerate(rows)]
    return spark.createDataFrame(data, CONTRACT_SCHEMA)


def efos(spark, *rows):
    return spark.createDataFrame(
        [(r, n, s, d, p) for r, n, s, d, p in rows], EFOS_SCHEMA)


def sfp(spark, *rows):
    return spark.createDataFrame(
        [(r, n, None, "OIC", "x", a, b) for r, n, a, b in rows], SFP_SCHEMA)
