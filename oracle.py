"""Independent SQL for the registered queries, over the driver's tables.

Each statement is built from shared common table expressions; only the ones a
statement refers to are included.
"""

from __future__ import annotations

import re

from contraluz.functions import fixed_values as V

_SUFFIXES = "|".join(sorted(V.LEGAL_SUFFIXES, key=len, reverse=True))
_RFC = f"^(?:{V.RFC_PATTERN})$"


def nn(x: str) -> str:
    """Name key."""
    return (f"regexp_replace(trim(regexp_replace(upper(strip_accents({x})), "
            f"'[^A-Z0-9]+', ' ', 'g')), '(?: (?:{_SUFFIXES}))+$', '')")


def mill(total: str, digits: int) -> str:
    return (f"CAST(round(CAST(CAST({total} AS DECIMAL(24,2)) * 0.000001 "
            f"AS DECIMAL(34,8)), {digits}) AS DOUBLE)")


def dec(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


def rnd(x: str, digits: int) -> str:
    return f"round(CAST({x} AS DOUBLE), {digits})"


def titled(x: str) -> str:
    return (f"array_to_string(list_transform(string_split({x}, ' '), "
            "lambda w: upper(w[1]) || lower(w[2:])), ' ')")


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def iso(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def case_id(*parts: str) -> str:
    keys = ", ".join(f"coalesce({nn(p)}, '')" for p in parts)
    return f"substr(sha1(concat_ws('|', {keys})), 1, 32)"


MXN = "coalesce(moneda_efectiva = 'MXN', TRUE)"
DIRECT = "coalesce(tipo_procedimiento LIKE 'ADJUDICACI%DIRECTA%', FALSE)"
STATE_MXN = ("(moneda IS NULL OR upper(moneda) LIKE '%PESO%' "
             "OR upper(moneda) = 'MXN')")
PLAUSIBLE = f"(coalesce(importe BETWEEN 1 AND 5e9, FALSE) AND {STATE_MXN})"
_AMOUNT = ("(CAST(l_extendedprice AS DECIMAL(12,2)) * "
           "CAST(l_quantity AS DECIMAL(5,0)))")
_KIND = """CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'ADJUDICACIÓN DIRECTA'
    WHEN '2' THEN 'ADJUDICACIÓN DIRECTA POR EXCEPCIÓN'
    WHEN '3' THEN 'INVITACIÓN A CUANDO MENOS TRES PERSONAS'
    WHEN '5' THEN 'LICITACIÓN PÚBLICA' END"""
_LINK = ("'https://portal.example/#/detalle/' || md5(CAST(l_orderkey AS VARCHAR))"
         " || '/procedimiento'")

CTES: dict[str, str] = {}

CTES["sup"] = """
    SELECT *, chr(CAST(65 + s_suppkey % 26 AS INTEGER))
      || chr(CAST(65 + (s_suppkey // 26) % 26 AS INTEGER)) || 'X'
      || strftime(constituida, '%y%m%d')
      || lpad(CAST(s_suppkey % 1000 AS VARCHAR), 3, '0') AS rfc
    FROM (SELECT s_suppkey, s_name, DATE '1994-01-01'
            + CAST((s_suppkey * 7919) % 2400 AS INTEGER) AS constituida
          FROM supplier)"""

CTES["efos"] = """
    SELECT rfc AS rfc_norm, s_name || ', S.A. de C.V.' AS nombre,
      CASE s_suppkey % 4 WHEN 0 THEN 'Definitivo' WHEN 1 THEN 'Presunto'
        WHEN 2 THEN 'Desvirtuado' ELSE 'Sentencia Favorable' END AS situacion,
      d AS fecha_definitivo,
      CASE WHEN s_suppkey % 21 <> 0
        THEN d - CAST(200 + s_suppkey % 100 AS INTEGER) END AS fecha_presunto
    FROM (SELECT *, DATE '1996-06-01'
            + CAST((s_suppkey * 31) % 1500 AS INTEGER) AS d
          FROM sup WHERE s_suppkey % 3 = 0)"""

CTES["sfp"] = """
    SELECT rfc AS rfc_norm, s_name || ' SA DE CV' AS nombre,
      '{"monto":' || s_suppkey || '}' AS multa,
      'OIC-' || (s_suppkey % 7) AS institucion_sancionadora,
      '1 AÑO' AS plazo_txt, a AS inicio,
      CASE WHEN s_suppkey % 15 <> 0 THEN a + 365 END AS fin
    FROM (SELECT *, DATE '1996-01-01'
            + CAST((s_suppkey * 13) % 900 AS INTEGER) AS a
          FROM sup WHERE s_suppkey % 5 = 0)
    UNION ALL
    SELECT rfc, s_name || ' SA DE CV', '{"monto":' || s_suppkey || '}',
      'OIC-' || (s_suppkey % 7), '6 MESES', b, b + 180
    FROM (SELECT *, DATE '1999-01-01'
            + CAST((s_suppkey * 17) % 700 AS INTEGER) AS b
          FROM sup WHERE s_suppkey % 10 = 0)"""

CTES["sales"] = """
    SELECT l.*, o.*, c_mktsegment, n_nationkey, n_name, n_regionkey, s_name,
      rfc, constituida, CAST(l_shipdate AS DATE) AS dia
    FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN sup ON l_suppkey = s_suppkey"""

CTES["contracts"] = f"""
    SELECT strftime(dia, '%Y') AS file_year,
      l_orderkey || '-' || l_linenumber AS codigo_contrato,
      'N' || l_orderkey AS num_contrato, 'CONTRATO ' || l_partkey AS titulo_contrato,
      n_name AS institucion, 'UC-' || o_custkey AS nombre_uc,
      CASE WHEN o_orderstatus = 'P' THEN 'ENTIDAD FEDERATIVA'
        ELSE 'ADMINISTRACIÓN PÚBLICA FEDERAL' END AS orden_gobierno,
      CASE WHEN o_orderstatus = 'P' THEN 'ESTADO ' || n_regionkey END
        AS estado_comprador,
      s_name AS proveedor, rfc AS rfc_norm, constituida, dia AS fecha_efectiva,
      CAST({_AMOUNT} AS DOUBLE) AS importe,
      CASE WHEN l_returnflag = 'A' THEN 'MXN'
        WHEN l_returnflag = 'R' AND l_suppkey % 10 = 0 THEN 'USD'
        WHEN l_returnflag = 'R' THEN 'MXN' END AS moneda_efectiva,
      {_KIND} AS tipo_procedimiento,
      CASE WHEN l_linestatus = 'O' THEN 'LEY DE OBRAS'
        ELSE 'LEY DE ADQUISICIONES' END AS ley,
      CAST({_AMOUNT} AS DOUBLE) AS monto_original,
      CAST(round(CAST({_AMOUNT} AS DECIMAL(18,2))
        * (1 + 2 * CAST(l_discount AS DECIMAL(4,2))
           + CAST(l_tax AS DECIMAL(4,2))), 2) AS DOUBLE) AS monto_ultimo_convenio,
      strftime(dia + 30, '%Y-%m-%d') AS fecha_firma_ultimo_conv,
      {_LINK} AS direccion_anuncio
    FROM sales"""

CTES["hits"] = """
    SELECT c.*, e.situacion, e.fecha_definitivo,
      coalesce(c.fecha_efectiva > e.fecha_definitivo, FALSE)
        AS firmado_despues_definitivo
    FROM contracts c JOIN efos e USING (rfc_norm)"""

CTES["aged"] = """
    SELECT *, date_diff('day', constituida, fecha_efectiva) AS edad_dias
    FROM contracts
    WHERE date_diff('day', constituida, fecha_efectiva) BETWEEN 0 AND 36500"""

# the best window by ranking all pairs; contracts carry a row number first
CTES["sfp_hits"] = """
    SELECT * FROM (
      SELECT c.*, s.nombre AS nombre_sfp, s.multa, s.institucion_sancionadora,
        s.inicio, s.fin, s.plazo_txt,
        coalesce(c.fecha_efectiva BETWEEN s.inicio AND s.fin, FALSE)
          AS durante_inhabilitacion,
        row_number() OVER (PARTITION BY c.cid ORDER BY
          coalesce(c.fecha_efectiva BETWEEN s.inicio AND s.fin, FALSE) DESC,
          s.inicio DESC NULLS LAST, s.fin DESC NULLS LAST) AS rn
      FROM (SELECT *, row_number() OVER () AS cid FROM contracts) c
      JOIN sfp s USING (rfc_norm))
    WHERE rn = 1"""

CTES["archive"] = f"""
    SELECT * FROM (
      SELECT *, row_number() OVER (PARTITION BY codigo_contrato
          ORDER BY importe_num DESC, fecha, proveedor, codigo_expediente) AS rn,
        {nn('proveedor')} AS nombre_norm
      FROM (
        SELECT CASE WHEN l_orderkey % 97 <> 0 THEN 'C' || l_orderkey END
            AS codigo_contrato,
          l_orderkey || '-' || l_linenumber AS codigo_expediente,
          s_name || CASE l_linenumber % 3 WHEN 0 THEN ', S.A. DE C.V.'
            WHEN 1 THEN ' S. de R.L.' ELSE '' END AS proveedor,
          CASE WHEN l_returnflag = 'R' THEN 'USD' ELSE 'MXN' END AS moneda,
          'CONTRATO ' || l_partkey AS titulo_contrato,
          'PARTE ' || l_partkey AS descripcion_contrato,
          CAST({_AMOUNT} AS DOUBLE) AS importe_num, dia AS fecha
        FROM sales))
    WHERE rn = 1"""

CTES["archive_hits"] = f"""
    SELECT a.*, e.situacion, e.fecha_definitivo, e.rfc_norm AS rfc_69b,
      e.nombre AS nombre_69b,
      coalesce(a.fecha > e.fecha_definitivo, FALSE) AS iniciado_despues_definitivo
    FROM archive a JOIN (
      SELECT *, {nn('nombre')} AS nombre_norm FROM efos) e USING (nombre_norm)
    WHERE length(a.nombre_norm) >= 8"""

CTES["states"] = f"""
    SELECT r_name AS estado_comprador, r_regionkey AS id_entidad,
      'S' || n_nationkey AS id_sujeto,
      n_name || '/' || c_mktsegment AS sujeto_obligado,
      strftime(dia, '%Y') AS ejercicio, {_KIND} AS tipo_procedimiento,
      CASE WHEN l_linenumber % 8 = 4 THEN CAST(l_orderkey AS VARCHAR) END
        AS expediente,
      CASE WHEN l_linenumber % 4 <> 0
        THEN l_orderkey || '-' || l_linenumber END AS num_contrato,
      CASE WHEN l_linenumber = 7 THEN 'PERSONA FISICA'
        ELSE s_name || ', S.A. de C.V.' END AS proveedor,
      CASE WHEN l_linenumber % 5 = 0 THEN 'NA' ELSE rfc END AS rfc_norm,
      l_linenumber % 5 <> 0 AS rfc_valido, constituida, dia AS fecha_efectiva,
      CASE WHEN l_partkey % 500 = 0 THEN CAST({_AMOUNT} AS DOUBLE) * 1e4
        ELSE CAST({_AMOUNT} AS DOUBLE) END AS importe,
      CASE WHEN l_returnflag = 'A' THEN 'MXN'
        WHEN l_returnflag = 'R' AND l_suppkey % 10 = 0 THEN 'USD'
        WHEN l_returnflag = 'R' THEN 'PESO MEXICANO' END AS moneda,
      {_LINK} AS direccion_anuncio, 'PARTE ' || l_partkey AS descripcion,
      'OBJETO ' || l_linenumber AS objeto, l_linenumber
    FROM sales JOIN region ON n_regionkey = r_regionkey"""

CTES["state_efos"] = f"""
    SELECT s.*, e.situacion, e.fecha_definitivo,
      coalesce(s.fecha_efectiva > e.fecha_definitivo, FALSE)
        AS firmado_despues_definitivo, {PLAUSIBLE} AS importe_plausible
    FROM states s JOIN efos e USING (rfc_norm)
    WHERE rfc_valido AND e.situacion IN ('Definitivo', 'Presunto')"""

CTES["state_sfp"] = CTES["sfp_hits"].replace("FROM contracts)", "FROM states "
                                              "WHERE rfc_valido)")

_F05 = f"""SELECT proveedor, rfc_norm AS rfc, {iso('inicio')} AS inhabilitado_desde,
      {iso('fin')} AS hasta, {iso('fecha_efectiva')} AS fecha_contrato, institucion,
      orden_gobierno, estado_comprador, tipo_procedimiento, importe,
      {rnd('importe / 1e6', 2)} AS monto_mxn_millones, direccion_anuncio
    FROM sfp_hits WHERE durante_inhabilitacion AND {MXN}"""
CTES["f05"] = _F05

CTES["f01d"] = f"""
    SELECT file_year, codigo_contrato, num_contrato, titulo_contrato, proveedor,
      rfc_norm AS rfc, situacion, {iso('fecha_definitivo')} AS definitivo_dof,
      {iso('fecha_efectiva')} AS fecha_contrato, firmado_despues_definitivo,
      institucion, nombre_uc, orden_gobierno, estado_comprador,
      tipo_procedimiento, importe, moneda_efectiva, direccion_anuncio
    FROM hits WHERE situacion IN ('Definitivo', 'Presunto')"""

CTES["f07"] = f"""
    SELECT file_year, institucion, nombre_uc, proveedor, rfc_norm AS rfc,
      codigo_contrato, num_contrato, titulo_contrato, ley, tipo_procedimiento,
      monto_original, monto_ultimo_convenio,
      {rnd('100.0 * (monto_ultimo_convenio - monto_original) / monto_original', 1)}
        AS pct_incremento,
      CASE WHEN ley LIKE '%OBRAS%' THEN 25.0::DOUBLE ELSE 20.0::DOUBLE END
        AS tope_legal_pct,
      {iso('fecha_efectiva')} AS fecha_contrato, fecha_firma_ultimo_conv,
      direccion_anuncio
    FROM contracts
    WHERE {MXN} AND monto_original > 0
      AND monto_ultimo_convenio > monto_original * (1.0::DOUBLE
        + CASE WHEN ley LIKE '%OBRAS%' THEN 0.25::DOUBLE ELSE 0.2::DOUBLE END
        + 0.0005::DOUBLE)"""

CTES["rot_base"] = f"""
    SELECT institucion, nombre_uc, proveedor, rfc_norm, count(*) AS n,
      sum({dec('importe')}) FILTER (WHERE {MXN}) AS monto,
      count(DISTINCT file_year) AS anios, min(fecha_efectiva) AS primer_contrato
    FROM contracts WHERE tipo_procedimiento LIKE 'LICITACI%'
    GROUP BY ALL"""

CTES["rot"] = """
    SELECT institucion, nombre_uc, sum(n) AS contratos, count(*) AS k,
      max(anios) AS anios_activos, sum(monto) AS monto, max(e) AS evenness,
      string_agg(proveedor || ' (' || n || ')', ' | '
        ORDER BY n DESC, proveedor, rfc_norm) AS proveedores
    FROM (
      SELECT *, -sum(n / total * ln(n / total))
          OVER (PARTITION BY institucion, nombre_uc) / ln(nsup) AS e
      FROM (SELECT *,
          CAST(sum(n) OVER (PARTITION BY institucion, nombre_uc) AS DOUBLE) AS total,
          count(*) OVER (PARTITION BY institucion, nombre_uc) AS nsup
        FROM rot_base)
      WHERE nsup BETWEEN 2 AND 5 AND total >= 4)
    GROUP BY 1, 2 HAVING max(e) >= 0.75 - 1e-12"""


def ring_ctes(prefix: str, source: str, keys: str, where: str, counted: str,
              least: int) -> None:
    """Rings by comparing every firm with the run that starts at each firm."""
    CTES[f"{prefix}_firms"] = f"""
    SELECT {keys}, rfc_norm, min(proveedor) AS proveedor,
      min(constituida) AS constituida, min(fecha_efectiva) AS primer_contrato,
      count(*) AS contratos, sum({dec('importe')}) FILTER (WHERE {counted}) AS monto
    FROM {source} WHERE {where} GROUP BY {keys}, rfc_norm"""
    CTES[f"{prefix}_start"] = f"""
    SELECT {keys}, desde FROM (
      SELECT {keys}, desde, row_number() OVER (PARTITION BY {keys}
          ORDER BY size DESC, desde) AS rn
      FROM (SELECT {keys}, constituida AS desde, count(*) OVER (
              PARTITION BY {keys} ORDER BY constituida
              RANGE BETWEEN CURRENT ROW AND INTERVAL 30 DAYS FOLLOWING) AS size
            FROM {prefix}_firms)
      WHERE size >= {least}) WHERE rn = 1"""
    CTES[f"{prefix}_members"] = f"""
    SELECT f.* FROM {prefix}_firms f JOIN {prefix}_start USING ({keys})
    WHERE constituida BETWEEN desde AND desde + 30"""
    CTES[f"{prefix}_sum"] = f"""
    SELECT {keys}, count(*) AS empresas,
      date_diff('day', min(constituida), max(constituida))
        AS dias_entre_constituciones,
      {iso('min(constituida)')} AS constituidas_desde,
      {iso('max(constituida)')} AS constituidas_hasta,
      {big('sum(contratos)')} AS contratos,
      coalesce({mill('sum(monto)', 1)}, 0.0) AS monto_mxn_millones,
      string_agg(proveedor || ' (' || rfc_norm || ', ' || {iso('constituida')}
        || ')', ' | ' ORDER BY constituida, rfc_norm) AS proveedores
    FROM {prefix}_members GROUP BY {keys}"""


RING_LEAST = 4
ring_ctes("ring", "contracts", "institucion, nombre_uc", "TRUE", MXN, RING_LEAST)
ring_ctes("sring", "states", "estado_comprador, sujeto_obligado", "rfc_valido",
          PLAUSIBLE, 3)

CTES["splits"] = f"""
    SELECT institucion, proveedor, rfc_norm, fecha_efectiva AS dia,
      count(*) AS contratos, CAST(sum({dec('importe')}) AS DOUBLE) AS total_mxn,
      {rnd(f"max(importe) / CAST(sum({dec('importe')}) AS DOUBLE)", 2)} AS pct_mayor
    FROM contracts WHERE {DIRECT} AND {MXN}
    GROUP BY 1, 2, 3, 4
    HAVING count(*) >= 2 AND sum({dec('importe')}) >= 1000000"""

CTES["d02f"] = f"""
    SELECT rfc_norm, fecha_efectiva AS flag_date FROM (
      SELECT rfc_norm, fecha_efectiva, row_number() OVER (
        PARTITION BY rfc_norm ORDER BY fecha_efectiva) AS rn
      FROM contracts WHERE {DIRECT})
    WHERE rn = 10 AND rfc_norm IN (
      SELECT rfc_norm FROM contracts GROUP BY 1
      HAVING count(*) FILTER (WHERE {DIRECT}) >= 10
        AND count(*) FILTER (WHERE {DIRECT}) >= 0.4 * count(*)
        AND sum({dec('importe')}) FILTER (WHERE {DIRECT} AND {MXN}) >= 20000000)"""

CTES["d04f"] = f"""
    SELECT rfc_norm, min(fecha_efectiva) AS flag_date FROM aged
    WHERE edad_dias < 365 AND importe >= 1e6 AND {MXN} GROUP BY 1"""

CTES["flags"] = """
    SELECT 'd04_joven_y_grande' AS senal, rfc_norm, flag_date FROM d04f
    UNION ALL SELECT 'd02_concentracion_directas', rfc_norm, flag_date FROM d02f
    UNION ALL SELECT 'd06_fraccionamiento', rfc_norm, min(dia) FROM splits GROUP BY 2
    UNION ALL SELECT 'd06_anillo_constitucion', rfc_norm, min(primer_contrato)
      FROM ring_members GROUP BY 2
    UNION ALL SELECT 'd06_rotacion', rfc_norm, min(primer_contrato)
      FROM rot_base JOIN rot USING (institucion, nombre_uc) GROUP BY 2
    UNION ALL SELECT 'd07_convenio_inflado', rfc, min(CAST(fecha_contrato AS DATE))
      FROM f07 GROUP BY 2"""

CTES["composite"] = """
    SELECT rfc_norm, min(flag_date) AS flag_date FROM flags GROUP BY 1
    HAVING count(DISTINCT senal) >= 2"""

CTES["sanctions"] = """
    SELECT rfc_norm, min(d) AS fecha_sancion FROM (
      SELECT rfc_norm, least(coalesce(fecha_presunto, fecha_definitivo),
        coalesce(fecha_definitivo, fecha_presunto)) AS d FROM efos
      UNION ALL SELECT rfc_norm, inicio FROM sfp) WHERE d IS NOT NULL GROUP BY 1"""

CTES["universe"] = "SELECT rfc_norm, min(fecha_efectiva) AS t0 FROM contracts GROUP BY 1"

_LABELS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in V.SIGNAL_LABELS.items())
CTES["ensemble"] = f"""
    SELECT f.rfc_norm AS rfc, c.proveedor, f.n_senales, f.senales,
      f.primera_marca, c.contratos, c.monto_mxn_millones, c.dependencias,
      e.situacion IS NOT NULL AS en_69b, e.situacion AS situacion_69b,
      s.rfc_norm IS NOT NULL AS inhabilitado_sfp
    FROM (SELECT rfc_norm, CAST(count(DISTINCT senal) AS INTEGER) AS n_senales,
        string_agg(CASE senal {_LABELS} END, '; ' ORDER BY senal) AS senales,
        min(flag_date) AS primera_marca FROM flags GROUP BY 1) f
    LEFT JOIN (SELECT rfc_norm, min(proveedor) AS proveedor, count(*) AS contratos,
        {mill(f"sum({dec('importe')}) FILTER (WHERE {MXN})", 2)}
          AS monto_mxn_millones,
        count(DISTINCT institucion) AS dependencias
      FROM contracts GROUP BY 1) c USING (rfc_norm)
    LEFT JOIN efos e USING (rfc_norm)
    LEFT JOIN (SELECT DISTINCT rfc_norm FROM sfp) s USING (rfc_norm)"""

CTES["f10cov"] = f"""
    SELECT estado_comprador, ejercicio, count(*) AS contratos,
      {rnd('100.0 * count(*) FILTER (WHERE rfc_valido) / count(*)', 1)}
        AS pct_rfc_valido,
      {rnd('100.0 * count(fecha_efectiva) / count(*)', 1)} AS pct_con_fecha,
      {mill(f"sum({dec('importe')}) FILTER (WHERE {PLAUSIBLE})", 1)}
        AS monto_mxn_millones,
      count(DISTINCT id_sujeto) AS sujetos_obligados
    FROM states GROUP BY 1, 2"""

CTES["f10conc"] = f"""
    WITH pairs AS (
      SELECT estado_comprador, sujeto_obligado, proveedor, count(*) AS contratos,
        sum({dec('importe')}) AS paid
      FROM states WHERE {DIRECT} AND {PLAUSIBLE} AND l_linenumber <> 7
      GROUP BY 1, 2, 3)
    SELECT estado_comprador, sujeto_obligado, proveedor, contratos,
      {mill('paid', 2)} AS monto_mxn_millones,
      {rnd('100.0 * CAST(paid AS DOUBLE) / CAST(total AS DOUBLE)', 1)}
        AS pct_del_gasto_directo, {big('n')} AS directas_del_sujeto
    FROM (SELECT *, sum(paid) OVER (PARTITION BY sujeto_obligado) AS total,
        sum(contratos) OVER (PARTITION BY sujeto_obligado) AS n FROM pairs)
    WHERE total >= 1e7 AND n >= 15 AND CAST(paid AS DOUBLE) >= 0.02 * CAST(total AS DOUBLE)"""

CTES["f10e"] = f"""
    SELECT estado_comprador, sujeto_obligado, proveedor, rfc_norm AS rfc, situacion,
      {iso('fecha_definitivo')} AS definitivo_dof,
      {iso('fecha_efectiva')} AS fecha_contrato, firmado_despues_definitivo,
      tipo_procedimiento, ejercicio, importe,
      {rnd('importe / 1e6', 2)} AS monto_mxn_millones, importe_plausible,
      direccion_anuncio
    FROM state_efos"""

CTES["f10y"] = f"""
    SELECT estado_comprador, sujeto_obligado, proveedor, rfc_norm AS rfc,
      {iso('constituida')} AS constituida, {iso('fecha_efectiva')} AS fecha_contrato,
      CAST(date_diff('day', constituida, fecha_efectiva) AS INTEGER) AS edad_dias,
      tipo_procedimiento, ejercicio, importe,
      {rnd('importe / 1e6', 2)} AS monto_mxn_millones, direccion_anuncio
    FROM states WHERE rfc_valido AND {PLAUSIBLE} AND importe >= 1e6
      AND date_diff('day', constituida, fecha_efectiva) BETWEEN 0 AND 364"""

SQL: dict[str, str] = {}


def statement(body: str) -> str:
    """The body with the common table expressions it needs, in order."""
    needed: list[str] = []

    def need(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                need(CTES[name])
                if name not in needed:
                    needed.append(name)

    need(body)
    if not needed:
        return body
    parts = ",\n".join(f"{name} AS ({CTES[name]})" for name in needed)
    return f"WITH {parts}\n{body}"


# ------------------------------------------------------------- fraud list, d01
_VOLUME = (f"count(*) AS contratos, count(DISTINCT rfc_norm) AS empresas, "
           f"{mill(f'sum({dec('importe')}) FILTER (WHERE {MXN})', 1)} "
           "AS monto_mxn_millones")
SQL["d01_sanity"] = """
    SELECT file_year, count(*) AS contratos, count(rfc_norm) AS con_rfc,
      count(fecha_efectiva) AS con_fecha, count(importe) AS con_importe
    FROM contracts GROUP BY 1"""
SQL["d01_by_status_year"] = f"SELECT situacion, file_year, {_VOLUME} FROM hits GROUP BY 1, 2"
SQL["d01_after_definitive"] = f"""
    SELECT file_year, {_VOLUME} FROM hits
    WHERE situacion = 'Definitivo' AND firmado_despues_definitivo GROUP BY 1"""
SQL["d01_top25"] = f"""
    SELECT proveedor, rfc_norm AS rfc, situacion,
      {iso('fecha_definitivo')} AS definitivo_dof,
      {iso('fecha_efectiva')} AS fecha_contrato,
      firmado_despues_definitivo AS post_definitivo, institucion,
      tipo_procedimiento, {rnd('importe / 1e6', 2)} AS monto_mxn_millones,
      moneda_efectiva
    FROM hits WHERE situacion = 'Definitivo' AND {MXN}
    ORDER BY importe DESC, rfc_norm, fecha_efectiva, institucion, codigo_contrato
    LIMIT 25"""
SQL["d01_by_procedure"] = f"""
    SELECT tipo_procedimiento, count(*) AS contratos,
      {mill(f"sum({dec('importe')}) FILTER (WHERE {MXN})", 1)} AS monto_mxn_millones
    FROM hits WHERE situacion = 'Definitivo' GROUP BY 1"""
SQL["d01_detail"] = "SELECT * FROM f01d"

_AVOL = (f"count(*) AS contratos, count(DISTINCT nombre_norm) AS empresas, "
         f"{mill(f'''sum({dec('importe_num')}) FILTER (WHERE moneda = 'MXN')''', 1)}"
         " AS monto_mxn_millones")
SQL["d01h_universe"] = f"""
    SELECT count(*) AS contratos, min(fecha) AS desde, max(fecha) AS hasta,
      {rnd(mill(f"sum({dec('importe_num')}) FILTER (WHERE moneda = 'MXN')", 6)
           + " / 1e3", 1)} AS total_mxn_mmd FROM archive"""
SQL["d01h_by_status"] = f"SELECT situacion, {_AVOL} FROM archive_hits GROUP BY 1"
SQL["d01h_after_by_year"] = f"""
    SELECT CAST(year(fecha) AS INTEGER) AS anio, {_AVOL} FROM archive_hits
    WHERE situacion = 'Definitivo' AND iniciado_despues_definitivo GROUP BY 1"""
SQL["d01h_top"] = f"""
    SELECT proveedor, rfc_69b, {iso('fecha_definitivo')} AS definitivo_dof,
      {iso('fecha')} AS inicio_contrato, titulo_contrato,
      {rnd('importe_num / 1e6', 2)} AS monto_mxn_millones, codigo_contrato
    FROM archive_hits WHERE situacion = 'Definitivo'
      AND iniciado_despues_definitivo AND moneda = 'MXN'
    ORDER BY importe_num DESC, codigo_contrato LIMIT 25"""
SQL["d01h_detail"] = f"""
    SELECT 'name_match' AS match_method, proveedor, nombre_69b, rfc_69b, situacion,
      {iso('fecha_definitivo')} AS definitivo_dof, {iso('fecha')} AS inicio_contrato,
      iniciado_despues_definitivo, titulo_contrato, descripcion_contrato,
      importe_num, moneda, codigo_contrato, codigo_expediente
    FROM archive_hits WHERE situacion IN ('Definitivo', 'Presunto')"""

# --------------------------------------------------------- concentration, d02
SQL["d02_suppliers"] = f"""
    SELECT proveedor, rfc_norm AS rfc, '' AS contexto, count(*) AS contratos,
      count(*) FILTER (WHERE {DIRECT}) AS directas,
      {rnd(f'100.0 * count(*) FILTER (WHERE {DIRECT}) / count(*)', 1)} AS pct_directas,
      count(DISTINCT institucion) AS instituciones,
      {mill(f"sum({dec('importe')}) FILTER (WHERE {MXN})", 1)} AS monto_mxn_millones,
      {mill(f"sum({dec('importe')}) FILTER (WHERE {MXN} AND {DIRECT})", 1)}
        AS monto_directas_mxn_m
    FROM contracts GROUP BY 1, 2
    HAVING count(*) FILTER (WHERE {DIRECT}) >= 10
      AND 100.0 * count(*) FILTER (WHERE {DIRECT}) / count(*) >= 40
      AND sum({dec('importe')}) FILTER (WHERE {MXN} AND {DIRECT}) >= 20000000"""
SQL["d02_institutions"] = f"""
    SELECT institucion, count(*) AS contratos,
      {rnd(f'100.0 * count(*) FILTER (WHERE {DIRECT}) / count(*)', 1)}
        AS pct_directas_n,
      {mill(f"sum({dec('importe')}) FILTER (WHERE {MXN})", 1)} AS monto_mxn_millones,
      {rnd(f"100.0 * CAST(sum({dec('importe')}) FILTER (WHERE {MXN} AND {DIRECT}) AS DOUBLE)"
           f" / CAST(sum({dec('importe')}) FILTER (WHERE {MXN}) AS DOUBLE)", 1)}
        AS pct_directas_monto
    FROM contracts GROUP BY 1
    HAVING count(*) >= 100 AND sum({dec('importe')}) FILTER (WHERE {MXN}) >= 100000000
    ORDER BY pct_directas_monto DESC NULLS LAST, institucion LIMIT 40"""
SQL["d02_dependence"] = f"""
    SELECT nombre_uc, proveedor, {mill('paid', 1)} AS monto_directas_mxn_m,
      n AS n_directas,
      {rnd('100.0 * CAST(paid AS DOUBLE) / CAST(total AS DOUBLE)', 1)}
        AS pct_del_gasto_directo
    FROM (SELECT *, sum(paid) OVER (PARTITION BY nombre_uc) AS total,
        sum(n) OVER (PARTITION BY nombre_uc) AS nt
      FROM (SELECT nombre_uc, proveedor, count(*) AS n,
          sum({dec('importe')}) FILTER (WHERE {MXN}) AS paid
        FROM contracts WHERE {DIRECT} GROUP BY 1, 2))
    WHERE total >= 1000000 AND nt >= 5
      AND CAST(paid AS DOUBLE) >= 0.25 * CAST(total AS DOUBLE)
    ORDER BY paid DESC, nombre_uc, proveedor LIMIT 30"""
SQL["d02_flags"] = "SELECT * FROM d02f"


# -------------------------------------------------------------- digits, d03 d12
def digits_sql(source: str, group: str, where: str, least: int) -> tuple[str, str]:
    first = ("CAST(substr(CAST(CAST(floor(importe) AS BIGINT) AS VARCHAR), 1, 1)"
             " AS INTEGER)")
    second = ("CAST(substr(CAST(CAST(floor(importe) AS BIGINT) AS VARCHAR), 2, 1)"
              " AS INTEGER)")
    core = f"""
    amounts AS (SELECT {group} AS g, {first} AS d1, {second} AS d2
      FROM {source} WHERE importe >= 100 AND {where}),
    big_groups AS (SELECT g, count(*) AS n FROM amounts GROUP BY 1
      HAVING count(*) >= {least}),
    one AS (SELECT g, n, d, log10(1 + 1.0::DOUBLE / d) AS p,
        (SELECT count(*) FROM amounts a WHERE a.g = b.g AND a.d1 = d) AS o
      FROM big_groups b, range(1, 10) t(d)),
    two AS (SELECT g, n, d, p, (SELECT count(*) FROM amounts a
          WHERE a.g = b.g AND a.d2 = d) AS o
      FROM big_groups b, (SELECT d, sum(log10(1 + 1.0::DOUBLE / (10 * k + d))) AS p
        FROM range(0, 10) t(d), range(1, 10) u(k) GROUP BY 1)),
    m1 AS (SELECT g, n, avg(abs(o / n::DOUBLE - p)) AS mad1,
        sum((o - n * p) ** 2 / (n * p)) AS chi2 FROM one GROUP BY 1, 2),
    m2 AS (SELECT g, avg(abs(o / n::DOUBLE - p)) AS mad2 FROM two GROUP BY 1),
    tested AS (SELECT *, exp(-chi2 / 2) * (1 + chi2 / 2 + (chi2 / 2) ** 2 / 2
        + (chi2 / 2) ** 3 / 6) AS p_value FROM m1 JOIN m2 USING (g)),
    cut AS (SELECT max(p_value) AS c FROM (SELECT p_value,
        row_number() OVER (ORDER BY p_value) AS r, count(*) OVER () AS k FROM tested)
      WHERE p_value <= 0.05 * r / k)"""

    def band(x: str, limits) -> str:
        tests = " ".join(f"WHEN {x} <= {v} THEN '{n}'" for v, n in limits)
        return f"CASE {tests} ELSE 'NO CONFORME' END"

    table = f"""
    SELECT g AS {group}, {big('n')} AS n_contratos, {rnd('mad1', 4)} AS mad,
      {band('mad1', V.FIRST_DIGIT_BANDS)} AS banda_nigrini,
      {rnd('mad2', 4)} AS mad_segundo_digito,
      {band('mad2', V.SECOND_DIGIT_BANDS)} AS banda_segundo_digito,
      {rnd('chi2', 1)} AS chi2, {rnd('p_value', 9)} AS p_value,
      coalesce(p_value <= (SELECT c FROM cut), FALSE) AS no_conforme_fdr05
    FROM tested"""
    gap = "abs(o / n::DOUBLE - p)"
    z = (f"({gap} - CASE WHEN 0.5 / n < {gap} THEN 0.5 / n ELSE 0 END) "
         "/ sqrt(p * (1 - p) / n)")
    worst = f"""
    SELECT CAST(d AS INTEGER) AS digito, o AS observado,
      {rnd('100.0::DOUBLE * o / n', 1)} AS pct_observado,
      {rnd('p * 100', 1)} AS pct_benford, {rnd(z, 2)} AS z_nigrini,
      {z} > 1.96 AS anomalo
    FROM one WHERE g = (SELECT g FROM m1 ORDER BY {rnd('mad1', 4)} DESC, g LIMIT 1)"""
    return core, table, worst


def with_core(core: str, body: str) -> str:
    full = statement(body + core)
    tail = body + core
    head = full[:-len(tail)] if full != tail else "WITH "
    joiner = ",\n" if full != tail else ""
    return head.rstrip() + joiner + core + body


_CORE3, _T3, _W3 = digits_sql("contracts", "institucion", MXN, 300)
_CORE12, _T12, _W12 = digits_sql("states", "sujeto_obligado", PLAUSIBLE, 200)
SQL["d03_benford"] = with_core(_CORE3, _T3)
SQL["d03_worst_digits"] = with_core(_CORE3, _W3)
SQL["d12_benford"] = with_core(_CORE12, _T12)
SQL["d12_worst_digits"] = with_core(_CORE12, _W12)

# ----------------------------------------------------------------- ages, d04
SQL["d04_by_year"] = f"""
    SELECT file_year, count(*) AS contratos_pm,
      count(*) FILTER (WHERE edad_dias < 365) AS a_empresas_menores_1a,
      count(*) FILTER (WHERE edad_dias < 365 AND importe >= 1e6 AND {MXN})
        AS jovenes_y_grandes,
      {mill(f"sum({dec('importe')}) FILTER (WHERE edad_dias < 365 AND {MXN})", 1)}
        AS monto_a_menores_1a_mxn_m
    FROM aged GROUP BY 1"""
SQL["d04_top30"] = f"""
    SELECT proveedor, rfc_norm AS rfc, {iso('constituida')} AS constituida,
      {iso('fecha_efectiva')} AS fecha_contrato,
      CAST(edad_dias AS INTEGER) AS edad_dias, institucion,
      tipo_procedimiento, {rnd('importe / 1e6', 2)} AS monto_mxn_millones,
      'ejercido' AS tipo_monto, direccion_anuncio
    FROM aged WHERE edad_dias < 365 AND importe >= 1e6 AND {MXN}
    ORDER BY importe DESC, rfc_norm, fecha_efectiva, institucion, codigo_contrato
    LIMIT 30"""
SQL["d04_age_by_class"] = f"""
    SELECT CASE WHEN tipo_procedimiento LIKE 'ADJUDICACI%DIRECTA%'
        THEN 'ADJUDICACION DIRECTA'
      WHEN tipo_procedimiento LIKE 'INVITACI%' THEN 'INVITACION RESTRINGIDA'
      WHEN tipo_procedimiento LIKE 'LICITACI%' THEN 'LICITACION PUBLICA'
      ELSE 'OTRO' END AS procedimiento, count(*) AS contratos,
      {rnd('median(edad_dias) / 365.25::DOUBLE', 1)} AS edad_mediana_anios,
      {rnd('100.0 * count(*) FILTER (WHERE edad_dias < 365) / count(*)', 2)}
        AS pct_a_menores_1a
    FROM aged GROUP BY 1"""
_YOUNG = "count(*) FILTER (WHERE a < 365{})"
_OLD = "count(*) FILTER (WHERE a >= 365{})"
SQL["d04_enrichment"] = f"""
    SELECT {_YOUNG.format('')} AS empresas_jovenes, {_OLD.format('')} AS empresas_viejas,
      {_YOUNG.format(' AND d')} AS jovenes_definitivo,
      {_OLD.format(' AND d')} AS viejas_definitivo,
      {rnd(f"10000.0 * {_YOUNG.format(' AND d')} / nullif({_YOUNG.format('')}, 0)", 2)}
        AS tasa_jovenes_x10k,
      {rnd(f"10000.0 * {_OLD.format(' AND d')} / nullif({_OLD.format('')}, 0)", 2)}
        AS tasa_viejas_x10k
    FROM (SELECT rfc_norm, min(edad_dias) AS a,
        coalesce(bool_or(situacion = 'Definitivo'), FALSE) AS d
      FROM aged LEFT JOIN efos USING (rfc_norm) GROUP BY 1)"""
SQL["d04_flags"] = "SELECT * FROM d04f"

# ----------------------------------------------------------- debarment, d05
SQL["d05_universe"] = """
    SELECT count(*) AS sanciones, count(DISTINCT rfc_norm) AS empresas,
      count(DISTINCT rfc_norm) FILTER (WHERE fin >= DATE '1999-06-01')
        AS vigentes_aprox FROM sfp"""
SQL["d05_by_year"] = f"SELECT file_year, {_VOLUME} FROM sfp_hits GROUP BY 1"
SQL["d05_during"] = "SELECT * FROM f05"
SQL["d05_detail"] = f"""
    SELECT file_year, codigo_contrato, proveedor, rfc_norm AS rfc, nombre_sfp,
      {iso('inicio')} AS inhab_desde, {iso('fin')} AS inhab_hasta,
      {iso('fecha_efectiva')} AS fecha_contrato, durante_inhabilitacion,
      institucion, orden_gobierno, estado_comprador, tipo_procedimiento, importe,
      moneda_efectiva, multa, institucion_sancionadora, direccion_anuncio
    FROM sfp_hits"""

# ------------------------------------------------------------ collusion, d06
SQL["d06_rotation"] = f"""
    SELECT institucion, nombre_uc, {big('contratos')} AS contratos,
      k AS n_proveedores, {rnd('evenness', 3)} AS evenness, anios_activos,
      coalesce({mill('monto', 1)}, 0.0) AS monto_mxn_millones, proveedores
    FROM rot"""
SQL["d06_rotation_members"] = """
    SELECT institucion, nombre_uc, rfc_norm, proveedor, primer_contrato
    FROM rot_base SEMI JOIN rot USING (institucion, nombre_uc)"""
SQL["d06_rings"] = "SELECT * FROM ring_sum"
SQL["d06_ring_members"] = """
    SELECT institucion, nombre_uc, rfc_norm, proveedor, constituida,
      primer_contrato, contratos, CAST(monto AS DOUBLE) AS monto FROM ring_members"""
SQL["d06_splits"] = "SELECT * FROM splits"

# --------------------------------------- modifications, other buyer, bunching
SQL["d07_over_cap"] = "SELECT * FROM f07"
SQL["d07_total_increase"] = f"""
    SELECT count(*) AS contratos,
      {mill(f"sum({dec('monto_ultimo_convenio')} - {dec('monto_original')})", 1)}
        AS incremento_mxn_millones FROM f07"""
CTES["utility"] = f"""
    SELECT l_orderkey || '-' || l_linenumber AS numero,
      s_name || CASE WHEN l_linenumber % 2 = 0 THEN ' SA de CV' ELSE ' S.C.' END
        AS proveedor, {_KIND} AS tipo_procedimiento,
      CAST({_AMOUNT} AS VARCHAR) AS monto, n_name AS area_contratante,
      dia AS fecha, upper(replace(s_name, '#', ' ')) AS clave,
      row_number() OVER () AS uid
    FROM sales"""
SQL["d08_other_buyer"] = f"""
    SELECT numero, proveedor, '69-B' AS lista, e.rfc_norm AS rfc,
      e.situacion AS detalle, CAST(NULL AS BOOLEAN) AS durante_inhabilitacion,
      tipo_procedimiento, monto, {iso('fecha')} AS fecha, area_contratante,
      'name' AS match_method, TRUE AS needs_verification
    FROM utility JOIN efos e ON {nn('e.nombre')} = clave
    UNION ALL
    SELECT numero, proveedor, 'SFP', rfc_norm, 'inhabilitada ' || {iso('inicio')}
        || ' → ' || coalesce({iso('fin')}, 'None'), durante,
      tipo_procedimiento, monto, {iso('fecha')}, area_contratante, 'name', TRUE
    FROM (SELECT u.*, s.*,
        coalesce(fecha BETWEEN inicio AND fin, FALSE) AS durante,
        row_number() OVER (PARTITION BY uid ORDER BY
          coalesce(fecha BETWEEN inicio AND fin, FALSE) DESC, inicio DESC) AS rn
      FROM utility u JOIN sfp s ON {nn('s.nombre')} = clave) WHERE rn = 1"""


_CUTS = ", ".join(f"({t}, {t * 0.95!r}::DOUBLE, {t * 1.05!r}::DOUBLE)" for t in V.CUT_POINTS)
_NEAREST, _FARTHEST = min(V.CUT_POINTS) * 0.95, max(V.CUT_POINTS) * 1.05
# a term of the tail further than ten square roots of n from n / 2 is below 1e-80
SQL["d11_bunching"] = with_core(f"""
    amounts AS MATERIALIZED (SELECT institucion, importe FROM contracts
      WHERE {MXN} AND tipo_procedimiento NOT LIKE '%LICITACI%'
        AND importe BETWEEN {_NEAREST!r}::DOUBLE AND {_FARTHEST!r}::DOUBLE),
    scans AS (SELECT institucion, umbral, count(*) FILTER (WHERE importe < umbral) AS bajo,
        count(*) FILTER (WHERE importe > umbral) AS sobre,
        count(*) FILTER (WHERE importe = umbral) AS exacto
      FROM amounts JOIN (VALUES {_CUTS}) c(umbral, low, high)
        ON importe BETWEEN low AND high GROUP BY 1, 2),
    bt AS (SELECT *, bajo + sobre AS n, CAST(ceil(10 * sqrt(bajo + sobre)) AS BIGINT) AS far
      FROM scans WHERE bajo + sobre >= 30),
    bp AS MATERIALIZED (SELECT *, least(1.0::DOUBLE, list_sum(list_transform(
        range(greatest(bajo, n // 2 - far), least(n, greatest(bajo, n // 2) + far) + 1),
        lambda i: exp(lgamma(n + 1.0::DOUBLE) - lgamma(i + 1.0::DOUBLE)
          - lgamma(n - i + 1.0::DOUBLE) + n * ln(0.5::DOUBLE))))) AS p FROM bt),
    bcut AS (SELECT max(p) AS c FROM (SELECT p, row_number() OVER (ORDER BY p) AS r,
        count(*) OVER () AS k FROM bp) WHERE p <= 0.05 * r / k)""", f"""
    SELECT institucion, umbral, bajo, sobre, exacto, n AS n_ventana,
      {rnd('bajo::DOUBLE / nullif(sobre, 0)', 2)} AS razon,
      {rnd('p', 6)} AS p_binomial,
      coalesce(p <= (SELECT c FROM bcut), FALSE) AS q_fdr05,
      {rnd('100.0::DOUBLE * exacto / (n + exacto)', 1)} AS pct_exacto
    FROM bp""")

# --------------------------------------------------------- ensemble, backtest
SQL["d09_ensemble"] = "SELECT * FROM ensemble"
SQL["d09_distribution"] = f"""
    SELECT n_senales, count(*) AS proveedores,
      count(*) FILTER (WHERE en_69b) AS ya_sancionados,
      {rnd('100.0 * count(*) FILTER (WHERE en_69b) / count(*)', 1)}
        AS pct_ya_sancionado FROM ensemble GROUP BY 1"""
SQL["bt_signals"] = "SELECT * FROM flags"
SQL["bt_composite"] = "SELECT * FROM composite"
SQL["bt_sanctions"] = "SELECT * FROM sanctions"
SQL["bt_universe"] = "SELECT * FROM universe"

_ALL = (*sorted(V.SIGNAL_LABELS), V.COMPOSITE_SIGNAL)
_Z = "1.959963984540054::DOUBLE"


def _wilson(k: str, n: str, sign: str) -> str:
    p = f"({k}::DOUBLE / {n})"
    centre = f"({p} + {_Z} * {_Z} / (2 * {n}))"
    half = (f"{_Z} * sqrt({p} * (1 - {p}) / {n} + {_Z} * {_Z} "
            f"/ (4.0::DOUBLE * {n} * {n}))")
    value = f"({centre} {sign} {half}) / (1 + {_Z} * {_Z} / {n})"
    return (f"greatest(0.0::DOUBLE, {value})" if sign == "-"
            else f"least(1.0::DOUBLE, {value})")


_CHOOSE = ("(lgamma({0} + 1.0::DOUBLE) - lgamma({1} + 1.0::DOUBLE) "
           "- lgamma({0} - {1} + 1.0::DOUBLE))")
SQL["bt_evaluate"] = with_core(f"""
    long AS (SELECT * FROM flags UNION ALL
      SELECT '{V.COMPOSITE_SIGNAL}', rfc_norm, flag_date FROM composite),
    names AS (SELECT unnest({list(_ALL)!r}) AS senal),
    judged AS (SELECT l.*, fecha_sancion,
        coalesce(fecha_sancion > flag_date, FALSE) AS hit
      FROM long l LEFT JOIN sanctions USING (rfc_norm)),
    flagged AS (SELECT senal, count(*) AS n, count(*) FILTER (WHERE hit) AS k,
        median(date_diff('day', flag_date, fecha_sancion)) FILTER (WHERE hit) AS md
      FROM judged GROUP BY 1),
    base AS (SELECT names.senal, count(*) AS bn,
        count(*) FILTER (WHERE coalesce(fecha_sancion > t0, FALSE)) AS bk
      FROM names, universe LEFT JOIN sanctions USING (rfc_norm)
      WHERE NOT EXISTS (SELECT 1 FROM long WHERE long.senal = names.senal
        AND long.rfc_norm = universe.rfc_norm) GROUP BY 1),
    counted AS (SELECT senal, coalesce(n, 0) AS n, coalesce(k, 0) AS k, md,
        coalesce(bn, 0) AS bn, coalesce(bk, 0) AS bk
      FROM names LEFT JOIN flagged USING (senal) LEFT JOIN base USING (senal)),
    bounded AS (SELECT *,
        CASE WHEN n > 0 THEN {_wilson('k', 'n', '-')} END AS flo,
        CASE WHEN n > 0 THEN {_wilson('k', 'n', '+')} END AS fhi,
        CASE WHEN bn > 0 THEN {_wilson('bk', 'bn', '-')} END AS blo,
        CASE WHEN bn > 0 THEN {_wilson('bk', 'bn', '+')} END AS bhi FROM counted)""",
    f"""
    SELECT senal, n AS empresas_flag, k AS sancionadas_despues,
      {rnd('1e4 * (k / n::DOUBLE)', 1)} AS tasa_flag_x10k,
      CASE WHEN n > 0 THEN printf('%.0f–%.0f', 1e4 * flo, 1e4 * fhi) END
        AS tasa_flag_ic95,
      bn AS base_empresas, bk AS base_sancionadas,
      {rnd('1e4 * (bk / nullif(bn, 0)::DOUBLE)', 1)} AS tasa_base_x10k,
      CASE WHEN n > 0 AND bk > 0 THEN
        {rnd('(k / n::DOUBLE) / (bk / bn::DOUBLE)', 1)} END AS lift,
      CASE WHEN n > 0 AND bk > 0 AND bhi > 0 AND blo > 0
        THEN printf('%.1f–%.1f', flo / bhi, fhi / blo) END AS lift_ic95,
      CASE WHEN n > 0 THEN {rnd(
        "least(1.0::DOUBLE, list_sum(list_transform(range(greatest(k, k + bk - bn),"
        " least(n, k + bk) + 1), lambda a: exp("
        + _CHOOSE.format('n', 'a') + " + " + _CHOOSE.format('bn', '(k + bk - a)')
        + " - " + _CHOOSE.format('(n + bn)', '(k + bk)') + "))))", 4)} END AS p_fisher,
      CAST(floor(md) AS INTEGER) AS mediana_dias_a_sancion
    FROM bounded""")

# ------------------------------------------------------------- state layer, d10
SQL["d10_coverage"] = "SELECT * FROM f10cov"
SQL["d10_list_rfc"] = "SELECT * FROM f10e"
SQL["d10_windows"] = """
    SELECT estado_comprador, sujeto_obligado, proveedor, rfc_norm, fecha_efectiva,
      importe, tipo_monto, nombre_sfp, multa, institucion_sancionadora, inicio, fin,
      plazo_txt, durante_inhabilitacion
    FROM (SELECT *, 'con_impuestos' AS tipo_monto FROM state_sfp)"""
SQL["d10_by_name"] = f"""
    SELECT estado_comprador, sujeto_obligado, proveedor, e.rfc_norm AS rfc_69b,
      e.situacion, {iso('fecha_definitivo')} AS definitivo_dof,
      {iso('fecha_efectiva')} AS fecha_contrato, ejercicio, importe,
      {rnd('importe / 1e6', 2)} AS monto_mxn_millones, direccion_anuncio
    FROM states s JOIN efos e ON {nn('s.proveedor')} = {nn('e.nombre')}
    WHERE NOT rfc_valido AND e.situacion = 'Definitivo'"""
SQL["d10_young"] = "SELECT * FROM f10y"
SQL["d10_concentration"] = "SELECT * FROM f10conc"
SQL["d10_rings"] = f"""
    SELECT estado_comprador, sujeto_obligado, empresas, t AS proveedores_del_sujeto,
      {rnd('100.0 * empresas / t', 1)} AS pct_del_sujeto, dias_entre_constituciones,
      constituidas_desde, constituidas_hasta, contratos, monto_mxn_millones,
      proveedores
    FROM sring_sum JOIN (SELECT sujeto_obligado, count(DISTINCT rfc_norm) AS t
      FROM sring_firms GROUP BY 1) USING (sujeto_obligado)
    WHERE empresas / t::DOUBLE >= 0.04"""
SQL["d10_dedupe"] = f"""
    SELECT estado_comprador, ejercicio, formato, count(*) AS contratos,
      CAST(sum({dec('importe')}) AS DOUBLE) AS importe
    FROM (SELECT *, row_number() OVER (PARTITION BY id_entidad, ejercicio, id_sujeto,
          coalesce(num_contrato, expediente, md5(descripcion || '|' || objeto)),
          rfc_norm, importe, fecha_efectiva
        ORDER BY formato DESC) AS rn
      FROM (SELECT *, '59729' AS formato FROM states
        UNION ALL SELECT *, '59730' FROM states WHERE l_linenumber % 3 = 0))
    WHERE rn = 1 GROUP BY 1, 2, 3"""

# ------------------------------------------------ canonicalisation, gazette
SQL["canon_contracts"] = f"""
    SELECT strftime(dia, '%Y') AS file_year,
      CASE WHEN l_linenumber % 3 = 0 THEN 'ejercido' ELSE 'techo_maximo' END
        AS tipo_monto,
      CASE WHEN l_linenumber % 3 = 0 THEN 'MXN' ELSE 'USD' END AS moneda_efectiva,
      CASE WHEN l_linenumber % 2 = 0 THEN CASE n_nationkey + 55
        {' '.join(f"WHEN {k} THEN '{v}'" for k, v in V.BRANCH_STATES.items())} END
        END AS estado_comprador, count(*) AS contratos, count(dia) AS con_fecha,
      count(DISTINCT rfc) AS empresas, min(dia) AS desde, max(constituida) AS joven,
      CAST(sum({_AMOUNT}) AS DOUBLE) AS importe
    FROM sales GROUP BY 1, 2, 3, 4"""
SQL["src_contracts"] = f"""
    SELECT CASE WHEN l_linenumber % 3 = 0 THEN 'ejercido' ELSE 'techo_maximo' END AS tipo_monto,
      CASE WHEN l_linenumber % 3 = 0 THEN 'MXN' ELSE 'USD' END AS moneda_efectiva,
      CASE WHEN l_linenumber % 2 = 0 THEN CASE n_nationkey + 55
        {' '.join(f"WHEN {k} THEN '{v}'" for k, v in V.BRANCH_STATES.items())} END
        END AS estado_comprador, count(*) AS contratos, count(dia) AS con_fecha,
      count(DISTINCT rfc) AS empresas, min(dia) AS desde, max(constituida) AS joven,
      CAST(sum({_AMOUNT}) AS DOUBLE) AS importe, count(DISTINCT rfc) AS titulos,
      CAST(sum(length(rfc) + 17) AS BIGINT) AS largo, 'OBRA "Ñ", ' AS titulo
    FROM sales GROUP BY 1, 2, 3"""
SQL["src_efos"] = """
    SELECT rfc_norm, nombre, situacion, fecha_definitivo, fecha_presunto FROM efos"""
SQL["src_states"] = f"""
    SELECT estado_comprador, ejercicio, 'con_impuestos' AS tipo_monto, count(*) AS contratos,
      count(fecha_efectiva) AS con_fecha, count(*) FILTER (WHERE rfc_norm <> 'NA') AS validos,
      count(DISTINCT proveedor) AS empresas, max(fecha_efectiva + later) AS hasta,
      max(objeto) AS objeto, CAST(sum({dec('importe')}) AS DOUBLE) AS importe
    FROM states JOIN (VALUES (0), (90)) r(later) ON later = 0 OR l_linenumber % 3 = 0
    GROUP BY 1, 2"""
SQL["name_norm"] = f"""
    SELECT doc_id, md5({nn('text')}) AS clave, length({nn('text')}) AS largo
    FROM documents"""
CTES["raw_keys"] = """
    SELECT r_name AS estado, CASE l_linenumber WHEN 1 THEN ' ' || lower(rfc) || ' '
        WHEN 2 THEN '' WHEN 3 THEN 'NA' WHEN 4 THEN 'XAXX010101000'
        WHEN 5 THEN substr(rfc, 1, 3) || ' ' || substr(rfc, 4) ELSE rfc END AS raw
    FROM sales JOIN region ON n_regionkey = r_regionkey"""
_BARE = "upper(replace(trim(raw), ' ', ''))"
SQL["rfc_quality"] = f"""
    SELECT estado, count(*) AS n,
      count(*) FILTER (WHERE regexp_matches({_BARE}, '{_RFC}')) AS valido,
      count(*) FILTER (WHERE {_BARE} = '') AS vacio,
      count(*) FILTER (WHERE {_BARE} <> ''
        AND NOT regexp_matches({_BARE}, '{_RFC}')) AS basura,
      count(*) FILTER (WHERE {_BARE} IN ('XAXX010101000', 'XEXX010101000'))
        AS genericos
    FROM raw_keys GROUP BY 1"""
_STATE_OF = (f"CASE WHEN o_orderkey % 40 + 52 BETWEEN 60 AND 91 THEN CASE "
             "o_orderkey % 40 + 52 "
             + ' '.join(f"WHEN {k} THEN '{v}'" for k, v in V.BRANCH_STATES.items())
             + " END END")
SQL["buyer_states"] = f"""
    SELECT {_STATE_OF} AS estado, count(*) AS procedimientos FROM orders GROUP BY 1"""
CTES["circulars"] = """
    SELECT k AS cod_nota, strftime(f, '%Y-%m-%d') AS fecha_dof, titulo, quien,
      'https://dof.gob.mx/nota_detalle.php?codigo=' || k || '&fecha='
        || strftime(f, '%d/%m/%Y') AS url, f AS fecha
    FROM (SELECT s_suppkey AS k, DATE '1996-01-01'
          + CAST((s_suppkey * 29) % 1800 AS INTEGER) AS f,
        'CIRCULAR por la que se comunica que deberán abstenerse de aceptar '
          || 'propuestas y/o celebrar contratos con ' || CASE s_suppkey % 4
            WHEN 0 THEN 'la empresa ' || s_name || ', S.A. de C.V.'
            WHEN 1 THEN 'las empresas ' || s_name || ', S.A. de C.V. y Filial '
              || s_name || ', S. de R.L.'
            ELSE 'la persona moral denominada ' || s_name || ', S.A. de C.V.' END
          AS titulo,
        unnest(CASE s_suppkey % 4 WHEN 1
          THEN [s_name || ', S.A. de C.V.', 'Filial ' || s_name || ', S. de R.L']
          ELSE [s_name || ', S.A. de C.V'] END) AS quien
      FROM supplier WHERE s_suppkey % 4 <> 3)"""
SQL["dof_parse"] = "SELECT cod_nota, fecha_dof, titulo, quien, url FROM circulars"
CTES["dof_recent"] = f"""
    SELECT * FROM (SELECT *, {nn('quien')} AS clave, row_number() OVER (
        PARTITION BY {nn('quien')} ORDER BY fecha DESC, cod_nota DESC) AS rn
      FROM circulars WHERE DATE '1999-01-01' - fecha <= 180) WHERE rn = 1"""
SQL["dof_recent"] = "SELECT clave AS nombre_norm, cod_nota, fecha_dof, quien FROM dof_recent"
_BODY = r"regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')"
SQL["dof_bodies"] = rf"""
    SELECT page_id, md5({_BODY}) AS cuerpo,
      nullif(regexp_extract({_BODY}, '{V.GAZETTE_RFC}', 1), '') AS rfc,
      nullif(trim(regexp_extract({_BODY}, '{V.GAZETTE_TERM}', 1)), '') AS plazo_txt
    FROM pages"""

# ---------------------------------------------------------------- live layer
CTES["changes"] = """
    SELECT *, CASE WHEN previous IS NULL THEN 'new' ELSE 'status_change' END AS change
    FROM (SELECT CAST(user_id AS VARCHAR) AS uuid, event_type AS estatus, ts, event_id,
        lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous
      FROM events) WHERE previous IS NULL OR previous <> estatus"""
SEEN_DAYS = 1.5


def _seen(days: float) -> str:
    """Row by row: the status and time of the last row found are carried along."""
    minutes = round(days * 1440)
    return f"""
    WITH RECURSIVE feed AS (
      SELECT CAST(user_id AS VARCHAR) AS uuid, event_type AS estatus, ts, event_id,
        row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
    walk AS (
      SELECT uuid, estatus, ts, event_id, n, CAST(NULL AS VARCHAR) AS previous,
        'new' AS change, ts AS first_seen, estatus AS held, ts AS last, TRUE AS found
      FROM feed WHERE n = 1
      UNION ALL
      SELECT f.uuid, f.estatus, f.ts, f.event_id, f.n,
        CASE WHEN NOT old THEN held END,
        CASE WHEN old THEN 'new' ELSE 'status_change' END,
        CASE WHEN old THEN f.ts ELSE first_seen END,
        CASE WHEN old OR f.estatus <> held THEN f.estatus ELSE held END,
        CASE WHEN old OR f.estatus <> held THEN f.ts ELSE last END,
        old OR f.estatus <> held
      FROM (SELECT f.*, w.held, w.last, w.first_seen,
          f.ts > w.last + INTERVAL {minutes} MINUTE AS old
        FROM walk w JOIN feed f ON f.uuid = w.uuid AND f.n = w.n + 1) f)
    SELECT uuid, estatus, ts, event_id, previous, change, first_seen FROM walk WHERE found"""


SQL["rt_seen_diff"] = SQL["rt_stream"] = _seen(V.SEEN_MAX_AGE_DAYS).strip()
SQL["rt_seen_expiry"] = SQL["rt_stream_expiry"] = _seen(SEEN_DAYS).strip()

_DIRECTA = "(kind LIKE '%ADJUDICACI%' AND kind LIKE '%DIRECTA%')"
CTES["award_hits"] = f"""
    SELECT md5(CAST(l_orderkey AS VARCHAR)) AS uuid, e.situacion,
      s.rfc_norm IS NOT NULL AS s_hit,
      coalesce(list_bool_or(list_transform(s.w, lambda x:
        coalesce(a.fecha BETWEEN x.inicio AND x.fin, FALSE))), FALSE) AS during,
      d.fecha AS d_fecha, a.fecha,
      CASE WHEN l_tax > 0 THEN CAST({_AMOUNT} * 2 AS DOUBLE)
        ELSE CAST({_AMOUNT} AS DOUBLE) END AS amount, l_returnflag <> 'R' AS pesos
    FROM (SELECT *, CAST(l_shipdate AS DATE) AS fecha FROM lineitem) a
    JOIN (SELECT *, {nn('s_name')} AS clave FROM sup) p ON l_suppkey = s_suppkey
    LEFT JOIN (SELECT *, {nn('nombre')} AS clave FROM efos) e USING (clave)
    LEFT JOIN (SELECT rfc_norm, {nn('nombre')} AS clave,
        list({{'inicio': inicio, 'fin': fin}}) AS w FROM sfp GROUP BY 1, 2) s
      USING (clave)
    LEFT JOIN dof_recent d USING (clave)"""
CTES["fired"] = f"""
    SELECT uuid, 'EFOS_69B' AS code,
      CASE WHEN situacion = 'Definitivo' THEN 6 ELSE 2 END AS weight
      FROM award_hits WHERE situacion IS NOT NULL
    UNION ALL SELECT uuid, 'SFP_SANCION', CASE WHEN during THEN 8 ELSE 3 END
      FROM award_hits WHERE s_hit
    UNION ALL SELECT uuid, 'DOF_INHABILITACION',
      CASE WHEN fecha >= d_fecha THEN 8 ELSE 3 END
      FROM award_hits WHERE d_fecha IS NOT NULL AND NOT s_hit
    UNION ALL SELECT uuid, 'MONTO_ALTO', 1 FROM award_hits
      WHERE pesos AND amount >= 5e6
    UNION ALL SELECT uuid, unnest(list_filter([
        CASE WHEN {_DIRECTA} THEN 'DIRECTA' END,
        CASE WHEN rec AND o_orderstatus = 'P' THEN 'PLAZO_RECORTADO' END,
        CASE WHEN rec AND kind LIKE 'LICITACI%' AND o_custkey % 25 < 10
          THEN 'PLAZO_COMPRIMIDO' END,
        CASE WHEN rec AND o_custkey % 7 = 0 THEN 'EMERGENCIA' END,
        CASE WHEN rec AND {_DIRECTA} AND o_custkey % 3 = 0 THEN 'EXCEPCION' END,
        CASE WHEN rec AND o_custkey % 5 = 0 THEN 'ANTICIPO' END],
        lambda x: x IS NOT NULL)) AS code, NULL
      FROM (SELECT *, md5(CAST(o_orderkey AS VARCHAR)) AS uuid,
          o_orderkey % 11 <> 0 AS rec, coalesce({_KIND}, '') AS kind FROM orders)"""
CTES["assessed"] = f"""
    SELECT o.*, coalesce(f.score, 0) AS score, coalesce(n_flags, 0) AS n_flags,
      coalesce(codes, '') AS codes, coalesce(listed, 0) AS listed
    FROM (SELECT *, md5(CAST(o_orderkey AS VARCHAR)) AS uuid FROM orders) o
    LEFT JOIN (SELECT uuid, CAST(sum(w) AS INTEGER) AS score, {big('sum(n)')} AS n_flags,
        string_agg(code || ':' || n, ',' ORDER BY code) AS codes,
        CAST(coalesce(sum(n) FILTER (WHERE code IN ('EFOS_69B', 'SFP_SANCION',
          'DOF_INHABILITACION')), 0) AS INTEGER) AS listed
      FROM (SELECT uuid, code, count(*) AS n, sum(coalesce(weight, CASE
            WHEN code IN ('EXCEPCION', 'ANTICIPO') THEN 1 ELSE 2 END)) AS w
          FROM fired GROUP BY 1, 2)
      GROUP BY 1) f USING (uuid)"""
SQL["rt_rules"] = """
    SELECT uuid, 'LA-' || (o_orderkey % 40 + 52) || '-' || o_orderkey AS numero,
      score, n_flags, codes FROM assessed"""
SQL["rt_alerts"] = f"""
    SELECT '2002-01-01' AS ts, uuid, 'Procedimiento ' || o_orderkey AS nombre,
      score, CAST(n_flags AS INTEGER) AS razones, listed AS senaladas,
      replace('{V.PROCEDURE_URL}', '{{}}', uuid) AS url, 'new' AS change,
      CASE WHEN {_STATE_OF} IS NOT NULL THEN 'GEM' END AS orden_gobierno,
      {_STATE_OF} AS estado_comprador
    FROM assessed WHERE score >= 4"""

SQL["rt_alert_rules"] = """
    SELECT code, coalesce(weight, CASE WHEN code IN ('EXCEPCION', 'ANTICIPO') THEN 1 ELSE 2 END)
        AS weight, count(*) AS reglas, count(DISTINCT uuid) AS procedimientos,
      count(*) FILTER (WHERE code IN ('EFOS_69B', 'SFP_SANCION')) AS con_rfc
    FROM fired WHERE uuid IN (SELECT uuid FROM assessed WHERE score >= 4) GROUP BY 1, 2"""
_STATUS = "CASE WHEN o_orderstatus = 'F' THEN 'ADJUDICADO' ELSE 'VIGENTE' END"
SQL["rt_monitor"] = f"""
    SELECT uuid, 'Procedimiento ' || o_orderkey AS nombre,
      CASE change WHEN 'new' THEN {_STATUS} ELSE 'CANCELADO' END AS estatus, score,
      CAST(n_flags AS INTEGER) AS razones, listed AS senaladas,
      replace('{V.PROCEDURE_URL}', '{{}}', uuid) AS url, change,
      CASE WHEN {_STATE_OF} IS NOT NULL THEN 'GEM' END AS orden_gobierno,
      {_STATE_OF} AS estado_comprador
    FROM assessed, (VALUES ('new'), ('status_change')) c(change)
    WHERE score >= 4 AND (change = 'new' OR uuid < '4')"""
SQL["rt_best_alerts"] = f"""
    SELECT CASE WHEN o_orderstatus <> 'F' THEN '2002-01-02' ELSE '2002-01-01' END AS ts, uuid,
      CASE WHEN o_orderstatus <> 'F' THEN score + 2 ELSE score END AS score
    FROM assessed WHERE score >= 4"""

# -------------------------------------------------------------------- ledger
_LINKED = "nullif(regexp_extract(direccion_anuncio, 'detalle/([0-9a-f]{32})', 1), '')"
_PORTAL = f"coalesce(replace('{V.PROCEDURE_URL}', '{{}}', {_LINKED}), '')"
_SCOPE = ("CASE WHEN orden_gobierno LIKE '%ENTIDAD FEDERATIVA%' THEN 'estatal' "
          "ELSE 'federal' END")


def evidence(source: str, where: str = "TRUE", **values: str) -> str:
    kinds = {
        "case_id": "VARCHAR", "pattern": "VARCHAR", "scope": "VARCHAR",
        "ambito": "VARCHAR", "estado_geo": "VARCHAR", "rfc": "VARCHAR",
        "sujeto": "VARCHAR", "institucion": "VARCHAR", "source_file": "VARCHAR",
        "fecha": "DATE", "importe": "DOUBLE", "n": "BIGINT", "uuid": "VARCHAR",
        "url": "VARCHAR", "en_ventana": "BOOLEAN", "ventana": "VARCHAR",
        "rfc_valido": "BOOLEAN", "definitivo_dof": "VARCHAR",
        "pct_incremento": "DOUBLE", "tope_legal_pct": "DOUBLE",
        "n_senales": "INTEGER"}
    cells = ", ".join(f"CAST({values.get(k, 'NULL')} AS {t}) AS {k}"
                      for k, t in kinds.items())
    return f"SELECT {cells} FROM {source} WHERE {where}"


def q(x: str) -> str:
    return f"'{x}'"


_E05 = evidence(
    "f05", case_id=f"CASE WHEN {_SCOPE} = 'federal' THEN "
    + case_id(q("fed"), q("inhabilitado"), "rfc", "institucion") + " ELSE "
    + case_id(q("est"), q("inhabilitado"), "estado_comprador", "institucion", "rfc")
    + " END", pattern=q("inhabilitado"),
    scope=f"CASE WHEN {_SCOPE} = 'federal' THEN 'contrato' ELSE 'estatal' END",
    ambito=_SCOPE, estado_geo=f"CASE WHEN {_SCOPE} = 'estatal' THEN estado_comprador END",
    rfc="rfc", sujeto="proveedor", institucion="institucion",
    source_file=q("f05_durante_inhabilitacion"), fecha="fecha_contrato",
    importe="importe", n="1", uuid=_LINKED, url=_PORTAL, en_ventana="TRUE",
    ventana="inhabilitado_desde || '/' || hasta")
_E01 = evidence(
    "f01d", "situacion = 'Definitivo' AND firmado_despues_definitivo",
    case_id=case_id(q("fed"), q("efos"), "rfc"), pattern=q("efos"),
    scope=q("proveedor"), ambito=q("federal"), rfc="rfc", sujeto="proveedor",
    institucion="institucion", source_file=q("f01_detalle_completo"),
    fecha="fecha_contrato", importe="importe", n="1", uuid=_LINKED, url=_PORTAL,
    definitivo_dof="definitivo_dof")
_E07 = evidence(
    f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rfc, codigo_contrato
        ORDER BY monto_ultimo_convenio DESC, pct_incremento DESC, fecha_contrato,
          institucion, direccion_anuncio) AS rn FROM f07) WHERE rn = 1)""",
    case_id=case_id(q("fed"), q("convenio"), "rfc", "codigo_contrato"),
    pattern=q("convenio"), scope=q("contrato"), ambito=q("federal"), rfc="rfc",
    sujeto="proveedor", institucion="institucion",
    source_file=q("f07_convenios_inflados"), fecha="fecha_contrato",
    importe="monto_ultimo_convenio", n="1", uuid=_LINKED, url=_PORTAL,
    pct_incremento="pct_incremento", tope_legal_pct="tope_legal_pct")
_E10I = evidence(
    "state_sfp", "durante_inhabilitacion",
    case_id=case_id(q("est"), q("inhabilitado"), "estado_comprador",
                    "sujeto_obligado", "rfc_norm"),
    pattern=q("inhabilitado"), scope=q("estatal"), ambito=q("estatal"),
    estado_geo="estado_comprador", rfc="rfc_norm", sujeto="proveedor",
    institucion="sujeto_obligado", source_file=q("f10_inhabilitados_estatal"),
    fecha="fecha_efectiva", importe="importe", n="1", url="direccion_anuncio",
    en_ventana="TRUE", ventana=f"{iso('inicio')} || '/' || {iso('fin')}",
    rfc_valido="TRUE")
_E10E = evidence(
    "f10e", "firmado_despues_definitivo AND importe_plausible",
    case_id=case_id(q("est"), q("efos"), "estado_comprador", "sujeto_obligado", "rfc"),
    pattern=q("efos"), scope=q("estatal"), ambito=q("estatal"),
    estado_geo="estado_comprador", rfc="rfc", sujeto="proveedor",
    institucion="sujeto_obligado", source_file=q("f10_efos_estatal"),
    fecha="fecha_contrato", importe="importe", n="1", url="direccion_anuncio",
    definitivo_dof="definitivo_dof")
_E06 = evidence(
    "rot", case_id=case_id(q("fed"), q("rotacion"), "institucion", "nombre_uc"),
    pattern=q("rotacion"), scope=q("institucion"), ambito=q("federal"),
    sujeto="nombre_uc", institucion="institucion",
    source_file=q("f06_rotacion_licitaciones"),
    importe=f"coalesce({mill('monto', 1)}, 0.0) * 1e6", n="contratos")
_E12 = evidence(
    "ensemble", "n_senales >= 4", case_id=case_id(q("fed"), q("riesgo"), "rfc"),
    pattern=q("riesgo"), scope=q("proveedor"), ambito=q("federal"), rfc="rfc",
    sujeto="proveedor", source_file=q("f12_riesgo_proveedor"),
    importe="monto_mxn_millones * 1e6", n="contratos", n_senales="n_senales")
_E10C = evidence(
    "f10conc", case_id=case_id(q("est"), q("concentracion"), "estado_comprador",
                               "sujeto_obligado", "proveedor"),
    pattern=q("concentracion"), scope=q("estatal"), ambito=q("estatal"),
    estado_geo="estado_comprador", sujeto="proveedor", institucion="sujeto_obligado",
    source_file=q("f10_concentracion_estatal"),
    importe="monto_mxn_millones * 1e6", n="contratos")
CTES["evid"] = "\n    UNION ALL ".join((_E05, _E10I, _E01, _E10E, _E07, _E06, _E12, _E10C))
CTES["complaints"] = """
    SELECT rfc, institucion, regexp_extract(direccion_anuncio,
      'detalle/([0-9a-f]{32})', 1) AS uuid
    FROM f05 WHERE institucion IN ('NATION_1', 'NATION_7')"""


def cases_sql(source: str) -> str:
    return f"""
    SELECT c.*, coalesce(
        first_uuid IN (SELECT uuid FROM complaints), FALSE)
        OR coalesce(institucion IS NOT NULL AND (rfc, {nn('institucion')}) IN (
          SELECT (rfc, {nn('institucion')}) FROM complaints), FALSE)
        OR (n_ids > 0 AND n_open = 0) AS already_filed,
      sha1(concat_ws('|', scope, pattern, coalesce(rfc, ''),
        coalesce({nn('institucion')}, ''),
        CAST(CAST(monto AS DECIMAL(24,2)) AS VARCHAR),
        CAST(n_contratos AS VARCHAR), CAST(ids AS VARCHAR), ventanas))
        AS content_hash
    FROM (SELECT case_id, min(scope) AS scope, min(pattern) AS pattern,
        min(ambito) AS ambito, min(estado_geo) AS estado_geo, min(rfc) AS rfc,
        min(sujeto) AS sujeto, min(institucion) AS institucion,
        min(uuid) AS first_uuid, min(source_file) AS source_file,
        CAST(sum({dec('importe')}) AS DOUBLE) AS monto, {big('sum(n)')} AS n_contratos,
        max(fecha) AS fecha, bool_and(en_ventana) AS ventana_ok,
        coalesce(string_agg(DISTINCT ventana, ';' ORDER BY ventana), '') AS ventanas,
        bool_or(rfc_valido) AS rfc_given, min(definitivo_dof) AS definitivo_dof,
        max(pct_incremento) AS pct, max(tope_legal_pct) AS cap,
        max(n_senales) AS n_senales,
        bool_or(coalesce(url, '') <> '') AS cited, count(uuid) AS n_ids,
        count(uuid) FILTER (WHERE uuid NOT IN (SELECT uuid FROM complaints)) AS n_open,
        CAST(coalesce(sum(CAST(CAST('0x' || substr(md5(uuid), 1, 15) AS BIGINT)
          AS DECIMAL(38,0))), 0) AS DECIMAL(38,0)) AS ids
      FROM {source} GROUP BY 1) c"""


def scored_sql(source: str) -> str:
    valid = (f"CASE WHEN ambito = 'federal' THEN regexp_matches(coalesce(rfc, ''), "
             f"'{_RFC}') ELSE coalesce(rfc_given, regexp_matches(coalesce(rfc, ''), "
             f"'{_RFC}')) END")
    return f"""
    SELECT *, CASE pattern WHEN 'inhabilitado' THEN 'T1' WHEN 'efos' THEN 'T2'
        WHEN 'convenio' THEN 'T2' ELSE 'T3' END AS tier,
      CAST(round_even(least(100.0::DOUBLE, CASE WHEN already_filed THEN 0
        WHEN quarantined THEN raw * 0.4::DOUBLE ELSE raw END), 0) AS INTEGER) AS score,
      CASE WHEN already_filed THEN 'suppress' WHEN quarantined THEN 'cuarentena'
        ELSE 'revisar' END AS recomendacion,
      NOT quarantined AND v AND s AS auto_ok
    FROM (SELECT *, quality * support * CASE
          WHEN pattern IN ('rotacion', 'riesgo', 'concentracion') THEN
            30 + 50 * size + CASE WHEN pattern = 'riesgo'
              THEN 5 * least(n_senales - 3, 4) ELSE 0 END
          ELSE CASE WHEN pattern = 'inhabilitado' THEN 100 ELSE 80 END
            * CASE WHEN pattern = 'convenio' THEN docs
                ELSE (docs + CASE WHEN quarantined THEN 0 ELSE 1 END) / 2 END
            * (0.6::DOUBLE + 0.4::DOUBLE * size)
            * (0.7::DOUBLE + 0.3::DOUBLE * recency) END AS raw
      FROM (SELECT *, (CAST(v AS INTEGER) + CAST(s AS INTEGER)) / 2.0::DOUBLE AS docs,
          least(1.0::DOUBLE, log10(greatest(monto, 1.0::DOUBLE)) / 7) AS size,
          CASE WHEN fecha IS NULL OR DATE '2002-01-01' - fecha <= 365 THEN 1.0::DOUBLE
            ELSE greatest(0.3::DOUBLE,
              1 - (DATE '2002-01-01' - fecha - 365) / 1825.0::DOUBLE) END AS recency,
          CASE WHEN ambito = 'estatal' THEN 0.7::DOUBLE + 0.3::DOUBLE
            * coalesce(quality_of, 0.6::DOUBLE) ELSE 1.0::DOUBLE END AS quality,
          1 + 0.05::DOUBLE * least(corrobora, 3) AS support,
          CASE pattern
            WHEN 'inhabilitado' THEN fecha IS NULL OR fecha > DATE '2002-01-01'
              OR monto <= 0 OR NOT coalesce(ventana_ok, FALSE)
            WHEN 'efos' THEN fecha IS NULL OR fecha > DATE '2002-01-01'
              OR monto <= 0 OR NOT coalesce(fecha > CAST(definitivo_dof AS DATE), FALSE)
            WHEN 'convenio' THEN monto <= 0 OR NOT coalesce(pct > cap, FALSE)
            ELSE FALSE END AS quarantined
        FROM (SELECT c.*, {valid} AS v, first_uuid IS NOT NULL OR cited AS s,
            CASE WHEN rfc IS NULL THEN 0
              ELSE count(*) OVER (PARTITION BY rfc) - 1 END AS corrobora
          FROM {source} c)
        LEFT JOIN (SELECT {nn('estado_comprador')} AS st,
            max(pct_rfc_valido) / 100 AS quality_of FROM f10cov GROUP BY 1)
          ON st = {nn('estado_geo')}))"""


CTES["cases8"] = cases_sql("evid")
CTES["scored8"] = scored_sql("cases8")
CTES["evid_before"] = "SELECT * FROM evid WHERE fecha < DATE '2000-01-01'"
CTES["cases_before"] = cases_sql("evid_before")
SQL["lg_cases"] = """
    SELECT case_id, scope, pattern, ambito, estado_geo, rfc, sujeto, institucion,
      first_uuid AS procedure_uuid, source_file, monto, n_contratos, fecha,
      ventana_ok, ventanas, already_filed, content_hash FROM cases8"""
SQL["lg_scored"] = """
    SELECT case_id, pattern, tier, score, recomendacion, auto_ok, already_filed,
      corrobora FROM scored8"""
_AUTH = " ".join(f"WHEN pattern = '{p}' AND ambito = '{a}' THEN '{w}'"
                 for p, a, w, _ in V.LEGAL_ROUTES)
SQL["lg_routes"] = f"""
    SELECT pattern, ambito, CASE {_AUTH} ELSE '{V.DEFAULT_ROUTE[0]}' END AS autoridad,
      count(*) AS casos FROM scored8 GROUP BY 1, 2, 3"""
CTES["snap"] = """
    SELECT case_id, content_hash, CASE WHEN substr(case_id, 1, 1) < '4'
        THEN 'descartado' WHEN substr(case_id, 1, 1) < '8' THEN 'verificando'
        ELSE 'nuevo' END AS estado FROM cases_before"""
CTES["merged"] = """
    SELECT case_id, coalesce(s.estado, 'nuevo') AS estado,
      CASE WHEN s.case_id IS NULL THEN 't1' ELSE 't0' END AS first_seen,
      CASE WHEN n.case_id IS NULL THEN 't0' ELSE 't1' END AS last_seen,
      CASE WHEN s.case_id IS NULL OR s.content_hash <> n.content_hash THEN 't1'
        ELSE 't0' END AS last_changed,
      s.case_id IS NULL AS is_new,
      coalesce(s.content_hash <> n.content_hash, FALSE) AS changed,
      n.already_filed, n.score
    FROM snap s FULL JOIN scored8 n USING (case_id)"""
SQL["lg_merge"] = """
    SELECT case_id, estado, first_seen, last_seen, last_changed, is_new, changed
    FROM merged"""
SQL["lg_emissions"] = """
    SELECT case_id, CASE WHEN is_new THEN 'nuevo' ELSE 'cambiado' END AS reason, score
    FROM merged WHERE NOT already_filed
      AND (is_new OR (changed AND estado IN ('nuevo', 'verificando')))"""
SQL["lg_counters"] = """
    SELECT count(*) AS scanned, count(*) FILTER (WHERE is_new AND NOT already_filed)
        AS nuevos,
      count(*) FILTER (WHERE changed AND NOT already_filed) AS cambiados,
      count(*) FILTER (WHERE already_filed) AS suprimidos
    FROM merged WHERE already_filed IS NOT NULL"""
_FOOT = [
    ("f05_durante_inhabilitacion", "federal", "f05", "NULL", "institucion", "rfc",
     "fecha_contrato", "importe"),
    ("f01_detalle_completo", "federal", "f01d", "NULL", "institucion", "rfc",
     "fecha_contrato", "importe"),
    ("f07_convenios_inflados", "federal", "f07", "NULL", "institucion", "rfc",
     "fecha_contrato", "monto_ultimo_convenio"),
    ("f12_riesgo_proveedor", "federal", "ensemble", "NULL", "NULL", "rfc", "NULL",
     "monto_mxn_millones * 1e6"),
    ("f10_inhabilitados_estatal", "estatal", "state_sfp", "estado_comprador",
     "sujeto_obligado", "rfc_norm", "CAST(fecha_efectiva AS VARCHAR)", "importe"),
    ("f10_efos_estatal", "estatal", "f10e", "estado_comprador", "sujeto_obligado",
     "rfc", "fecha_contrato", "importe"),
    ("f10_jovenes_estatal", "estatal", "f10y", "estado_comprador", "sujeto_obligado",
     "rfc", "fecha_contrato", "importe"),
    ("f10_concentracion_estatal", "estatal", "f10conc", "estado_comprador",
     "sujeto_obligado", "NULL", "NULL", "monto_mxn_millones * 1e6"),
]
SQL["lg_footprint"] = " UNION ALL ".join(
    f"SELECT '{o}' AS origen, '{a}' AS ambito, CAST({e} AS VARCHAR) AS estado, "
    f"CAST({i} AS VARCHAR) AS institucion, proveedor, CAST({r} AS VARCHAR) AS rfc, "
    f"CAST({d} AS VARCHAR) AS fecha, CAST({m} AS DOUBLE) AS importe, "
    f"{nn('proveedor')} AS nombre_norm FROM {t}"
    for o, a, t, e, i, r, d, m in _FOOT)
SQL["lg_name_candidates"] = f"""
    SELECT s_name AS razon_social, rfc_norm AS rfc, fuente, situacion, inicio, fin,
      nombre
    FROM supplier JOIN (
      SELECT {nn('nombre')} AS clave, rfc_norm, '69-B (EFOS)' AS fuente, situacion,
        NULL AS inicio, NULL AS fin, nombre FROM efos
      UNION ALL SELECT {nn('nombre')}, rfc_norm, 'SFP sancionados', plazo_txt,
        {iso('inicio')}, {iso('fin')}, nombre FROM sfp)
      ON clave = upper(replace(s_name, '#', ' '))"""
SQL["lg_complaint_groups"] = f"""
    SELECT rfc, institucion, min(proveedor) AS proveedor,
      min(inhabilitado_desde) AS inhabilitado_desde, max(hasta) AS hasta,
      count(*) AS contratos, CAST(sum({dec('importe')}) AS DOUBLE) AS total_mxn
    FROM f05 GROUP BY 1, 2"""
CTES["two_alerts"] = """
    SELECT uuid, '2002-01-01' AS ts, 'Procedimiento ' || o_orderkey AS nombre, score
      FROM assessed WHERE score >= 4 AND o_orderstatus = 'F'
    UNION ALL SELECT uuid, '2002-02-01', 'Procedimiento ' || o_orderkey, score + 1
      FROM assessed WHERE score >= 6"""
SQL["lg_alert_cases"] = """
    SELECT uuid, min(nombre) AS nombre, max(score) AS max_score, 'nuevo' AS estado,
      min(ts) AS first_seen, max(ts) AS last_alert FROM two_alerts GROUP BY 1"""

# ------------------------------------------------------------------- reports
SQL["rp_figures"] = f"""
    SELECT
      (SELECT CAST(round(sum(CAST(m AS DECIMAL(24,6))), 1) AS DOUBLE) FROM (
        SELECT {mill(f"sum({dec('importe')}) FILTER (WHERE {MXN})", 1)} AS m FROM hits
        WHERE situacion = 'Definitivo' GROUP BY file_year)) AS d01_monto,
      (SELECT {mill(f"sum({dec('importe_num')}) FILTER (WHERE moneda = 'MXN')", 1)}
        FROM archive_hits WHERE situacion = 'Definitivo') AS d01h_monto,
      (SELECT CAST(count(*) AS DOUBLE) FROM archive_hits
        WHERE situacion = 'Definitivo') AS d01h_contratos,
      (SELECT CAST(count(DISTINCT nombre_norm) AS DOUBLE) FROM archive_hits
        WHERE situacion = 'Definitivo') AS d01h_empresas,
      (SELECT CAST(round(sum(CAST(m AS DECIMAL(24,6))), 1) AS DOUBLE) FROM (
        SELECT {mill(f"sum({dec('importe')}) FILTER (WHERE edad_dias < 365 AND {MXN})", 1)}
          AS m FROM aged GROUP BY file_year)) AS d04_monto,
      (SELECT CAST(count(*) AS DOUBLE) FROM f05) AS d05_gun,
      (SELECT CAST(count(*) FILTER (WHERE banda_nigrini = 'NO CONFORME') AS DOUBLE)
        FROM ({SQL["d03_benford"]})) AS d03_noconf,
      (SELECT CAST(count(*) AS DOUBLE) FROM ({SQL["d03_benford"]})) AS d03_total,
      (SELECT CAST(count(*) AS DOUBLE) FROM f07) AS d07_n,
      (SELECT coalesce(max(lift), 0.0) FROM ({SQL["bt_evaluate"]})) AS best_lift"""
SQL["rp_derived_figures"] = f"""
    SELECT
      CAST((SELECT count(*) FROM f05) + (SELECT count(*) FROM state_sfp
        WHERE durante_inhabilitacion) AS DOUBLE) AS inhabilitadas_n,
      {rnd(f'''(SELECT CAST(sum(CAST(m AS DECIMAL(24,6))) AS DOUBLE) FROM (
        SELECT {mill(f"sum({dec('importe')}) FILTER (WHERE {MXN})", 1)} AS m FROM hits
        WHERE situacion = 'Definitivo' GROUP BY file_year))
        + (SELECT {mill(f"sum({dec('importe')})", 6)} FROM f10e
           WHERE situacion = 'Definitivo' AND importe_plausible)''', 1)}
        AS facturera_rfc_monto,
      CAST((SELECT count(*) FROM f01d WHERE situacion = 'Definitivo')
        + (SELECT count(*) FROM f10e WHERE situacion = 'Definitivo'
           AND importe_plausible) AS DOUBLE) AS facturera_rfc_contratos,
      (SELECT CAST(count(*) AS DOUBLE) FROM state_sfp WHERE durante_inhabilitacion)
        AS estatal_durante_n,
      (SELECT CAST(count(*) AS DOUBLE) FROM f10e WHERE situacion = 'Definitivo'
        AND importe_plausible) AS estatal_facturera_n,
      (SELECT CAST(count(*) AS DOUBLE) FROM archive_hits
        WHERE situacion = 'Definitivo') AS facturera_hist_contratos,
      (SELECT {mill(f"sum({dec('importe_num')}) FILTER (WHERE moneda = 'MXN')", 1)}
        FROM archive_hits WHERE situacion = 'Definitivo') AS facturera_hist_monto,
      (SELECT CAST(count(DISTINCT nombre_norm) AS DOUBLE) FROM archive_hits
        WHERE situacion = 'Definitivo') AS facturera_hist_empresas,
      (SELECT CASE WHEN min(y) IS NULL THEN '—' WHEN min(y) = max(y) THEN min(y)
          ELSE min(y) || '–' || max(y) END
        FROM (SELECT left(CAST(fecha_contrato AS VARCHAR), 4) AS y FROM f01d
          WHERE situacion = 'Definitivo')) AS facturera_rfc_rango,
      (SELECT CAST(count(*) AS DOUBLE) FROM f07) AS sobrecostos_n,
      (SELECT CAST(round(sum(CAST(m AS DECIMAL(24,6))), 1) AS DOUBLE) FROM (
        SELECT {mill(f"sum({dec('importe')}) FILTER (WHERE edad_dias < 365 AND {MXN})", 1)}
          AS m FROM aged GROUP BY file_year)) AS jovenes_monto,
      (SELECT CAST(count(DISTINCT estado_comprador) AS DOUBLE) FROM states)
        AS estatal_estados_n"""
SQL["rp_unified_debarred"] = f"""
    SELECT proveedor, rfc, 'federal' AS ambito, inhabilitado_desde AS desde, hasta,
      fecha_contrato, institucion AS comprador, monto_mxn_millones, direccion_anuncio
    FROM f05
    UNION ALL SELECT proveedor, rfc_norm, {titled('estado_comprador')}, {iso('inicio')}, {iso('fin')},
      {iso('fecha_efectiva')}, sujeto_obligado, {rnd('importe / 1e6', 2)},
      direccion_anuncio
    FROM state_sfp WHERE durante_inhabilitacion"""
SQL["rp_unified_fraud"] = f"""
    SELECT proveedor, rfc, 'federal' AS ambito, definitivo_dof, fecha_contrato,
      institucion AS comprador, {rnd('importe / 1e6', 2)} AS monto_mxn_millones,
      direccion_anuncio
    FROM f01d WHERE situacion = 'Definitivo'
    UNION ALL SELECT proveedor, rfc, {titled('estado_comprador')}, definitivo_dof, fecha_contrato,
      sujeto_obligado, monto_mxn_millones, direccion_anuncio
    FROM f10e WHERE situacion = 'Definitivo' AND importe_plausible"""
SQL["rp_offices"] = f"""
    SELECT count(*) AS oficinas_total FROM (
      SELECT institucion, nombre_uc FROM rot
      UNION SELECT institucion, nombre_uc FROM ring_sum
      UNION SELECT institucion, nombre_uc FROM (
        SELECT institucion, nombre_uc FROM contracts WHERE {DIRECT} AND {MXN}
        GROUP BY institucion, nombre_uc, proveedor, rfc_norm, fecha_efectiva
        HAVING count(*) >= 2 AND sum({dec('importe')}) >= 1000000))"""
SQL["rp_status_distribution"] = "SELECT situacion, count(*) AS contratos FROM f01d GROUP BY 1"
SQL["rp_by_supplier"] = f"""
    SELECT rfc, min(proveedor) AS proveedor, count(*) AS contratos,
      CAST(sum({dec('importe')}) AS DOUBLE) AS total_mxn FROM f05 GROUP BY 1"""
SQL["rp_inventory"] = " UNION ALL ".join(
    f"SELECT '{n}' AS nombre, count(*) AS filas FROM {t}" for n, t in (
        ("f01_detalle_completo", "f01d"), ("f05_durante_inhabilitacion", "f05"),
        ("f07_convenios_inflados", "f07"), ("f10_efos_estatal", "f10e"),
        ("f06_anillos_constitucion", "ring_sum")))
_FILE = """CASE event_type WHEN 'view' THEN 'sat_69b_completo.csv'
    WHEN 'click' THEN 'sfp_sancionados.json' WHEN 'error' THEN 'dof_circulares.json'
    ELSE 'otro_' || event_type || '.csv' END"""
SQL["rp_freshness"] = f"""
    SELECT archivo, strftime(descargado, '%Y-%m-%dT%H:%M:%S') AS descargado,
      CAST(floor(epoch(TIMESTAMP '2024-02-20 00:00:00'
        - date_trunc('second', descargado)) / 86400) AS INTEGER) AS edad_dias,
      limite_dias, descargado IS NOT NULL AND coalesce(floor(epoch(
        TIMESTAMP '2024-02-20 00:00:00' - date_trunc('second', descargado)) / 86400)
          <= limite_dias, TRUE) AS vigente,
      CASE WHEN descargado IS NULL THEN 'fuente esperada sin descarga registrada' END
        AS nota
    FROM (SELECT {_FILE} AS archivo, max(ts) AS descargado FROM events
      WHERE value >= 1 GROUP BY 1)
    FULL JOIN (VALUES {', '.join(f"('{k.format(year=2024)}', {v})"
                                 for k, v in V.FRESHNESS_LIMITS.items())})
      t(archivo, limite_dias) USING (archivo)"""
SQL["rp_pending"] = """
    SELECT clave, filas, CASE WHEN done IS NULL THEN 'nueva'
      WHEN filas > done THEN 'creció' ELSE 'partes fallidas' END AS motivo
    FROM (SELECT 'C' || o_custkey AS clave, count(*) AS filas,
        count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1998-01-01') AS d,
        nullif(d, 0) AS done, count(*) FILTER (WHERE o_orderstatus = 'P'
          AND o_orderdate < TIMESTAMP '1998-01-01') AS failed
      FROM orders GROUP BY 1)
    WHERE done IS NULL OR filas > done OR failed > 0"""


# ------------------------------------------------------------------- folios
CTES["cased"] = """
    SELECT *, CASE WHEN k > 1 THEN base || '-' || k ELSE base END AS caso
    FROM (SELECT *, row_number() OVER (PARTITION BY base ORDER BY importe DESC NULLS LAST,
          institucion NULLS FIRST, direccion_anuncio NULLS FIRST,
          tipo_procedimiento NULLS FIRST) AS k
      FROM (SELECT *, regexp_replace(trim(concat_ws('_', 'inhabilitado', rfc, fecha_contrato)),
          '[^A-Za-z0-9._-]+', '_', 'g') AS base FROM f05))"""
CTES["named_cases"] = """
    SELECT *, CAST(CAST('0x' || substr(md5(caso), 1, 7) AS BIGINT) AS VARCHAR) || '-2001'
      AS sidec FROM cased"""
CTES["queue"] = """
    SELECT rfc, sidec, row_number() OVER (PARTITION BY rfc ORDER BY sidec) AS turn
    FROM named_cases WHERE institucion = 'NATION_7'"""
CTES["own_folios"] = """
    SELECT *, coalesce(exact_folio, next_folio) AS own
    FROM (SELECT c.*, q.sidec AS next_folio
      FROM (SELECT *, CASE WHEN institucion = 'NATION_1' THEN sidec END AS exact_folio,
          row_number() OVER (PARTITION BY rfc, institucion = 'NATION_1' ORDER BY caso) AS free
        FROM named_cases) c
      LEFT JOIN queue q ON q.rfc = c.rfc AND q.turn = c.free AND exact_folio IS NULL)"""
CTES["covered_cases"] = """
    SELECT o.*, coalesce(own, g.folio) AS folio FROM own_folios o
    LEFT JOIN (SELECT rfc, institucion, arg_max(own, caso) AS folio FROM own_folios
      WHERE own IS NOT NULL GROUP BY 1, 2) g
    ON g.rfc = o.rfc AND g.institucion = o.institucion WHERE coalesce(own, g.folio) IS NOT NULL"""
_COVERED_SUM = f"CAST(sum({dec('coalesce(importe, monto_mxn_millones * 1e6)')}) AS DOUBLE)"
SQL["rp_folios"] = f"""
    SELECT rfc, folio, count(*) AS contratos, {_COVERED_SUM} AS importe_mxn
    FROM covered_cases GROUP BY 1, 2"""
SQL["rp_complaints"] = f"""
    SELECT rfc, min(proveedor) AS empresa, min(inhabilitado_desde) AS inhabilitada_desde,
      max(hasta) AS inhabilitada_hasta, count(*) AS contratos, {_COVERED_SUM} AS importe_mxn,
      count(DISTINCT folio) AS folios FROM covered_cases GROUP BY 1"""


# --------------------------------------------------------------- case store
SQL["lg_runs"] = """
    SELECT 1 AS run, 'scan' AS kind, 't0' AS at, count(*) AS scanned,
      count(*) FILTER (WHERE NOT already_filed) AS nuevos, 0 AS cambiados,
      count(*) FILTER (WHERE already_filed) AS suprimidos, 0 AS rechazadas FROM cases_before
    UNION ALL SELECT 2, 'decisions', 't0', NULL, NULL, NULL, NULL,
      count(*) FILTER (WHERE substr(case_id, 1, 1) >= '8') FROM cases_before
    UNION ALL SELECT 3, 'scan', 't1', count(*),
      count(*) FILTER (WHERE is_new AND NOT already_filed),
      count(*) FILTER (WHERE changed AND NOT already_filed),
      count(*) FILTER (WHERE already_filed), 0 FROM merged WHERE already_filed IS NOT NULL"""
SQL["lg_history"] = """
    SELECT 1 AS run, case_id, 't0' AS at, 'nuevo' AS event, 'nuevo' AS estado,
      't0' AS first_seen, 't0' AS last_changed FROM cases_before
    UNION ALL SELECT 2, case_id, 't0', 'decidido', estado, 't0', 't0' FROM snap
      WHERE estado <> 'nuevo'
    UNION ALL SELECT 3, case_id, 't1', CASE WHEN is_new THEN 'nuevo' ELSE 'cambiado' END,
      estado, first_seen, 't1' FROM merged WHERE is_new OR changed"""
SQL["lg_decisions"] = """
    SELECT estado, count(*) AS casos,
      count(*) FILTER (WHERE estado <> 'nuevo') AS decididos, min(first_seen) AS desde
    FROM merged GROUP BY 1"""


# ------------------------------------------------------------ evidence chain
_CITED = [(f, s) for f, sources in (
    ("contratos", ("f05_durante_inhabilitacion", "f01_detalle_completo",
                   "f07_convenios_inflados", "f06_rotacion_licitaciones",
                   "f12_riesgo_proveedor")),
    (V.LIST_FILES["SFP"], ("f05_durante_inhabilitacion", "f10_inhabilitados_estatal")),
    (V.LIST_FILES["69-B"], ("f01_detalle_completo", "f10_efos_estatal"))) for s in sources]
CTES["versions"] = f"""
    SELECT archivo, ts, max(md5(CAST(event_id AS VARCHAR))) AS sha256
    FROM (SELECT CASE event_type WHEN 'view' THEN '{V.LIST_FILES["69-B"]}'
          WHEN 'click' THEN '{V.LIST_FILES["SFP"]}'
          ELSE 'contratos_200' || length(event_type) || '.csv' END AS archivo,
        date_trunc('second', ts) AS ts, event_id
      FROM events WHERE value >= 1) GROUP BY 1, 2"""
CTES["case_files"] = f"""
    SELECT case_id, archivo, TIMESTAMP '2024-01-01' + to_minutes(
        CAST('0x' || substr(case_id, 1, 4) AS INTEGER)) AS seen
    FROM (SELECT case_id, min(source_file) AS source_file FROM evid GROUP BY 1)
    JOIN (VALUES {', '.join(f"('{f}', '{s}')" for f, s in _CITED)}) c(cited, source_file)
      USING (source_file)
    JOIN (SELECT DISTINCT archivo FROM versions) ON archivo = cited
      OR (cited = 'contratos' AND archivo LIKE 'contratos_%')"""
SQL["lg_evidence_chain"] = """
    SELECT case_id, c.archivo, strftime(ts, '%Y-%m-%d %H:%M:%S') AS descargado, sha256,
      date_diff('day', CAST(ts AS DATE), CAST(seen AS DATE)) AS dias
    FROM case_files c ASOF JOIN versions v ON c.archivo = v.archivo AND c.seen >= v.ts"""


# ------------------------------------------------------------ lists and shares
SQL["lg_case_list"] = """
    SELECT case_id, pattern, score, recomendacion FROM scored8
    WHERE NOT already_filed AND ambito = 'federal' AND tier = 'T1'"""
SQL["rp_doubled"] = """
    SELECT count(*) FILTER (WHERE pct_incremento >= 100) AS al_doble,
      count(*) AS contratos FROM f07"""
SQL["rp_largest"] = """
    SELECT codigo_contrato, rfc, proveedor, monto_ultimo_convenio FROM f07
    ORDER BY monto_ultimo_convenio DESC NULLS LAST, codigo_contrato, rfc LIMIT 10"""
SQL["rp_without_tender"] = f"""
    SELECT count(*) AS contratos, {rnd("100.0 * count(*) FILTER (WHERE NOT coalesce("
      "tipo_procedimiento LIKE '%LICITACI%', FALSE)) / count(*)", 1)} AS pct_sin_licitacion
    FROM f10y"""
