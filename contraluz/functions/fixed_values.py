"""Published codes, file layouts, word lists and thresholds.

Everything in this file is data, not logic.  The values are facts of the
sources (government file layouts, budget-branch codes, legal caps, list
vocabularies) and must stay exactly as they are for results to be right.
"""

# --- fixed values: federal contract file, 73 columns by position ------------
CONTRACT_COLUMNS = (
    "orden_gobierno", "clave_ramo", "ramo", "tipo_institucion",
    "clave_institucion", "siglas_institucion", "institucion", "clave_uc",
    "nombre_uc", "codigo_expediente", "referencia_expediente",
    "titulo_expediente", "partida_especifica", "ley", "tipo_procedimiento",
    "articulo_excepcion", "descripcion_excepcion", "contrato_marco",
    "compra_consolidada", "num_proc_consolidacion",
    "nombre_proc_consolidacion", "tipo_proc_consolidacion",
    "art_exc_proc_consolidacion", "numero_procedimiento",
    "tipo_contratacion", "caracter_procedimiento", "forma_participacion",
    "caso_fortuito", "credito_externo", "organismo_financiero",
    "clave_programa_federal", "clave_cartera_shcp", "fecha_publicacion",
    "fecha_apertura", "fecha_fallo", "codigo_contrato", "num_contrato",
    "titulo_contrato", "descripcion_contrato", "contrato_plurianual",
    "estatus_drc", "fecha_inicio_contrato", "fecha_fin_contrato",
    "fecha_firma_contrato", "importe_drc", "moneda_drc",
    "convenio_modificatorio_drc", "codigo_ref_contrato", "estatus_contrato",
    "fecha_firma2", "tipo_contrato", "monto_sin_imp_min",
    "monto_min_con_imp", "monto_sin_imp_max", "monto_max_con_imp", "moneda",
    "convenio_modificatorio", "codigo_ref_ultimo_conv",
    "fecha_fin_ultimo_conv", "monto_sin_imp_min_uc", "monto_min_con_imp_uc",
    "monto_sin_imp_max_uc", "monto_max_con_imp_uc",
    "fecha_firma_ultimo_conv", "rfc", "proveedor", "folio_rupc",
    "pais_empresa", "nacionalidad_proveedor", "auto_registro",
    "estratificacion", "origen", "direccion_anuncio",
)

# --- fixed values: tax-fraud list file, 20 columns by position --------------
EFOS_COLUMNS = (
    "no", "rfc", "nombre", "situacion",
    "oficio_presuncion_sat", "pub_sat_presuntos",
    "oficio_presuncion_dof", "pub_dof_presuntos",
    "oficio_desvirtuaron_sat", "pub_sat_desvirtuados",
    "oficio_desvirtuaron_dof", "pub_dof_desvirtuados",
    "oficio_definitivos_sat", "pub_sat_definitivos",
    "oficio_definitivos_dof", "pub_dof_definitivos",
    "oficio_sentencia_sat", "pub_sat_sentencia",
    "oficio_sentencia_dof", "pub_dof_sentencia",
)

# --- fixed values: other-buyer (power utility) contract file ----------------
UTILITY_COLUMNS = (
    "numero", "descripcion", "tipo_procedimiento", "tipo_contratacion",
    "fecha_publicacion", "estado_procedimiento",
    "nomb_proveedor_adjudicado", "monto", "fecha_fallo",
    "area_contratante", "area_requirente",
)

# --- fixed values: state file, logical field -> header fragment -------------
STATE_FIELDS = {
    "estado": "entidad federativa",
    "id_entidad": "id entidad",
    "id_sujeto": "id sujeto",
    "sujeto_obligado": "sujeto obligado",
    "ejercicio": "ejercicio",
    "tipo_procedimiento": "tipo de procedimiento",
    "materia": "materia o tipo",
    "caracter": "carácter del procedimiento",
    "expediente": "número de expediente",
    "descripcion": "descripción de las obras",
    "nombre_pf": "nombre(s) de la persona física",
    "ap1_pf": "primer apellido",
    "ap2_pf": "segundo apellido",
    "razon_social": "denominación o razón social",
    "rfc": "registro federal de contribuyentes",
    "municipio_proveedor": "nombre del municipio",
    "cp_proveedor": "código postal",
    "num_contrato": "número que identifique al contrato",
    "fecha_contrato": "fecha del contrato expresada",
    "inicio_vigencia": "inicio de la vigencia",
    "monto_sin_imp": "monto del contrato sin impuestos",
    "monto_con_imp": "monto total del contrato con impuestos",
    "monto_max": "monto máximo",
    "moneda": "tipo de moneda",
    "objeto": "objeto del contrato",
    "url_fallo": "acta de fallo",
    "url_contrato": "documento del contrato",
    "origen_recursos": "origen de los recursos",
    "convenio_modif": "contratos modificatorios",
    "fecha_actualizacion": "fecha de actualización",
}
STATE_REQUIRED = (
    "estado", "id_entidad", "id_sujeto", "sujeto_obligado", "ejercicio",
    "rfc", "fecha_actualizacion",
)
STATE_MIN_YEAR = 2015

# --- fixed values: budget branch 60..91 -> state, alphabetical order --------
BRANCH_STATES = {
    60: "AGUASCALIENTES", 61: "BAJA CALIFORNIA", 62: "BAJA CALIFORNIA SUR",
    63: "CAMPECHE", 64: "COAHUILA DE ZARAGOZA", 65: "COLIMA", 66: "CHIAPAS",
    67: "CHIHUAHUA", 68: "CIUDAD DE MÉXICO", 69: "DURANGO",
    70: "GUANAJUATO", 71: "GUERRERO", 72: "HIDALGO", 73: "JALISCO",
    74: "MÉXICO", 75: "MICHOACÁN DE OCAMPO", 76: "MORELOS", 77: "NAYARIT",
    78: "NUEVO LEÓN", 79: "OAXACA", 80: "PUEBLA", 81: "QUERÉTARO",
    82: "QUINTANA ROO", 83: "SAN LUIS POTOSÍ", 84: "SINALOA", 85: "SONORA",
    86: "TABASCO", 87: "TAMAULIPAS", 88: "TLAXCALA",
    89: "VERACRUZ DE IGNACIO DE LA LLAVE", 90: "YUCATÁN", 91: "ZACATECAS",
}

# --- fixed values: legal-form suffixes, after punctuation became blanks -----
LEGAL_SUFFIXES = (
    "SA DE CV", "S A DE C V", "S DE RL DE CV", "S DE R L DE C V",
    "SAPI DE CV", "S A P I DE C V", "SAB DE CV", "S A B DE C V",
    "SAS", "S A S", "SRL", "S R L", "S DE RL", "S DE R L",
    "SC", "S C", "AC", "A C", "SOFOM ENR", "SOFOM E N R", "SOFOM",
)

# --- fixed values: taxpayer key ----------------------------------------------
RFC_PATTERN = "[A-ZÑ&]{3,4}[0-9]{6}[A-Z0-9]{3}"
GENERIC_RFCS = ("XAXX010101000", "XEXX010101000")
MIN_NAME_KEY = 8

# --- fixed values: words that stand for "no supplier" in state files --------
IMPLAUSIBLE_SUPPLIERS = (
    "HOMBRE", "MUJER", "PERSONA FISICA", "PERSONA MORAL",
    "DATOS PERSONALES", "NO APLICA", "N/A", "NA", "NINGUNO", "SIN DATO",
    "SIN DATOS", "DESIERTA", "NO SE CUENTA CON LA INFORMACION",
)
IMPLAUSIBLE_SUPPLIER_LIKE = (
    "http%", "ley %", "%PERSONA FISICA%", "%DATOS PERSONALES%",
    "%TRAN%PARENCIA%", "%NO SE REALIZ%", "% HOMBRE", "% MUJER",
)
PLACEHOLDER_SUPPLIERS = (
    "CONTRATISTA", "PERSONA FISICA", "FISICA", "PERSONAS FISICAS", "MORAL",
    "PERSONA MORAL", "NO DATO", "NO APLICA", "NO SE GENERA INFORMACION",
    "ADMINISTRADOR UNICO", "ADMINSTRADOR UNICO", "PROVEEDOR", "SIN DATO",
)

# --- fixed values: supplier context by brand or public entity ---------------
PATENT_PHARMA = (
    "ROCHE", "NOVARTIS", "LABORATORIOS PISA", "GILEAD", "NOVO NORDISK",
    "GLAXO", "TAKEDA", "AMGEN", "JANSSEN", "MERCK", "ASTELLAS", "PFIZER",
    "ELI LILLY", "CSL BEHRING", "OCTAPHARMA", "MEDTRONIC", "BAYER",
    "SANOFI", "BOEHRINGER", "ASTRAZENECA", "BRISTOL", "ABBVIE", "BIOGEN",
)
STATE_ENTITIES = (
    "LICONSA", "DICONSA", "IMPRESORA Y ENCUADERNADORA PROGRESO",
    "TALLERES GRAFICOS", "ESTUDIOS CHURUBUSCO",
    "AEROPUERTOS Y SERVICIOS AUXILIARES", "SERVICIO POSTAL",
    "TELECOMUNICACIONES DE MEXICO",
)

# --- fixed values: normal quantiles for the usual confidence levels ---------
NORMAL_QUANTILES = {
    0.90: 1.6448536269514722,
    0.95: 1.959963984540054,
    0.99: 2.5758293035489004,
}

# --- fixed values: conformity bands of the digit test -----------------------
FIRST_DIGIT_BANDS = (
    (0.006, "conforme"), (0.012, "aceptable"), (0.015, "marginal"))
SECOND_DIGIT_BANDS = (
    (0.008, "conforme"), (0.010, "aceptable"), (0.012, "marginal"))
OUTSIDE_BANDS = "NO CONFORME"

# --- fixed values: candidate round thresholds for bunching ------------------
CUT_POINTS = (
    50_000, 100_000, 150_000, 200_000, 300_000, 400_000, 500_000, 750_000,
    1_000_000, 1_500_000, 2_000_000, 3_000_000, 5_000_000)

# --- fixed values: plausible amount of a state contract ---------------------
MIN_PLAUSIBLE_AMOUNT = 1.0
MAX_PLAUSIBLE_AMOUNT = 5e9

# --- fixed values: legal growth caps and the rounding margin above them -----
CAP_ACQUISITIONS = 0.20
CAP_WORKS = 0.25
CAP_MARGIN = 0.0005

# --- fixed values: readable label per signal --------------------------------
SIGNAL_LABELS = {
    "d02_concentracion_directas": "concentración de adjudicaciones directas",
    "d04_joven_y_grande": "empresa joven con contrato grande",
    "d06_anillo_constitucion": "constituidas casi al mismo tiempo",
    "d06_fraccionamiento": "fraccionamiento el mismo día",
    "d06_rotacion": "rotación de ganadores",
    "d07_convenio_inflado": "convenio por encima del tope legal",
}
COMPOSITE_SIGNAL = "compuesto_2+"

# --- fixed values: human states of a case -----------------------------------
CASE_STATES = (
    "nuevo", "verificando", "verificado", "denunciado", "publicado",
    "descartado")
OPEN_STATES = ("nuevo", "verificando")

# --- fixed values: tier of a pattern ----------------------------------------
PATTERN_TIERS = {
    "inhabilitado": "T1", "efos": "T2", "convenio": "T2", "rotacion": "T3",
    "anillo": "T3", "fraccionamiento": "T3", "riesgo": "T3",
    "concentracion": "T3", "joven": "T3",
}

# --- fixed values: (pattern, scope) -> (authority, legal basis) -------------
LEGAL_ROUTES = (
    ("inhabilitado", "federal", "SIDEC + OIC de la institución contratante",
     "LGRA arts. 59 y 67; LAASSP art. 50 fr. IV"),
    ("inhabilitado", "estatal", "OIC / Contraloría del sujeto obligado estatal",
     "LGRA arts. 59 y 67 (servidores estatales); ley estatal de adquisiciones"),
    ("efos", "federal", "SAT (procedimiento art. 69-B) y FGR",
     "CFF art. 69-B; CPF art. 113-bis"),
    ("efos", "estatal", "SAT y FGR; con copia al OIC del estado",
     "CFF art. 69-B; CPF art. 113-bis"),
    ("convenio", "federal", "Auditoría Superior de la Federación",
     "LAASSP art. 52 / LOPSRM art. 59"),
    ("convenio", "estatal", "Entidad de Fiscalización Superior del estado",
     "ley estatal de obra/adquisiciones"),
    ("rotacion", "federal", "COFECE / Comisión Nacional Antimonopolio",
     "LFCE art. 53 (prácticas monopólicas absolutas)"),
    ("anillo", "federal", "OIC — solicitud de investigación",
     "indicio estructural; requiere expediente"),
    ("anillo", "estatal", "OIC del estado — solicitud de investigación",
     "indicio estructural; requiere expediente"),
    ("fraccionamiento", "federal", "OIC — solicitud de investigación",
     "LAASSP art. 42 (fraccionamiento)"),
    ("riesgo", "federal", "OIC — línea de investigación",
     "señales agregadas; no es violación por sí sola"),
    ("concentracion", "estatal", "OIC / EFS del estado — línea de investigación",
     "concentración; requiere expediente"),
    ("joven", "estatal", "OIC del estado — línea de investigación",
     "empresa joven con contrato grande; indicio"),
)
DEFAULT_ROUTE = ("OIC competente", "requiere análisis")

# --- fixed values: live rules, code -> weight -------------------------------
RULE_WEIGHTS = {
    "DIRECTA": 2, "PLAZO_RECORTADO": 2, "PLAZO_COMPRIMIDO": 2,
    "EMERGENCIA": 2, "EXCEPCION": 1, "ANTICIPO": 1,
    "EFOS_69B": (6, 2), "SFP_SANCION": (8, 3), "DOF_INHABILITACION": (8, 3),
    "MONTO_ALTO": 1,
}
MIN_TENDER_WINDOW_DAYS = 10
BIG_AWARD_MXN = 50_000_000
GAZETTE_RELEVANT_DAYS = 180
SEEN_MAX_AGE_DAYS = 90

# --- fixed values: gazette title, tax key and term patterns -----------------
GAZETTE_TITLE = (
    r"(?i)abstenerse de .{0,90}?celebrar contratos? con\s+"
    r"(la empresa|las empresas|la(?:s)? (?:persona(?:s)? )?moral(?:es)?|"
    r"la persona f[ií]sica(?: con actividad empresarial)?|"
    r"las personas f[ií]sicas(?: con actividad empresarial)?|"
    r"el C\.|la C\.|el ciudadano|la ciudadana)?\s*(?:denominad[ao]s?\s+)?"
    r"(.+?)\s*\.?\s*$")
GAZETTE_SPLIT = r"\s+y\s+|\s+e\s+|;\s*"
GAZETTE_RFC = r"\b([A-ZÑ&]{3,4}\d{6}[A-Z0-9]{3})\b"
GAZETTE_TERM = (
    r"(?i)(?:INHABILITACI[ÓO]N TEMPORAL[^.;]{0,40}?(?:periodo|plazo) de|"
    r"por el plazo de)\s+([^.;]{3,90})")
GAZETTE_EDITIONS = (
    "NotasMatutinas", "NotasVespertinas", "NotasExtraordinarias")
GAZETTE_URL = "https://dof.gob.mx/nota_detalle.php?codigo={}&fecha={}"

# --- fixed values: public procedure page ------------------------------------
PROCEDURE_URL = (
    "https://upcp-compranet.buengobierno.gob.mx/sitiopublico/#/sitiopublico/"
    "detalle/{}/procedimiento")
PROCEDURE_ID = r"detalle/([0-9a-f]{32})"

# --- fixed values: age limit in days of each live source --------------------
FRESHNESS_LIMITS = {
    "contratos_{year}.csv": 7,
    "sat_69b_completo.csv": 35,
    "sfp_sancionados.json": 7,
    "cfe_contratos_adjudicados.csv": 120,
    "pnt/manifiesto.json": 7,
    "dof_circulares.json": 7,
}

# --- fixed values: list name -> evidence file -------------------------------
LIST_FILES = {
    "69-B": "sat_69b_completo.csv",
    "SFP": "sfp_sancionados.json",
}
