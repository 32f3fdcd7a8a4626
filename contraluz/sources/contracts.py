"""Federal contract files: positional CSV to the canonical contracts table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contraluz.functions import columns as C
from contraluz.functions import fixed_values as V
from contraluz.sources import records


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_positional(spark: SparkSession, paths: str | Sequence[str],
                    names: Sequence[str], header: bool,
                    encoding: str = "windows-1252",
                    multi_line: bool = True) -> DataFrame:
    """All-text scan by position and the `filename`; short rows are padded with NULL.

    Nothing is inferred.  Fields may hold line breaks: records are cut by counting
    quotes, so one file is read by many tasks.  With `multi_line` off, files without
    such fields are read in a single pass.  With `header`, a file begins with it.
    """
    if multi_line:
        cells = records.parsed(records.read_records(spark, paths, encoding), names)
        rows = cells.where(F.col("place") > 0) if header else cells
        return rows.withColumn("filename", records.file_name("file")).drop("file", "place")
    return (spark.read.schema(text_schema(names))
            .option("header", header).option("enforceSchema", True)
            .option("mode", "PERMISSIVE").option("encoding", encoding).option("escape", '"')
            .csv(paths if isinstance(paths, str) else list(paths))
            .select("*", F.col("_metadata.file_name").alias("filename")))


def read_contracts(spark: SparkSession, paths: str | Sequence[str],
                   today: dt.date | None = None,
                   multi_line: bool = True) -> DataFrame:
    if not paths:
        raise ValueError("no contract files given")
    return canonical_contracts(read_positional(
        spark, paths, V.CONTRACT_COLUMNS, header=True, multi_line=multi_line), today)


def year_of_file(name: Column | str) -> Column:
    """Four digits before the extension; blank where the name carries none."""
    return F.regexp_extract(C.as_col(name), r"(\d{4})(?:\.utf8)?\.csv$", 1)


def canonical_contracts(raw: DataFrame, today: dt.date | None = None) -> DataFrame:
    """Adds the derived columns; all of them are codegen expressions."""
    parsed = raw.withColumns({
        "_used": C.number("importe_drc"),
        "monto_original": C.number("monto_max_con_imp"),
        "monto_ultimo_convenio": C.number("monto_max_con_imp_uc")})
    spent = F.col("_used").isNotNull()
    dates = [C.parse_day(c) for c in (
        "fecha_firma_contrato", "fecha_firma2", "fecha_inicio_contrato",
        "fecha_fallo")]
    return parsed.withColumns({
        "file_year": year_of_file("filename"),
        "fecha_efectiva": F.coalesce(*dates),
        "importe": F.coalesce("_used", "monto_original", "monto_ultimo_convenio"),
        "tipo_monto": F.when(spent, "ejercido").otherwise("techo_maximo"),
        "moneda_efectiva": F.when(spent, F.col("moneda_drc"))
        .otherwise(F.col("moneda")),
        "estado_comprador": C.branch_state("clave_ramo"),
        "rfc_norm": C.rfc_norm("rfc"),
        "es_persona_moral": C.legal_person("rfc"),
        "fecha_constitucion_rfc": C.incorporation_day("rfc", today),
    }).drop("_used")
