"""State contract files: headers resolved by fragment, ragged rows repaired."""

from __future__ import annotations

import csv
import datetime as dt
import io
import sys
from collections import defaultdict
from collections.abc import Sequence
from urllib.parse import unquote

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contraluz.functions import columns as C
from contraluz.functions import fixed_values as V
from contraluz.operators.state_layer import dedupe
from contraluz.sources import records

_BAD = "_bad_record"


def resolve_header(headers: Sequence[str], *fragments: str) -> str | None:
    """The header equal to a lone fragment, else the first holding them all."""
    wanted = [f.casefold() for f in fragments]
    folded = [(h, h.casefold()) for h in headers]
    equal = (h for h, low in folded
             if len(wanted) == 1 and low.strip() == wanted[0])
    holding = (h for h, low in folded if all(f in low for f in wanted))
    return next(equal, None) or next(holding, None)


def resolve_fields(headers: Sequence[str]) -> dict[str, int | None]:
    """Position of each logical field; a missing required one is an error."""
    places = {}
    for field, fragment in V.STATE_FIELDS.items():
        header = resolve_header(headers, fragment)
        if header is None and field in V.STATE_REQUIRED:
            raise ValueError(f"no column for {field!r} ({fragment!r})")
        places[field] = None if header is None else list(headers).index(header)
    return places


def fold_record(text: str, width: int) -> list[str]:
    """A malformed record cut to width; surplus joins the last field."""
    csv.field_size_limit(16_000_000)
    cells = next(csv.reader(io.StringIO(text, newline="")), [])
    cells = cells + [""] * (width - len(cells))
    return cells[:width - 1] + [" ".join(cells[width - 1:])]


def _repair(width: int):
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def repaired(records: pd.Series) -> pd.Series:
        return records.map(
            lambda r: None if r is None else fold_record(r, width))
    return repaired


def _scan(spark: SparkSession, paths: Sequence[str],
          headers: Sequence[str]) -> DataFrame:
    """Files that share one header, in a single scan.

    The parser hands over the raw text of records whose width is wrong; only
    those are parsed again, so nothing after the last column is lost.
    """
    cells = [f"c{i}" for i in range(len(headers))]
    rows = records.read_records(spark, paths, "utf-8").where(F.col("place") > 0)
    fixed = records.parsed(rows, cells, _BAD).withColumns({
        "_file": records.file_name("file"), "_fixed": _repair(len(cells))(F.col(_BAD))})
    places = resolve_fields(headers)

    def field(name: str):
        place = places[name]
        if place is None:
            return F.lit(None).cast("string").alias(name)
        return F.when(F.col(_BAD).isNull(), F.col(cells[place])).otherwise(
            F.get("_fixed", F.lit(place))).alias(name)

    return records.once(fixed, [], F.struct(
        *[field(n) for n in V.STATE_FIELDS],
        F.regexp_extract("_file", r"pnt_\d+_\d+_(\d+)\.csv$", 1)
        .alias("formato")))


def file_headers(spark: SparkSession, paths: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The files by their header: one job over all files, a header each to the driver."""
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for file, record in records.first_records(spark, paths, "utf-8"):
        names = next(csv.reader(io.StringIO(record.lstrip("\ufeff"), newline="")))
        groups[tuple(names)].append(unquote(file))
    return groups


def read_state_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Union of all files; one scan per distinct header, not one per file."""
    if not paths:
        raise ValueError("no state files given")
    scans = [_scan(spark, sorted(files), headers)
             for headers, files in sorted(file_headers(spark, paths).items())]
    if not scans:
        raise ValueError("no state file has a header")
    union = scans[0]
    for scan in scans[1:]:
        union = union.unionByName(scan, allowMissingColumns=True)
    return union


def typed_states(raw: DataFrame, today: dt.date | None = None,
                 min_year: int = V.STATE_MIN_YEAR) -> DataFrame:
    """Typed rows of plausible fiscal years, federal copies dropped."""
    def amount(field: str):
        return C.number(field, "$, ")

    taxed, untaxed = amount("monto_con_imp"), amount("monto_sin_imp")
    key = C.rfc_compact("rfc")
    typed = raw.select(
        F.upper(F.trim("estado")).alias("estado_comprador"),
        C.whole("id_entidad").alias("id_entidad"),
        F.trim("id_sujeto").alias("id_sujeto"),
        F.trim("sujeto_obligado").alias("sujeto_obligado"),
        C.first_filled("ejercicio").alias("ejercicio"),
        "tipo_procedimiento", "materia", "caracter",
        C.first_filled("expediente").alias("expediente"),
        C.first_filled("num_contrato").alias("num_contrato"),
        C.person_name("razon_social", ("nombre_pf", "ap1_pf", "ap2_pf"))
        .alias("proveedor"), key.alias("rfc_norm"),
        F.coalesce(C.parse_day("fecha_contrato"), C.parse_day("inicio_vigencia"))
        .alias("fecha_efectiva"),
        F.coalesce(taxed, untaxed, amount("monto_max")).alias("importe"),
        F.when(taxed.isNotNull(), "con_impuestos")
        .when(untaxed.isNotNull(), "sin_impuestos")
        .otherwise("techo_maximo").alias("tipo_monto"),
        C.first_filled("moneda").alias("moneda"),
        C.first_filled("url_contrato", "url_fallo").alias("direccion_anuncio"),
        C.first_filled("url_fallo").alias("url_fallo"),
        "municipio_proveedor", "cp_proveedor", "origen_recursos",
        "convenio_modif", "descripcion", "objeto",
        C.parse_day("fecha_actualizacion").alias("fecha_actualizacion"),
        "formato")
    kept = typed.where(
        (F.col("proveedor").isNotNull() | F.col("rfc_norm").isNotNull())
        & C.whole("ejercicio").between(min_year, C.clock_year(today) + 1)
        & ~F.col("estado_comprador").ilike("FEDERACI%"))
    return with_key_traits(kept, today)


def with_key_traits(typed: DataFrame, today: dt.date | None = None) -> DataFrame:
    return typed.withColumns({
        "rfc_valido": C.rfc_valid("rfc_norm"),
        "es_persona_moral": C.legal_person(
            F.coalesce("rfc_norm", F.lit(""))),
        "fecha_constitucion_rfc": C.incorporation_day(
            F.coalesce("rfc_norm", F.lit("")), today),
    })


def read_states(spark: SparkSession, paths: Sequence[str],
                today: dt.date | None = None) -> DataFrame:
    return dedupe(typed_states(read_state_files(spark, paths), today))


def key_quality(raw: DataFrame, rfc: str = "rfc",
                by: Sequence[str] = ()) -> DataFrame:
    """Share of valid, empty, junk and generic keys among raw captures."""
    kind = C.rfc_class(rfc)
    return raw.groupBy(*by).agg(
        F.count("*").alias("n"), F.count_if(kind == "valido").alias("valido"),
        F.count_if(kind == "vacio").alias("vacio"),
        F.count_if(kind == "basura").alias("basura"),
        F.count_if(C.rfc_generic(rfc)).alias("genericos"))


# tasks receive the helpers themselves, so workers need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
