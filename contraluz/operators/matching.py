"""Joins of facts to sanction lists: by key, by name, by debarment window.

No side is broadcast by hand.  The lists are small today, so AQE broadcasts
them from their measured size; if a list outgrows the threshold the same plan
runs as a sort-merge join with skewed partitions split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contraluz.functions import columns as C
from contraluz.session import few, stored


def latest_per_key(df: DataFrame, keys: list[Column | str],
                   order: list[Column]) -> DataFrame:
    """First row of each key in the given order.

    The rank limit runs before the shuffle as well (window group limit), so a
    hot key sends one row per map task and not all of its rows.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def repeated(df: DataFrame, keys: list[Column | str], least: int) -> DataFrame:
    """The rows whose key comes `least` times or more, and few others.

    One number for a row is counted, the hash of its key; rows themselves stay in place
    while the numbers that are frequent enough are few.  Keys of one hash count together,
    so no row is lost and the caller counts the keys that are left.
    """
    return df if least <= 1 else parted(df, keys, least)[0]


def parted(df: DataFrame, keys: list[Column | str], least: int) -> tuple[DataFrame, DataFrame]:
    """`repeated` rows, and all others: their keys certainly come less than `least` times."""
    number = F.xxhash64(*keys)
    often = few(stored(df.select(number.alias("_number")).groupBy("_number").agg(
        F.count("*").alias("_n")).where(F.col("_n") >= least).select("_number")))
    numbered = df.withColumn("_number", number)
    return tuple(numbered.join(often, "_number", how).drop("_number")
                 for how in ("left_semi", "left_anti"))


def fraud_hits(contracts: DataFrame, efos: DataFrame) -> DataFrame:
    """Contracts of listed suppliers by taxpayer key, with the time test."""
    listed = efos.select("rfc_norm", F.col("nombre").alias("nombre_69b"),
                         "situacion", "fecha_definitivo", "fecha_presunto")
    return contracts.join(listed, "rfc_norm").withColumn(
        "firmado_despues_definitivo",
        C.after("fecha_efectiva", "fecha_definitivo"))


# ----------------------------------------------------------------- by name

def keyed_by_name(df: DataFrame, name: str, key: str = "nombre_norm") -> DataFrame:
    """Adds the name key and keeps rows whose key is long enough to match."""
    return df.withColumn(key, C.name_norm(name)).where(C.long_enough_key(key))


def fraud_by_name(efos: DataFrame) -> DataFrame:
    """One listed firm per name key: definitive first, then the latest."""
    keyed = keyed_by_name(efos, "nombre")
    return latest_per_key(
        keyed, ["nombre_norm"],
        [(F.col("situacion") == "Definitivo").desc(),
         F.col("fecha_definitivo").desc_nulls_last(), F.col("rfc_norm")])


def fraud_latest_by_name(efos: DataFrame) -> DataFrame:
    """One listed firm per name key: the latest definitive date (archive)."""
    keyed = efos.withColumn("nombre_norm", C.name_norm("nombre"))
    return latest_per_key(
        keyed, ["nombre_norm"],
        [F.col("fecha_definitivo").desc_nulls_last(), F.col("rfc_norm")])


# --------------------------------------------------------------- by window

_WINDOW_FIELDS = ("inicio", "fin", "rfc_norm", "nombre",
                  "institucion_sancionadora", "plazo_txt", "multa")


def windows_per_key(sfp: DataFrame, key: str = "rfc_norm") -> DataFrame:
    """All debarment windows of a key as one array, latest start first.

    Windows that share a start collapse to the one that ends last, which
    contains the others.  The array is therefore bounded by the number of
    calendar days, whatever the number of records behind one key.
    """
    rest = [f for f in _WINDOW_FIELDS if f not in ("inicio", "fin")]
    longest = (sfp.groupBy(key, "inicio").agg(F.max(F.struct(
        F.col("fin").alias("fin"),
        *[F.col(f).alias(f) for f in rest])).alias("w")))
    window = F.struct("inicio", "w.fin", *[f"w.{f}" for f in rest])
    return longest.groupBy(key).agg(
        F.sort_array(F.collect_list(window), asc=False).alias("ventanas"))


def picked_window(day: Column | str, windows: Column | str) -> Column:
    """Window that contains the day, else the latest; latest start wins."""
    array = C.as_col(windows)
    holding = F.filter(
        array, lambda w: C.inside_window(day, w["inicio"], w["fin"]))
    return F.coalesce(F.try_element_at(holding, F.lit(1)),
                      F.try_element_at(array, F.lit(1)))


def debarment_hits(facts: DataFrame, sfp: DataFrame,
                   day: str = "fecha_efectiva") -> DataFrame:
    """One row per fact of an ever-debarred supplier, with its best window.

    The facts are joined once on their key and need no row id and no shuffle
    of their own when the windows fit a broadcast.
    """
    joined = facts.join(windows_per_key(sfp), "rfc_norm")
    picked = joined.withColumn("_w", picked_window(day, "ventanas"))
    return picked.select(
        *facts.columns,
        F.col("_w.nombre").alias("nombre_sfp"), F.col("_w.multa").alias("multa"),
        F.col("_w.institucion_sancionadora").alias("institucion_sancionadora"),
        F.col("_w.inicio").alias("inicio"), F.col("_w.fin").alias("fin"),
        F.col("_w.plazo_txt").alias("plazo_txt"),
        C.inside_window(day, "_w.inicio", "_w.fin")
        .alias("durante_inhabilitacion"))


def windows_per_name(sfp: DataFrame) -> DataFrame:
    return windows_per_key(keyed_by_name(sfp, "nombre"), "nombre_norm")


def name_candidates(names: DataFrame, efos: DataFrame, sfp: DataFrame,
                    name: str = "razon_social") -> DataFrame:
    """Advisory keys for company names, from both lists, stacked."""
    asked = names.select(name).dropDuplicates().withColumn(
        "nombre_norm", C.name_norm(name))
    fraud = asked.join(fraud_by_name(efos), "nombre_norm").select(
        name, F.col("rfc_norm").alias("rfc"), F.lit("69-B (EFOS)").alias("fuente"),
        "situacion", F.lit(None).cast("string").alias("inicio"),
        F.lit(None).cast("string").alias("fin"), "nombre")
    barred = asked.join(keyed_by_name(sfp, "nombre"), "nombre_norm").select(
        name, F.col("rfc_norm").alias("rfc"),
        F.lit("SFP sancionados").alias("fuente"),
        F.col("plazo_txt").alias("situacion"),
        C.iso_text("inicio").alias("inicio"), C.iso_text("fin").alias("fin"),
        "nombre")
    return fraud.unionByName(barred)
