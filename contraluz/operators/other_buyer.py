"""A buyer outside the federal feed: both lists by supplier name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contraluz.functions import columns as C
from contraluz.operators import matching as M

_COLUMNS = ["numero", "proveedor", "lista", "rfc", "detalle",
            "durante_inhabilitacion", "tipo_procedimiento", "monto", "fecha",
            "area_contratante", "match_method", "needs_verification"]


def name_screen(awards: DataFrame, efos: DataFrame, sfp: DataFrame) -> DataFrame:
    """Hits on the fraud list and on the debarment list, one row per list.

    The awards are scanned and keyed once: both lists are joined to them and
    each award gives out one row for every list that holds its name.
    """
    keyed = awards.withColumn("nombre_norm", C.name_norm("proveedor"))
    listed = M.fraud_by_name(efos).select("nombre_norm", F.struct(
        F.col("rfc_norm").alias("rfc"), "situacion").alias("_fraud"))
    joined = (keyed.join(listed, "nombre_norm", "left")
              .join(M.windows_per_name(sfp), "nombre_norm", "left")
              .where(F.col("_fraud").isNotNull() | F.col("ventanas").isNotNull())
              .withColumn("_w", M.picked_window("fecha", "ventanas")))
    span = F.concat(
        F.lit("inhabilitada "), F.coalesce(C.iso_text("_w.inicio"), F.lit("None")),
        F.lit(" → "), F.coalesce(C.iso_text("_w.fin"), F.lit("None")))

    def hit(shown: Column, name: str, rfc: Column, detail: Column,
            during: Column) -> Column:
        return F.when(shown, F.struct(
            F.lit(name).alias("lista"), rfc.alias("rfc"),
            detail.alias("detalle"), during.alias("durante_inhabilitacion")))

    hits = F.array_compact(F.array(
        hit(F.col("_fraud").isNotNull(), "69-B", F.col("_fraud.rfc"),
            F.col("_fraud.situacion"), F.lit(None).cast("boolean")),
        hit(F.col("_w").isNotNull(), "SFP", F.col("_w.rfc_norm"), span,
            C.inside_window("fecha", "_w.inicio", "_w.fin"))))
    return joined.select("*", F.inline(hits)).withColumns({
        "fecha": F.coalesce(C.iso_text("fecha"), F.lit("")),
        "match_method": F.lit("name"),
        "needs_verification": F.lit(True)}).select(*_COLUMNS)
