"""Ranks inside groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contraluz.session import stored


def rank_in_groups(rows: DataFrame, keys: list[str], order: list[Column], name: str,
                   parts: int | None = None) -> DataFrame:
    """The place of each row in its group, from 1, without a window over a whole group.

    Rows are dealt by ranges of (keys, order), so a group with a third of all rows
    spreads over many parts.  A row's place is its place in its part, behind the
    group's rows in earlier parts: only their counts meet, one for each part.
    Rows equal in the keys and the whole order are ranked in any order.
    """
    by = [*(F.col(k) for k in keys), *order]
    dealt = rows.repartitionByRange(parts, *by) if parts else rows.repartitionByRange(*by)
    ranged = stored(dealt.withColumn("_part", F.spark_partition_id()))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    counts = ranged.groupBy(*keys, "_part").count().select(
        *(F.col(k).alias(f"_{k}_") for k in keys), F.col("_part").alias("_at"),
        F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, "_part").orderBy(*order)
    placed = ranged.withColumn("_inside", F.row_number().over(inside))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}_")) for k in keys]
    return placed.join(counts, [*same, F.col("_part") == F.col("_at")]).select(
        *rows.columns, (F.col("_before") + F.col("_inside")).alias(name))
