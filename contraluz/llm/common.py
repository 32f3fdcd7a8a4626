"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from contraluz.session import stored

__all__ = ["documents", "few", "held_out", "map_column", "ship", "slices", "stored",
           "table", "without"]

SLICE = 1 << 20
BROADCAST_ROWS = 1_000_000


def ship(module: str) -> None:
    """Functions of the module travel by value, so workers need no copy of it."""
    found: types.ModuleType = sys.modules[module]
    cloudpickle.register_pickle_by_value(found)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def held_out(doc_id: str, parts: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder; false for a null id."""
    crc = F.crc32(F.col(doc_id).cast("string"))
    return F.coalesce(crc % parts == remainder, F.lit(False))


def without(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Columns whose names, in any case of letters, are not among the given ones."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def map_column(df: DataFrame, column: str, added: str,
               start: Callable[[], Callable[[pa.Array], list[pa.Array]]]) -> DataFrame:
    """Columns computed from one column by Arrow batches, beside all others.

    `start` is called once in a task and gives the function from the column's
    array to the arrays of the added columns.  A column of the input that has
    the name of an added one is replaced.
    """
    fields = StructType.fromDDL(added).fields
    kept = without(df, [f.name for f in fields])
    schema = StructType([df.schema[c] for c in kept] + fields)
    names = [f.name for f in schema.fields]
    source = "__source"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for part in slices(batch, batch.num_columns - 1):
                columns = part.columns
                yield pa.RecordBatch.from_arrays(
                    [*columns[:-1], *work(columns[-1])], names=names)

    chosen = [F.col(f"`{c}`") for c in kept]
    return df.select(*chosen, F.col(f"`{column}`").alias(source)).mapInArrow(run, schema)


def few(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """The rows, marked for broadcast if they are counted to be few.

    For stored tables of a few narrow columns: `most` rows of them are some
    tens of megabytes.  Beyond that the join that uses them shuffles.
    """
    return F.broadcast(df) if df.count() <= most else df


def slices(batch: pa.RecordBatch, column: int, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batch in consecutive parts of about `most` bytes or items of a column.

    Spark bounds a batch by rows alone; whatever a task derives from the rows
    stays small this way, also where texts are long.
    """
    values = batch.column(column)
    size = pc.list_value_length if pa.types.is_list(values.type) else pc.binary_length
    ends = np.cumsum(size(values).fill_null(0).to_numpy(zero_copy_only=False) + 1)
    begin = 0
    while begin < batch.num_rows:
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


ship(__name__)
