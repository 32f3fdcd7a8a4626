"""Records of quoted CSV files, cut in many tasks for each file.

A line break ends a record only outside quotes, so a file with line breaks inside
fields cannot be cut at any line.  But a quote inside a field is doubled: whether a
line ends inside quotes depends only on whether the quotes before it are odd.  A
first pass counts quotes by block of a file; a running sum over the blocks says
which of them start inside quotes; a second pass reads the lines again, in the
order of the file, and joins those of a record.  What a block's end leaves open is
put together with the beginning of the blocks behind it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: what windows-1252 has at 128 to 159, where Latin-1 has control characters; the five
#: bytes that stand for nothing become U+FFFD
_WINDOWS = bytes(range(128, 160)).decode("windows-1252", errors="replace")
_CONTROLS = bytes(range(128, 160)).decode("latin-1")
_PARTS = ("file", "block", "place", "kind", "record")


def decoded(line: Column, encoding: str) -> Column:
    """Text of raw bytes; undecodable ones become U+FFFD."""
    if encoding.lower() in ("utf-8", "utf8"):
        return F.make_valid_utf8(line)
    if encoding.lower() not in ("windows-1252", "cp1252"):
        raise ValueError(f"unknown encoding {encoding!r}")
    return F.translate(F.decode(line.cast("binary"), "ISO-8859-1"), _CONTROLS, _WINDOWS)


def read_records(spark: SparkSession, paths: str | Sequence[str],
                 encoding: str = "windows-1252") -> DataFrame:
    """(file, place, record): the records of CSV files as text.

    `place` is 0 for the first record of a file, else the block's start in the
    file and the number in the block in one number, so it rises along the file.
    Records without text are left out.  A file that ends inside quotes ends its
    last record there.
    """
    raw = _lines(spark, paths)
    # a block that is its whole file needs no other, so no quotes before it are counted
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    along = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    inside = (raw.where("not alone").groupBy("file", "block").agg(F.sum(quotes).alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(along), F.lit(0)))
              .where("before % 2 = 1").select("file", "block", F.lit(True).alias("inside")))
    # few blocks start inside quotes: the table is one small row for each of them
    lines = raw.join(F.broadcast(inside), ["file", "block"], "left").select(
        "file", "block", F.coalesce("inside", F.lit(False)).alias("inside"), "alone",
        decoded(F.col("value"), encoding).alias("value"))
    schema = "file string, block long, place long, kind string, record string"
    whole = lines.mapInArrow(_whole, schema)
    cut = lines.where("not alone").mapInArrow(_edges, schema)
    # an opened record goes on through the blocks behind it, up to the one that ends it
    order = Window.partitionBy("file").orderBy("block", "place")
    open_ = cut.withColumn("opened", F.sum(
        F.when(F.col("kind") == "open", 1).otherwise(0)).over(order))
    joined = open_.groupBy("file", "opened").agg(
        F.min(F.struct("block", "place")).alias("at"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(
            "block", "place", "record"))), lambda p: p["record"]), "\n").alias("record")).select(
                "file", "at.block", "at.place", "record")
    both = whole.select("file", "block", "place", "record").unionByName(joined)
    place = F.col("block") + F.col("place")
    return both.where(F.trim("record") != "").select(
        "file", place.alias("place"), F.regexp_replace("record", "\r$", "").alias("record"))


def _lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Raw lines with their block of a file, and whether it is `alone` in the file."""
    return (spark.read.option("lineSep", "\n")
            .text(paths if isinstance(paths, str) else list(paths))
            .select(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    (F.col("_metadata.file_block_length") >= F.col("_metadata.file_size"))
                    .alias("alone"), "value"))


def first_records(spark: SparkSession, paths: str | Sequence[str],
                  encoding: str = "windows-1252") -> list[tuple[str, str]]:
    """(file, first record) of each file that begins with one; one job, no record is cut.

    Only files whose first line leaves quotes open have their records read.
    """
    lines = _lines(spark, paths).where("block = 0").select(
        "file", decoded(F.col("value"), encoding).alias("record"))
    first = lines.mapInArrow(_first, "file string, record string").select(
        "file", F.regexp_replace("record", "\r$", "").alias("record")).collect()
    found = [(r["file"], r["record"]) for r in first]
    going_on = [unquote(file) for file, record in found if record.count('"') % 2]
    if going_on:
        rest = read_records(spark, going_on, encoding).where("place = 0").select("file", "record")
        found = [(f, r) for f, r in found if r.count('"') % 2 == 0] + [
            (r["file"], r["record"]) for r in rest.collect()]
    return [(file, record) for file, record in found if record.strip(" ")]


def _first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line of each file."""
    last = None
    for batch in batches:
        if batch.num_rows:
            files = batch.column(0)
            begins = np.append(files[0].as_py() != last, _turns(files)).nonzero()[0]
            last = files[-1].as_py()
            yield pa.RecordBatch.from_arrays([
                files.take(pa.array(begins)),
                batch.column(1).take(pa.array(begins)).fill_null("")], names=["file", "record"])


def _turns(column: pa.Array) -> np.ndarray:
    """Whether a value differs from the one before it, from the second on."""
    return np.asarray(pc.not_equal(column[1:], column[:-1]), dtype=bool)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records that lie in one block."""
    return (piece for kind, piece in _cut(batches) if kind == "whole")


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of records that go on over a block's end."""
    return (piece for kind, piece in _cut(batches) if kind != "whole")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.RecordBatch]]:
    """Records of the lines of blocks by kind, each block's lines one after another.

    A line starts at its block's start plus its number at least, so a place of
    block and number rises along the file.  Records are ranges of lines, joined
    a batch at a time.
    """
    at, waiting, begun, number, inside, alone = None, [], 0, 0, False, True
    going_on = False  # whether the record at hand began in an earlier block

    def pieces(kind: str, places: np.ndarray, records: pa.Array) -> tuple[str, pa.RecordBatch]:
        n = len(records)
        return kind, pa.RecordBatch.from_arrays([
            pa.repeat(pa.scalar(at[0], pa.string()), n), pa.repeat(pa.scalar(at[1], pa.int64()), n),
            pa.array(places, pa.int64()), pa.repeat(pa.scalar(kind), n), records],
            names=list(_PARTS))

    def left() -> Iterator[tuple[str, pa.RecordBatch]]:
        # lines left open at a block's end: an opened record, or the middle of one
        if waiting:
            kind = "whole" if alone else "within" if going_on else "open"
            yield pieces(kind, np.array([begun]), pa.array(["\n".join(waiting)], pa.string()))

    for batch in batches:
        if not batch.num_rows:
            continue
        files, blocks, starts, alones = batch.columns[:4]
        values = batch.column(4).fill_null("")
        odd = np.asarray(pc.count_substring(values, '"')) % 2
        turns = np.flatnonzero(_turns(files) | _turns(blocks)) + 1
        for begin, end in zip([0, *turns], [*turns, batch.num_rows]):
            here = (files[begin].as_py(), blocks[begin].as_py())
            if here != at:
                yield from left()
                at, waiting, number = here, [], 0
                inside = going_on = starts[begin].as_py()
                alone = alones[begin].as_py()
            lines = values[begin:end]
            open_after = (np.cumsum(odd[begin:end]) + inside) % 2
            lasts = np.flatnonzero(open_after == 0)
            firsts = np.append(0, lasts + 1)
            if len(lasts):
                if len(lasts) == lasts[-1] + 1:
                    records = lines[:len(lasts)]
                else:
                    records = pc.binary_join(pa.ListArray.from_arrays(
                        pa.array(firsts, pa.int32()), lines), "\n")
                places = number + firsts[:-1]
                if waiting or going_on:
                    kind = "within" if going_on else "whole"
                    head = "\n".join([*waiting, records[0].as_py()])
                    yield pieces(kind, np.array([begun if waiting else number]),
                                 pa.array([head], pa.string()))
                    records, places = records[1:], places[1:]
                    waiting, going_on = [], False
                yield pieces("whole", places, records)
            if not waiting:
                begun = number + int(firsts[-1])
            waiting += lines[int(firsts[-1]):].to_pylist()
            inside = bool(open_after[-1])
            number += end - begin
    if at is not None:
        yield from left()


def parsed(records: DataFrame, names: Sequence[str], bad: str | None = None) -> DataFrame:
    """Records as text columns by position; short ones are padded with NULL.

    `bad` names a column for the text of records whose width is not that of the
    names.  The columns `file` and `place` stay.
    """
    fields = [*names, *([bad] if bad else [])]
    schema = ", ".join(f"`{n}` string" for n in fields)
    options = {"mode": "PERMISSIVE", "quote": '"', "escape": '"', "maxCharsPerColumn": "-1",
               "maxColumns": str(len(names) + 20_000)}
    if bad:
        options["columnNameOfCorruptRecord"] = bad
    return once(records, ["file", "place"], F.from_csv("record", schema, options))


def once(rows: DataFrame, kept: Sequence[str], fields: Column) -> DataFrame:
    """The kept columns and the fields of a struct, which is made once for each row.

    Filters on a projected column are moved below it with a copy of its expression, so
    that a parser would run once for each column filtered; they do not pass a generator.
    """
    return rows.select(*kept, F.inline_outer(F.array(fields)))


def file_name(file: Column | str) -> Column:
    return F.element_at(F.split(file, "/"), -1)


# tasks receive the helpers themselves, so workers need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
