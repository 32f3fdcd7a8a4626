"""Positional joins of the items of list-like columns, block by block.

A row's column is a sequence of items (the words of a text, the pairs of an
alignment).  What a table says of an item is wanted at each position, but a row
for each position would move many times the text.  So the rows are dealt to
blocks of bounded size inside the tasks that read them; a block numbers its
distinct items, a row keeps the numbers, and only the distinct items of blocks
are joined.  The values come back to the block, where the numbers pick them.

Rows and dictionary of a block leave a task in one exchange that both later
branches read.  A mark (checksum) of the dictionary goes both ways and is
compared at the end: were an unstable input to give other blocks when a lost
executor's part is read again, the job would fail, not mix them up.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, IntegerType, LongType, StructField, StructType)

from contraluz.llm.common import ship, slices, without

BLOCK = 16 << 20
OWN = [StructField("__block", LongType()), StructField("__mark", LongType()),
       StructField("__size", IntegerType()), StructField("__codes", BinaryType())]

#: a slice of the column to its items in a row, their bytes, and how many each row has
Itemize = Callable[[pa.Array], tuple[pa.Array, int, np.ndarray]]


def varint(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers, seven bits to a byte with the lowest first: bytes, and their ends."""
    size = np.ones(len(values), np.int64)
    rest = values >> 7
    while (rest > 0).any():
        size += rest > 0
        rest >>= 7
    ends = np.cumsum(size)
    raw = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    at, rest, left = ends - size, values, size
    while len(rest):
        more = left > 1
        raw[at] = (rest & 127) | np.where(more, 128, 0)
        at, rest, left = at[more] + 1, rest[more] >> 7, left[more] - 1
    return raw, ends


def unvarint(raw: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(raw < 128)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    out = (raw[starts] & 127).astype(np.int64)
    width, shift = ends - starts, 0
    more = np.flatnonzero(width > 0)
    while len(more):
        shift += 1
        out[more] |= (raw[starts[more] + shift].astype(np.int64) & 127) << (7 * shift)
        more = more[width[more] > shift]
    return out


def packed(raw: bytes) -> bytes:
    return len(raw).to_bytes(6, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpacked(cell: bytes) -> bytes:
    return pa.decompress(cell[6:], int.from_bytes(cell[:6], "little"), codec="zstd", asbytes=True)


def squeeze(values: np.ndarray) -> bytes:
    """Whole numbers as one compressed cell."""
    return packed(varint(values)[0].tobytes())


def unsqueeze(cells: list[bytes]) -> np.ndarray:
    """The numbers of the cells, one cell's after another's."""
    return unvarint(np.frombuffer(b"".join(map(unpacked, cells)), np.uint8))


def squeeze_items(items: pa.Array) -> bytes:
    """An array of items as one compressed cell."""
    sink = pa.BufferOutputStream()
    batch = pa.record_batch([items], names=["item"])
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unsqueeze_items(cell: bytes) -> pa.Array:
    with pa.ipc.open_stream(cell) as read:
        return read.read_all().column(0).combine_chunks()


class Block:
    """Rows and distinct items of one block while a task gathers it."""

    def __init__(self):
        self.index: dict = {}
        self.rows: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray]] = []
        self.bytes = 0

    def add(self, kept: pa.RecordBatch, items: pa.Array, size: int, sizes: np.ndarray) -> None:
        coded = items.dictionary_encode()
        index = self.index
        local = np.fromiter((index.setdefault(x, len(index))
                             for x in coded.dictionary.to_pylist()), np.int64,
                            len(coded.dictionary))
        codes = local[coded.indices.to_numpy(zero_copy_only=False)] if len(items) else (
            np.zeros(0, np.int64))
        self.rows.append((kept, codes, sizes))
        self.bytes += size

    def close(self, block: int, item: pa.DataType) -> Iterator[pa.RecordBatch]:
        """The dictionary with the times of each item, the most frequent first, then the rows."""
        items, n = list(self.index), len(self.index)
        times = np.zeros(n, np.int64)
        for _, codes, _ in self.rows:
            times += np.bincount(codes, minlength=n)
        by = np.argsort(-times, kind="stable")
        items, times = [items[i] for i in by], times[by]
        rank = np.empty(n, np.int64)
        rank[by] = np.arange(n)
        cell = squeeze_items(pa.array(items, item))
        mark = zlib.crc32(cell)
        first = self.rows[0][0]
        blank = [pa.nulls(1, t) for t in first.schema.types]
        yield pa.RecordBatch.from_arrays(
            [*blank, pa.array([block]), pa.array([mark]), pa.array([-1 - n], pa.int32()),
             pa.array([cell + squeeze(times) + len(cell).to_bytes(8, "little")])],
            names=[*first.schema.names, *(f.name for f in OWN)])
        for kept, codes, sizes in self.rows:
            raw, reach = varint(rank[codes])
            raw, reach = raw.tobytes(), np.concatenate([[0], reach])
            ends = np.cumsum(sizes)
            bounds = zip(reach[ends - sizes].tolist(), reach[ends].tolist())
            cells = [packed(raw[a:b]) if b > a else None for a, b in bounds]
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(np.full(len(sizes), block)),
                 pa.array(np.full(len(sizes), mark)), pa.array(sizes, pa.int32()),
                 pa.array(cells, pa.binary())],
                names=[*kept.schema.names, *(f.name for f in OWN)])


def in_blocks(df: DataFrame, column: str, kept: list[str], item: pa.DataType,
              start: Callable[[], Itemize], block_bytes: int = BLOCK) -> DataFrame:
    """Rows with numbered items and the dictionaries of their blocks, by block.

    `__size` is the number of items of a row, or -1 - n for a dictionary of n.
    """
    # a dictionary's row is null in the rows' columns
    schema = StructType([StructField(c, df.schema[c].dataType) for c in kept] + OWN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, count = start(), 0
        part = TaskContext.get().partitionId() << 32
        block = Block()
        for batch in batches:
            for piece in slices(batch, batch.num_columns - 1):
                rows = pa.RecordBatch.from_arrays(piece.columns[:-1], names=kept)
                block.add(rows, *work(piece.columns[-1]))
                if block.bytes >= block_bytes:
                    yield from block.close(part + count, item)
                    block, count = Block(), count + 1
        if block.rows:
            yield from block.close(part + count, item)

    chosen = [F.col(f"`{c}`") for c in kept]
    return (df.select(*chosen, F.col(f"`{column}`").alias("__source"))
            .mapInArrow(run, schema).repartition("__block"))


def dictionary(cell: bytes) -> tuple[pa.Array, np.ndarray]:
    """The items of a block in the order of their numbers, and their times."""
    cut = int.from_bytes(cell[-8:], "little")
    return unsqueeze_items(cell[:cut]), unsqueeze([cell[cut:-8]])


def dictionaries(blocks: DataFrame, added: str,
                 spell: Callable[[int, int, pa.Array, np.ndarray], Iterator[pa.RecordBatch]],
                 ) -> DataFrame:
    """Rows made from each block's distinct items: (block, mark, items, times).

    An opaque map, so that it reads the very exchange that the rows wait in.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {n: batch.schema.get_field_index(n) for n in (f.name for f in OWN)}
            sizes = batch.column(at["__size"])
            for i in np.flatnonzero(pc.less(sizes, 0).to_numpy(zero_copy_only=False)):
                yield from spell(batch.column(at["__block"])[i].as_py(),
                                 batch.column(at["__mark"])[i].as_py(),
                                 *dictionary(batch.column(at["__codes"])[i].as_py()))

    return blocks.mapInArrow(run, f"__block long, __mark long, {added}")


def by_position(blocks: DataFrame, found: DataFrame, kept: list[str], added: str,
                assemble: Callable[[pa.Table, pa.Array], Callable[[np.ndarray, np.ndarray],
                                                                list[pa.Array]]]) -> DataFrame:
    """The rows of `in_blocks` with columns computed from their items' values.

    `found` has (block, mark) and whatever `assemble` reads; `assemble` gets its
    rows of a block and the block's items, and gives a function from the items'
    numbers of consecutive rows and the rows' sizes to the added columns.
    """
    fields = StructType.fromDDL(added).fields
    schema = StructType([blocks.schema[c] for c in kept] + fields)
    names = [f.name for f in schema.fields]

    def run(rows: pa.Table, values: pa.Table) -> pa.Table:
        sizes = rows.column("__size").to_numpy()
        held = np.flatnonzero(sizes < 0)
        marks = pc.unique(pa.concat_arrays([c for t in (rows, values) for c in
                                            t.column("__mark").chunks]))
        if len(held) != 1 or len(marks) != 1:
            raise RuntimeError("the input gave other blocks when it was read again")
        items, _ = dictionary(rows.column("__codes")[held[0]].as_py())
        look = assemble(values, items)
        rows = rows.filter(pc.greater_equal(rows.column("__size"), 0))
        out = []
        for batch in rows.to_batches(max_chunksize=4096):
            counts = batch.column(batch.schema.get_field_index("__size")).to_numpy()
            cells = batch.column(batch.schema.get_field_index("__codes"))
            begin = 0
            ends = np.cumsum(counts)
            while begin < len(counts):
                before = ends[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(ends, before + (1 << 20), "right")))
                flat = unsqueeze([c.as_py() for c in cells[begin:end] if c.is_valid])
                part = batch.slice(begin, end - begin)
                own = [part.column(part.schema.get_field_index(c)) for c in kept]
                out.append(pa.RecordBatch.from_arrays(
                    [*own, *look(flat, counts[begin:end].astype(np.int64))], names=names))
                begin = end
        return pa.Table.from_batches(out)

    return blocks.groupBy("__block").cogroup(found.groupBy("__block")).applyInArrow(run, schema)


def others(df: DataFrame, *names: str) -> list[str]:
    """Columns that stay beside the added ones."""
    return without(df, [*names, *(f.name for f in OWN)])


ship(__name__)
