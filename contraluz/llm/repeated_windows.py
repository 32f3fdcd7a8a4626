"""Removal of repeated word windows behind a sharded count-min prefilter.

Nearly every window of a corpus is unique, so moving all windows to group them
would move more bytes than the corpus has.  Instead:

1. Documents are dealt into blocks of bounded size.  Each block makes a partial
   count-min sketch of its windows, split into shards by hash range.  A partial
   sketch is sparse, so it travels as its sorted non-zero cells in an
   Elias-Fano code, about a byte and a half for a window and sketch row.
2. The partial sketches of a shard and row are merged in one task of bounded
   size.  Each block gets back one bit for each of its cells: whether the merged
   counter is two or more.  Counters only overestimate, so no repeat is lost.
3. Blocks send the windows estimated repeated, by 96-bit hash, to be grouped
   exactly; within a block each hash is sent once.  Grouping tells the earliest
   start of every class and sends that back to its block.
4. A window estimated repeated is removed unless it is the earliest of its
   class.  A window that was estimated wrongly is alone in its class and so
   stays.

Sketch, blocks and shards all grow in number, not in size, and a window that
stands in a third of the documents is one cell and at most one exact row for a
block.  The text is shuffled once by block; the three passes read that shuffle.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contraluz.llm.common import ship
from contraluz.llm.hashing import Hasher, U, mix, scaled

WINDOW = 20
BLOCK_BYTES = 8 << 20
SHARD_WINDOWS = 8 << 20
LEAST_SHARDS = 12
CELLS = 4  # counters for a window in each sketch row
ROWS = 2
WORD_BYTES = 6  # a usual word with its blank, for the sketch's width only

NO_ID = -(1 << 63)


def pack(cells: np.ndarray, doubled: np.ndarray) -> bytes:
    """Sorted distinct cells, and which of them count twice, in few bytes."""
    n = len(cells)
    gap = int(cells[-1]) // n
    low = 0 if gap < 16 else 1 if gap < 1 << 12 else 2 if gap < 1 << 20 else 3
    high = (cells >> (8 * low)) + np.arange(n)
    bits = np.zeros(int(high[-1]) + 1, bool)
    bits[high] = True
    lows = cells.astype("<u4").view(np.uint8).reshape(n, 4)[:, :low].T
    return (np.array([n, low, len(bits)], "<u4").tobytes() + lows.tobytes()
            + np.packbits(bits).tobytes() + np.packbits(doubled).tobytes())


def unpack(code: bytes) -> tuple[np.ndarray, np.ndarray]:
    n, low, size = np.frombuffer(code, "<u4", 3).tolist()
    lows = np.frombuffer(code, np.uint8, n * low, 12).reshape(low, n)
    at = 12 + n * low
    bits = np.unpackbits(np.frombuffer(code, np.uint8, -(-size // 8), at), count=size)
    cells = (np.flatnonzero(bits) - np.arange(n)) << (8 * low)
    for i in range(low):
        cells |= lows[i].astype(np.int64) << (8 * i)
    doubled = np.unpackbits(np.frombuffer(code, np.uint8, -1, at + -(-size // 8)), count=n)
    return cells, doubled


class Block:
    """The rows of a block in order, with the hashes of their windows."""

    def __init__(self, table: pa.Table, hasher: Hasher):
        ids = table.column("doc_id").to_pylist()
        texts = [t or b"" for t in table.column("text").cast(pa.binary()).to_pylist()]
        key = [(NO_ID if i is None else i, t) for i, t in zip(ids, texts)]
        order = sorted(range(len(key)), key=key.__getitem__)
        # a repeated row is the same document: worked out once, returned twice
        self.rows = [list(g) for _, g in itertools.groupby(order, key.__getitem__)]
        self.ids = [ids[g[0]] for g in self.rows]
        self.texts = [texts[g[0]] for g in self.rows]
        self.first, self.second, self.valid, self.sizes = hasher.windows(self.texts, WINDOW)
        starts = np.cumsum(self.sizes) - self.sizes
        keys = np.array([NO_ID if i is None else i for i in self.ids], np.int64)
        # texts of one id follow each other, and positions run on over them
        new = np.r_[True, keys[1:] != keys[:-1]] if len(keys) else np.zeros(0, bool)
        base = np.repeat(starts[new], np.diff(np.r_[np.flatnonzero(new), len(keys)]))
        self.keys = np.repeat(keys, self.sizes)
        self.places = (np.arange(len(self.keys)) - np.repeat(base, self.sizes)).astype(np.int64)
        self.base = dict(zip(keys[new].tolist(), starts[new].tolist()))

    def cells(self, shards: int, width: int):
        """(shard, row, windows, distinct cells, cell index of each window, counts)"""
        at = np.flatnonzero(self.valid)
        shard = scaled(self.first[at], shards)
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(shards + 1))
        for s in range(shards):
            mine = at[order[cuts[s]:cuts[s + 1]]]
            if len(mine):
                for row in range(ROWS):
                    cell = scaled(mix(self.first[mine], 11 + row), width).astype(np.int64)
                    yield (s, row, mine, *np.unique(
                        cell, return_inverse=True, return_counts=True))

    def repeated(self, replies: pa.Table, shards: int, width: int) -> np.ndarray:
        """Which windows both rows of the merged sketch estimate as repeated."""
        answer = dict(zip(zip(replies.column("shard").to_pylist(),
                              replies.column("row").to_pylist()),
                          replies.column("a").to_pylist()))
        votes = np.zeros(len(self.valid), np.uint8)
        for shard, row, at, cells, inverse, _ in self.cells(shards, width):
            bits = np.unpackbits(np.frombuffer(answer[shard, row], np.uint8), count=len(cells))
            votes[at] += bits[inverse]
        return votes == ROWS


SIDE = "block int, kind int, shard int, row int, a binary, b binary, c binary, d binary"
SIDE_NAMES = [x.split()[0] for x in SIDE.split(", ")]
SIDE_TYPES = [pa.int32()] * 4 + [pa.binary()] * 4


def side(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array(list(x), t) for x, t in zip(
        zip(*rows) if rows else [[]] * 8, SIDE_TYPES)], names=SIDE_NAMES)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    block_bytes: int = BLOCK_BYTES,
                    shard_windows: int = SHARD_WINDOWS) -> DataFrame:
    """Each document without the words of windows that start earlier elsewhere.

    Words are runs of characters other than blank and \\t to \\r; a window is 20
    of them in one document.  Earlier means a smaller id, or the same document
    and an earlier start.  Returned: doc_id, n_words, n_removed, kept (the kept
    words, joined by one blank).  A null text has no words, a null id comes
    before all others, equal rows are one document and each gets its result,
    and different texts of one id are parts of one document, in the order of
    their bytes.  Other columns of the input are not used.

    `block_bytes` of text are held by a task at a time (a longer document is
    held as it is), `shard_windows` bounds a merged sketch shard.
    """
    chosen = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                         F.col(f"`{text}`").alias("text"))
    size = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    expected = size // WORD_BYTES + 1
    blocks = size // block_bytes + 1
    shards = max(LEAST_SHARDS, -(-expected // shard_windows))
    width = max(1024, -(-expected // shards) * CELLS)
    block: Column = F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int")
    dealt = chosen.select("doc_id", "text", block.alias("block"))

    def sketch(table: pa.Table) -> pa.Table:
        number = table.column("block")[0].as_py()
        return side([(number, 0, shard, row, pack(cells, counts > 1), None, None, None)
                     for shard, row, _, cells, _, counts
                     in Block(table, Hasher()).cells(shards, width)])

    def merge(table: pa.Table) -> pa.Table:
        counters = np.zeros(width, np.uint8)
        codes = table.column("a").to_pylist()
        for code in codes:
            cells, doubled = unpack(code)
            counters[cells] = np.minimum(counters[cells] + 1 + doubled, 2)
        replies = [np.packbits(counters[unpack(c)[0]] > 1).tobytes() for c in codes]
        at = table.schema.get_field_index("a")
        return table.set_column(at, "a", pa.array(replies, pa.binary()))

    def estimate(left: pa.Table, replies: pa.Table) -> pa.Table:
        if not left.num_rows:
            return side([])
        rows = Block(left, Hasher())
        at = np.flatnonzero(rows.repeated(replies, shards, width))
        second = (rows.second[at] >> U(32)).astype(np.uint32)
        order = np.lexsort((second, rows.first[at]))  # stable, so the earliest leads
        at, second = at[order], second[order]
        first = rows.first[at]
        new = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])][:len(at)]
        at, second, first = at[new], second[new], first[new]
        cuts = np.searchsorted(scaled(first, shards), np.arange(shards + 1))
        number, out = left.column("block")[0].as_py(), []
        for s in range(shards):
            order = np.argsort(at[cuts[s]:cuts[s + 1]]) + cuts[s]
            if len(order):
                out.append((number, 1, s, 0, first[order].tobytes(),
                            second[order].tobytes(), rows.keys[at[order]].tobytes(),
                            rows.places[at[order]].astype(np.int32).tobytes()))
        return side(out)

    def earliest(table: pa.Table) -> pa.Table:
        def joined(name, kind):
            return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
        first, second = joined("a", np.uint64), joined("b", np.uint32)
        keys, places = joined("c", np.int64), joined("d", np.int32)
        sizes = [len(x) // 8 for x in table.column("a").to_pylist()]
        owner = np.repeat(np.array(table.column("block").to_pylist(), np.int64), sizes)
        order = np.lexsort((places, keys, second, first))
        new = np.r_[True, (np.diff(first[order]) != 0) | (np.diff(second[order]) != 0)]
        at = order[new]
        at = at[np.argsort(owner[at], kind="stable")]
        numbers, cuts = np.unique(owner[at], return_index=True)
        shard = table.column("shard")[0].as_py()
        return side([(int(b), 2, shard, 0, keys[p].tobytes(), places[p].tobytes(), None, None)
                     for b, p in zip(numbers, np.split(at, cuts[1:]))])

    def finish(left: pa.Table, answers: pa.Table) -> pa.Table:
        if left.num_rows:
            rows = Block(left, Hasher())
            kinds = np.array(answers.column("kind").to_pylist(), np.int64)
            removed = rows.repeated(answers.filter(pa.array(kinds == 0)), shards, width)
            firsts = answers.filter(pa.array(kinds == 2))
            for keys, places in zip(firsts.column("a").to_pylist(),
                                    firsts.column("b").to_pylist()):
                keys, places = np.frombuffer(keys, np.int64), np.frombuffer(places, np.int32)
                distinct, inverse = np.unique(keys, return_inverse=True)
                base = np.array([rows.base[k] for k in distinct.tolist()], np.int64)
                removed[base[inverse] + places] = False
            change = np.zeros(len(removed) + WINDOW + 1, np.int32)
            starts = np.flatnonzero(removed)
            change[starts] += 1
            change[starts + WINDOW] -= 1
            covered = np.cumsum(change)[:len(removed)] > 0
            ends = np.cumsum(rows.sizes).tolist()
        out = []
        for i in range(len(rows.rows) if left.num_rows else 0):
            n = int(rows.sizes[i])
            gone = covered[ends[i] - n:ends[i]]
            words, m = rows.texts[i].split(), int(gone.sum())
            if m:
                words = itertools.compress(words, (~gone).tolist())
            out += [(rows.ids[i], n, m, b" ".join(words))] * len(rows.rows[i])
        kinds = [pa.int64()] * 3 + [pa.binary()]
        columns = [pa.array(list(x), t) for x, t in zip(zip(*out) if out else [[]] * 4, kinds)]
        columns[3] = columns[3].cast(pa.string())
        return pa.table(columns, names=["doc_id", "n_words", "n_removed", "kept"])

    by_block = dealt.groupBy("block")
    replies = by_block.applyInArrow(sketch, SIDE).groupBy("shard", "row").applyInArrow(
        merge, SIDE)
    firsts = by_block.cogroup(replies.groupBy("block")).applyInArrow(
        estimate, SIDE).groupBy("shard").applyInArrow(earliest, SIDE)
    return by_block.cogroup(replies.unionByName(firsts).groupBy("block")).applyInArrow(
        finish, "doc_id long, n_words long, n_removed long, kept string")


ship(__name__)
