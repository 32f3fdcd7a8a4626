"""BPE encoding and decoding through a table of distinct words.

Texts are cut into words (pre-tokens) in the tasks that read them.  The distinct
words of blocks of rows go, by bucket of a hash, to the shard of the word table
that holds them; there each distinct word is encoded once, whatever the number
of blocks that use it, and its ids go back to the blocks.  A row then picks the
ids of its words by position.  Decoding joins ids to the pieces of the
vocabulary, whose size is bounded by the vocabulary's file.

A frequent word is one entry in each block, not one for each use; words and ids
travel packed, a row for each block and bucket.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contraluz.llm import byte_bpe, positions
from contraluz.llm.byte_level import Cutter, Vocabulary, disputed
from contraluz.llm.common import ship

BUCKETS = 8192


def bucket_of(words: list[str]) -> np.ndarray:
    return np.fromiter((zlib.crc32(w.encode()) % BUCKETS for w in words), np.int64, len(words))


def bucket_order(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The places of a block's words in the order of their buckets, and those buckets."""
    buckets = bucket_of(words.to_pylist())
    by = np.argsort(buckets, kind="stable")
    return by, buckets[by]


def small(values: np.ndarray) -> bytes:
    """Whole numbers in one, two or four bytes each, behind a byte that says which."""
    top = values.max() if len(values) else 0
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4
    return bytes([width]) + values.astype(f"u{width}").tobytes()


def large(cell: bytes) -> np.ndarray:
    return np.frombuffer(cell, f"u{cell[0]}", offset=1)


def spell(block: int, mark: int, words: pa.Array, times: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each bucket of a block's words: where they begin, lengths and bytes."""
    by, buckets = bucket_order(words)
    raw = [w.encode() for w in words.take(pa.array(by)).to_pylist()]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    starts = np.flatnonzero(np.diff(buckets, prepend=-1))
    ends = np.append(starts[1:], len(raw))
    n = len(starts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, block)), pa.array(np.full(n, mark)),
         pa.array(buckets[starts], pa.int32()), pa.array(starts, pa.int32()),
         pa.array([small(sizes[a:b]) for a, b in zip(starts, ends)], pa.binary()),
         pa.array([b"".join(raw[a:b]) for a, b in zip(starts, ends)], pa.binary())],
        names=["__block", "__mark", "bucket", "first", "sizes", "words"])


def encode_shards(uses: DataFrame, start) -> DataFrame:
    """Packed ids of packed words; the rows of a bucket come one after another.

    Words are remembered to the end of their bucket, so each is encoded once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, known, last = start(), {}, None
        for batch in batches:
            buckets = batch.column(2).to_pylist()
            rows = []
            for sizes, words in zip(batch.column(4), batch.column(5)):
                ends = np.cumsum(large(sizes.as_py()), dtype=np.int64).tolist()
                text = words.as_py()
                rows.append([text[a:b] for a, b in zip([0, *ends], ends)])
            if buckets and buckets[0] != last:
                known = {}
            new = list({w for row in rows for w in row if w not in known})
            known.update(zip(new, encode(new)))
            counts, ids = [], []
            for row in rows:
                found = [known[w] for w in row]
                counts.append(small(np.fromiter(map(len, found), np.int64, len(found))))
                ids.append(small(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], batch.column(3), pa.array(counts, pa.binary()),
                 pa.array(ids, pa.binary())],
                names=["__block", "__mark", "first", "counts", "ids"])
            if buckets and buckets[0] != buckets[-1]:
                known = {w: known[w] for b, row in zip(buckets, rows)
                         if b == buckets[-1] for w in row}
            last = buckets[-1] if buckets else last

    return uses.mapInArrow(run, "__block long, __mark long, first int, counts binary, ids binary")


def encode(df: DataFrame, text: str, vocabulary: Vocabulary, pattern: str, out: str = "ids",
           special: bool = True, block_bytes: int = positions.BLOCK) -> DataFrame:
    """The token ids of each whole text, in place of the text.

    With `special`, strings of the vocabulary's added tokens become their ids, as
    the library does by default; without, they are ordinary text.  A null or empty
    text has no ids (an empty array).  All other columns stay; one named as the
    added column is replaced.  Repeated rows and ids, and a null id, change
    nothing.  A very long text is cut in bounded lists; its row of ids is one cell.
    """
    kept = positions.others(df, text, out)
    added = tuple(vocabulary.added) if special else ()
    strange, context = disputed(vocabulary, pattern), df.sparkSession.sparkContext
    spelled = context.broadcast(vocabulary.text)
    plain = context.broadcast(byte_bpe.Codec(vocabulary.ranks, pattern).plain)
    whole = {content.encode(): at for content, at in vocabulary.added.items()} if special else {}

    def cutter():
        parts = Cutter(spelled.value, pattern, strange, added).parts

        def work(column: pa.Array):
            chunks, sizes, size = [pa.array([], pa.string())], [], 0
            waiting: list[str] = []
            for value in column.to_pylist():
                count = 0
                for words in parts(value) if value else ():
                    count += len(words)
                    waiting.extend(words)
                    if len(waiting) >= 1 << 17:
                        chunks.append(pa.array(waiting, pa.string()))
                        waiting = []
                sizes.append(count)
                size += len(value or "")
            chunks.append(pa.array(waiting, pa.string()))
            return pa.concat_arrays(chunks), size, np.array(sizes, np.int64)
        return work

    def encoder():
        codec = byte_bpe.Codec(*plain.value)

        def work(words: list[bytes]) -> list[np.ndarray]:
            found = codec.encode_pieces([w for w in words if w not in whole])
            rest = iter(found)
            return [np.array([whole[w]], np.int32) if w in whole else next(rest) for w in words]
        return work

    blocks = positions.in_blocks(df, text, kept, pa.string(), cutter, block_bytes)
    uses = (positions.dictionaries(blocks, "bucket int, first int, sizes binary, words binary",
                                   spell)
            .repartition("bucket").sortWithinPartitions("bucket"))
    return positions.by_position(blocks, encode_shards(uses, encoder), kept,
                                 f"`{out}` array<int>", pick_ids)


def pick_ids(values: pa.Table, words: pa.Array):
    """Ids of a block's words, to be picked by the words' numbers."""
    firsts = values.column("first").to_pylist()
    order = sorted(range(len(firsts)), key=firsts.__getitem__)
    cells = [values.column(c).to_pylist() for c in ("counts", "ids")]
    counts = np.concatenate([large(cells[0][i]) for i in order] or [np.zeros(0)]).astype(np.int64)
    flat = np.concatenate([large(cells[1][i]) for i in order] or [np.zeros(0)]).astype(np.int32)
    if len(counts) != len(words):
        raise RuntimeError("the input gave other blocks when it was read again")
    place = np.empty(len(words), np.int64)
    place[bucket_order(words)[0]] = np.arange(len(words))
    starts = (np.cumsum(counts) - counts)[place]
    counts = counts[place]

    def look(codes: np.ndarray, sizes: np.ndarray) -> list[pa.Array]:
        wide = counts[codes]
        ends = np.cumsum(wide)
        total = int(ends[-1]) if len(ends) else 0
        ids = flat[np.repeat(starts[codes] - (ends - wide), wide) + np.arange(total)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])]
        return [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))]
    return look


def piece_table(spark: SparkSession, vocabulary: Vocabulary) -> DataFrame:
    """The pieces of a vocabulary: (id, piece), as many rows as its file has entries."""
    return spark.createDataFrame(sorted(vocabulary.pieces.items()), "id int, piece binary")


def decode(df: DataFrame, ids: str, pieces: DataFrame, out: str = "decoded") -> DataFrame:
    """Adds the text that the ids stand for: their pieces' bytes, read as UTF-8.

    Rows that have ids are joined to one row that lists the pieces by id; its size
    is that of the vocabulary's file, so it is broadcast.  Bytes that are no UTF-8
    become U+FFFD; ids that the vocabulary lacks give nothing; null or no ids give
    an empty text.  All other columns stay; one named as the added one is replaced.
    """
    every = pieces.agg(F.max("id").alias("last")).select(
        F.explode(F.sequence(F.lit(0), "last")).alias("id"))
    listed = every.join(pieces, "id", "left").agg(
        (F.max("id") >= 0).alias("__some"),
        F.array_sort(F.collect_list(F.struct("id", F.hex("piece").alias("piece"))))
        .getField("piece").alias("__pieces"))
    kept = [F.col(f"`{c}`") for c in positions.others(df, out)]
    some = F.coalesce(F.size(f"`{ids}`") > 0, F.lit(False))
    joined = df.select(*kept, some.alias("__some")).join(
        F.broadcast(listed), "__some", "left")
    hexed = F.array_join(F.transform(f"`{ids}`", lambda i: F.get("__pieces", i)), "")
    text = F.make_valid_utf8(F.unhex(F.coalesce(hexed, F.lit(""))).cast("string"))
    return joined.select(*kept, text.alias(out))


ship(__name__)
