"""Alignment of two tokenizers' tokens by pointer jumping, and link counts over a corpus.

A text is encoded by a byte-level BPE vocabulary (A) and by a sentencepiece model
(B), as runs of bytes of the same string.  Every token points to the overlapping
token that reaches farthest right, itself included; where two reach equally far
B's is taken.  Doubling the pointers (each token takes its successor's successor)
leaves every token at the last token of its connected component: the components
are the groups, cut where tokens of both sides end together.  All texts of a
slice are doubled at once, as one run of bytes.

The last tokens of a group are linked.  How often an id pair is linked in the
corpus comes from the blocks' distinct pairs, and goes back to the rows by
position.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contraluz.llm import byte_bpe, positions
from contraluz.llm.byte_level import Cutter, Vocabulary, disputed
from contraluz.llm.common import map_column, ship

ALIGNED = "n_a long, n_b long, n_groups long, groups string, links array<bigint>"


def piece_bytes(model) -> list[bytes]:
    """The bytes of each piece of a sentencepiece model, the block sign as a blank."""
    return [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, model.id_to_piece(i)) for i in range(len(model)))]


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For each token, A's and then B's, the place among B's of its component's last token.

    The tokens of a side follow one another without gaps; both end together.
    """
    n = len(ends_a)
    starts_a, starts_b = (np.concatenate([[0], e[:-1]]) for e in (ends_a, ends_b))
    over_b = np.searchsorted(starts_b, ends_a, "left") - 1
    over_a = np.searchsorted(starts_a, ends_b, "left") - 1
    own = n + np.arange(len(ends_b))
    successor = np.concatenate([n + over_b, np.where(ends_a[over_a] > ends_b, over_a, own)])
    moving = np.arange(len(successor))
    while len(moving):
        farther = successor[successor[moving]]
        moved = farther != successor[moving]
        moving, farther = moving[moved], farther[moved]
        successor[moving] = farther
    return successor - n


def written(ids: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Decimal ids, each with its sign behind it (none where 0): bytes and ends."""
    width = np.ones(len(ids), np.int64)
    for power in range(1, 10):
        longer = ids >= 10 ** power
        if not longer.any():
            break
        width += longer
    ends = np.cumsum(width + (signs > 0))
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    out[ends[signs > 0] - 1] = signs[signs > 0]
    at, rest, left = ends - 1 - (signs > 0), ids, width
    while len(rest):
        out[at] = 48 + rest % 10
        more = left > 1
        at, rest, left = at[more] - 1, rest[more] // 10, left[more] - 1
    return out, ends


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of the given sizes."""
    reach = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return reach[ends] - reach[ends - sizes]


def align_slice(ids_a: np.ndarray, sizes_a: np.ndarray, ids_b: np.ndarray, sizes_b: np.ndarray,
                bytes_a: np.ndarray, bytes_b: np.ndarray) -> list[pa.Array]:
    """The added columns for texts whose tokens stand in a row, without gaps between texts."""
    rows, n, m = len(sizes_a), len(ids_a), len(ids_b)
    last = terminals(np.cumsum(bytes_a[ids_a]), np.cumsum(bytes_b[ids_b]))
    ends_group = last[n:] == np.arange(m)
    group = np.cumsum(ends_group) - 1
    of_a, of_b = group[last[:n]], group[last[n:]]
    doc_b = np.repeat(np.arange(rows), sizes_b)
    n_groups = np.bincount(doc_b[ends_group], minlength=rows)
    last_a = np.flatnonzero(np.diff(of_a, append=-1))
    pairs = ids_a[last_a].astype(np.int64) << 32 | ids_b[ends_group]
    # where each token is written: groups in order, A's tokens before B's
    place_a = np.arange(n) + np.searchsorted(of_b, of_a, "left")
    place_b = np.arange(m) + np.searchsorted(of_a, of_b, "right")
    ids, signs = np.empty(n + m, np.int64), np.full(n + m, ord(","), np.uint8)
    ids[place_a], ids[place_b] = ids_a, ids_b
    signs[place_a[last_a]] = ord("|")
    signs[place_b[ends_group]] = ord(";")
    total = np.cumsum(sizes_a + sizes_b)
    signs[total[(sizes_a + sizes_b) > 0] - 1] = 0
    text, ends = written(ids, signs)
    cuts = np.concatenate([[0], ends])[np.concatenate([[0], total])]
    # offsets of 64 bits, as one long text may fill a slice of its own
    groups = pa.LargeStringArray.from_buffers(
        rows, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(text)).cast(pa.string())
    offsets = np.concatenate([[0], np.cumsum(n_groups)])
    links = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(pairs))
    return [pa.array(sizes_a), pa.array(sizes_b), pa.array(n_groups), groups, links]


def align(df: DataFrame, text: str, vocabulary: Vocabulary, pattern: str,
          model: bytes) -> DataFrame:
    """Adds the alignment of each whole text: counts, groups and links.

    A encodes a blank and the text, B the text, before which the model puts its
    blank; added tokens' strings are plain text.  `groups` lists the groups in order,
    `a1,a2|b1;a3|b2,b3`; `links` has a group's last ids, A's in the upper 32 bits.
    A text that is null, empty, or that a tokenizer does not give back byte for byte
    (as one that normalises it) has no tokens: zeros, '' and no links.  Repeated rows
    and ids, and a null id, are rows like others.  All other columns stay; those
    named as added ones are replaced.
    """
    strange, context = disputed(vocabulary, pattern), df.sparkSession.sparkContext
    spelled, proto = context.broadcast(vocabulary.text), context.broadcast(model)
    plain = context.broadcast(byte_bpe.Codec(vocabulary.ranks, pattern).plain)

    def start():
        import sentencepiece
        codec = byte_bpe.Codec(*plain.value)
        encoder, parts = byte_bpe.Encoder(codec), Cutter(spelled.value, pattern, strange).parts
        encoder.find = lambda t: [w for words in parts(t) for w in words]
        other = sentencepiece.SentencePieceProcessor(model_proto=proto.value)
        pieces = piece_bytes(other)
        bytes_b = np.fromiter(map(len, pieces), np.int64, len(pieces))
        bytes_a = np.zeros(max(codec.vocabulary) + 1, np.int64)
        for at, piece in codec.vocabulary.items():
            bytes_a[at] = len(piece)

        def work(column: pa.Array) -> list[pa.Array]:
            texts = [t or "" for t in column.to_pylist()]
            found = other.encode(texts, num_threads=1)
            whole = [bool(t) and b"".join([pieces[i] for i in ids]) == b" " + t.encode()
                     for t, ids in zip(texts, found)]
            ids_b = [ids if good else [] for ids, good in zip(found, whole)]
            ids_a, sizes_a = encoder.encode(
                [" " + t if good else "" for t, good in zip(texts, whole)])
            sizes_b = np.fromiter(map(len, ids_b), np.int64, len(ids_b))
            flat_b = np.fromiter((i for ids in ids_b for i in ids), np.int64, int(sizes_b.sum()))
            return align_slice(ids_a.astype(np.int64), sizes_a, flat_b, sizes_b,
                               bytes_a, bytes_b)
        return work

    return map_column(df, text, ALIGNED, start)


def spell(block: int, mark: int, pairs: pa.Array, times: np.ndarray) -> Iterator[pa.RecordBatch]:
    n = len(pairs)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, block)), pa.array(np.full(n, mark)),
         pa.array(np.arange(n), pa.int32()), pairs, pa.array(times)],
        names=["__block", "__mark", "code", "pair", "times"])


def pair_table(uses: DataFrame) -> DataFrame:
    """Each linked id pair: its count, and whether no pair of its B id counts more.

    A B id has at most as many pairs as A has ids, which bounds the window's groups.
    """
    counted = uses.groupBy("pair").agg(F.sum("times").alias("count"))
    of_b = Window.partitionBy(F.expr("pair & 4294967295"))
    return counted.select("pair", "count", (F.col("count") == F.max("count").over(of_b))
                          .alias("best"))


def link_counts(df: DataFrame, links: str, block_bytes: int = positions.BLOCK) -> DataFrame:
    """In place of the links: n_best and count_sum over a row's links.

    `count_sum` sums the corpus-wide counts of a row's links; `n_best` says how many
    of them are the most frequent of their B id (ties included).  Null or no links
    give zeros.  All other columns stay; those named as added ones are replaced.
    """
    kept = positions.others(df, links, "n_best", "count_sum")

    def start():
        def work(column: pa.Array):
            sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            items = column.flatten()
            return items, 8 * len(items) + 8 * len(column), sizes.astype(np.int64)
        return work

    blocks = positions.in_blocks(df, links, kept, pa.int64(), start, block_bytes=block_bytes)
    uses = positions.dictionaries(blocks, "code int, pair long, times long", spell)
    found = uses.join(pair_table(uses), "pair").select(
        "__block", "__mark", "code", "count", "best")
    return positions.by_position(blocks, found, kept, "n_best long, count_sum long", total_counts)


def total_counts(values: pa.Table, pairs: pa.Array):
    code, items = values.column("code").to_numpy(), len(pairs)
    if len(code) != items:
        raise RuntimeError("the input gave other blocks when it was read again")
    count, best = np.zeros(items, np.int64), np.zeros(items, np.int64)
    count[code] = values.column("count").to_numpy()
    best[code] = values.column("best").to_numpy(zero_copy_only=False)

    def look(codes: np.ndarray, sizes: np.ndarray) -> list[pa.Array]:
        return [pa.array(sums(best[codes], sizes)), pa.array(sums(count[codes], sizes))]
    return look


ship(__name__)
