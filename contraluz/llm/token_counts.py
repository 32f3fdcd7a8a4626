"""Token counts that follow edits without encoding whole texts again.

Each document has a segment tree over blocks of its pre-tokens: a leaf holds
the lengths and token counts of some consecutive pre-tokens, an inner node the
sums of its two children.  An edit descends to the pre-tokens it touches.
Cutting starts again at the last pre-token that ends two characters before the
edit, since the pattern never looks further than one character past the end of
a match, and stops at the first old boundary behind the edit that the new cut
meets again: from there on both texts are cut alike.  Only the pre-tokens in
between are encoded, and the sums above the changed leaves are renewed.

Documents are independent, so all of it is a narrow map; edits that live in a
table of their own are first gathered by document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contraluz.llm.common import ship, slices, without

BLOCK = 64
REMEMBERED = 200_000
BOUNDARY = 2  # characters before an edit whose pre-tokens it can still change
EDIT = "array<struct<start:int,removed:int,inserted:string>>"


class Known(dict):
    """Token counts of pre-tokens, encoded when first asked for."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, piece: str) -> int:
        found = self[piece] = len(self.encode(piece.encode()))
        return found


class Counter:
    """Pre-tokens and their token counts, with a bounded memory of them."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern)
        self.encoding = tiktoken.Encoding(
            "counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.known = Known(self.encoding._encode_single_piece)

    def counts(self, pieces: list[str]) -> np.ndarray:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        return np.fromiter(map(self.known.__getitem__, pieces), np.int32, len(pieces))


class SegmentTree:
    """A document's pre-token lengths and counts, in leaves under a sum tree."""

    def __init__(self, lengths: np.ndarray, counts: np.ndarray):
        self.build(lengths, counts)

    def build(self, lengths: np.ndarray, counts: np.ndarray) -> None:
        cuts = range(BLOCK, len(lengths), BLOCK)
        self.lengths, self.counts = np.split(lengths, cuts), np.split(counts, cuts)
        self.width = 1 << max(0, len(self.lengths) - 1).bit_length()
        self.chars = np.zeros(2 * self.width, np.int64)
        self.tokens = np.zeros(2 * self.width, np.int64)
        n = len(self.lengths)
        if len(lengths):
            starts = np.arange(0, len(lengths), BLOCK)
            self.chars[self.width:self.width + n] = np.add.reduceat(lengths, starts)
            self.tokens[self.width:self.width + n] = np.add.reduceat(counts, starts)
        level = self.width
        while level > 1:
            for sums in (self.chars, self.tokens):
                sums[level // 2:level] = sums[level:2 * level].reshape(-1, 2).sum(axis=1)
            level //= 2

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    def locate(self, position: int) -> tuple[int, int]:
        """The leaf that holds a character, and the characters before that leaf."""
        node, before = 1, 0
        while node < self.width:
            node *= 2
            if before + self.chars[node] <= position and self.chars[node + 1]:
                before += int(self.chars[node])
                node += 1
        return node - self.width, before

    def replace(self, first: int, last: int, lengths: np.ndarray, counts: np.ndarray) -> None:
        """New contents for the leaves first..last, all put into the first one."""
        for leaf in range(first, last + 1):
            mine = leaf == first
            self.lengths[leaf] = lengths if mine else lengths[:0]
            self.counts[leaf] = counts if mine else counts[:0]
            node = self.width + leaf
            self.chars[node] = self.lengths[leaf].sum()
            self.tokens[node] = self.counts[leaf].sum()
            while node > 1:
                node //= 2
                self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
                self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]
        if len(lengths) > 8 * BLOCK:  # a leaf that outgrew its block: spread it again
            self.build(np.concatenate(self.lengths), np.concatenate(self.counts))


def cut(text: str, counter: Counter) -> tuple[np.ndarray, np.ndarray]:
    pieces = counter.pattern.findall(text)
    return np.fromiter(map(len, pieces), np.int32, len(pieces)), counter.counts(pieces)


def edit(text: str, tree: SegmentTree, counter: Counter, start: int, removed: int,
         inserted: str) -> tuple[str, int]:
    """The edited text and how many pre-tokens were encoded; the tree follows.

    A start or length beyond the text is drawn back to its end.
    """
    start = min(max(start, 0), len(text))
    removed = min(max(removed, 0), len(text) - start)
    new = text[:start] + inserted + text[start + removed:]
    first, before = tree.locate(max(0, start - BOUNDARY))
    if start <= BOUNDARY:
        first, before = 0, 0
    ends = before + np.cumsum(tree.lengths[first])
    keep = int(np.searchsorted(ends, start - BOUNDARY, side="right"))
    begin = int(ends[keep - 1]) if keep else before
    old_end, shift = start + removed, len(inserted) - removed
    leaf, reach = first, before  # old boundaries, leaf by leaf
    boundaries = set(ends[ends >= old_end].tolist())
    reach = int(ends[-1]) if len(ends) else before
    pieces, meeting = [], None
    for match in counter.pattern.finditer(new, begin):
        pieces.append(match.group())
        old = match.end() - shift
        if match.end() < start + len(inserted) or old < old_end:
            continue
        while reach < old and leaf + 1 < len(tree.lengths):
            leaf += 1
            more = reach + np.cumsum(tree.lengths[leaf])
            boundaries.update(more[more >= old_end].tolist())
            reach = int(more[-1]) if len(more) else reach
        if old in boundaries:
            meeting = old
            break
    if meeting is None:
        leaf, meeting = len(tree.lengths) - 1, len(text)
    lengths = np.concatenate(tree.lengths[first:leaf + 1])
    counts = np.concatenate(tree.counts[first:leaf + 1])
    resume = int(np.searchsorted(before + np.cumsum(lengths), meeting, side="right"))
    fresh = np.fromiter(map(len, pieces), np.int32, len(pieces))
    tree.replace(
        first, leaf, np.concatenate([lengths[:keep], fresh, lengths[resume:]]),
        np.concatenate([counts[:keep], counter.counts(pieces), counts[resume:]]))
    return new, len(pieces)


def count_with_edits(df: DataFrame, text: str, edits: str, ranks: dict[bytes, int],
                     pattern: str) -> DataFrame:
    """Token counts before and after the edits of each document.

    `edits` is an array of (start, removed, inserted) in order, each meant for
    the text that the ones before it left.  Added: `n_tokens`,
    `n_tokens_edited`, `n_pieces`, `n_reencoded` (pre-tokens encoded for the
    edits) and `edited`.  A null text counts as empty, a null edit list as
    none, null parts of an edit as 0 or empty.  Columns of those names are
    replaced, all others kept.
    """
    added = ("n_tokens long, n_tokens_edited long, n_pieces long, n_reencoded long, "
             "edited string")
    names = [a.split()[0] for a in added.split(", ")]
    kept = without(df, names)
    shared = df.sparkSession.sparkContext.broadcast((ranks, pattern))
    chosen = df.select(*[F.col(f"`{c}`") for c in kept],
                       F.col(f"`{text}`").alias("__text"),
                       F.col(f"`{edits}`").cast(EDIT).alias("__edits"))
    schema = df.select(*[F.col(f"`{c}`") for c in kept]).schema
    for part in added.split(", "):
        schema = schema.add(*part.split())

    def one(part, counter):
        columns, rows = part.columns, []
        for body, changes in zip(columns[-2], columns[-1]):
            body, changes = body.as_py() or "", changes.as_py() or []
            tree = SegmentTree(*cut(body, counter))
            n, pieces, again = tree.total, sum(map(len, tree.lengths)), 0
            for c in changes:
                body, some = edit(body, tree, counter, c["start"] or 0,
                                  c["removed"] or 0, c["inserted"] or "")
                again += some
            rows.append((n, tree.total, pieces, again, body))
        out = [pa.array(x, t) for x, t in zip(zip(*rows), [pa.int64()] * 4 + [pa.string()])]
        return pa.RecordBatch.from_arrays([*columns[:-2], *out], names=schema.names)

    def run(batches):
        counter = Counter(*shared.value)
        for batch in batches:
            for part in slices(batch, batch.num_columns - 2):
                yield one(part, counter)

    return chosen.mapInArrow(run, schema)


def with_edits(docs: DataFrame, edits: DataFrame, out: str = "edits") -> DataFrame:
    """Documents with the edits of a table (doc_id, seq, start, removed, inserted).

    The edits of one document follow each other, so they are one list; ties in
    `seq` go by start, removed and inserted.
    """
    lists = edits.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(
        "seq", "start", "removed", "inserted"))).alias("__all"))
    return docs.select(*[F.col(f"`{c}`") for c in without(docs, [out])]).join(
        lists, "doc_id", "left").withColumn(out, F.transform("__all", lambda e: F.struct(
            e["start"].alias("start"), e["removed"].alias("removed"),
            e["inserted"].alias("inserted")))).drop("__all")


def revision_edits(doc_id: str, text: str) -> Column:
    """Three edits drawn from the id: an insertion, a deletion, a replacement."""
    def place(salt: int, size: Column) -> Column:
        return F.pmod(F.xxhash64(F.col(doc_id), F.lit(salt)), size).cast("int")
    size = F.coalesce(F.length(text), F.lit(0)) + 1
    change = [(place(1, size), F.lit(0), F.lit(" it's a note,\n 2 ")),
              (place(2, size), place(3, F.lit(12)), F.lit("")),
              (place(4, size), place(5, F.lit(6)),
               F.substring(F.col(text), 1, 9))]
    return F.array(*[F.struct(a.alias("start"), b.alias("removed"), c.alias("inserted"))
                     for a, b, c in change])


ship(__name__)
