"""Byte-level BPE encoding and decoding over padded numpy matrices.

A text is cut into pre-tokens by the vocabulary's pattern.  The distinct
pre-tokens that a task has not met yet are laid out, by length bucket, as rows
of padded matrices of token ids.  In each round every row merges its leftmost
pair of minimum rank: the ranks of the pairs come from a hashed table held in
flat arrays, the merged cell is compacted away, only the two pairs beside it
are looked up again, and rows without a mergeable pair leave the matrix.  A
pre-token longer than the widest bucket takes the same merges from a heap, as
its row would need as many rounds as it has bytes.

Everything is a narrow map over Arrow batches: no shuffle, no state beyond a
bounded memory of pre-tokens, which is a cache and decides nothing.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from contraluz.llm.common import map_column, ship

NONE = np.int32(2**31 - 1)
BUCKETS = (4, 8, 16, 32, 64, 256)
CELLS = 1 << 19
REMEMBERED = 150_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file; a vocabulary is bounded and small."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class PairTable:
    """Open addressing over flat arrays: (left id, right id) to the merged id."""

    def __init__(self, ranks: dict[bytes, int],
                 slots: tuple[np.ndarray, np.ndarray] | None = None):
        if slots is not None:
            self.keys, self.merged = slots
            self.bits = len(self.keys).bit_length() - 1
            return
        keys, merged = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    merged.append(rank)
        self.bits = max(4, (2 * len(keys) + 1).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.merged = np.full(1 << self.bits, NONE, np.int32)
        waiting, values = np.array(keys, np.int64), np.array(merged, np.int32)
        slot = self._slot(waiting)
        while len(waiting):
            free = self.keys[slot] < 0
            _, first = np.unique(np.where(free, slot, -1 - np.arange(len(slot))),
                                 return_index=True)
            won = np.zeros(len(slot), bool)
            won[first] = True
            won &= free
            self.keys[slot[won]], self.merged[slot[won]] = waiting[won], values[won]
            waiting, values = waiting[~won], values[~won]
            slot = (slot[~won] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged ids, NONE where a pair has none or a cell is padding."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        keys[(left < 0) | (right < 0)] = -2
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.merged[slot], NONE)
        open_ = np.flatnonzero((found != keys) & (found >= 0) & (keys >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.merged[slot[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str,
                 slots: tuple[np.ndarray, np.ndarray] | None = None):
        self.ranks, self.pattern = ranks, pattern
        self.pairs = PairTable(ranks, slots)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.vocabulary = {rank: token for token, rank in ranks.items()}

    @property
    def plain(self) -> tuple:
        """The parts from which a task makes the codec again, as plain data."""
        return self.ranks, self.pattern, (self.pairs.keys, self.pairs.merged)

    def merge_rows(self, rows: list[bytes], width: int) -> list[np.ndarray]:
        """Merges of one length bucket; the rows keep their order."""
        n = len(rows)
        lengths = np.fromiter(map(len, rows), np.int64, n)
        flat = self.byte_ids[np.frombuffer(b"".join(rows), np.uint8)]
        ids = np.full((n, width), -1, np.int32)
        ids[np.arange(width) < lengths[:, None]] = flat
        out: list[np.ndarray] = [None] * n
        ranks = self.pairs.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, -1)
        alive, columns = np.arange(n), np.arange(width)
        while len(alive):
            best = ranks.argmin(axis=1)
            lowest = ranks[np.arange(len(alive)), best]
            done = lowest == NONE
            if done.any():
                for row, cells in zip(alive[done], ids[done]):
                    out[row] = cells[cells >= 0]
                alive, ids, ranks = alive[~done], ids[~done], ranks[~done]
                best, lowest = best[~done], lowest[~done]
                if not len(alive):
                    break
            at = np.arange(len(alive))
            ids[at, best] = lowest
            moved = np.minimum(columns + (columns > best[:, None]), width - 1)
            ids = np.take_along_axis(ids, moved, axis=1)
            ids[:, -1] = -1
            ranks = np.take_along_axis(ranks, moved[:, :-1].clip(max=width - 2), axis=1)
            ranks[:, -1] = NONE
            ranks[at, best.clip(max=width - 2)] = NONE
            right = np.flatnonzero(best < width - 1)
            ranks[right, best[right]] = self.pairs.find(
                ids[right, best[right]], ids[right, best[right] + 1])
            left = np.flatnonzero(best > 0)
            ranks[left, best[left] - 1] = self.pairs.find(
                ids[left, best[left] - 1], ids[left, best[left]])
        return out

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges for one very long pre-token, lowest rank first."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        tokens = [self.vocabulary[i] for i in ids]
        n = len(ids)
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        get = self.ranks.get
        heap = [(r, i, i + 1) for i in range(n - 1)
                if (r := get(tokens[i] + tokens[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, j = heapq.heappop(heap)
            if tokens[i] is None or following[i] != j or tokens[j] is None or (
                    get(tokens[i] + tokens[j]) != rank):
                continue
            tokens[i], tokens[j] = tokens[i] + tokens[j], None
            ids[i], after = rank, following[j]
            following[i] = after
            if after < n:
                before[after] = i
                if (r := get(tokens[i] + tokens[after])) is not None:
                    heapq.heappush(heap, (r, i, after))
            b = before[i]
            if b >= 0 and (r := get(tokens[b] + tokens[i])) is not None:
                heapq.heappush(heap, (r, b, i))
        return np.array([t for t, kept in zip(ids, tokens) if kept is not None], np.int32)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pre-tokens; one that is a token as it stands needs no merges."""
        out: list[np.ndarray] = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = np.array([whole], np.int32)
            elif len(piece) > BUCKETS[-1]:
                out[i] = self.merge_long(piece)
            else:
                width = next(b for b in BUCKETS if len(piece) <= b)
                buckets.setdefault(width, []).append(i)
        for width, members in buckets.items():
            step = max(1, CELLS // width)
            for begin in range(0, len(members), step):
                part = members[begin:begin + step]
                for i, ids in zip(part, self.merge_rows([pieces[i] for i in part], width)):
                    out[i] = ids
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids))


class Encoder:
    """Encodes texts in a task; remembers a bounded number of pre-tokens."""

    def __init__(self, codec: Codec):
        self.codec, self.find = codec, regex.compile(codec.pattern).findall
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.empty(1 << 16, np.int32)
        self.starts = np.zeros(REMEMBERED, np.int64)
        self.sizes = np.zeros(REMEMBERED, np.int64)
        self.used = 0

    def learn(self, pieces: list[str]) -> None:
        found = self.codec.encode_pieces([p.encode() for p in pieces])
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        new, at, total = len(self.index) + len(pieces), len(self.index), int(sizes.sum())
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        if new > len(self.starts):
            room = np.zeros(new - len(self.starts), np.int64)
            self.starts = np.concatenate([self.starts, room])
            self.sizes = np.concatenate([self.sizes, room])
        self.flat[self.used:self.used + total] = np.concatenate(found)
        self.starts[at:new] = self.used + np.cumsum(sizes) - sizes
        self.sizes[at:new] = sizes
        self.index.update(zip(pieces, range(at, new)))
        self.used += total

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        cut = [self.find(t) for t in texts]
        pieces = [p for c in cut for p in c]
        if len(self.index) > REMEMBERED:
            self.forget()
        known = self.index
        if new := [p for p in set(pieces) if p not in known]:
            self.learn(new)
        codes = np.fromiter(map(self.index.__getitem__, pieces), np.int64, len(pieces))
        sizes = self.sizes[codes]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        shift = np.repeat(self.starts[codes] - (ends - sizes), sizes)
        ids = self.flat[shift + np.arange(total)]
        bounds = np.concatenate([[0], np.cumsum([len(c) for c in cut])])
        reach = np.concatenate([[0], ends])[bounds]
        return ids, np.diff(reach)


def encode(df: DataFrame, text: str, codec: Codec, out: str = "ids") -> DataFrame:
    """Adds the token ids of each whole text as an array.

    A null or empty text has no ids.  Special tokens are ordinary text.  Every
    other column is kept; one named as the added one is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(codec.plain)

    def start():
        encoder = Encoder(Codec(*shared.value))

        def work(column: pa.Array) -> list[pa.Array]:
            texts = [t or "" for t in column.to_pylist()]
            ids, sizes = encoder.encode(texts)
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            return [pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(ids))]
        return work

    return map_column(df, text, f"`{out}` array<int>", start)


def decode(df: DataFrame, ids: str, codec: Codec, out: str = "decoded") -> DataFrame:
    """Adds the bytes that the ids stand for; null or no ids give no bytes.

    Bytes, as ids may end inside a character.  An id outside the vocabulary
    fails the job with its number, as it stands for nothing.
    """
    shared = df.sparkSession.sparkContext.broadcast(codec.vocabulary)

    def start():
        token = shared.value.__getitem__

        def work(column: pa.Array) -> list[pa.Array]:
            flat = column.flatten().to_numpy(zero_copy_only=False)
            sizes = np.zeros(len(column), np.int64)
            counted = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            sizes[:] = counted
            ends = np.cumsum(sizes)
            return [pa.array([b"".join(map(token, flat[e - n:e].tolist()))
                              for e, n in zip(ends.tolist(), sizes.tolist())], pa.binary())]
        return work

    return map_column(df, ids, f"`{out}` binary", start)


ship(__name__)
