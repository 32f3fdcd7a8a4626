"""Vectorised hashes of words and word windows, without a loop over words.

Words are runs of bytes other than blank and \\t to \\r.  Texts are joined to
one byte array; prefix sums of byte values, weighted by powers of an odd base,
give every word's polynomial hash, and the same over words every window's.
"""

from __future__ import annotations

import numpy as np

from contraluz.llm.common import ship

CHUNK = 1 << 20

U = np.uint64
BASE, STEP = U(0x9E3779B97F4A7C15 | 1), U(0xD1B54A32D192ED03 | 1)
MASK = (1 << 64) - 1
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit finaliser; the salt gives independent functions."""
    x = (x + U(salt * 0x9E3779B97F4A7C15 & MASK))
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE_VALUES = mix(np.arange(256, dtype=np.uint64), 7)


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, made as needed."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse = int(base), pow(int(base), -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        while len(self.up) < n:
            half = len(self.up)
            self.up = np.concatenate([self.up, self.up * U(pow(self.base, half, 1 << 64))])
            self.down = np.concatenate(
                [self.down, self.down * U(pow(self.inverse, half, 1 << 64))])


class Hasher:
    """Hashes of all words and windows of some texts, without a loop over words."""

    def __init__(self) -> None:
        self.byte_powers, self.word_powers = Powers(BASE), Powers(STEP)

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """A hash for every word, and the number of words of every text."""
        data = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
        blank = SPACE[data]
        starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
        ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
        self.byte_powers.reach(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[data] * self.byte_powers.down[:len(data)], out=sums[1:])
        hashes = (sums[ends] - sums[starts]) * self.byte_powers.up[ends]
        bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
        return mix(hashes, 1), np.diff(np.searchsorted(starts, bounds + 1))

    def windows(self, texts: list[bytes], width: int) -> tuple[np.ndarray, ...]:
        """Two hashes of the `width` words from every word on, whether those words
        stand in one text, and the number of words of every text."""
        firsts, seconds, counts = [], [], []
        for a, b in chunks(texts):
            words, sizes = self.words(texts[a:b])
            n = len(words)
            self.word_powers.reach(n + width)
            for salt, out in ((2, firsts), (3, seconds)):
                sums = np.zeros(n + width + 1, np.uint64)
                np.cumsum(mix(words, salt) * self.word_powers.down[:n], out=sums[1:n + 1])
                sums[n + 1:] = sums[n]
                window = (sums[width:n + width] - sums[:n]) * self.word_powers.up[:n]
                out.append(mix(window, salt + 2))
            counts.append(sizes)
        sizes = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        ends = np.repeat(np.cumsum(sizes), sizes)
        valid = np.arange(len(ends)) + width <= ends
        empty = np.zeros(0, np.uint64)
        return (np.concatenate(firsts or [empty]), np.concatenate(seconds or [empty]),
                valid, sizes)


def chunks(texts: list[bytes]):
    begin, total = 0, 0
    for i, t in enumerate(texts):
        if total and total + len(t) > CHUNK:
            yield begin, i
            begin, total = i, 0
        total += len(t) + 1
    if begin < len(texts):
        yield begin, len(texts)


def scaled(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes mapped evenly to 0..n-1."""
    return ((hashes >> U(32)) * U(n)) >> U(32)


ship(__name__)
