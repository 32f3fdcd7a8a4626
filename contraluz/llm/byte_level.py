"""Byte-level vocabularies of the tokenizer library's JSON files.

Reads the entries as bytes, and cuts texts into the library's pre-tokens.  The
cut is a regular expression; as its letter and number classes may be newer than
those of the library, the library is asked once about characters that are new,
and texts that hold one in dispute are cut by the library itself.
"""

from __future__ import annotations

import itertools
import json
import sys
import unicodedata
from collections.abc import Iterator
from functools import cached_property

import regex

from contraluz.llm.common import ship

LONG = 1 << 20
WORDS = 1 << 17


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte: itself where printable in Latin-1, else from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Pieces of a byte-level BPE file: bytes by id, ranks for merging, added tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as text:
            self.text = text.read()
        read, byte = json.loads(self.text), byte_alphabet()
        self.added = {t["content"]: t["id"] for t in read["added_tokens"]}
        self.ranks = {bytes(byte[c] for c in piece): at
                      for piece, at in read["model"]["vocab"].items() if piece not in self.added}
        made = [self.ranks[bytes(byte[c] for c in a + b)] for a, b in
                (m.split(" ") if isinstance(m, str) else m for m in read["model"]["merges"])]
        if made != sorted(made):
            raise ValueError("the merges are not in the order of the ids they make")
        self.pieces = {at: piece for piece, at in self.ranks.items()} | {
            at: content.encode() for content, at in self.added.items()}


def disputed(vocabulary: Vocabulary, pattern: str) -> str:
    """Characters that the pattern's classes and the library's may see differently.

    Only characters newer than Python's own table are asked about, in one call.
    """
    from tokenizers import Tokenizer
    known = regex.compile(r"[\p{L}\p{N}]").match
    new = [c for c in map(chr, range(sys.maxunicode + 1))
           if unicodedata.category(c) == "Cn" and known(c)]
    cut = Tokenizer.from_str(vocabulary.text).pre_tokenizer.pre_tokenize_str
    find = regex.compile(pattern).findall
    out = []
    for begin in range(0, len(new), 4096):
        # the letter a and the digit 1 join a character of their own class
        probes = [probe for c in new[begin:begin + 4096] for probe in (f"a{c}", f"1{c}")]
        text = "\n".join(probes)
        theirs = {span[0] for _, span in cut(text)}
        at, mine = 0, set()
        for word in find(text):
            mine.add(at)
            at += len(word)
        split = theirs ^ mine
        out += [p[1] for i, p in enumerate(probes) if 3 * i + 1 in split]
    return "".join(dict.fromkeys(out))


class Cutter:
    """Cuts texts into pre-tokens as the library does; made once in a task."""

    def __init__(self, text: str, pattern: str, strange: str, added: tuple[str, ...] = ()):
        self.text = text
        compiled = regex.compile(pattern)
        self.findall, self.finditer = compiled.findall, compiled.finditer
        self.known = frozenset(strange).isdisjoint
        # most texts have no character as late in the table as the first in dispute
        self.late = regex.compile(f"[^\\x00-\\U{ord(min(strange)) - 1:08x}]").search if strange else None
        self.added = regex.compile(
            "(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")"
        ) if added else None

    @cached_property
    def library(self):
        from tokenizers import Tokenizer
        return Tokenizer.from_str(self.text).pre_tokenizer.pre_tokenize_str

    def parts(self, text: str) -> Iterator[list[str]]:
        """The words of one text in order, in lists of bounded length."""
        pieces = self.added.split(text) if self.added else [text]
        for i, piece in enumerate(pieces):
            if i % 2:
                yield [piece]
            elif self.late and self.late(piece) and not self.known(piece):
                yield [piece[a:b] for _, (a, b) in self.library(piece)]
            elif len(piece) <= LONG:
                yield self.findall(piece)
            else:
                found = (m.group() for m in self.finditer(piece))
                while part := list(itertools.islice(found, WORDS)):
                    yield part


ship(__name__)
