"""Token ids of whole texts, with a cache of the pieces that a tokenizer treats on their own.

``pieces`` says where a text may be cut without changing any id:

* ``spaced``: byte-level BPE whose pattern lets a word take the space before it. A cut before a
  space is safe unless two spaces meet, since a run of blanks is split by its length; such texts are
  encoded whole.
* ``words``: blanks are dropped between words, so every space and newline is a safe cut.
* ``whole``: no cut.

A piece that is one run of plain Latin letters, or such a run with punctuation after it, goes straight
to the vocabulary's merges; every other piece takes the tokenizer's whole path. The cache belongs to
a worker process and lives as long as that, so its memory is bounded: it holds two generations of pieces.
When the younger one is full it becomes the older one, whose pieces are taken over when they are met again.
"""

from __future__ import annotations

import codecs
import os
import re
import sys

#: Pieces of a generation, unless a coder is asked for with another number; a worker process keeps two.
CACHE = 150_000

_RUN = "[A-Za-zÀ-ÖØ-öø-įĲ-ɏ]+"
_MARKS = r"[!-&(-/:-@\[-`{-~]"
_LETTERS = re.compile(rf"({_RUN})({_MARKS}*)")
_LINES = re.compile(rf"({_RUN}{_MARKS}*)\n({_RUN})({_MARKS}*)")
#: Fixed by byte-level BPE: bytes that stand for themselves; the others follow from U+0100 in order.
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTES = {b: 0x100 + i for i, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))}
_SHOWN = "".join([chr(_BYTES.get(b, b)) for b in range(256)])


class Pieces(dict):
    """Ids of pieces as little-endian unsigned 32-bit integers, found when first asked for."""

    def __init__(self, path: str, spaced: bool, cache: int | None = None) -> None:
        super().__init__()
        self.cache = cache
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        self.lead = " " if spaced else ""
        self.space = chr(_BYTES[ord(" ")]) if spaced else ""
        self.lower = not spaced
        self.marks: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        found = self.tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join([i.to_bytes(4, "little") for i in found])

    def _mark(self, run: str) -> bytes:
        if run not in self.marks:
            if len(self.marks) >= CACHE:
                self.marks = {"": b""}
            self.marks[run] = self.ids(run)
        return self.marks[run]

    def _merged(self, word: str, lead: str) -> bytes:
        raw = word if word.isascii() else codecs.charmap_decode(word.encode(), "strict", _SHOWN)[0]
        return b"".join([t.id.to_bytes(4, "little") for t in self.merges.tokenize(lead + raw)])

    def __missing__(self, piece: str) -> bytes:
        out = self.older.get(piece)
        if out is None:
            out = self._found(piece)
        if len(self) >= (self.cache or CACHE):
            self.older = dict(self)
            self.clear()
        self[piece] = out
        return out

    def _found(self, piece: str) -> bytes:
        # most new pieces are bare words, and need no pattern to tell
        if piece.isascii() and piece.isalpha() and (piece.islower() or not self.lower):
            return self._merged(piece, self.space)
        if found := _LETTERS.fullmatch(piece):
            word, mark = found.groups()
            if mark or (self.lower and word != word.lower()):
                return self[word.lower() if self.lower else word] + self._mark(mark)
            return self._merged(word, self.space)
        if self.lead and (found := _LINES.fullmatch(piece)):
            above, word, mark = found.groups()
            return self[above] + self._mark("\n") + self._merged(word, "") + self._mark(mark)
        return self.ids(self.lead + piece)


class Coder:
    def __init__(self, path: str, pieces: str, cache: int | None = None) -> None:
        self.pieces, self.known = pieces, Pieces(path, pieces == "spaced", cache)

    def encode(self, text: str) -> bytes:
        """All ids as little-endian unsigned 32-bit integers."""
        known = self.known
        if self.pieces == "whole" or (self.pieces == "spaced" and "  " in text):
            return known.ids(text)
        if self.pieces == "words":
            return b"".join(map(known.__getitem__, text.replace("\n", " ").split(" ")))
        first, *rest = text.split(" ")
        return known.ids(first) + b"".join(map(known.__getitem__, rest))


def coder(path: str, pieces: str = "whole", cache: int | None = None) -> Coder:
    """The process's coder for a vocabulary file; executors must find the file at the same path.

    ``cache`` is the number of pieces of a generation, ``CACHE`` by default, some 150 bytes each.

    This module's code travels with each task, so the coder is kept on a module that stays loaded.
    """
    import tokenizers

    kept = vars(sys.modules[tokenizers.__name__]).setdefault("_kept_coders", {})
    if (path, pieces, cache) not in kept:
        kept[path, pieces, cache] = Coder(path, pieces, cache)
    return kept[path, pieces, cache]
