"""Encoding of whole texts with a public tokenizer, word by word through a bounded cache.

Both vocabularies split a text into pre-tokens before merging, and no pre-token crosses a single
space or newline between two visible characters, nor the end of a run of letters. A text can
therefore be encoded as the concatenation of its words' ids, and each word needs the library once.
Texts with other white space, with several such characters in a row, or with the string of an added
token (which is one id, as in the library's plain call) go to the library in pieces, cut where no
pre-token crosses, since its result takes about 160 times the bytes of what it is given.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from tokenizers import Tokenizer

#: Bytes of words kept per Python worker and vocabulary, about, in two generations: when the younger one is full, it
#: replaces the older one. ENTRY_BYTES: what an entry takes beside its characters and ids.
CACHE_BYTES, ENTRY_BYTES = 192 << 20, 150
#: Longest word that is kept, and characters given to the library at once, about.
LONGEST_KEPT, PIECE = 256, 1 << 16

# White space besides space and newline: such texts are encoded whole.
_OTHER_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0 ᠎ -     　]")
_WORD_THEN_MARK = re.compile(r"([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([!-/:-@\[-`{-~].*)", re.DOTALL)


_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-įı-ɏ]+")
#: Before a single space or line end between letters, and after a letter before a mark that is no letter: no pre-token crosses.
_CUT = re.compile("(?<=[A-Za-z])(?=[ \n][A-Za-z])|(?<=[^\\W\\d_])(?=[。、，．！？])")


def _byte_names() -> str:
    """Byte -> the visible character that byte-level vocabularies write for it, as a 256-character string."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names, extra = {b: chr(b) for b in visible}, 256
    for b in range(256):
        if b not in names:
            names[b], extra = chr(extra), extra + 1
    return "".join(names[b] for b in range(256))


_BYTE_NAMES = _byte_names()


class _Words(dict):
    """Piece -> its ids as little-endian unsigned 32-bit bytes; ``lead`` stands before each piece.

    ``held`` counts the bytes of all dictionaries of one encoder, which grow old together.
    """

    def __init__(self, tok: Tokenizer, lead: str, rest: "_Words | None"):
        super().__init__()
        self.held = rest.held if rest is not None else [0]
        self.all = rest.all if rest is not None else []
        self.all.append(self)
        self.old: dict[str, bytes] = {}
        self.tok, self.lead, self.rest = tok, lead, rest if rest is not None else self
        self.model, self.lower = tok.model, tok.normalizer is not None

    def letters(self, word: str) -> bytes:
        """Ids of one run of letters: a single pre-token, so the library's merge model alone decides."""
        word = word.lower() if self.lower else word
        if word.isascii():  # letters stand for themselves
            name = _BYTE_NAMES[32] + word if self.lead else word
        else:
            name = (self.lead + word).encode("utf-8").decode("latin-1").translate(_BYTE_NAMES)
        return _bytes([t.id for t in self.model.tokenize(name)])

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.encode(piece)
        if len(piece) <= LONGEST_KEPT:
            self.held[0] += ENTRY_BYTES + len(piece) + len(ids)
            if self.held[0] > CACHE_BYTES // 2:
                for words in self.all:
                    words.old = words.copy()
                    words.clear()
                self.held[0] = 0
            self[piece] = ids
        return ids

    def forget(self) -> None:
        self.held[0] = 0
        for words in self.all:
            words.old = {}
            words.clear()

    def encode(self, piece: str) -> bytes:
        if piece.isascii() and piece.isalpha():
            return self.letters(piece)
        m = _WORD_THEN_MARK.fullmatch(piece)
        if m:  # a run of letters ends a pre-token: the marks after it are words of their own
            ids = self[m[1]] + self.rest[m[2]]
        elif _LETTERS.fullmatch(piece):
            ids = self.letters(piece)
        else:
            ids = _bytes(self.tok.encode(self.lead + piece, add_special_tokens=False).ids)
        return ids


def _bytes(ids: list[int]) -> bytes:
    a = array("I", ids)
    if sys.byteorder == "big":
        a.byteswap()
    return a.tobytes()


class WordEncoder:
    """``encode(text)`` -> ids as ``<u4`` bytes, equal to the library's own ids for the whole text."""

    def __init__(self, path: str):
        self.tok = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.spaces_count = self.tok.normalizer is None  # the word-end vocabulary drops white space
        self.first = _Words(self.tok, "", None)
        self.inner = _Words(self.tok, " ", self.first) if self.spaces_count else self.first

    def pieces(self, text: str, size: int) -> Iterator[str]:
        """The text in pieces of about ``size`` characters, or longer where nothing allows a cut."""
        at = 0
        while at < len(text):
            cut = _CUT.search(text, at + size) if len(text) - at > size else None
            to = cut.start() if cut else len(text)
            yield text[at:to]
            at = to

    def whole(self, text: str) -> bytes:
        """By the library, a piece of the text at a time."""
        return b"".join(_bytes(self.tok.encode(t, add_special_tokens=False).ids) for t in self.pieces(text, PIECE))

    def encode(self, text: str) -> bytes:
        return self._encode(text) if len(text) <= 16 * PIECE else b"".join(map(self._encode, self.pieces(text, 16 * PIECE)))

    def _encode(self, text: str) -> bytes:
        if _OTHER_SPACE.search(text) or any(t in text for t in self.added):
            return self.whole(text)
        first, inner = self.first.__getitem__, self.inner.__getitem__
        if not self.spaces_count:
            return b"".join(map(first, text.replace("\n", " ").split(" ")))
        if "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
            return self.whole(text)
        out = []
        for k, line in enumerate(text.split("\n")):
            if k:
                out.append(first("\n"))
            words = line.split(" ")
            out.append(first(words[0]))
            out.extend(map(inner, words[1:]))
        return b"".join(out)


_ENCODERS: dict[str, WordEncoder] = {}
_STAGE = [-1]


def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker and vocabulary; words that an earlier stage left are given up."""
    task = TaskContext.get()
    stage = task.stageId() if task else -1
    if stage != _STAGE[0]:
        _STAGE[0] = stage
        for e in _ENCODERS.values():
            e.first.forget()
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def ids_of(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype="<u4")
