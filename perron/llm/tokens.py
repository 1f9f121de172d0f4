"""Whole texts to token ids with a public tokenizer, inside tasks.

Words are encoded once per task process and remembered. A text is cut before each blank, and before line feeds, where
a word follows and none of the cut's sides is white space besides: there both kinds of tokenizer cut anyway. Texts
with other white space, or with the start of a special token's name, go to the library whole.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from itertools import islice

import numpy as np

#: Letters that every Unicode version counts as such, with one run of marks behind: two pieces for either tokenizer.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?#*$%&|]*)")
REMEMBERED = 800_000
LONGEST = 64


class _Odd(Exception):
    """White space that a cut would change."""


class _Known(dict):
    """Remembers what `make` gives for a word."""

    def __init__(self, make):
        super().__init__()
        self.make, self.passed = make, 0

    def of(self, word: str) -> bytes:
        ids = self.get(word)
        if ids is None:
            ids = self.make(word)
            if len(self) < REMEMBERED:
                if len(word) <= LONGEST:
                    self[word] = ids
            else:
                self.passed += 1
                if self.passed > 4 * REMEMBERED:
                    self.clear()
                    self.passed = 0
        return ids


def _byte_letters() -> list[str]:
    """The printable stand-ins of the 256 bytes in byte-level vocabularies: printable bytes stand for themselves,
    the others for the characters from 256 up, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    kept = set(own)
    return [chr(b) if b in kept else chr(next(rest)) for b in range(256)]


class Encoder:
    """Texts to the bytes of their ids and the end id, each an unsigned little-endian integer of `kind`."""

    def __init__(self, path: str, end: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = id_kind(path)
        self.end = np.array([end], self.kind).tobytes()
        layout = json.loads(self.tokenizer.to_str())
        pre, normal = layout["pre_tokenizer"] or {}, layout["normalizer"]
        self.bytewise = normal is None and pre.get("type") == "ByteLevel" and not pre["add_prefix_space"]
        self.wordwise = bool(normal) and [n["type"] for n in normal.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        self.letters = _byte_letters()
        self.blank, self.model, self.code = self.letters[32], self.tokenizer.model, "HI"[self.kind.itemsize == 4]
        self.inner, self.first, self.marks = _Known(self._inner), _Known(self._first), _Known(self._library)

    def _library(self, text: str) -> bytes:
        return self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def pack(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes() if sys.byteorder == "little" else np.array(ids, self.kind).tobytes()

    def _word(self, word: str, blank: str) -> bytes:
        if not (word.isascii() and word.isalpha()):
            plain = _PLAIN.fullmatch(word)
            if not plain:
                return self._library(blank + word)
            body, marks = plain.groups()
            if marks:
                return (self.inner if blank else self.first).of(body) + self.marks.of(marks)
        body = blank + word if self.bytewise else word.lower()
        model = body.replace(" ", self.blank) if body.isascii() else "".join([self.letters[b] for b in body.encode()])
        return self.pack([t.id for t in self.model.tokenize(model)])

    def _first(self, word: str) -> bytes:
        if not word or word[0].isspace() or word[-1].isspace():
            raise _Odd
        return self._word(word, "")

    def _inner(self, word: str) -> bytes:
        if word[:1] == "\n":
            return self.marks.of("\n") + self._first(word[1:])
        if not word or word[0].isspace() or word[-1].isspace():
            raise _Odd
        return self._word(word, " ")

    def encode(self, text: str | None) -> bytes:
        if not text:
            return self.end
        if "<|" not in text and (self.bytewise or self.wordwise):
            words = text.replace("\n", " \n").split(" ")
            try:
                words[0] = self.first.of(words[0])
                words[1:] = map(self.inner.get, islice(words, 1, None))
                if None in words:
                    raw = text.replace("\n", " \n").split(" ")
                    words = [self.inner.of(raw[i]) if ids is None else ids for i, ids in enumerate(words)]
                words.append(self.end)
                return b"".join(words)
            except _Odd:
                pass
        return self._library(text) + self.end


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, end: int) -> Encoder:
    """One encoder per task process, so that later tasks find the words of earlier ones."""
    if (path, end) not in _encoders:
        _encoders[path, end] = Encoder(path, end)
    return _encoders[path, end]


def id_kind(path: str) -> np.dtype:
    """Two bytes an id if the vocabulary allows."""
    from tokenizers import Tokenizer

    return np.dtype("<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4")


def vocabulary_path(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)
