"""Tokenizer files, and encoding by cached words.

The vocabularies split a text before merging, and no piece crosses from one run of non-space characters to the next (a
byte-level piece may begin with one plain space). So the ids of a text are the ids of its words one after another, and a
word is encoded only the first time a worker meets it. The cache is bounded; a word met after it is full is encoded anew.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Callable
from functools import lru_cache

# White space as the tokenizers' \s has it, and ASCII marks but the apostrophe, which may begin a piece.
SPACE = "\t-\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

_LITTLE = sys.byteorder == "little"
BYTE_CHUNK = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
WORD_CHUNK = re.compile(rf"[^{SPACE}]+")
_ENDS_IN_SPACE = re.compile(rf"[{SPACE}]\Z")
CACHE_ENTRIES, LONGEST = 400_000, 64


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Crossing(Exception):
    """A run of white space goes on past the plain space at which the text was split."""


class Words(dict):
    """word -> the value of that word with a plain space before it (byte-level), or of the word alone.

    encode gives the value of one chunk, letters that of a word of letters, which is one piece; total joins the values of
    neighbours. Words over LONGEST characters aren't kept, so the cache is bounded in bytes too.
    """

    def __init__(self, encode: Callable, letters: Callable, total: Callable, byte_level: bool, room: int = CACHE_ENTRIES):
        self.encode, self.letters, self.total, self.byte_level, self.room = encode, letters, total, byte_level, room
        self.bare: dict = {}

    def _bare(self, chunk: str):
        if not self.byte_level:
            return self[chunk]
        out = self.bare.get(chunk)
        if out is None:
            out = self.encode(chunk)
            if len(self.bare) < self.room // 4 and len(chunk) <= LONGEST:
                self.bare[chunk] = out
        return out

    def by_chunks(self, text: str):
        """The value of a text without a look at its split by plain spaces."""
        if not self.byte_level:
            return self.total(self[c] for c in WORD_CHUNK.findall(text))
        return self.total(self[c[1:]] if len(c) > 1 and c[0] == " " and not _ENDS_IN_SPACE.search(c) else self._bare(c) for c in BYTE_CHUNK.findall(text))

    def __missing__(self, word: str):
        keep = len(word) <= LONGEST and len(self) < self.room
        if word.isalpha():
            out = self.letters(word)
        elif not word:
            if self.byte_level:
                raise _Crossing
            return self.total(())
        else:
            core = word.rstrip(MARKS)
            if core and len(core) < len(word) and core[-1].isalpha():
                # closing marks are pieces of their own after a letter, so a word shares its entry with and without them
                keep = keep and core in self
                out = self[core] + self._bare(word[len(core) :])
            elif WORD_CHUNK.fullmatch(word):
                out = self.encode(" " + word if self.byte_level else word)
            else:
                if self.byte_level and _ENDS_IN_SPACE.search(word):
                    raise _Crossing
                keep = False
                left, _, right = word.partition("\n")
                if self.byte_level and left and WORD_CHUNK.fullmatch(left) and WORD_CHUNK.fullmatch(right):
                    return self[left] + self._bare("\n") + self._bare(right)  # a line break inside, the commonest case
                out = self.by_chunks(" " + word if self.byte_level else word)
        if keep:
            self[word] = out
        return out

    def values_of(self, text: str) -> list:
        """Values that add up to the text's."""
        first, *rest = text.split(" ")
        try:
            return [self.by_chunks(first), *map(self.__getitem__, rest)]
        except _Crossing:
            return [self.by_chunks(text)]


def byte_letters() -> list[str]:
    """The letter that stands for each byte in these vocabularies: itself where it prints, else the next one from 256."""
    prints = {*range(ord("!"), ord("~") + 1), *range(ord("\u00a1"), ord("\u00ac") + 1), *range(ord("\u00ae"), ord("\u00ff") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(spare)) for b in range(256)]


def _packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class TextEncoder:
    """Gives the ids that the library's encode(text, add_special_tokens=False) gives, as little-endian uint32."""

    def __init__(self, path: str, room: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = dict(enumerate(byte_letters()))
        byte_level = self.tokenizer.normalizer is None
        self.words = Words(self._chunk, self._letters if byte_level else self._chunk, b"".join, byte_level, room)

    def _library(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _letters(self, word: str) -> bytes:
        """The ids of a word of letters after a plain space."""
        piece = self.letters[32] + (word if word.isascii() else word.encode().decode("latin-1").translate(self.letters))
        return array("I", [t.id for t in self.tokenizer.model.tokenize(piece)]).tobytes() if _LITTLE else self._chunk(" " + word)

    def _chunk(self, chunk: str) -> bytes:
        """The ids of a chunk. A word of letters is one piece, which goes to the library's model as it stands."""
        word = chunk.lstrip(" ")
        if word.isalpha() and len(chunk) - len(word) < 2:
            if self.words.byte_level:
                piece = chunk if chunk.isascii() else chunk.encode().decode("latin-1")
                return _packed([t.id for t in self.tokenizer.model.tokenize(piece.translate(self.letters))])
            if max(word) < "\u0250":  # no character of these is composed with another
                piece = word.lower()
                piece = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
                return _packed([t.id for t in self.tokenizer.model.tokenize(piece)])
        return self._library(chunk)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.special):  # rare: the library looks for these strings before it splits
            return self._library(text)
        return b"".join(self.words.values_of(text))


@lru_cache(maxsize=2)
def text_encoder(path: str) -> TextEncoder:
    """One encoder for each worker and file."""
    return TextEncoder(path)


def forget_encoders() -> None:
    text_encoder.cache_clear()
