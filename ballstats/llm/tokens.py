"""Token ids of the public byte-level BPE vocabulary, one distinct chunk of text at a time.

The vocabulary's pre-tokenizer cuts a text into chunks (a word with its blank, a run of digits, ...)
that are encoded on their own. Chunks repeat, so each worker keeps what it has seen; the memory of
that is bounded by ``MOST_KEPT`` entries, after which it starts anew.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable
from functools import lru_cache
from itertools import filterfalse
from typing import TypeVar

from tokenizers import Tokenizer

VOCABULARY = "byte_bpe_50k.json"
MOST_KEPT = 1_000_000
V = TypeVar("V")

# Chunks of letters, of digits, of other signs, of white space, in texts of Latin letters, ASCII and
# typographic signs and common white space; the library itself cuts texts with any other character.
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
_UNUSUAL = re.compile(rf"[^\t\n\r\x20-\x7e\u2010-\u2027\u20a0-\u20bf{_LATIN}]")
_FAST = re.compile(
    rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LATIN}]+| ?[0-9]+| ?[^\t\n\r 0-9{_LATIN}]+|[\t\n\r ]+(?![^\t\n\r ])|[\t\n\r ]+"
)


def byte_signs() -> dict[int, str]:
    """The sign that stands for each byte in byte-level vocabularies: printable ones for themselves."""
    printable = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    rest = (b for b in range(256) if b not in printable)
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}


SIGNS = byte_signs()


class Kept(dict):
    """Values by chunk; those that are missing are computed together."""

    def __init__(self, compute: Callable[[list[str]], list[V]], most: int = MOST_KEPT):
        super().__init__()
        self.compute, self.most = compute, most

    def of(self, lists: list[list[str]]) -> list[list[V]]:
        every = set().union(*lists)
        missing = list(filterfalse(self.__contains__, every))
        if len(self) + len(missing) > self.most:
            self.clear()
            missing = list(every)
        self.update(zip(missing, self.compute(missing), strict=True))
        return [list(map(self.__getitem__, found)) for found in lists]


class Vocabulary:
    """The library's tokenizer, with its special strings cut out of texts as it does by default."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        with open(path, encoding="utf-8") as file:
            self.added = {x["content"]: x for x in json.load(file)["added_tokens"]}
        plain = all(not (x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"]) for x in self.added.values())
        if not plain:
            raise ValueError(f"{path}: special tokens that take their surroundings are not supported")
        longest_first = sorted(self.added, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.added else None
        self.model = self.tokenizer.model
        self.ids = Kept(self._encode)

    def chunks(self, text: str) -> list[str]:
        """The chunks in order; joined they give the text."""
        if _UNUSUAL.search(text):
            return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        return _FAST.findall(text)

    def pieces(self, text: str) -> list[str]:
        """The chunks of a text; a special string is a chunk of its own."""
        if self.special is None or not self.special.search(text):
            return self.chunks(text)
        out: list[str] = []
        for part in self.special.split(text):
            out += [part] if part in self.added else self.chunks(part)
        return out

    def _encode(self, pieces: list[str]) -> list[bytes]:
        out = []
        for piece in pieces:
            if piece in self.added:
                ids = [self.added[piece]["id"]]
            elif piece.isascii() and piece.isprintable():  # of these, only the blank has another sign
                ids = [token.id for token in self.model.tokenize(piece.replace(" ", SIGNS[32]))]
            else:
                ids = [token.id for token in self.model.tokenize(piece.encode().decode("latin-1").translate(SIGNS))]
            out.append(array("I", ids).tobytes())
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return [b"".join(x) for x in self.ids.of([self.pieces(text) for text in texts])]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """One of each per worker process."""
    return Vocabulary(path)
