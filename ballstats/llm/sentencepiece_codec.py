"""Encoding and decoding with a merge-type SentencePiece vocabulary.

Symbols next to each other that make a piece of the vocabulary are put on an agenda ordered by the
piece's score, then by place; the best pair is merged until the agenda is empty. What is no piece falls
back to its bytes. Texts are cut where no piece of the vocabulary can reach across, which is looked up
in the vocabulary itself, so each distinct chunk is encoded once per worker; chunks new to a worker are
checked against the library, all those of an Arrow batch's slice in one call, and a difference stops
the job.

Edge cases: a null or empty text has the begin and end ids only and decodes to nothing; the sign for
blanks (U+2581) in a text decodes to a blank, as the library does it; repeated rows stay.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from ballstats.llm import common, tokens

MODEL = "piece_bpe_32k.model"
BLANK = "▁"
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"


class Codec:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str, check: bool = True):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.check = check
        n = self.library.get_piece_size()
        names = [self.library.id_to_piece(i) for i in range(n)]
        special = [self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i) for i in range(n)]
        self.rank = {p: (-self.library.get_score(i), i) for i, p in enumerate(names) if not special[i]}
        byte_id = {int(names[i][3:5], 16): i for i in range(n) if self.library.is_byte(i)}
        self.of_byte = [byte_id[b] for b in range(256)]
        self.surface = [b"" if special[i] else p.replace(BLANK, " ").encode() for i, p in enumerate(names)]
        for b, i in byte_id.items():
            self.surface[i] = bytes([b])
        self.begin, self.end = (np.array([i], "<u4").tobytes() for i in (self.library.bos_id(), self.library.eos_id()))
        self.cut = self._cut()
        self.known = tokens.Kept(self._encode_new)

    def _cut(self) -> re.Pattern:
        """Chunks: blanks, then Latin letters or other signs. Only if no piece crosses such a border."""
        letters = re.compile(rf"{BLANK}*[{_LATIN}]+|{BLANK}*[^{BLANK}{_LATIN}]+|{BLANK}+")
        blanks = re.compile(rf"{BLANK}*[^{BLANK}]+|{BLANK}+")
        whole = re.compile("(?s).+")
        return next(x for x in (letters, blanks, whole) if all(x.fullmatch(p) and len(x.findall(p)) == 1 for p in self.rank))

    def merged(self, chunk: str) -> list[int]:
        """Ids of one chunk by the agenda."""
        symbols: list[str | None] = list(chunk)
        before, after = list(range(-1, len(symbols) - 1)), list(range(1, len(symbols) + 1))
        agenda: list[tuple[float, int, int, str]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right < len(symbols):
                both = symbols[left] + symbols[right]
                if found := self.rank.get(both):
                    heapq.heappush(agenda, (found[0], left, right, both))

        for left in range(len(symbols) - 1):
            offer(left, left + 1)
        while agenda:
            _, left, right, both = heapq.heappop(agenda)
            # Stale if either side has been merged since: then they differ in length or are gone.
            if symbols[left] is None or symbols[right] is None or symbols[left] + symbols[right] != both:
                continue
            symbols[left], symbols[right] = both, None
            after[left] = after[right]
            if after[left] < len(symbols):
                before[after[left]] = left
            offer(before[left], left)
            offer(left, after[left])
        ids: list[int] = []
        for symbol in filter(None, symbols):
            found = self.rank.get(symbol)
            ids += [found[1]] if found else [self.of_byte[b] for b in symbol.encode()]
        return ids

    def _encode_new(self, new: list[str]) -> list[tuple[bytes, bytes]]:
        ids = [self.merged(chunk) for chunk in new]
        if self.check:
            # The library puts a blank in front itself; every chunk here begins with one or follows one.
            plain = [k for k, chunk in enumerate(new) if chunk[0] == BLANK]
            theirs = self.library.encode([new[k][1:].replace(BLANK, " ") for k in plain], num_threads=1)
            for k, other in zip(plain, theirs, strict=True):
                if ids[k] != other and len(new[k]) > 1:
                    raise ValueError(f"{new[k]!r} is {ids[k]} here and {other} by the library")
        return [(np.array(x, "<u4").tobytes(), b"".join(map(self.surface.__getitem__, x))) for x in ids]

    def encode_decode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Per text: ids with begin and end as little-endian unsigned 32-bit integers; what they decode to."""
        spaced = [BLANK + text.replace(" ", BLANK) if text else "" for text in texts]
        out = []
        for found in self.known.of([self.cut.findall(text) for text in spaced]):
            ids = b"".join([self.begin, *(x[0] for x in found), self.end])
            decoded = b"".join([x[1] for x in found])
            out.append((ids, decoded[1:].decode(errors="replace")))  # without the blank put in front
        return out

    def decode(self, ids: list[int]) -> str:
        data = b"".join(map(self.surface.__getitem__, ids))
        return (data[1:] if data[:1] == b" " else data).decode(errors="replace")


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])
_DIGESTS = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
)


def encoded(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Per document: its ids (packed, with begin and end) and the text decoded from them."""

    def run(ids: list, texts: list[str]) -> dict[str, list]:
        both = codec(public_tokenizers.path(model)).encode_decode(texts)
        return {"doc_id": ids, "ids": [x[0] for x in both], "decoded": [x[1] for x in both]}

    return common.id_and_text(docs).mapInArrow(common.in_slices(run, _ENCODED), common.ddl(_ENCODED))


def digests(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Per document: number of ids, and SHA-256 of ids and of the decoded text, made where the ids are."""

    def run(ids: list, texts: list[str]) -> dict[str, list]:
        both = codec(public_tokenizers.path(model)).encode_decode(texts)
        return {
            "doc_id": ids,
            "n_tokens": [len(x[0]) // 4 for x in both],
            "ids_sha256": [hashlib.sha256(x[0]).hexdigest() for x in both],
            "decoded_sha256": [hashlib.sha256(x[1].encode()).hexdigest() for x in both],
        }

    return common.id_and_text(docs).mapInArrow(common.in_slices(run, _DIGESTS), common.ddl(_DIGESTS))
