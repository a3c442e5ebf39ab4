"""Exact token counts at every prefix of a text, by dynamic programming over the merge list.

For each prefix of a chunk the table keeps the last token of its encoding. A token may follow another
if the two, encoded together, come out as these two; exactly one last token fits at each place, so the
count at a place is one more than the count where that token starts. Counts of whole chunks add up, so
that a text's counts at all places, how much of it a budget holds, and its total come from one table.

Edge cases: a null text is empty and has 0 tokens; a special string of the vocabulary is one token, a
cut inside it counts as ordinary text; rows are independent, so repeated rows and ids stay; a null id
stays null.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from functools import cached_property, lru_cache
from itertools import accumulate

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ballstats.llm import common, tokens

# A chunk of one kind of sign only: what is left of it by a cut after its first sign is one chunk as well.
_RUN = regex.compile(r" ?(?:\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+)")
MOST_PAIRS = 400_000
LIMIT = 512


class PrefixCounts:
    """Counts of chunks and texts for one vocabulary file."""

    def __init__(self, path: str):
        self.split = tokens.vocabulary(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        sign = {sign: byte for byte, sign in tokens.SIGNS.items()}
        read = lambda piece: bytes(sign[c] for c in piece)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(read(left), read(right)): k for k, (left, right) in enumerate(merges)}
        self.halves: dict[bytes, tuple[bytes, bytes]] = {}
        for left, right in self.rank:
            self.halves.setdefault(left + right, (left, right))
        found = {read(piece) for piece in model["vocab"] if all(c in sign for c in piece)}
        self.longest = max(map(len, found))
        self.whole = {token for token in found if len(token) == 1 or token in self.halves}
        self.edges: dict[tuple[bytes, int], list[tuple[bytes, int, float]]] = {}
        self.after: dict[bytes, dict[bytes, bool]] = {b"": {}}
        self.n_pairs = 0
        self.tables = tokens.Kept(lambda missing: [self.table(x) for x in missing])

    def merged(self, data: bytes) -> list[bytes]:
        """The encoding of a few bytes: the first pair in the merge list goes first, from the left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = min((self.rank.get(pair, len(self.rank)), i) for i, pair in enumerate(zip(parts, parts[1:])))
            if best == len(self.rank):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def edge(self, token: bytes, side: int) -> list[tuple[bytes, int, float]]:
        """What stands at the token's left (0) or right (1) edge while it is merged: the part, the rank
        of the merge that makes it, and the rank of the one that it goes into."""
        found = self.edges.get((token, side))
        if found is None:
            found, part, until = [], token, float("inf")
            while part:
                halves = self.halves.get(part)
                made = self.rank[halves] if halves else -1
                found.append((part, made, until))
                part, until = (halves[side], made) if halves else (b"", until)
            self.edges[token, side] = found
        return found

    def follows(self, left: bytes, right: bytes) -> bool:
        """Whether the two, encoded together, stay as they are: no merge across the border comes before
        those that take its two sides away (of equal merges the left one comes first)."""
        if not left:
            return self.merged(right) == [right]
        for x, made_x, until_x in self.edge(left, 1):
            for y, made_y, until_y in self.edge(right, 0):
                rank = self.rank.get((x, y))
                if rank is not None:
                    at = max(rank, made_x, made_y)
                    if at < until_x and at <= until_y:
                        return False
        return True

    def table(self, chunk: str) -> bytes | tuple[int, ...]:
        """Tokens of each prefix of the chunk, in code points: entry k is for its first k."""
        if chunk in self.split.added:
            return (*range(len(chunk)), 1)
        data = chunk.encode()
        size = len(data)
        if self.n_pairs > MOST_PAIRS:
            self.after, self.n_pairs = {b"": {}}, 0
        whole, after, longest = self.whole, self.after, self.longest
        rows, count = [after[b""]], [0]
        last = [b""]
        for end in range(1, size + 1):
            for start in range(max(0, end - longest), end):
                token = data[start:end]
                if token in whole:
                    row = rows[start]
                    fits = row.get(token)
                    if fits is None:
                        fits = row[token] = self.follows(last[start], token)
                        self.n_pairs += 1
                    if fits:
                        last.append(token)
                        count.append(count[start] + 1)
                        rows.append(after.setdefault(token, {}))
                        break
            else:
                raise ValueError(f"no token of the vocabulary ends at byte {end} of {chunk!r}")
        if size != len(chunk):
            count = [count[end] for end in accumulate((len(c.encode()) for c in chunk), initial=0)]
        return bytes(count) if count[-1] < 250 and max(count) < 256 else tuple(count)

    def looked_up(self, texts: list[str]) -> list[Prefixes]:
        """The stored counts of several texts."""
        pieces = [self.split.pieces(text) for text in texts]
        return [Prefixes(self, *own) for own in zip(texts, pieces, self.tables.of(pieces), strict=True)]

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of whole texts."""
        return [found.total() for found in self.looked_up(texts)]

    def indexed(self, text: str) -> Prefixes:
        return self.looked_up([text])[0]


class Prefixes:
    """The stored counts of one text."""

    def __init__(self, counts: PrefixCounts, text: str, pieces: list[str], tables: list):
        self.own, self.text, self.pieces, self.tables = counts, text, pieces, tables
        self.runs: dict[int, bool] = {}

    def total(self) -> int:
        return sum([table[-1] for table in self.tables])

    @cached_property
    def starts(self) -> list[int]:
        """Where each chunk begins, and the end of the text."""
        return [0, *accumulate(map(len, self.pieces))]

    @cached_property
    def before(self) -> list[int]:
        """Tokens before each chunk, and of the whole text."""
        return [0, *accumulate(table[-1] for table in self.tables)]

    def at(self, length: int) -> int:
        """Tokens of the first ``length`` code points.

        Inside a run of letters, digits or other signs the table has it. Elsewhere a cut changes how the
        chunk that it falls in is cut, and white space just before it, which is two chunks at most; so
        those chunks are looked up again from two before on.
        """
        if not 0 <= length <= len(self.text):
            raise ValueError(f"the text has {len(self.text)} code points")
        if length == len(self.text):
            return self.before[-1]
        inside = bisect_right(self.starts, length) - 1
        if length - self.starts[inside] >= 2 and self.is_run(inside):
            return self.before[inside] + self.tables[inside][length - self.starts[inside]]
        k = max(0, inside - 2)
        tail = self.own.split.pieces(self.text[self.starts[k] : length])
        return self.before[k] + sum(t[-1] for t in self.own.tables.of([tail])[0])

    def is_run(self, chunk: int) -> bool:
        """Whether the chunk keeps its beginning wherever it is cut."""
        if chunk not in self.runs:
            piece = self.pieces[chunk]
            self.runs[chunk] = piece not in self.own.split.added and _RUN.fullmatch(piece) is not None
        return self.runs[chunk]

    def every(self) -> list[int]:
        """Tokens at every prefix, the empty one first."""
        return [self.at(length) for length in range(len(self.text) + 1)]

    def fits(self, budget: int) -> int:
        """Code points of the longest prefix with at most ``budget`` tokens.

        A cut may give fewer tokens than one before it, so places are tried from the last possible one
        down; those inside a run cost a look at the table each.
        """
        n = 0
        for k, table in enumerate(self.tables):
            n += table[-1]
            if n > budget:  # the chunks after the next one cannot matter
                near = Prefixes(self.own, self.text, self.pieces[: k + 3], self.tables[: k + 3])
                return next(at for at in range(near.starts[min(k + 2, len(near.pieces))], -1, -1) if near.at(at) <= budget)
        return len(self.text)


@lru_cache(maxsize=4)
def prefix_counts(path: str) -> PrefixCounts:
    return PrefixCounts(path)


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())]
    + [("fits_chars", pa.int64())]
)


def token_counts(docs: DataFrame, limit: int = LIMIT, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """Per document: bytes, tokens, whether it is over ``limit``, and how many code points a limit holds."""

    def count(ids: list, texts: list[str]) -> dict[str, list]:
        own = prefix_counts(public_tokenizers.path(vocabulary))
        found = own.looked_up(texts)
        n = [x.total() for x in found]
        return {
            "doc_id": ids,
            "n_bytes": [len(text.encode()) for text in texts],
            "n_tokens": n,
            "over_limit": [x > limit for x in n],
            "fits_chars": [x.fits(limit) for x in found],
        }

    return common.id_and_text(docs).mapInArrow(common.in_slices(count, _SCHEMA), common.ddl(_SCHEMA))
