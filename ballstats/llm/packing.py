"""Packing documents into sequences of tokens by bounded-space online best fit.

A packer keeps a fixed number of open sequences. A bitset has a bit for each amount of free space that
an open sequence has; shifted by a piece's length, its lowest bit is the tightest place for the piece.
If nothing fits, a new sequence is opened, and the fullest is closed first if too many are open. Pieces
come in windows of ``WINDOW``, which are placed from the longest to the shortest.

Documents over the length are cut into full pieces, the first piece being what is left over; full
pieces fill sequences of their own. Only the lengths of pieces are shuffled, never text or ids, in an
order that a hash decides, so that long and short pieces mix. Each task packs what it reads, in
constant memory; a task lost and run again gives the same sequences.

Edge cases: a null or empty text is one piece that holds the end id only; repeated rows and ids are
pieces of their own; a null id stays null; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from itertools import count

import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballstats.llm import common, tokens

CAPACITY = 1024
END_ID = 2
OPEN = 4096
#: So many pieces are looked at together, the longest placed first.
WINDOW = 4096
# A task's sequences are numbered from its own number, shifted by so many bits.
_TASK_BITS = 40

_PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
)
_PACKED = pa.schema([*_PIECES, ("sequence_id", pa.int64()), ("offset", pa.int64())])


class BestFit:
    """Open sequences by free space."""

    def __init__(self, capacity: int, most_open: int):
        self.capacity, self.most_open = capacity, most_open
        self.free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits, self.n_open, self.numbers = 0, 0, count()

    def _take(self, space: int) -> int:
        self.n_open -= 1
        number = self.free[space].pop()
        if not self.free[space]:
            self.bits ^= 1 << space
        return number

    def _put(self, space: int, number: int) -> None:
        if space:
            self.n_open += 1
            self.free[space].append(number)
            self.bits |= 1 << space

    def place(self, length: int) -> tuple[int, int]:
        """The sequence and the offset of a piece."""
        fitting = self.bits >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            number = self._take(space)
        else:
            space, number = self.capacity, next(self.numbers)
        self._put(space - length, number)
        if self.n_open > self.most_open:
            self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest is closed
        return number, self.capacity - space


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """Per piece of a document: its number, the ids before it, its length and the checksum of its ids."""
    end = end_id.to_bytes(4, "little")

    def cut(ids: list, texts: list[str]) -> dict[str, list]:
        out: dict[str, list] = {name: [] for name in _PIECES.names}
        for doc_id, data in zip(ids, tokens.vocabulary(public_tokenizers.path(vocabulary)).encode(texts), strict=True):
            data += end
            n = len(data) // 4
            starts = [0, *range(n % capacity, n, capacity)] if n % capacity else list(range(0, n, capacity))
            for k, (start, stop) in enumerate(zip(starts, [*starts[1:], n], strict=True)):
                row = (doc_id, k, start, stop - start, zlib.crc32(data[4 * start : 4 * stop]))
                for name, value in zip(_PIECES.names, row, strict=True):
                    out[name].append(value)
        return out

    return common.id_and_text(docs).mapInArrow(common.in_slices(cut, _PIECES), common.ddl(_PIECES))


def pack(cut: DataFrame, capacity: int = CAPACITY, most_open: int = OPEN) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; ``cut`` has the columns of :func:`pieces`."""

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, base = BestFit(capacity, most_open), TaskContext.get().partitionId() << _TASK_BITS
        for batch in batches:
            for start in range(0, batch.num_rows, WINDOW):
                part = batch.slice(start, WINDOW)
                lengths = part.column("length").to_pylist()
                placed: list[tuple[int, int]] = [(0, 0)] * len(lengths)
                for k in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
                    placed[k] = fit.place(lengths[k])
                numbers = pa.array([base + number for number, _ in placed], pa.int64())
                offsets = pa.array([offset for _, offset in placed], pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns, numbers, offsets], schema=_PACKED)

    mixed = F.xxhash64("doc_id", "piece", "ids_crc32")
    dealt = cut.select(*_PIECES.names).repartition("doc_id", "piece", "ids_crc32")
    return dealt.sortWithinPartitions(mixed, "doc_id", "piece", "length").mapInArrow(place, common.ddl(_PACKED))


def packed(docs: DataFrame, capacity: int = CAPACITY, most_open: int = OPEN) -> DataFrame:
    return pack(pieces(docs, capacity), capacity, most_open)
