"""Near-equal lines by a segment-partition edit join.

Two lines link if at most ``EDITS`` bytes have to be inserted, removed or replaced (UTF-8). A line is
split into ``EDITS`` + 1 segments of about equal length: one of them must be in the other line, at a
place that the lengths and the edits before and after it leave open. So each line is indexed by
(length, segment number, segment), and probes, for each length from its own down to ``EDITS`` less, the
few substrings at those places. Hashes of all substrings come from running sums over whole arrays.
Candidates are verified by a banded bit-parallel edit distance, many pairs at a time.

Lines stand for themselves by a 64-bit hash, so equal lines are one and copies are never paired; that no
two lines share one is checked by 64 bits more, and if some do, all is done again under another key. Text
is shuffled only for lines that have candidates. Most segments occur in one line only and meet no
probe; Bloom filters of fixed size (``BITS``) sort them out before the shuffle, and let some more through if
they fill up, never fewer. Within a block of equal segments, pairs are left out that differ in more
bytes, pairs of bytes or words than the edits can touch, as far as 64 parity bits of each tell.

Lines of under ``LEAST_BYTES`` bytes link with equal lines only. Edge cases: a null or empty text and
blank lines have no rows; a class is named by its first line in the order of (doc_id, line_no), null
ids last; repeated ids are one document with the same line numbers; extra columns are ignored.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterable, Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ballstats.llm import common
from ballstats.llm.components import components
from ballstats.llm.jaccard_join import bitmap, hits
from ballstats.llm.shingles import mixed, running_hash, words_of

EDITS = 2
LEAST_BYTES = 24
BITS = 1 << 27
#: Where in a key the bits begin that name its places in a filter.
_PLACES = (0, 12, 24, 36)
#: Bytes, pairs of bytes and words that one edit can change: a replaced byte is one gone and one new, and
#: so are its two pairs; a blank parts a word into two or joins two.
_PER_EDIT = {"p0": 2, "p1": 4, "p2": 3}
#: Pairs that are verified together, and the longest line, in bytes, that is verified with others. Longer ones
#: are compared by runs of equal bytes, with the same result.
_TOGETHER, LONG = 256, 4096

Batches = Iterable[pa.RecordBatch]


class Lines:
    """The lines of some texts that are not blank, as places in one array of bytes."""

    def __init__(self, texts: list[str], seed: int = 0):
        encoded = [text.encode() for text in texts]
        self.data = b"\n".join(encoded)
        raw = np.frombuffer(self.data, np.uint8)
        breaks = np.flatnonzero(raw == 10)
        starts, ends = np.concatenate([[0], breaks + 1]), np.concatenate([breaks, [len(raw)]])
        bounds = np.concatenate([[0], np.cumsum([len(x) + 1 for x in encoded])])
        self.owner = np.searchsorted(bounds, starts, side="right") - 1
        self.number = np.arange(len(starts)) - np.searchsorted(starts, bounds[:-1])[self.owner]
        self.hash_of = running_hash(raw)
        words, begin = words_of(self.data)
        n_words = np.searchsorted(begin, ends) - np.searchsorted(begin, starts)
        keep = n_words > 0
        self.start, self.end = starts[keep], ends[keep]
        self.owner, self.number = self.owner[keep], self.number[keep]
        self.size = self.end - self.start
        whole = zip(self.start.tolist(), self.end.tolist(), strict=True)
        digests = b"".join([xxhash.xxh3_128_digest(self.data[a:b], seed) for a, b in whole])
        self.key, self.check = np.frombuffer(digests, "<i8").reshape(-1, 2).T
        self.long = self.size >= LEAST_BYTES
        self._words, self._first = words, np.searchsorted(begin, self.start)
        self._last = np.searchsorted(begin, self.end)

    def parity(self) -> list[np.ndarray]:
        """64 bits each for a line's bytes, pairs of bytes and words: how often, modulo 2, one falls on each."""
        raw = np.frombuffer(self.data, np.uint8).astype(np.uint64)
        pairs = mixed(raw[:-1] * np.uint64(256) + raw[1:])
        places = [(raw, self.start, self.end), (pairs, self.start, self.end - 1), (self._words, self._first, self._last)]
        out = []
        for values, first, last in places:
            bits = np.uint64(1) << (values & np.uint64(63))
            sums = np.concatenate([np.zeros(1, np.uint64), np.bitwise_xor.accumulate(bits)])
            out.append((sums[last] ^ sums[first]).view(np.int64))
        return out

    def _substring(self, segment: int, of_size: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        marks = of_size.astype(np.uint64) * np.uint64(0xA24BAED4963EE407) + np.uint64(segment * 0x9FB21C651E98DF25 % 2**64)
        return mixed(self.hash_of(start, end) + marks).view(np.int64)

    def index(self) -> np.ndarray:
        """Index keys of the long lines: (line, segment)."""
        start, size = self.start[self.long], self.size[self.long]
        cut = [size * k // (EDITS + 1) for k in range(EDITS + 2)]
        return np.stack([self._substring(k, size, start + cut[k], start + cut[k + 1]) for k in range(EDITS + 1)], axis=1)

    def probes(self) -> np.ndarray:
        """Keys under which a line of the same or less length would be found, but for its own: (line, probe)."""
        start, size = self.start[self.long], self.size[self.long]
        out = []
        for less in range(EDITS + 1):
            other = size - less
            cut = [other * k // (EDITS + 1) for k in range(EDITS + 2)]
            for k in range(EDITS + 1):
                # Before the segment at most k edits, after it at most EDITS - k, which shift by `less` in all.
                for shift in range(max(-k, less - (EDITS - k)), min(k, less + EDITS - k) + 1):
                    if less or shift:
                        at = start + cut[k] + shift
                        out.append(self._substring(k, other, at, at + cut[k + 1] - cut[k]))
        return np.stack(out, axis=1)


def within(pairs: list[tuple[bytes, bytes]], edits: int = EDITS) -> np.ndarray:
    """Whether the two of each pair are at most ``edits`` apart: the band of 2 * edits + 1 diagonals is
    one number per pair, whose bits are the vertical differences, one column at a time for all pairs."""
    n = len(pairs)
    if not n:
        return np.zeros(0, bool)
    size_x, size_y = (np.array([len(pair[k]) for pair in pairs]) for k in (0, 1))
    width = int(max(size_x.max(), size_y.max())) + 1
    x, y = (np.zeros((n, width + 2 * edits + 2), np.int16) for _ in range(2))
    x -= 1
    for k, (a, b) in enumerate(pairs):
        x[k, edits : edits + len(a)] = np.frombuffer(a, np.uint8)
        y[k, : len(b)] = np.frombuffer(b, np.uint8)
    one, full, top = np.uint64(1), np.uint64((1 << (2 * edits + 1)) - 1), np.uint64(2 * edits)
    vp = np.full(n, ((1 << (edits + 1)) - 1) << edits, np.uint64)
    vn = np.zeros(n, np.uint64)
    distance = np.full(n, edits)
    columns_x, columns_y = np.ascontiguousarray(x.T), np.ascontiguousarray(y.T)
    for j in range(int(size_y.max())):
        # Bit b of a column stands for row j + 1 - edits + b.
        match = np.zeros(n, np.uint64)
        for b in range(2 * edits + 1):
            match |= (columns_x[j + b] == columns_y[j]).astype(np.uint64) << np.uint64(b)
        d0 = ((((match & vp) + vp) ^ vp) | match | vn) & full
        hp = (vn | ~(d0 | vp)) & full
        hn = d0 & vp
        # Down the lowest diagonal until the last row, then along that row.
        left = size_x - (j + 1) - edits
        live = j < size_y
        row = np.clip(left + 2 * edits, 0, 63).astype(np.uint64)
        down = (live & (left >= 0)) & (((d0 >> top) & one) == 0)
        along = live & (left < 0)
        distance += down
        distance += along * (((hp >> row) & one).astype(int) - ((hn >> row) & one).astype(int))
        moved = d0 >> one
        vn, vp = moved & hp, (hn | ~(moved | hp)) & full
    return (np.abs(size_x - size_y) <= edits) & (distance <= edits)


def _common(x: bytes, y: bytes, at_x: int, at_y: int) -> int:
    """How many bytes from these places on are the same."""
    low, high = 0, min(len(x) - at_x, len(y) - at_y)
    while low < high:
        middle = (low + high + 1) // 2
        if x[at_x + low : at_x + middle] == y[at_y + low : at_y + middle]:
            low = middle
        else:
            high = middle - 1
    return low


def within_long(x: bytes, y: bytes, edits: int = EDITS) -> bool:
    """:func:`within` for one pair: how far each diagonal gets with 0, 1, ... edits, equal runs being compared whole."""
    reached = {0: _common(x, y, 0, 0)}
    for spent in range(edits + 1):
        if reached.get(len(x) - len(y), -1) >= len(x):
            return True
        further = {}
        for diagonal in range(-spent - 1, spent + 2):
            steps = (reached.get(diagonal, -2) + 1, reached.get(diagonal - 1, -2) + 1, reached.get(diagonal + 1, -2))
            at = min(max(steps), len(x), len(y) + diagonal)
            if at >= max(0, diagonal):
                further[diagonal] = at + _common(x, y, at, at - diagonal)
        reached = further
    return False


def verified(pairs: list[tuple[bytes, bytes]], edits: int = EDITS) -> np.ndarray:
    """Whether the two of each pair are within the edits, in groups of a bounded number of bytes."""
    fit = np.zeros(len(pairs), bool)
    # Pairs of like length go together, so that short ones do not wait for long ones.
    size = [max(map(len, pair)) for pair in pairs]
    order = sorted(range(len(pairs)), key=size.__getitem__)
    # The band needs lines that are longer than it is wide.
    banded = lambda k: size[k] <= LONG and min(map(len, pairs[k])) > 2 * edits
    short = [k for k in order if banded(k)]
    for k in order:
        if not banded(k):
            fit[k] = within_long(*pairs[k], edits)
    for k in range(0, len(short), _TOGETHER):
        some = short[k : k + _TOGETHER]
        fit[some] = within([pairs[i] for i in some], edits)
    return fit


def _sliced(batches: Batches, seed: int) -> Iterator[tuple[list, Lines]]:
    for part in common.parts(batches):
        yield part.column("doc_id").to_pylist(), Lines(part.column("text").to_pylist(), seed)


def _all_lines(batches: Batches, seed: int) -> Iterator[pa.RecordBatch]:
    for ids, lines in _sliced(batches, seed):
        keys = np.zeros((len(lines.key), EDITS + 1), np.int64)
        keys[lines.long] = lines.index()
        ends = np.concatenate([[0], np.cumsum(np.where(lines.long, EDITS + 1, 0))])
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()).take(pa.array(lines.owner)), pa.array(lines.number, pa.int32())]
            + [pa.array(np.ascontiguousarray(x)) for x in (lines.key, lines.check)]
            + [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys[lines.long].ravel()))],
            ["doc_id", "line_no", "h", "check", "keys"],
        )


def _alike() -> Column:
    """Whether two lines may be within the edits (necessary, not sufficient)."""
    return reduce(and_, (F.bit_count(F.col(f"l.{c}").bitwiseXOR(F.col(f"r.{c}"))) <= n * EDITS for c, n in _PER_EDIT.items()))


def places_for(n: int, bits: int = BITS) -> tuple[int, ...]:
    """As many places as let the fewest of other keys through when ``n`` keys are in a filter."""
    return _PLACES[: max(1, min(len(_PLACES), int(0.7 * bits / max(n, 1))))]


def bloom(keys: DataFrame, places: tuple[int, ...], bits: int = BITS) -> np.ndarray:
    """A filter of the column ``key``, at these places."""
    named = F.explode(F.array(*[F.shiftrightunsigned("key", k) for k in places])).alias("key")
    return bitmap(keys.select(named), "key", bits)


def met(keys: np.ndarray, known: np.ndarray, places: tuple[int, ...]) -> tuple[np.ndarray, ...]:
    """Where ``keys`` may be in the filter, as ``np.nonzero`` gives it."""
    at = np.nonzero(hits(keys.view(np.uint64), known))
    for k in places[1:]:
        found = hits(keys[at].view(np.uint64) >> np.uint64(k), known)
        at = tuple(x[found] for x in at)
    return at


def candidates(texts: DataFrame, lines: DataFrame, seed: int) -> DataFrame:
    """Pairs of line hashes (``a`` < ``b``) that share a segment where they can."""
    share = texts.sparkSession.sparkContext.broadcast
    keyed = lines.select(F.explode("keys").alias("key"), "h").groupBy("key").agg(F.min("h").alias("lo"), F.max("h").alias("hi"))
    keyed = common.stored(keyed, "line-keys")
    places = places_for(keyed.count())
    every, several = share(bloom(keyed, places)), share(bloom(keyed.where("lo <> hi"), places))

    def meeting(batches: Batches) -> Iterator[pa.RecordBatch]:
        """Index keys that several lines have, and probes that meet an index key."""
        for _, found in _sliced(batches, seed):
            parity = [p[found.long] for p in found.parity()]
            h = found.key[found.long]
            for probe, keys, known in ((False, found.index(), several.value), (True, found.probes(), every.value)):
                at, which = met(keys, known, places)
                arrays = [keys[at, which], h[at], *(p[at] for p in parity), np.full(len(at), probe)]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, arrays)), ["key", "h", *_PER_EDIT, "probe"])

    rows = texts.mapInArrow(meeting, "key long, h long, p0 long, p1 long, p2 long, probe boolean").distinct()
    rows = common.stored(rows, "line-rows")
    every.destroy()
    several.destroy()
    index, probes = rows.where("not probe"), rows.where("probe")
    pair = lambda x, y: [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]
    # A key of one line is met by the line that the key table names; one of several by its index rows.
    single = probes.join(keyed.where("lo = hi"), "key").where("h <> lo").select(*pair("h", "lo"))
    same = (F.col("l.key") == F.col("r.key")) & _alike()
    within_index = index.alias("l").join(index.alias("r"), same & (F.col("l.h") < F.col("r.h"))).select(*pair("l.h", "r.h"))
    across = probes.alias("l").join(index.alias("r"), same & (F.col("l.h") != F.col("r.h"))).select(*pair("l.h", "r.h"))
    pairs = common.stored(single.union(within_index).union(across).distinct(), "line-candidates")
    common.dropped(keyed, rows)
    return pairs


def links(texts: DataFrame, lines: DataFrame, seed: int) -> DataFrame:
    """Pairs of line hashes (``a`` < ``b``) of lines within the edits; equal lines are one hash."""
    pairs = candidates(texts, lines, seed)
    ends = pairs.select(F.col("a").alias("h")).union(pairs.select("b"))
    wanted = texts.sparkSession.sparkContext.broadcast(bitmap(ends, "h"))

    def contents(batches: Batches) -> Iterator[pa.RecordBatch]:
        for _, found in _sliced(batches, seed):
            at = np.flatnonzero(hits(found.key.view(np.uint64), wanted.value) & found.long)
            text = [found.data[found.start[k] : found.end[k]] for k in at]
            yield pa.RecordBatch.from_arrays([pa.array(found.key[at]), pa.array(text, pa.binary())], ["h", "line"])

    known = common.stored(texts.mapInArrow(contents, "h long, line binary").dropDuplicates(["h"]), "line-contents")
    wanted.destroy()
    left = known.select(F.col("h").alias("a"), F.col("line").alias("x"))
    right = known.select(F.col("h").alias("b"), F.col("line").alias("y"))

    def verify(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.parts([batch], "y"):
                both = list(zip(part.column("x").to_pylist(), part.column("y").to_pylist(), strict=True))
                yield part.filter(pa.array(verified(both))).select(["a", "b"])

    verified_pairs = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(verify, "a long, b long")
    found = common.stored(verified_pairs, "line-links")
    common.dropped(pairs, known)
    return found


def classed(docs: DataFrame) -> DataFrame:
    """Per line that is not blank: its class, named by the first line of it (``first_doc``, ``first_line``),
    how many different lines link with it (``n_links``), its bytes, and whether it is that first line."""
    texts = common.id_and_text(docs)
    schema = "doc_id long, line_no int, h long, check long, keys array<long>"
    while True:
        seed = secrets.randbits(63)
        lines = common.stored(texts.mapInArrow(lambda batches, seed=seed: _all_lines(batches, seed), schema), "lines")
        checks = lines.groupBy("h").agg(F.min("check").alias("low"), F.max("check").alias("high"))
        if not checks.where("low <> high").limit(1).count():
            break
    found = links(texts, lines, seed)
    ends = found.select(F.col("a").alias("h")).union(found.select("b"))
    known = components(found).withColumnRenamed("node", "h").join(ends.groupBy("h").agg(F.count("*").alias("n_links")), "h")
    named = lines.select("doc_id", "line_no", "h", (F.size("keys") > 0).alias("long")).join(known, "h", "left")
    named = named.withColumn("label", F.coalesce("label", "h"))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "line_no")
    first = named.groupBy("label").agg(F.min(place).alias("first"))
    return named.join(first, "label").select(
        "doc_id",
        "line_no",
        F.col("first.doc_id").alias("first_doc"),
        F.col("first.line_no").alias("first_line"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("line_no") == F.col("first.line_no"))).alias("is_first"),
        "long",
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` without long lines that are near-equal to an earlier one, and without texts that then are blank.

    ``n_chars``, if there is such a column, is that of the text that is left. Other columns stay.
    """
    repeated = classed(docs).where("long and not is_first").where(F.col("doc_id").isNotNull())
    gone = repeated.groupBy("doc_id").agg(F.collect_set("line_no").alias("_gone"))  # a document's lines at most
    both = docs.join(gone, docs["doc_id"] == gone["doc_id"], "left").drop(gone["doc_id"])
    kept = F.filter(F.split("text", "\n", -1), lambda _, k: ~F.array_contains("_gone", k))
    left = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    out = both.withColumn("text", left).where(F.col("_gone").isNull() | (F.trim("text") != ""))
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col("_gone").isNull(), F.col("n_chars")).otherwise(F.length("text"))
        out = out.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)
