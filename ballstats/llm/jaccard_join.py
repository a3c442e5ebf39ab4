"""Exact Jaccard join of word-shingle sets by pivots in the metric space of Jaccard distance.

Distance is 1 - intersection / union. Unrelated texts share no shingle and lie at distance 1 from each
other and from any pivot, where the triangle inequality tells nothing; so pivots are taken inside
blocks. A set's signature are its rarest shingles, so many that two sets within the radius must share
one; a block holds the sets that share a signature shingle, and a set falls into as many blocks.

Each block has a pivot, with which all its sets are compared. Sets within the radius ``r`` of the pivot are its region and are linked through it. For a set
beyond, at distance d > r, the triangle inequality leaves as partners only sets of the region from d - r
on: these boundary sets are replicated into the rest, which is joined again by itself, with new pivots,
four times as many at each level, taken from sets that no pivot has reached, until few are left. Pairs
that these windows exclude, or that are in one component already, are never compared. So a block of n
near copies costs about n comparisons, and every pair within the radius is linked, directly or through
its pivots.

Pairs are compared in two steps. Counts of a set's shingles in cells of the hash space are compared
first: the sum of their minima over the sum of their maxima is no less than the Jaccard index, so that
their distance is a lower bound. Only where it is within the radius are whole sets fetched. A large set has
more cells, as unrelated sets look alike once each cell holds many shingles; of two sets, the finer cells are
added up to the coarser ones.

Two sets whose first common shingle, in the order of signatures, stands at places i and j share at most
what follows: min(n - i, m - j) shingles. Pairs of a block for which that is too few are left out; they
meet at their first common shingle if they are within the radius. That keeps texts apart that share one
frequent passage and little else.

Components are kept up to date as links are found, level by level, so that near copies which many
blocks hold are compared in one of them.

What reaches the driver or all tasks is of fixed size: the ``FREQUENT`` most frequent shingles, which
only order signatures, and bitmaps of ``BITS`` bits, which only leave out what cannot matter. Equal
sets have one 64-bit hash, which stands for them throughout; that no two sets share one is checked by
64 bits more, and if some do, all is done again under another key.

Edge cases: a null text, or one without words, has an empty set and is alone in its component; equal
sets are linked; fewer words than a shingle make one shingle; a null id keeps its row, and the component
is named by the smallest id that is not null; repeated rows stay.
"""

from __future__ import annotations

import secrets
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ballstats.llm import common, shingles
from ballstats.llm.components import components

#: Two sets link if PER * intersection >= LEAST * union.
LEAST, PER = 75, 100
FREQUENT = 1 << 17
BITS = 1 << 27
#: Blocks of up to so many sets are joined by all pairs that pivots leave.
FEW = 24
#: Cells of a set: so many that two of its shingles or fewer fall into one, within these bounds.
CELLS, MOST_CELLS = 256, 4096
#: New pivots of a larger block at its first further level; four times as many at each one after.
PIVOTS = 16
#: Texts whose shingles are counted together before what is rare among them is left out.
_COUNTED, _COUNTED_SHINGLES, _RARE = 2000, 1 << 20, 3

Batches = Iterable[pa.RecordBatch]


def _sets(batches: Batches, seed: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Ids and sets, a few documents at a time."""
    for part in common.parts(batches):
        yield part.column("doc_id").to_pylist(), shingles.shingle_sets(part.column("text").to_pylist(), seed=seed)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)])
    values = np.concatenate([*arrays, np.zeros(0, np.uint64)]).astype(np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.view(np.int64)))


def frequent(texts: DataFrame, seed: int, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles and how frequent they are, sorted by shingle.

    Shingles that are rare among the texts counted together do not add to the sum.
    """

    def count(batches: Batches) -> Iterator[pa.RecordBatch]:
        def counted(some: list[np.ndarray]) -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(some), return_counts=True)
            keep = n >= _RARE
            return pa.RecordBatch.from_arrays([pa.array(values[keep].view(np.int64)), pa.array(n[keep])], ["s", "n"])

        some: list[np.ndarray] = []
        held = 0
        for _, found in _sets(batches, seed):
            some += found
            held += sum(map(len, found))
            if len(some) >= _COUNTED or held >= _COUNTED_SHINGLES:
                yield counted(some)
                some, held = [], 0
        if some:
            yield counted(some)

    top = texts.mapInArrow(count, "s long, n long").groupBy("s").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "s").limit(most).toArrow()
    values, n = top.column("s").to_numpy().view(np.uint64), top.column("n").to_numpy()
    order = np.argsort(values)
    return values[order], n[order]


def signature(items: np.ndarray, often: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The rarest shingles of a set, so many that two sets within the radius share one."""
    size = len(items)
    if not size:
        return items
    n = size + (-size * LEAST // PER) + 1  # size - ceil(size * LEAST / PER) + 1
    values, counts = often
    if not len(values):
        return items[:n]
    at = np.minimum(np.searchsorted(values, items), len(values) - 1)
    count = np.where(values[at] == items, counts[at], 0)
    return items[np.lexsort((items, count))[:n]]


def bitmap(values: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """Which of the numbers' last bits occur, as a bitmap of fixed size."""
    low = F.col(column).bitwiseAND(bits - 1)
    words = values.select(F.shiftright(low, 6).cast("int").alias("w"), F.expr(f"shiftleft(1L, cast({column} & 63 as int))").alias("bit"))
    found = words.groupBy("w").agg(F.bit_or("bit").alias("bits")).toArrow()  # bits / 64 rows at most
    out = np.zeros(bits // 64, np.uint64)
    out[found.column("w").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def hits(values: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    low = values & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1) == 1


_MOST = 255
_SLACK = 1e-9
RADIUS = 1 - LEAST / PER


def cells_of(items: np.ndarray) -> bytes:
    """How many of a set's shingles fall into each cell, as bytes; their number is a power of two."""
    n = CELLS
    while n < MOST_CELLS and 2 * n < len(items):
        n *= 2
    shift = np.uint64(65 - n.bit_length())
    counts = np.bincount((items >> shift).astype(np.int64), minlength=n)
    return np.minimum(counts, _MOST).astype(np.uint8).tobytes()


def cell_distance(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Lower bounds of the distances of sets, by their cells; 0 where a count is too large to be told."""
    out = np.zeros(len(left))
    of_size: dict[tuple[int, int], list[int]] = {}
    for k, sizes in enumerate(zip(map(len, left), map(len, right), strict=True)):
        of_size.setdefault(sizes, []).append(k)
    for sizes, at in of_size.items():
        x, y = (np.frombuffer(b"".join([part[k] for k in at]), np.uint8).reshape(len(at), min(sizes), -1) for part in (left, right))
        told = np.maximum(x.max((1, 2)), y.max((1, 2))) < _MOST
        x, y = x.sum(2, dtype=np.int32), y.sum(2, dtype=np.int32)
        low = 1 - np.minimum(x, y).sum(1) / np.maximum(np.maximum(x, y).sum(1), 1)
        out[at] = np.where(told, low, 0.0)
    return out


def _pair(left: Column, right: Column, left_size: Column, right_size: Column) -> list[Column]:
    """The smaller hash as ``g``, the larger as ``p``, and the least distance that the sizes allow."""
    ratio = F.least(left_size, right_size) / F.greatest(left_size, right_size)
    return [F.least(left, right).alias("g"), F.greatest(left, right).alias("p"), (1.0 - ratio).alias("d")]


def _can_share_enough(n: str, at: str, m: str, at_other: str) -> Column:
    """Whether two sets may be within the radius if a shingle at these places is the first that they share."""
    return F.least(F.col(n) - F.col(at), F.col(m) - F.col(at_other)) * (LEAST + PER) >= (F.col(n) + F.col(m)) * LEAST


def _bounded(pairs: DataFrame, cells: DataFrame) -> DataFrame:
    """Pairs with a better lower bound ``d`` of their distance, where the sizes' bound is within the radius."""

    def bound(batches: Batches) -> Iterator[pa.RecordBatch]:
        for part in common.parts(batches, "x"):
            d = cell_distance(part.column("x").to_pylist(), part.column("y").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("g"), part.column("p"), pa.array(d)], ["g", "p", "d"])

    left, right = cells.select("g", F.col("cells").alias("x")), cells.select(F.col("g").alias("p"), F.col("cells").alias("y"))
    within = F.col("d") <= RADIUS + _SLACK
    both = pairs.where(within).select("g", "p").join(left, "g").join(right, "p").select("g", "p", "x", "y")
    return both.mapInArrow(bound, "g long, p long, d double").unionByName(pairs.where(~within))


def _exact(bounded: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """The pairs of ``bounded`` within the radius, with their exact distance and whether they are ``linked``.

    Both sets of a pair meet under the pair's own key, so that a frequent pivot is not one task's.
    """
    pairs = common.stored(bounded.where(F.col("d") <= RADIUS + _SLACK).select("g", "p"), f"jaccard-{name}-pairs")
    left = pairs.join(sets, "g").select("g", "p", F.col("items").alias("own"))
    right = pairs.join(sets.select(F.col("g").alias("p"), F.col("items").alias("other")), "p").select("g", "p", "other")
    both, shared = left.join(right, ["g", "p"]), F.size(F.array_intersect("own", "other"))
    sizes = both.select("g", "p", shared.alias("shared"), (F.size("own") + F.size("other")).alias("both"))
    union = F.col("both") - F.col("shared")
    compared = sizes.select("g", "p", (1.0 - F.col("shared") / union).alias("d"), (F.col("shared") * PER >= union * LEAST).alias("linked"))
    compared = common.stored(compared, f"jaccard-{name}")
    common.dropped(pairs)
    return compared


def _none_left(df: DataFrame) -> bool:
    return df.limit(1).count() == 0


def _apart(pairs: DataFrame, labels: DataFrame, left: str = "g", right: str = "p") -> DataFrame:
    """``pairs`` with ``one``: whether links found so far connect the two sets, and ``label``, the component of the right one."""
    for column in (left, right):
        named = labels.select(F.col("node").alias(column), F.col("label").alias(f"_{column}"))
        pairs = pairs.join(named, column, "left")
    label = F.coalesce(f"_{right}", right)
    return pairs.withColumn("one", F.coalesce(f"_{left}", left) == label).withColumn("label", label).drop(f"_{left}", f"_{right}")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select("g").union(pairs.select("p")).distinct()


def links(blocks: DataFrame, cells: DataFrame, sets_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Components of the sets that links connect: ``node`` and ``label``, for every set with a link.

    ``blocks`` has rows (``b``, ``g``, ``n``, ``at``, ``m``, ``p``, ``np``): block, set, its size and the
    place of the block's shingle in it, and of the block its number of sets, its pivot, which is its smallest
    set, and that one's size; ``sets_of`` makes the table of whole sets (``g``, ``items``) for given ones.
    """
    col = F.col
    starred = blocks.where("g <> p")
    with_pivot = _pair(col("g"), col("p"), col("n"), col("np"))
    pivoted = common.stored(_bounded(starred.select(*with_pivot).distinct(), cells), "jaccard-pivoted")
    low_high = [x.alias(name) for x, name in zip(with_pivot[:2], ("low", "high"), strict=True)]
    bounds = pivoted.select(col("g").alias("low"), col("p").alias("high"), "d")
    placed = starred.select("b", "g", "n", "at", "m", *low_high).join(bounds, ["low", "high"])
    placed = common.stored(placed.withColumn("close", col("d") <= RADIUS + _SLACK), "jaccard-placed")
    # In a small block, pairs with a set that is surely beyond the pivot's radius; the rest follows below.
    few = placed.where(col("m") <= FEW).select("b", "g", "n", "at", "close")
    other = few.select("b", col("g").alias("h"), col("n").alias("nh"), col("at").alias("ah"), col("close").alias("close_h"))
    more = few.join(other, "b").where(F.expr("g < h and not (close and close_h)") & _can_share_enough("n", "at", "nh", "ah"))
    more = more.select(*_pair(col("g"), col("h"), col("n"), col("nh"))).distinct().join(pivoted, ["g", "p"], "left_anti")
    bounded = common.stored(pivoted.unionByName(_bounded(more, cells)), "jaccard-bounds")
    near_enough = bounded.where(col("d") <= RADIUS + _SLACK)
    sets = sets_of(_ends(near_enough))
    # Each set with one other first. Of the other pairs, those that no links connect by then are left.
    first = near_enough.groupBy("p").agg(F.min("g").alias("g")).withColumn("d", F.lit(0.0))
    compared = _exact(first, sets, "first")
    labels = components(compared.where("linked"), "g", "p")
    second = _apart(near_enough.join(first.select("g", "p"), ["g", "p"], "left_anti"), labels).where("not one")
    second = _exact(second, sets, "second")
    labels = _joined(labels, second)
    # near: in the component of the block's pivot. Blocks with none beyond are done.
    exact = compared.unionByName(second).select(col("g").alias("low"), col("p").alias("high"), col("d").alias("exact"))
    rest = _apart(placed.where((col("m") > FEW) | col("close")), labels, "low", "high").withColumnRenamed("one", "near")
    rest = rest.join(rest.where("not near").select("b").distinct(), "b", "left_semi").join(exact, ["low", "high"], "left")
    rest = common.stored(rest, "jaccard-rest")
    # d: exact distance to the pivot; where it is unknown, no more than it is for sets beyond, no less for near ones.
    unknown = rest.where("near and exact is null and close").select(col("low").alias("g"), col("high").alias("p"), "d").distinct()
    third = _exact(unknown, sets, "third").select(col("g").alias("low"), col("p").alias("high"), col("d").alias("later"))
    d = F.coalesce("exact", "later", F.when(col("near"), 1.0).otherwise(col("d")))
    rest = rest.join(third, ["low", "high"], "left").select("b", "g", "n", "at", "low", d.alias("d"), "near", "label")
    known, level = bounded.select("g", "p"), 0
    while True:
        # Boundary: sets near the pivot that one beyond may reach.
        beyond = rest.where("not near").groupBy("b").agg(F.min("d").alias("nearest"))
        kept = rest.join(beyond, "b").where(F.expr(f"not near or d >= nearest - {RADIUS + _SLACK}")).drop("nearest")
        rest = common.stored(kept, f"jaccard-rest-{level}")
        if _none_left(rest):
            return labels
        if not level:
            # Few blocks are left by now; the cells of the others' sets would be shuffled again at each level.
            cells = common.stored(cells.join(rest.select("g").distinct(), "g", "left_semi"), "jaccard-cells-left")
        rest = rest.join(rest.groupBy("b").agg(F.count("*").alias("size")), "b")
        # Pivots: all sets beyond if few are left, or a growing number of them.
        rank = F.row_number().over(Window.partitionBy("b").orderBy("g"))
        most = F.when(col("size") <= FEW, FEW).otherwise(F.lit(PIVOTS * 4**level))
        pivots = rest.where("not near").withColumn("rank", rank).where(col("rank") <= most)
        as_pivot = {"g": "p", "n": "np", "at": "ap", "d": "dp", "label": "lp"}
        pivots = common.stored(pivots.select("b", *as_pivot).withColumnsRenamed(as_pivot), f"jaccard-pivots-{level}")
        window = F.expr(f"not near or d >= dp - {RADIUS + _SLACK}") & (F.least("n", "np") * PER >= F.greatest("n", "np") * LEAST)
        # Sets that links connect already are told apart in the join itself, so that they never become rows.
        window = window & _can_share_enough("n", "at", "np", "ap") & (col("label") != col("lp"))
        tried = rest.join(pivots, "b").where(window).select(*_pair(col("g"), col("p"), col("n"), col("np"))).distinct()
        pairs = common.stored(tried.join(known, ["g", "p"], "left_anti"), f"jaccard-pairs-{level}")
        close = common.stored(_bounded(pairs, cells).where(col("d") <= RADIUS + _SLACK), f"jaccard-close-{level}")
        absent = common.stored(_ends(close).join(sets, "g", "left_anti"), f"jaccard-absent-{level}")
        if not _none_left(absent):
            sets = sets.union(sets_of(absent))
        labels = _joined(labels, _exact(close, sets, f"links-{level}"))
        known = known.union(pairs.select("g", "p"))
        # Pivots are done. A set that links now connect to the block's pivot is near as well.
        rest = rest.where(col("size") > FEW).join(pivots.select("b", col("p").alias("g")), ["b", "g"], "left_anti")
        rest = _apart(rest.drop("label"), labels, "low", "g")
        turned = F.when(col("one") & ~col("near"), 1.0).otherwise(col("d"))
        rest = rest.select("b", "g", "n", "at", "low", turned.alias("d"), (col("near") | col("one")).alias("near"), "label")
        level += 1


def _joined(labels: DataFrame, compared: DataFrame) -> DataFrame:
    """Components by ``labels`` and the links of ``compared``."""
    links = compared.where("linked").select("g", "p")
    return labels if _none_left(links) else components(labels.select(F.col("node").alias("g"), F.col("label").alias("p")).union(links), "g", "p")


def grouped(docs: DataFrame) -> DataFrame:
    """Per document: ``n_shingles`` and ``component_id``, the smallest id that links can reach."""
    while (found := _grouped(docs, secrets.randbits(63))) is None:
        pass  # two sets had one hash
    return found


def _grouped(docs: DataFrame, seed: int) -> DataFrame | None:
    spark = docs.sparkSession
    texts = common.id_and_text(docs)
    share = spark.sparkContext.broadcast
    often = share(frequent(texts, seed))

    def signatures(batches: Batches) -> Iterator[pa.RecordBatch]:
        for _, found in _sets(batches, seed):
            values = np.concatenate([signature(items, often.value) for items in found])
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64))], ["s"])

    several = texts.mapInArrow(signatures, "s long").groupBy("s").count().where("count > 1")
    shared = share(bitmap(several, "s"))

    def with_hits(batches: Batches) -> Iterator[pa.RecordBatch]:
        """Of each signature, what other documents' may hold as well."""
        for ids, found in _sets(batches, seed):
            signed = [signature(items, often.value) for items in found]
            places = [np.flatnonzero(hits(s, shared.value)).astype(np.uint64) for s in signed]
            some = [s[at.astype(np.int64)] for s, at in zip(signed, places, strict=True)]
            own = [shingles.set_hash(items, seed) if len(items) else (None, None) for items in found]
            n = [len(items) for items in found]
            cells = [cells_of(items) if len(s) else None for items, s in zip(found, some, strict=True)]
            arrays = [pa.array(ids, pa.int64()), *(pa.array([x[k] for x in own], pa.int64()) for k in (0, 1)), pa.array(n, pa.int64())]
            arrays += [_lists(some), _lists(places), pa.array(cells, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "g", "check", "n", "hits", "places", "cells"])

    every = common.stored(
        texts.mapInArrow(with_hits, "doc_id long, g long, check long, n long, hits array<long>, places array<long>, cells binary"), "jaccard-documents"
    )
    often.destroy()
    shared.destroy()
    if not _none_left(every.groupBy("g").agg(F.min("check").alias("low"), F.max("check").alias("high")).where("low <> high")):
        return None
    shingle = F.explode(F.arrays_zip("hits", "places")).alias("x")
    rows = every.select(shingle, "g", "n").select(F.col("x.hits").alias("s"), "g", "n", F.col("x.places").alias("at")).distinct()
    rows = common.stored(rows, "jaccard-rows")
    # Blocks with the same sets, which their hashes, XORed, tell, count once: by the shingle that comes first.
    described = rows.groupBy("s").agg(
        F.count("*").alias("m"), F.min(F.struct("g", "n")).alias("p"), F.bit_xor(F.xxhash64("g")).alias("sets"), F.sum("at").alias("places")
    )
    chosen = described.where("m > 1").groupBy("m", "p", "sets").agg(F.min(F.struct("places", "s")).alias("first"))
    chosen = chosen.select("m", "p", F.col("first.s").alias("s"))
    named = rows.join(chosen, "s").select(F.col("s").alias("b"), "g", "n", "at", "m", F.col("p.g").alias("p"), F.col("p.n").alias("np"))
    blocks = common.stored(named, "jaccard-blocks")
    common.dropped(rows)
    inside = blocks.select("g").distinct()
    cells = common.stored(every.where("cells is not null").select("g", "cells").join(inside, "g", "left_semi").dropDuplicates(["g"]), "jaccard-cells")

    def sets_of(some: DataFrame) -> DataFrame:
        """Read again from one document of each set: bitmaps tell which texts to look at, and which sets to keep."""
        some = common.stored(every.join(some, "g", "left_semi").groupBy("g").agg(F.min("doc_id").alias("doc_id")), "jaccard-wanted")
        wanted, chosen = share(bitmap(some, "g")), share(bitmap(some.where("doc_id is not null"), "doc_id"))

        def whole_sets(batches: Batches) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = np.array(batch.column("doc_id").fill_null(0), np.int64).view(np.uint64)
                batch = batch.filter(pa.array(hits(ids, chosen.value) | np.array(batch.column("doc_id").is_null())))
                for _, found in _sets([batch], seed):
                    own = np.array([shingles.set_hash(items, seed)[0] if len(items) else 0 for items in found], np.int64)
                    keep = np.flatnonzero(hits(own.view(np.uint64), wanted.value) & np.array([len(x) > 0 for x in found], bool))
                    if len(keep):
                        yield pa.RecordBatch.from_arrays([pa.array(own[keep]), _lists([found[k] for k in keep])], ["g", "items"])

        found = texts.mapInArrow(whole_sets, "g long, items array<long>").join(some.select("g"), "g", "left_semi")
        found = common.stored(found.dropDuplicates(["g"]), "jaccard-sets")
        common.dropped(some)
        wanted.destroy()
        chosen.destroy()
        return found

    labels = links(blocks, cells, sets_of)
    named = every.select("doc_id", "n", "g").join(labels.withColumnRenamed("node", "g"), "g", "left")
    named = named.select("doc_id", "n", F.coalesce("label", "g").alias("group"))
    least = named.where(F.col("group").isNotNull()).groupBy("group").agg(F.min("doc_id").alias("component_id"))
    return named.join(least, "group", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, as they are, that are first in their component: those with its smallest id.

    Rows with a null id stay. Rows that repeat an id are one document and stay together.
    """
    others = grouped(docs).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti").select(docs.columns)
