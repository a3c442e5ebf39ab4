"""Exact join of vectors by cosine: pivots, the triangle inequality, and cells that join independently.

The angle between vectors is a metric. Pivots are spread over the table, and every vector belongs to the
cell of the nearest one. Two vectors of different cells meet in the cell of the smaller number: a vector
is replicated into the cell of a pivot p if it may be within the radius r of one of its members, which by
the triangle inequality needs an angle to p of at most the cell's own radius plus r, and of at most 2 r
more than the angle to its own pivot. Cells are joined in tiles of about ``TILE`` rows by ``TILE``, each
by one matrix product that yields counts and local components, never the pairs.

Members within r / 2 of their pivot form its ball. They are all linked with each other, so they are
counted and never compared; and a member at angle a is compared with others only if some vector outside
the ball is within a + r of the pivot. So a third of all rows may be copies of one vector: pivots are
taken from the densest places of a bounded sample, at more than r from each other, and such a group ends
in a ball. The sample decides what is compared, not what is found.

Vectors without structure in many dimensions lie at about the same angle to each other and to every pivot.
Then nearly all are replicated, and the tiles compare nearly all pairs: no exact method avoids that.

Edge cases: vectors that are null, zero or hold null or non-finite components, and rows without an id, link
with nothing and are a component of their own; shorter vectors count as ending in zeros; repeated rows
are linked rows; rows with one id are one node of the components; a table without rows gives none.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import acos, ceil, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballstats.llm import common, components

COSINE = 0.9
#: Vectors of the sample that pivots are taken from, most pivots, rows a cell should have and rows of a tile's side.
SAMPLE, PIVOTS, CELL, TILE = 4096, 1024, 16384, 4096
# Far over what an angle is rounded by.
_SLACK = 1e-6
_AT_ONCE = 1024
_FOUND = pa.schema([("row", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("least", pa.int64())])


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id`` and ``x``, which is null where the row can link with nothing."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda e: F.coalesce(F.abs(e.cast("double")) < float("inf"), F.lit(False)))
    some = F.exists(x, lambda e: e != 0)
    vec_id = F.col(id_col).cast("long")
    return vectors.select(vec_id.alias("vec_id"), F.when(finite & some & vec_id.isNotNull(), x).alias("x"))


def units(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists as rows of length 1, short ones ending in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), dtype=int)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    out /= np.abs(out).max(1, initial=0, keepdims=True)
    return out / np.sqrt((out**2).sum(1, keepdims=True))


def angles(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ pivots.T, -1.0, 1.0))


def pivots_of(sample: np.ndarray, radius: float, most: int) -> np.ndarray:
    """Vectors of the sample at more than the radius from each other, those with most neighbours first."""
    close = np.concatenate([(angles(sample[k : k + _AT_ONCE], sample) <= radius / 2).sum(1) for k in range(0, len(sample), _AT_ONCE)])
    taken: list[int] = []
    apart = np.full(len(sample), pi)
    for k in np.argsort(-close, kind="stable"):
        if apart[k] > radius:
            taken.append(int(k))
            if len(taken) == most:
                break
            apart = np.minimum(apart, angles(sample, sample[k : k + 1])[:, 0])
    return sample[taken]


class Cells:
    """Pivots and what is known of their cells: all bounded by the number of pivots."""

    def __init__(self, pivots: np.ndarray, cosine: float):
        n = len(pivots)
        self.pivots, self.cosine, self.radius = pivots, cosine, acos(cosine)
        self.reach = np.full(n, -pi)  # the widest angle of a member
        self.outside = np.full(n, 2 * pi)  # the smallest angle of a vector outside the ball
        self.ball = np.zeros(n, np.int64)  # rows of the ball
        self.least = np.zeros(n, np.int64)  # and its smallest id
        self.own = np.zeros(n, np.int64)  # tiles of a cell's members, and of replicated vectors
        self.more = np.zeros(n, np.int64)

    def sent(self, x: np.ndarray, cell: np.ndarray, angle: np.ndarray, ball: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which vector (by place) goes to which cell."""
        d = angles(x, self.pivots)
        own = ~ball | (angle + self.radius + _SLACK >= self.outside[cell])
        near = (d <= self.reach + self.radius + _SLACK) & (d <= angle[:, None] + 2 * self.radius + _SLACK)
        near &= np.arange(len(self.pivots)) < cell[:, None]
        near[np.flatnonzero(own), cell[own]] = True
        return np.nonzero(near)


def _parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, _AT_ONCE):
            yield batch.slice(start, _AT_ONCE)


def _placed(rows: DataFrame, cells: Cells, width: int) -> DataFrame:
    """Rows with their ``cell``, the ``angle`` to its pivot and whether they are in its ``ball``."""

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            d = angles(units(part.column("x"), width), cells.pivots)
            cell = d.argmin(1)
            angle = d[np.arange(len(d)), cell]
            more = [pa.array(cell, pa.int32()), pa.array(angle), pa.array(angle <= cells.radius / 2 - _SLACK)]
            yield pa.RecordBatch.from_arrays([*part.columns, *more], [*part.schema.names, "cell", "angle", "ball"])

    kind = dict(rows.dtypes)["x"]
    return rows.select("row", "vec_id", "x").mapInArrow(
        place, f"row long, vec_id long, x {kind}, cell int, angle double, ball boolean"
    )


def _outside(placed: DataFrame, cells: Cells, width: int) -> DataFrame:
    """Per pivot the smallest angle of a vector that is not in its ball; one row per pivot and task before adding."""

    def smallest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = np.full(len(cells.pivots), 2 * pi)
        for part in _parts(batches):
            d = angles(units(part.column("x"), width), cells.pivots)
            ball = part.column("ball").to_numpy(zero_copy_only=False)
            d[np.flatnonzero(ball), part.column("cell").to_numpy()[ball]] = 2 * pi
            least = np.minimum(least, d.min(0, initial=2 * pi))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(least)), pa.int32()), pa.array(least)], ["cell", "d"])

    return placed.select("x", "cell", "ball").mapInArrow(smallest, "cell int, d double").groupBy("cell").agg(F.min("d"))


def _sent(placed: DataFrame, cells: Cells, width: int) -> DataFrame:
    """Every vector once for each cell it is sent to (``at``); ``replica`` where that is not its own."""

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "x", "node", "at", "replica", "ball", "own", "more"]
        for part in _parts(batches):
            cell, angle, ball = (part.column(name).to_numpy(zero_copy_only=False) for name in ("cell", "angle", "ball"))
            place, at = cells.sent(units(part.column("x"), width), cell, angle, ball)
            node = np.where(ball, cells.least[cell], part.column("vec_id").to_numpy())
            replica = at != cell[place]
            more = [pa.array(node[place]), pa.array(at, pa.int32()), pa.array(replica), pa.array(ball[place] & ~replica)]
            more += [pa.array(cells.own[at]), pa.array(cells.more[at])]
            for start in range(0, len(place), _AT_ONCE):
                some = part.select(["row", "x"]).take(pa.array(place[start : start + _AT_ONCE]))
                yield pa.RecordBatch.from_arrays([*some.columns, *(column.slice(start, _AT_ONCE) for column in more)], names)

    kind = dict(placed.dtypes)["x"]
    return placed.select("row", "vec_id", "x", "cell", "angle", "ball").mapInArrow(
        send, f"row long, x {kind}, node long, at int, replica boolean, ball boolean, own long, more long"
    )


def connected(adjacent: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest node that each row (``left``) and column (``right``) reaches by way of a table of links."""
    low_left, low_right = left.copy(), right.copy()
    rows_open, columns_open = adjacent.any(1), adjacent.any(0)
    while rows_open.any():
        rows = frontier = np.flatnonzero(rows_open)[:1]
        columns = np.zeros(0, np.int64)
        rows_open[frontier] = False
        while len(frontier):
            fresh = np.flatnonzero(adjacent[frontier].any(0) & columns_open)
            columns_open[fresh] = False
            columns = np.concatenate([columns, fresh])
            frontier = np.flatnonzero(adjacent[:, fresh].any(1) & rows_open) if len(fresh) else fresh
            rows_open[frontier] = False
            rows = np.concatenate([rows, frontier])
        least = min(left[rows].min(), right[columns].min())
        low_left[rows], low_right[columns] = least, least
    return low_left, low_right


def joined(tile: pa.Table, width: int, cosine: float) -> pa.Table:
    """Rows of a tile that are linked: with how many, and the smallest node they reach inside the tile."""
    side = tile.column("side").to_numpy()
    low, high = side == tile.column("lo")[0].as_py(), side == tile.column("hi")[0].as_py()
    x, row, node, ball = (
        units(tile.column("x"), width),
        *(tile.column(name).to_numpy() for name in ("row", "node", "ball")),
    )
    left, right = np.flatnonzero(low), np.flatnonzero(high)
    adjacent = np.zeros((len(left), len(right)), bool)
    for start in range(0, len(left), _AT_ONCE):
        some = left[start : start + _AT_ONCE]
        near = x[some] @ x[right].T >= cosine
        near &= ~(ball[some][:, None] & ball[right][None]) & (row[some][:, None] != row[right][None])
        adjacent[start : start + _AT_ONCE] = near
    low_left, low_right = connected(adjacent, node[left], node[right])
    sides = [(left, adjacent.sum(1), low_left)]
    if not np.array_equal(left, right):
        sides.append((right, adjacent.sum(0), low_right))
    out = [np.concatenate(parts) for parts in zip(*[(row[at], n, node[at], least) for at, n, least in sides], strict=True)]
    some = out[1] > 0
    return pa.table([pa.array(column[some], pa.int64()) for column in out], schema=_FOUND)


def _tiles(sent: DataFrame) -> DataFrame:
    """``sent`` with the tiles ``lo``, ``hi`` each row goes to, and the ``side`` it is on."""
    deal = lambda parts: F.pmod(F.xxhash64("row"), F.col(parts))
    side = F.when(F.col("replica"), F.col("own") + deal("more")).otherwise(deal("own"))
    sided = sent.where("own > 0").withColumn("side", side)
    with_own = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("own") - 1),
        lambda k: F.struct(F.least(k, "side").alias("lo"), F.greatest(k, "side").alias("hi")),
    )
    with_more = F.transform(
        F.filter(F.sequence(F.lit(0).cast("long"), F.col("more")), lambda k: k < F.col("more")),
        lambda k: F.struct(F.col("side").alias("lo"), (F.col("own") + k).alias("hi")),
    )
    each = F.when(F.col("replica"), with_own).otherwise(F.concat(with_own, with_more))
    return sided.select("row", "x", "node", "at", "ball", "side", F.inline(each))


def _repeated_ids(placed: DataFrame, balls: DataFrame) -> DataFrame:
    """Links between ids and the nodes of their rows, for ids whose rows have several."""
    named = placed.where("ball").select("vec_id", "cell").join(F.broadcast(balls), "cell").select("vec_id", "node")
    named = named.union(placed.where("not ball").select("vec_id", F.col("vec_id").alias("node"))).distinct()
    several = named.groupBy("vec_id").agg(F.count("*").alias("rows")).where("rows > 1")
    return named.join(several, "vec_id").select("vec_id", "node")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per row ``n_links``, ``component_id`` and whether it is the one of its component that is ``kept``."""
    if not 0 < cosine < 1:
        raise ValueError("the least cosine must be between 0 and 1")
    spark = vectors.sparkSession
    given = usable(vectors, id_col, vector_col)
    n, width = given.where("x is not null").agg(F.count("*"), F.coalesce(F.max(F.size("x")), F.lit(1))).first()
    none = F.lit(0).cast("long")
    if not n:
        return given.select("vec_id", none.alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    hashed = given.where("x is not null").orderBy(F.xxhash64("vec_id", "x"), "vec_id", "x").limit(SAMPLE).select("x")
    cells = Cells(pivots_of(units(hashed.toArrow().column("x"), width), acos(cosine), min(PIVOTS, ceil(n / CELL))), cosine)

    numbered = given.select(F.monotonically_increasing_id().alias("row"), "vec_id", "x")
    every = _placed(numbered.where("x is not null"), cells, width)
    alone = numbered.where("x is null").select("row", "vec_id", "x", *(F.lit(None).cast(k).alias(c) for c, k in every.dtypes[3:]))
    stored = common.stored(every.unionByName(alone), "vectors-placed")
    placed = stored.where("x is not null")
    ball = F.col("ball")
    known = placed.groupBy("cell").agg(
        F.max("angle"), F.count(F.when(ball, 1)), F.min(F.when(ball, F.col("vec_id")))
    )
    for cell, reach, size, least in known.collect():  # one row per pivot, as those below
        cells.reach[cell], cells.ball[cell], cells.least[cell] = reach, size, least or 0
    for cell, d in _outside(placed, cells, width).collect():
        cells.outside[cell] = d
    for at, replica, rows in _sent(placed, cells, width).groupBy("at", "replica").agg(F.count("*")).collect():
        (cells.more if replica else cells.own)[at] = ceil(rows / TILE)

    tiles = _tiles(_sent(placed, cells, width)).groupBy("at", "lo", "hi")
    found = common.stored(tiles.applyInArrow(lambda tile: joined(tile, width, cosine), common.ddl(_FOUND)), "vectors-joined")
    balls = spark.createDataFrame(
        [(k, int(size), int(cells.least[k])) for k, size in enumerate(cells.ball) if size], "cell int, size long, node long"
    )
    links = found.select(F.col("node").alias("a"), F.col("least").alias("b")).union(_repeated_ids(placed, balls))
    labels = components.components(links.where("a <> b").distinct())
    balls = balls.join(labels, "node", "left").select("cell", "size", F.coalesce("label", "node").alias("of_ball"))
    counts = found.groupBy("row").agg(F.sum("n").alias("n"))
    rows = stored.select("row", "vec_id", "cell", "ball").join(counts, "row", "left")
    rows = rows.join(F.broadcast(balls), "cell", "left")  # a row per pivot at most
    rows = rows.join(labels.select(F.col("node").alias("vec_id"), "label"), "vec_id", "left")
    in_ball = F.coalesce("ball", F.lit(False))
    component = F.when(in_ball, F.col("of_ball")).otherwise(F.coalesce("label", "vec_id"))
    links_of = F.coalesce("n", none) + F.when(in_ball, F.col("size") - 1).otherwise(none)
    return rows.select(
        "vec_id", links_of.alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept")
    )
