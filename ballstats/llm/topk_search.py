"""Exact top-k by inner product over vectors sorted by length.

Vectors are turned by the singular vectors of the whole table, so that most of an inner product is in
the first ``LEADING`` coordinates. Candidates are dealt into strands and walked through by descending
length. By Cauchy-Schwarz a block of them is left out once the product of lengths is under a query's
threshold, and with it all that follow; within a block a pair is left out if the partial sum plus the
product of the residual lengths is under it. What remains is scored exactly, in whole numbers. The
first thresholds come from the ``HEAD`` longest vectors; strands raise their own as they go.

Queries go in blocks of ``QUERIES``, strands have about ``STRAND`` candidates: a task holds one of each.
Only the turning matrix, the head and numbers of rows reach the driver.

Edge cases: vectors that are null or hold null or non-finite components, or one whose whole number is
beyond 62 bits, and null ids, take no part; rows that repeat an id are queries and candidates of their
own; shorter vectors count as ending in zeros; ties go to the smaller id; a query with fewer than k
others has all of them. Scores are exact: where the lengths of vectors allow products beyond 53 bits,
floating point only sorts out what cannot be among the best, and the rest is scored in Python's whole
numbers. A score beyond 64 bits is given as the nearest number that has 64.
"""

from __future__ import annotations

from decimal import Decimal
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ballstats.llm import common

LEADING, BLOCK, HEAD = 16, 256, 1024
QUERIES, STRAND = 4096, 4096
_LARGEST = float(1 << 62)
# Products of lengths up to which sums of products are exact in floating point.
_EXACT = float(1 << 53)
# ``high`` is what a score has beyond 62 bits, and ``low`` the rest of it.
_FOUND = pa.schema(
    [(name, pa.int64()) for name in ("query", "query_id", "vec_id", "row")] + [("high", pa.decimal128(38, 0)), ("low", pa.int64())]
)
_FOUND_DDL = "query long, query_id long, vec_id long, row long, high decimal(38,0), low long"


def whole_numbers(vectors: DataFrame, scale: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id`` and ``v``, each component being floor(scale * x), and a number ``row`` for each."""
    scaled = lambda e: e.cast("double") * F.lit(float(scale))
    # Null where it has no whole number: filters may be moved, so each component is looked at by itself.
    v = F.transform(F.col(vector_col), lambda e: F.when(F.abs(scaled(e)) < _LARGEST, F.floor(scaled(e))))
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    return rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda e: e.isNotNull()))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Lists as rows of one matrix, short ones filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), dtype=int)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def rotation(rows: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all rows, largest singular value first: from the sum of outer products."""

    def outer(batches):
        total = np.zeros((width, width))
        for batch in batches:
            x = _matrix(batch.column("v"), width).astype(float)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], ["i", "row"]
        )

    parts = rows.select("v").mapInArrow(outer, "i int, row array<double>")
    summed = parts.select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x"))
    total = np.zeros((width, width))
    for i, j, x in summed.collect():  # width * width numbers
        total[i, j] = x
    return np.linalg.eigh(total)[1][:, ::-1]


def best_of(
    places: np.ndarray, scores: np.ndarray, k: int, more_places: np.ndarray, more: np.ndarray, ids: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The k highest of each row, as places in ``ids``, ties to the smaller id; -inf marks empty places."""
    places, scores = np.hstack([places, more_places]), np.hstack([scores, more])
    order = np.lexsort((places, ids[places], -scores), axis=-1)[:, :k]
    return np.take_along_axis(places, order, 1), np.take_along_axis(scores, order, 1)


def scored(query: np.ndarray, vectors: np.ndarray) -> list[int]:
    """Inner products in Python's whole numbers."""
    return (vectors.astype(object) @ query.astype(object)).tolist()


def search_large(
    rows: np.ndarray, queries: np.ndarray, least: np.ndarray, given: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> list[list[tuple[int, int]]]:
    """:func:`search` for numbers beyond floating point: per query (place, score) of its best candidates."""
    length = np.sqrt((vectors.astype(float) ** 2).sum(1))
    out = []
    for row, query, at_least in zip(rows, queries, least, strict=True):
        other = np.flatnonzero(given != row)
        near = vectors[other].astype(float) @ query.astype(float)
        # Far more than what sums of products are rounded by.
        slack = 1e-9 * length[other] * np.sqrt((query.astype(float) ** 2).sum()) + 1e-6
        enough = max(float(at_least), np.sort(near - slack)[-k] if len(near) >= k else -np.inf)
        some = other[near + slack >= enough]
        ranked = sorted(zip(scored(query, vectors[some]), some.tolist(), strict=True), key=lambda x: (-x[0], ids[x[1]], x[1]))
        out.append([(place, score) for score, place in ranked[:k]])
    return out


def search(
    rows: np.ndarray, queries: np.ndarray, least: np.ndarray, given: np.ndarray, ids: np.ndarray, vectors: np.ndarray, turn: np.ndarray, k: int
) -> list[list[tuple[int, int]]]:
    """Each query's best candidates as (place, score), as far as they reach its threshold ``least``.

    ``rows`` and ``given`` are the numbers of the queries' and the candidates' rows.
    """
    length = np.sqrt((vectors.astype(float) ** 2).sum(1))
    length_q = np.sqrt((queries.astype(float) ** 2).sum(1))
    if length.max(initial=0) * length_q.max(initial=0) >= _EXACT or max(length.max(initial=0), length_q.max(initial=0)) >= _EXACT:
        return search_large(rows, queries, least, given, ids, vectors, k)
    order = np.lexsort((given, ids, -length))
    places, length, v, q = order, length[order], vectors[order].astype(float), queries.astype(float)
    turned_q, turned_v = q @ turn, v @ turn
    rest = lambda x: np.sqrt((x[:, LEADING:] ** 2).sum(1))
    rest_q, rest_v = rest(turned_q), rest(turned_v)
    best_places = np.zeros((len(queries), k), np.int64)
    best, least = np.full((len(queries), k), -np.inf), least.copy()
    for start in range(0, len(places), BLOCK):
        part = slice(start, start + BLOCK)
        # A little over, for what the turn rounds off.
        slack = 1e-9 * length_q * length[start] + 1e-6
        live = np.flatnonzero(length_q * length[start] + slack >= least)
        if not len(live):
            break
        bound = turned_q[live, :LEADING] @ turned_v[part, :LEADING].T + rest_q[live, None] * rest_v[None, part]
        may = (bound + slack[live, None] >= least[live, None]) & (given[places[None, part]] != rows[live, None])
        some = np.flatnonzero(may.any(1))
        if not len(some):
            continue
        at = live[some]
        exact = np.where(may[some], q[at] @ v[part].T, -np.inf)
        best_places[at], best[at] = best_of(
            best_places[at], best[at], k, np.broadcast_to(places[part], exact.shape), exact, ids
        )
        least[at] = np.maximum(least[at], best[at, -1])
    return [
        [(int(place), int(score)) for place, score in zip(*row, strict=True) if score > -np.inf]
        for row in zip(best_places, best, strict=True)
    ]


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024) -> DataFrame:
    """The k best of all other rows for each row that ``is_query`` (of ``vec_id``) says: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    rows = common.stored(whole_numbers(vectors, scale), "topk-vectors")
    n, width = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    asked = rows.where(is_query)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    n_queries = asked.count()
    if not n_queries:
        return empty
    width = max(1, width)
    turn = rotation(rows, width)
    squared = F.aggregate("v", F.lit(0.0), lambda a, e: a + e.cast("double") * e.cast("double"))
    longest = rows.orderBy(F.desc(squared), "vec_id", "row").limit(HEAD).toArrow()  # HEAD rows
    head_rows, head = longest.column("row").to_numpy(), _matrix(longest.column("v"), width).astype(float)
    shared = spark.sparkContext.broadcast((turn, head_rows, head))

    def thresholds(batches):
        _, first_rows, first = shared.value
        size = np.sqrt((first**2).sum(1))
        for batch in batches:
            own, v = batch.column("row").to_numpy(), _matrix(batch.column("v"), width).astype(float)
            # Less what sums of products may be rounded by.
            scores = v @ first.T - 1e-9 * np.sqrt((v**2).sum(1))[:, None] * size[None]
            scores = np.where(own[:, None] == first_rows[None], -np.inf, scores)
            at = np.sort(scores, axis=1)[:, -k] if scores.shape[1] >= k else np.full(len(own), -np.inf)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], ["row", "vec_id", "v", "least"])

    blocks, strands = ceil(n_queries / QUERIES), ceil(n / STRAND)
    deal = lambda seed, parts: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(parts)).cast("int")
    each = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left = asked.mapInArrow(thresholds, "row long, vec_id long, v array<long>, least double").select(
        deal(1, blocks).alias("block"), each(strands).alias("strand"), "row", "vec_id", "v", "least"
    )
    right = rows.select(each(blocks).alias("block"), deal(2, strands).alias("strand"), "row", "vec_id", "v")

    def run(asked: pa.Table, given: pa.Table) -> pa.Table:
        if not asked.num_rows or not given.num_rows:
            return _FOUND.empty_table()
        queries, given_rows, ids = asked.column("row").to_numpy(), given.column("row").to_numpy(), given.column("vec_id").to_numpy()
        found = search(
            queries,
            _matrix(asked.column("v"), width),
            asked.column("least").to_numpy(),
            given_rows,
            ids,
            _matrix(given.column("v"), width),
            shared.value[0],
            k,
        )
        out = [
            (query, query_id, ids[place], given_rows[place], Decimal(score >> 62), score & ((1 << 62) - 1))
            for query, query_id, own in zip(queries, asked.column("vec_id").to_numpy(), found, strict=True)
            for place, score in own
        ]
        columns = list(zip(*out, strict=True)) or [[]] * len(_FOUND)
        return pa.table([pa.array(column, field.type) for column, field in zip(columns, _FOUND, strict=True)], schema=_FOUND)

    found = left.groupBy("block", "strand").cogroup(right.groupBy("block", "strand")).applyInArrow(run, _FOUND_DDL)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("high"), F.desc("low"), "vec_id", "row"))
    limit = (1 << 63) - 1
    score = (
        F.when(F.col("high") >= 2, F.lit(limit))
        .when(F.col("high") < -2, F.lit(-limit - 1))
        .otherwise(F.shiftleft(F.col("high").try_cast("long"), 62) + F.col("low"))
    )
    best = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score.alias("score"))
