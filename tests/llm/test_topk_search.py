"""Top-k inner products against brute force."""

import math
import random

from pyspark.sql import functions as F

from ballstats.llm import topk_search


def expected(rows, k):
    usable = []
    for vec_id, vector in rows:
        if vec_id is None or vector is None or any(x is None or not math.isfinite(x) or abs(1024 * x) >= 2**62 for x in vector):
            continue
        usable.append((vec_id, [math.floor(1024 * x) for x in vector]))
    out = []
    for at, (q, a) in enumerate(usable):
        if q % 100 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for k, (i, b) in enumerate(usable) if k != at)
            out += [(q, rank, i, max(-(2**63), min(2**63 - 1, -s))) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def got(spark, rows, k=10, kind="array<float>"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding {kind}").selectExpr("*", "1 as label", "2 as score", "3 as v")
    found = topk_search.top_k(df, F.col("vec_id") % 100 == 0, k)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, found.collect()))


def vectors(n, width, seed):
    rnd = random.Random(seed)
    return [(k, [rnd.randrange(-2000, 2000) / 1024 * rnd.choice([0.1, 1, 1]) for _ in range(width)]) for k in range(n)]


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "STRAND", 150)
    monkeypatch.setattr(topk_search, "QUERIES", 3)
    monkeypatch.setattr(topk_search, "HEAD", 20)
    monkeypatch.setattr(topk_search, "BLOCK", 16)
    rows = vectors(700, 24, 1) + [(1000 + k, vectors(1, 24, 9)[0][1]) for k in range(200)]
    assert got(spark, rows) == expected(rows, 10)
    assert got(spark, rows, 3) == expected(rows, 3)


def test_edge_cases(spark):
    rows = [(0, [1.0, 0.5]), (1, [0.0, 0.0]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0])]
    rows += [(None, [1.0, 1.0]), (6, [1.0, 0.5]), (7, [1.0, 0.5]), (100, [-1.0, 2.0]), (8, [0.25]), (9, []), (7, [3.0, 0.5])]
    assert got(spark, rows) == expected(rows, 10)
    assert got(spark, []) == []
    assert got(spark, [(100, [1.0])]) == []
    assert got(spark, [(1, [1.0])]) == []


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [3.0, 1.0]), (7, [1.0, 1.0]), (7, [5.0, 1.0]), (7, [5.0, 1.0])]
    assert len(expected(rows, 10)) == 15
    assert got(spark, rows) == expected(rows, 10)
    assert got(spark, rows, 2) == expected(rows, 2)


def test_large_components(spark):
    rnd = random.Random(6)
    for size in (4e6, 1e9, 1e14):
        rows = [(k * 50, [float(rnd.randrange(-1000, 1000)) * size / 1000 + rnd.randrange(3) for _ in range(5)]) for k in range(60)]
        assert got(spark, rows, 4, "array<double>") == expected(rows, 4)
    # Scores that differ in the last of over 60 bits.
    near = [(0, [2.0**21, 1.0]), *((k, [2.0**20, k / 1024]) for k in range(1, 40))]
    assert got(spark, near, 10, "array<double>") == expected(near, 10)
    assert got(spark, [(0, [1e300]), (1, [1.0]), (100, [2.0])], 3, "array<double>") == [(100, 1, 1, 2048 * 1024)]
