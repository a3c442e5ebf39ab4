"""Near-duplicate vectors against all pairs."""

import math
import random

import numpy as np
import pytest

from ballstats.llm import vector_dedup


def expected(rows, cosine=0.9):
    width = max((len(v) for _, v in rows if v), default=1)
    units, at = [], []
    for k, (i, v) in enumerate(rows):
        if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v):
            x = np.array([*v, *[0.0] * (width - len(v))]) / max(abs(c) for c in v)
            units.append(x / np.sqrt((x**2).sum()))
            at.append(k)
    u = np.array(units).reshape(len(units), width)
    near = u @ u.T >= cosine
    np.fill_diagonal(near, False)
    label = {i: i for i, _ in rows}
    moved = True
    while moved:
        moved = False
        for a, b in zip(*np.nonzero(near), strict=True):
            x, y = rows[at[a]][0], rows[at[b]][0]
            if label[x] != label[y]:
                label[x] = label[y] = min(label[x], label[y])
                moved = True
    n = dict(zip(at, near.sum(1).tolist(), strict=True))
    out = [(i, n.get(k, 0), label[i], label[i] == i) for k, (i, _) in enumerate(rows)]
    return sorted(out, key=repr)


def got(spark, rows, kind="array<float>"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding {kind}").selectExpr("*", "1 as label", "2 as x", "'r' as row", "0 as cell")
    found = vector_dedup.near_duplicates(df.repartition(3))
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(map(tuple, found.collect()), key=repr)


def as_float32(rows):
    return [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]


def table(n, width, seed):
    """Groups of near copies of very unequal size, chains between them, and vectors on their own."""
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(width)] for _ in range(12)]
    out = []
    for k in range(n):
        c = centres[0] if k % 3 == 0 else rnd.choice(centres)
        spread = rnd.choice([0.0, 0.05, 0.3, 0.45, 3.0])
        out.append((k * 7 % n, [rnd.choice([1, 2.5]) * (a + rnd.gauss(0, spread)) for a in c] if rnd.random() < 0.9 else [rnd.gauss(0, 1) for _ in c]))
    return as_float32(out)


@pytest.mark.parametrize(("tile", "cell"), [(4096, 16384), (40, 60), (64, 5000)])
def test_against_all_pairs(spark, monkeypatch, tile, cell):
    monkeypatch.setattr(vector_dedup, "TILE", tile)
    monkeypatch.setattr(vector_dedup, "CELL", cell)
    monkeypatch.setattr(vector_dedup, "SAMPLE", 300)
    rows = table(900, 6, tile)
    assert got(spark, rows) == expected(rows)


def test_balls_are_not_compared(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "CELL", 50)
    rnd = random.Random(2)
    rows = as_float32([(k, [1.0, rnd.gauss(0, 0.01), 0.0]) for k in range(400)] + [(400 + k, [0.0, 0.0, 1.0 + k]) for k in range(3)])
    joined = []
    monkeypatch.setattr(vector_dedup, "_tiles", lambda sent, make=vector_dedup._tiles: joined.append(sent.count()) or make(sent))
    assert got(spark, rows) == expected(rows)
    assert joined == [0]


def test_edge_cases(spark):
    rows = [(0, [1.0, 0.5]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [0.0, 0.0]), (5, [1.0]), (6, [2.0, 1.0]), (7, [])]
    rows += [(None, [1.0, 0.5]), (8, [-1.0, -0.5]), (9, [1.0, 0.5]), (9, [1.0, 0.5]), (9, [-0.5, 1.0]), (10, [-0.5, 1.0]), (11, [float("inf"), 1.0])]
    assert got(spark, rows) == expected(rows)
    assert got(spark, []) == []
    assert got(spark, [(1, None)]) == [(1, 0, 1, True)]
    large = [(1, [1e300, 1e299]), (2, [1e-300, 1e-301]), (3, [0.0, 1e300])]
    assert got(spark, large, "array<double>") == expected(large)
    with pytest.raises(ValueError):
        vector_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), cosine=1.5)
