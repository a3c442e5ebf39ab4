"""Whitening against covariances of fractions."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from ballstats.llm import whitening


def usable(rows):
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in kept), default=0)
    return [(i, [math.floor(1024 * c) + 100000 for c in [*v, *[0.0] * (width - len(v))]]) for i, v in kept]


def exact(xs):
    """Deviations and the covariance, from fractions."""
    n, width = len(xs), len(xs[0])
    sums = [sum(x[d] for x in xs) for d in range(width)]
    z = [[n * x[d] - sums[d] for d in range(width)] for x in xs]
    v = [[Fraction(sum(r[a] * r[b] for r in z), n**3) for b in range(width)] for a in range(width)]
    return [sum(e * e for e in r) for r in z], np.array([[float(e) for e in r] for r in v]), np.array(z, float) / n


def got(spark, rows, kind="array<double>"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding {kind}").selectExpr("*", "1 as n", "2 as x", "'a' as component")
    found = whitening.whitened(df.repartition(3))
    assert found.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return found.collect()


def compare(spark, rows):
    kept = usable(rows)
    deviations, v, centred = exact([x for _, x in kept])
    found = got(spark, rows)
    k = min(8, len(v))
    assert len(found) == k * len(kept)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    by_row = {}
    for row in found:
        assert row.n == len(kept)
        assert int(row.exact_deviation) == deviations[[i for i, _ in kept].index(row.vec_id)]
        assert row.deviation == (int(row.exact_deviation) if row.exact_deviation < 2**63 else None)
        assert row.explained == pytest.approx(values[row.component - 1] / np.trace(v), rel=1e-9, abs=1e-12)
        assert row.identity_error < 1e-6
        by_row.setdefault(row.component, {})[row.vec_id] = row.whitened
    for component, told in by_row.items():
        want = centred @ vectors[:, component - 1] / math.sqrt(values[component - 1])
        ours = np.array([told[i] for i, _ in kept])
        sign = np.sign(ours @ want)
        assert np.allclose(ours * sign, want, atol=1e-6)


def test_against_fractions(spark):
    rnd = random.Random(3)
    scales = [3.0, 2.5, 2.0, 1.6, 1.3, 1.0, 0.8, 0.6, 0.4, 0.3]
    compare(spark, [(k, [rnd.gauss(0.2, 1) * s for s in scales]) for k in range(300)])


def test_large_components(spark):
    rnd = random.Random(4)
    compare(spark, [(k, [rnd.gauss(0, 1) * 10.0**p for p in (12, 11, 10)]) for k in range(50)])


def test_squares_are_exact():
    rnd = random.Random(5)
    for bits in (10, 30, 61):
        rows = [[rnd.randrange(-(1 << bits), 1 << bits) for _ in range(3)] for _ in range(5000)]
        assert whitening.squares(np.array(rows, np.int64)) == [sum(r[d] ** 2 for r in rows) for d in range(3)]
        assert whitening.squares(np.array(rows, object)) == [sum(r[d] ** 2 for r in rows) for d in range(3)]


def test_edge_cases(spark):
    rows = [(0, [1.0, 0.5]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (5, [0.25]), (6, [2.0, -1.0]), (7, [])]
    compare(spark, rows)
    assert got(spark, []) == []
    assert got(spark, [(1, None), (2, [1e300])]) == []
    same = got(spark, [(None, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0])])
    assert [(row.deviation, row.whitened, row.explained, row.identity_error) for row in same] == [(0, None, None, 0.0)] * 6
    flat = got(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0])])
    assert sorted((row.vec_id, row.component, row.whitened and abs(round(row.whitened, 9))) for row in flat) == [
        (1, 1, 1.0), (1, 2, None), (2, 1, 1.0), (2, 2, None)
    ]
