"""The Jaccard join against brute force, with and without large blocks."""

import random
import re
from types import SimpleNamespace

import numpy as np
import pytest

from ballstats.llm import components, jaccard_join, shingles

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def expected(rows):
    sets = [shingle_set(text) for _, text in rows]
    group = list(range(len(rows)))

    def top(k):
        while group[k] != k:
            k = group[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= 75 * (len(sets[i]) + len(sets[j]) - shared):
                group[top(i)] = top(j)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(k)] = min(least.get(top(k), doc_id), doc_id)
    return sorted(((d, len(sets[k]), least.get(top(k))) for k, (d, _) in enumerate(rows)), key=repr)


def got(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as s", "1 as g", "2 as n", "3 as group")
    return sorted((tuple(row) for row in jaccard_join.grouped(docs).collect()), key=repr)


def copies(n, seed, changes=9):
    """Versions of one text, each with some words changed, and texts that share a passage."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(150)]
    rows = []
    for k in range(n):
        words = list(base)
        for _ in range(rnd.randrange(changes)):
            words[rnd.randrange(len(words))] = f"x{rnd.randrange(10**6)}"
        rows.append((k, " ".join(words)))
    passage = " ".join(base[:40])
    rows += [(1000 + k, passage + " " + " ".join(f"y{rnd.randrange(10**6)}" for _ in range(rnd.randrange(30)))) for k in range(n // 2)]
    return rows


def test_edge_cases(spark):
    text = "one two three four five six seven"
    rows = [(1, text), (2, text.upper()), (3, None), (4, ""), (5, " \n"), (6, "few words"), (7, "Few\twords")]
    rows += [(1, text), (None, text), (None, None), (9, "É one"), (8, "é one"), (10, "long " * 5000)]
    assert got(spark, rows) == expected(rows)


def test_empty_table(spark):
    assert got(spark, []) == []


@pytest.mark.parametrize("few, pivots", [(24, 16), (2, 1), (3, 2)])
def test_near_copies(spark, monkeypatch, few, pivots):
    """Blocks above ``few`` sets go through pivots and windows; the result is the same."""
    monkeypatch.setattr(jaccard_join, "FEW", few)
    monkeypatch.setattr(jaccard_join, "PIVOTS", pivots)
    rows = copies(30, seed=few)
    want = expected(rows)
    assert len({row[2] for row in want}) > 3
    assert got(spark, rows) == want


def test_signatures_meet():
    """Two sets within the radius share a shingle of their signatures, whatever the order."""
    rnd = np.random.default_rng(1)
    for _ in range(300):
        n = int(rnd.integers(1, 60))
        x = np.unique(rnd.integers(0, 2**63, n).astype(np.uint64))
        y = x[rnd.random(len(x)) > 0.1]
        y = np.unique(np.concatenate([y, rnd.integers(0, 2**63, int(rnd.integers(0, 8))).astype(np.uint64)]))
        shared = len(np.intersect1d(x, y))
        if len(y) and 100 * shared >= 75 * (len(x) + len(y) - shared):
            often = (np.sort(x[: len(x) // 2]), np.arange(len(x) // 2) + 3)
            a, b = jaccard_join.signature(x, often), jaccard_join.signature(y, often)
            assert len(np.intersect1d(a, b))


def test_cells_bound_distance():
    rnd = np.random.default_rng(2)
    for _ in range(100):
        x = np.unique(rnd.integers(0, 2**64, 200, dtype=np.uint64))
        y = np.unique(np.concatenate([x[:150], rnd.integers(0, 2**64, int(rnd.integers(1, 300)), dtype=np.uint64)]))
        shared = len(np.intersect1d(x, y))
        low = jaccard_join.cell_distance([jaccard_join.cells_of(x)], [jaccard_join.cells_of(y)])[0]
        assert low <= 1 - shared / (len(x) + len(y) - shared) + 1e-12


def test_shingles_are_those_of_words():
    texts = ["a b c d e f", "A\tB\nC d e  f", "a b c d f e", "", "x" * 300_000 + " a b c d e f", "a b c d e f " * 40_000]
    sets = shingles.shingle_sets(texts)
    assert [len(s) for s in sets] == [len(shingle_set(t)) for t in texts]
    assert np.array_equal(sets[0], sets[1]) and not np.array_equal(sets[0], sets[2])
    assert np.array_equal(shingles.shingle_sets(texts[4:5])[0], sets[4])


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    found = {row.node: row.label for row in components.components(links).collect()}
    assert found == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


def test_representatives(spark):
    text = "one two three four five six seven"
    docs = spark.createDataFrame([(2, text, "a"), (1, text, "b"), (3, None, "c"), (None, text, "d")], "doc_id long, text string, lang string")
    assert sorted(map(tuple, jaccard_join.representatives(docs).collect()), key=repr) == sorted(
        [(1, text, "b"), (3, None, "c"), (None, text, "d")], key=repr
    )


def test_words_that_clash_under_polynomials(spark):
    words = ["".join("ab"[(bin(k).count("1") + turn) % 2] for k in range(2048)) for turn in (0, 1)]
    rows = [(1, words[0]), (2, words[1]), (3, words[0]), (4, " ".join(words * 3)), (5, " ".join(words[::-1] * 3))]
    assert got(spark, rows) == expected(rows)


def test_clashing_hashes_are_drawn_again(spark, monkeypatch):
    rows = [(k, f"some words of text {k} with more and more words") for k in range(20)]
    seeds = iter([5, 6, 7])
    monkeypatch.setattr(jaccard_join.secrets, "randbits", lambda _: next(seeds))
    right = shingles.set_hash

    def clashing(items, seed):
        first, second = right(items, seed)
        return (first % 3 if seed < 7 else first), second

    patched = SimpleNamespace(set_hash=clashing, shingle_sets=shingles.shingle_sets)
    monkeypatch.setattr(jaccard_join, "shingles", patched)
    assert got(spark, rows) == expected(rows)
    assert next(seeds, None) is None


def test_cells_bound_the_distance():
    rnd = np.random.default_rng(5)
    for n, m, shared in [(1, 1, 1), (300, 400, 290), (900, 1100, 850), (4000, 4100, 100), (5000, 3800, 3700), (40000, 1000, 900)]:
        items = np.unique(rnd.integers(0, 2**64, n + m - shared, np.uint64))
        rnd.shuffle(items)
        x, y = items[:n], items[n - shared :]
        low = jaccard_join.cell_distance([jaccard_join.cells_of(x)], [jaccard_join.cells_of(y)])[0]
        assert 0 <= low <= 1 - shared / (n + m - shared) + 1e-12
    crowded = jaccard_join.cells_of(np.arange(10**4, dtype=np.uint64))
    assert jaccard_join.cell_distance([crowded] * 2, [crowded, jaccard_join.cells_of(items)]).tolist() == [0, 0]


@pytest.mark.parametrize("size", [100, 500, 2000, 6000])
def test_unrelated_sets_are_told_apart_by_their_cells(size):
    """Whatever their size, so that whole sets are not fetched for them."""
    rnd = np.random.default_rng(size)
    cells = [jaccard_join.cells_of(np.unique(rnd.integers(0, 2**64, size, np.uint64))) for _ in range(40)]
    assert jaccard_join.cell_distance(cells[1:], cells[:-1]).min() > jaccard_join.RADIUS
