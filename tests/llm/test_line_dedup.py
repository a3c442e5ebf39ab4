"""The edit join of lines against brute force."""

import random

import numpy as np
import pyarrow as pa

from ballstats.llm import line_dedup
from tests.llm.helpers import ODD, as_rows, documents


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def varied(rnd, line, edits, signs):
    out = list(line)
    for _ in range(edits):
        k = rnd.randrange(len(out))
        out[k : k + 1] = rnd.choice([[], [out[k], rnd.choice(signs)], [rnd.choice(signs)]])
    return "".join(out)


def expected(rows):
    lines = [(i, k, line) for i, t in rows for k, line in enumerate((t or "").split("\n")) if line.split()]
    texts = sorted({line for _, _, line in lines})
    group, links = {t: t for t in texts}, dict.fromkeys(texts, 0)

    def top(t):
        while group[t] != t:
            t = group[t]
        return t

    for k, a in enumerate(texts):
        for b in texts[:k]:
            x, y = a.encode(), b.encode()
            if min(len(x), len(y)) >= line_dedup.LEAST_BYTES and abs(len(x) - len(y)) <= 2 and distance(x, y) <= 2:
                links[a] += 1
                links[b] += 1
                group[top(a)] = top(b)
    first = {}
    for i, k, line in sorted(lines, key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        first.setdefault(top(line), (i, k))
    return sorted(((i, k, *first[top(line)], links[line]) for i, k, line in lines), key=repr)


def got(spark, rows):
    return as_rows(line_dedup.classed(documents(spark, rows)), "doc_id", "line_no", "first_doc", "first_line", "n_links")


def test_against_brute_force(spark):
    rnd = random.Random(11)
    signs = "abcdefgh  "
    bases = ["".join(rnd.choice(signs) for _ in range(rnd.choice([22, 24, 25, 40, 90]))) for _ in range(12)]
    rows = []
    for doc_id in range(40):
        lines = [varied(rnd, rnd.choice(bases), rnd.randrange(4), signs) for _ in range(rnd.randrange(5))]
        rows.append((doc_id, "\n".join(lines)))
    rows += [(100, None), (101, ""), (102, "short"), (103, "short\n\nshort"), (104, "é" * 20), (105, "é" * 19 + "e"), (None, bases[0])]
    want = expected(rows)
    assert sum(row[4] for row in want) > 20
    assert got(spark, rows) == want


def test_edge_cases(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, None), (2, "\n \n")]) == []
    rows = [(i, t) for i, t in ODD if i != 4]
    assert got(spark, rows) == expected(rows)


def test_distances():
    rnd = random.Random(2)
    pairs = []
    for _ in range(1500):
        a = "".join(rnd.choice("ab") for _ in range(rnd.randrange(3, 40)))
        pairs.append((a.encode(), varied(rnd, a, rnd.randrange(5), "ab").encode() or b"a"))
    assert line_dedup.within(pairs).tolist() == [distance(a, b) <= 2 for a, b in pairs]


def test_without_repeats(spark):
    line = "a line that is long enough to count here"
    rows = [(1, f"{line}\nown one"), (2, f"own two\n{line}!"), (3, line), (4, None), (5, ""), (6, "own two"), (7, f"{line}\n{line}\nx")]
    left = line_dedup.without_repeats(documents(spark, rows))
    assert as_rows(left, "doc_id", "text", "n_chars") == sorted(
        [(1, f"{line}\nown one", 48), (2, "own two", 7), (4, None, None), (5, "", 0), (6, "own two", 7), (7, "x", 1)], key=repr
    )
    assert left.columns == documents(spark, rows).columns


def thue_morse(n, first="a", second="b"):
    return "".join(first if bin(k).count("1") % 2 == 0 else second for k in range(n))


def test_lines_that_clash_under_polynomials(spark):
    rows = [(1, thue_morse(2048)), (2, thue_morse(2048, "b", "a")), (3, thue_morse(2048))]
    assert got(spark, rows) == expected(rows)


def test_clashing_hashes_are_drawn_again(spark, monkeypatch):
    rows = [(k, f"a line of text that has the number {k} and {k * 7919} in it") for k in range(30)]
    seeds = iter([5, 6, 7])
    monkeypatch.setattr(line_dedup.secrets, "randbits", lambda _: next(seeds))
    whole = line_dedup._all_lines

    def clashing(batches, seed):
        for batch in whole(batches, seed):
            yield batch.set_column(2, "h", pa.array([k % 3 for k in range(batch.num_rows)], pa.int64())) if seed < 7 else batch

    monkeypatch.setattr(line_dedup, "_all_lines", clashing)
    assert got(spark, rows) == expected(rows)
    assert next(seeds, None) is None


def test_long_lines_are_compared_like_short_ones():
    rnd = random.Random(8)
    pairs = []
    for _ in range(3000):
        x = bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(0, 14)))
        y = bytearray(x)
        for _ in range(rnd.randrange(0, 5)):
            at = rnd.randrange(len(y) + 1)
            y[at : at + rnd.choice([0, 1])] = rnd.choice([b"", b"a", b"b"])
        pairs.append((x, bytes(y)))
    for edits in (1, 2, 3):
        want = [distance(x, y) <= edits for x, y in pairs]
        assert [line_dedup.within_long(x, y, edits) for x, y in pairs] == want
        assert line_dedup.verified(pairs, edits).tolist() == want
    text = bytes(rnd.randrange(32, 127) for _ in range(1_000_000))
    assert line_dedup.verified([(text, b"?" + text[1:-1] + b"??"), (text, text[::-1])]).tolist() == [False, False]
    assert line_dedup.verified([(text, b"\x01" + text[:-1]), (text, text)] * 20).all()


def test_filters_let_few_other_keys_through_as_they_fill(spark):
    """Eight times the keys: of one bit per key a filter of 2^16 bits would let 15 times as many through, or a tenth."""
    rng = np.random.default_rng(5)
    other = rng.integers(-(2**63), 2**63 - 1, 100_000).reshape(-1, 4)
    share = []
    for n in (1000, 8000):
        keys = rng.integers(-(2**63), 2**63 - 1, n)
        places = line_dedup.places_for(n, 1 << 16)
        known = line_dedup.bloom(spark.createDataFrame([(int(k),) for k in keys], "key long"), places, 1 << 16)
        assert len(line_dedup.met(keys, known, places)[0]) == n
        at, which = line_dedup.met(other, known, places)
        assert len(at) == len(which)
        share.append(len(at) / other.size)
    assert share[1] < 0.04
    # Overfull, one place is best.
    assert line_dedup.places_for(1 << 17, 1 << 16) == (0,)
