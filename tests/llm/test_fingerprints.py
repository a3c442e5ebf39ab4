"""Sketches of paragraph digests: exact differences, and the edited versions."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from ballstats.llm import fingerprints
from tests.llm.helpers import ODD, documents

PARAGRAPH_END = re.compile(r"[\r\n]+|\s(?<=[.!?]\s)(?<=[^.!?\r\n]{60}[.!?]\s)\s*")


def paragraphs(text):
    return {p.strip(" ") for p in PARAGRAPH_END.split(text) if p.strip(" ")}


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    """In descending order of ids, null ids last."""
    texts = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for k, (doc_id, text) in enumerate(texts):
        after = texts[(k + 1) % len(texts)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        own = paragraphs(text)
        digest = hashlib.sha256(edited.encode()).hexdigest()
        out.setdefault(doc_id, []).append((len(text), digest, likeness(own, paragraphs(edited)), likeness(own, paragraphs(after))))
    return out


def check(spark, rows):
    found = fingerprints.edited_versions(documents(spark, rows)).collect()
    want = expected(rows)
    assert len(found) == len(rows)
    for row in found:
        got = (row.n_chars, row.edited_sha256, row.near_edited, row.near_next)
        assert any(got[:2] == w[:2] and got[2:] == pytest.approx(w[2:]) for w in want[row.doc_id])
    return found


def test_edge_cases(spark):
    rows = [(i, t) for i, t in ODD if i != 4] + [(-3, "a\nb\nc"), (2**62, "a\nb\nd")]
    found = {row.doc_id: row for row in check(spark, rows)}
    assert found[2].fingerprint == found[3].fingerprint


def test_repeated_ids_are_all_there(spark):
    found = fingerprints.edited_versions(documents(spark, ODD)).collect()
    assert len({row.fingerprint for row in found if row.doc_id in (1, 4)}) == 1
    assert len(found) == len(ODD)


def test_ids_with_gaps(spark):
    rnd = random.Random(5)
    ids = rnd.sample(range(-(10**12), 10**12), 60) + list(range(1000, 1060)) + [2**63 - 1, -(2**63)]
    check(spark, [(i, "\n".join(f"line {rnd.randrange(40)}" for _ in range(rnd.randrange(40)))) for i in ids])


def test_differences_of_all_sizes(spark):
    rnd = random.Random(7)
    rows = []
    for n in (0, 1, 2, 5, 20, 100, 700):
        for changed in (0, 1, 4, 40, 600):
            a = [rnd.getrandbits(62) for _ in range(n)]
            b = a[changed:] + [rnd.getrandbits(62) for _ in range(changed)]
            rows.append((a, b))
    df = spark.createDataFrame(rows, "a_digests array<long>, b_digests array<long>")
    df = df.withColumns({f"{x}_cells": fingerprints.sketch(F.col(f"{x}_digests")) for x in "ab"})
    for row in fingerprints.with_difference(df, "a_", "b_", "d").collect():
        a, b = set(row.a_digests), set(row.b_digests)
        assert sorted(row.d.removed) == sorted(a - b)
        assert sorted(row.d.added) == sorted(b - a)


def test_empty_table(spark):
    assert fingerprints.edited_versions(documents(spark, [])).count() == 0
