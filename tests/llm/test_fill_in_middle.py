"""Fill-in-the-middle against plain slicing."""

import hashlib

import pytest
import regex

from ballstats.llm import fill_in_middle
from tests.llm.helpers import ODD, as_rows, documents


def expected(rows):
    out = []
    for doc_id, text in rows:
        text = text or ""
        digits = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        h = [int(digits[8 * k : 8 * k + 8], 16) for k in range(4)]
        n, form, p, m, output = len(text), "plain", None, None, text
        if text and not any(mark in text for mark in ("<P>", "<S>", "<M>")) and h[2] % 100 < 90:
            a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
            form, p, m = ("spm" if h[3] % 100 < 20 else "psm"), a, b - a
            output = f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}" if form == "spm" else f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out.append((doc_id, n, form, p, m, sha(output), sha(text)))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def got(spark, rows):
    found = fill_in_middle.digests(documents(spark, rows))
    assert found.columns == COLUMNS
    return as_rows(found, *COLUMNS)


def test_against_slicing(spark):
    rows = [(k, ("Ünïcode 🙂\r\n\x00<P <S" + "x" * (k % 7)) * (k % 5)) for k in range(400)]
    assert got(spark, rows) == expected(rows)
    assert {row[2] for row in expected(rows)} == {"plain", "psm", "spm"}


def test_edge_cases(spark):
    rows = [*ODD, *((100 + k, text) for k, text in enumerate(("a<P>b", "<S>", "x<M>", "<M", "\n", "é")))]
    assert got(spark, rows) == expected(rows)
    assert got(spark, []) == []


def test_long_text_in_parts(spark, monkeypatch):
    rows = [(k, "aé🙂\n" * 60_000 + "x" * k) for k in range(4)]
    assert got(spark, rows) == expected(rows)


def test_other_units(spark):
    rows = [(k, f"one two  three {k} four ") for k in range(60)] + [(90, " leading")]
    found = fill_in_middle.transformed(documents(spark, rows), unit=r"\S+\s*").select("*", fill_in_middle.restored().alias("back"))
    texts = dict(rows)
    for row in found.collect():
        assert row.back == texts[row.doc_id]
        assert row.n == (None if row.doc_id == 90 else 5)
        if row.form != "plain":
            ends = {0, *regex.fullmatch(r"(\S+\s*)*", texts[row.doc_id]).ends(1)}
            assert {row.prefix_chars, row.prefix_chars + row.middle_chars} <= ends


@pytest.mark.parametrize("marks", [("<P>", "<P>", "<M>"), ("ab", "ba", "c"), ("", "a", "b"), ("aba", "x", "y")])
def test_marks_that_overlap(marks):
    with pytest.raises(ValueError):
        fill_in_middle.checked(marks)
