"""Toxicity and language identification: segments, sums over segmentations, held-out accuracy, edge cases."""

import itertools
import math
import random
import time
import zlib

import numpy as np
import pytest

from ballstats.llm import language_id, toxicity
from ballstats.llm.queries import table
from tests.llm.helpers import ODD, SF_DIR, as_rows, documents


def brute_segments(scores):
    """Disjoint maximal segments: the best one, then what is left and right of it."""
    best = max(((sum(scores[i:j]), -(j - i), i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=(0,))
    if best[0] <= 0:
        return []
    _, _, i, j = best
    right = [(a + j, b + j, s) for a, b, s in brute_segments(scores[j:])]
    return [*brute_segments(scores[:i]), (i, j, best[0]), *right]


def test_segments():
    rnd = random.Random(4)
    for _ in range(300):
        scores = [rnd.randrange(-9, 8) + rnd.random() / 100 for _ in range(rnd.randrange(14))]
        got = toxicity.segments(np.array(scores, float))
        want = brute_segments(scores)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert [s for *_, s in got] == pytest.approx([s for *_, s in want])


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def corpus(rnd, n):
    """Words of clean texts, and vile ones with a common beginning in some."""
    clean = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    rows, marks = [], []
    for k in range(n):
        words = [rnd.choice(clean) for _ in range(60)]
        toxic = int(k % 4 == 0)
        if toxic:
            for _ in range(3):
                words[rnd.randrange(60)] = "zorg" + rnd.choice(clean)[:3]
        rows.append((k, " ".join(words)))
        marks.append((k, 1, toxic))
    return rows, marks


def test_toxicity_of_unseen_words(spark):
    rows, marks = corpus(random.Random(1), 400)
    known = dict((i, t) for i, _, t in marks)
    found = toxicity.toxicity(documents(spark, rows), labels(spark, marks)).collect()
    held = [row for row in found if row.held_out]
    assert {row.doc_id for row in held} == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([row.predicted == known[row.doc_id] for row in held]) > 0.95
    assert all(row.predicted == int(row.score >= 0.5) and 0 <= row.score <= 1 for row in found)
    assert all((row.n_passages > 0) == bool(known[row.doc_id]) for row in held if row.predicted == known[row.doc_id])


def test_held_out_labels_are_not_learned_from(spark):
    rows, marks = corpus(random.Random(1), 200)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in marks]
    docs = documents(spark, rows)
    assert toxicity.fit(docs, labels(spark, marks)) == toxicity.fit(docs, labels(spark, turned))


@pytest.mark.parametrize("marks", [[], [(1, 1, 0), (2, 1, None), (None, 1, 1), (99, 1, 1), (6, 1, 7)]])
def test_toxicity_edge_cases(spark, marks):
    found = toxicity.toxicity(documents(spark, ODD), labels(spark, marks)).collect()
    assert len(found) == len(ODD) and all(row.predicted == 0 for row in found)
    docs = documents(spark, [])
    assert toxicity.toxicity(docs, labels(spark, marks)).count() == 0


def test_kept_rows_are_as_they_were(spark):
    rows, marks = corpus(random.Random(1), 100)
    docs = documents(spark, [*rows, (None, None), (1000, "")])
    model = toxicity.fit(docs, labels(spark, marks))
    kept = toxicity.kept(docs, model)
    assert kept.schema == docs.schema
    predicted = {row.doc_id for row in toxicity.scored(docs, model).collect() if row.predicted == 0}
    assert as_rows(kept, *docs.columns) == as_rows(docs.where(docs.doc_id.isin([x for x in predicted if x is not None]) | docs.doc_id.isNull()), *docs.columns)


def ways(word):
    """All segmentations of a word."""
    if not word:
        yield ()
    for k in range(1, len(word) + 1):
        for rest in ways(word[k:]):
            yield (word[:k], *rest)


def test_forward_sums_are_over_all_segmentations():
    rnd = random.Random(3)
    names = ["▁", *("".join(x) for n in (1, 2, 3) for x in itertools.product("ab", repeat=n)), "▁a", "▁ab"]
    pieces = {p: k for k, p in enumerate(names)}
    p = np.array([[rnd.random() for _ in range(2)] for _ in names])
    p /= p.sum(axis=0)
    words = ["a", "ab", "babba", "aac", "c"]
    value = lambda piece, k: p[pieces[piece], k] if piece in pieces else (language_id._UNKNOWN if len(piece) == 1 else 0.0)
    lattice = language_id.Lattice(words, language_id.Pieces(pieces))
    want = [[math.log(sum(math.prod(value(x, k) for x in way) for way in ways("▁" + w))) for k in range(2)] for w in words]
    assert np.allclose(lattice.likelihood(p), want)
    # Expected counts: of each segmentation its share.
    counts = np.zeros_like(p)
    for w in words:
        for k in range(2):
            shares = [(way, math.prod(value(x, k) for x in way)) for way in ways("▁" + w)]
            total = sum(s for _, s in shares)
            for way, s in shares:
                for x in way:
                    if x in pieces:
                        counts[pieces[x], k] += s / total
    assert np.allclose(lattice.expected(p, np.ones((len(words), 2))), counts)


def test_languages(spark):
    docs = table(spark, str(SF_DIR), "documents")
    found = language_id.predicted(docs, language_id.fit(docs, per_language=40))
    both = found.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(both) > 200
    assert np.mean([row.lang == row.lang_pred for row in both]) > 0.97
    assert all((zlib.crc32(str(row.doc_id).encode()) % 4 == 2) for row in both)


def test_language_edge_cases(spark):
    docs = documents(spark, ODD)
    found = language_id.predicted(docs, language_id.fit(docs)).collect()
    by_id = {row.doc_id: row for row in found}
    assert len(found) == len(ODD)
    assert all((row.lang_pred, row.score) == ("und", 0.0) for row in (by_id[2], by_id[3], by_id[7]))
    assert by_id[6].lang_pred == by_id[None].lang_pred == "en"
    nothing = language_id.fit(docs.where("false"))
    assert {row.lang_pred for row in language_id.predicted(docs, nothing).collect()} == {"und"}
    kept = language_id.kept(docs, language_id.fit(docs))
    assert kept.schema == docs.schema and kept.count() == len(ODD) - 3


def test_long_words_are_summed_whole(monkeypatch):
    pieces = language_id.pieces_of("piece_bpe_32k.model")
    table, rnd = language_id.Pieces(pieces), np.random.default_rng(3)
    p = rnd.random((len(pieces), 3))
    p /= p.sum(axis=0)
    words = ["haus", "straßenbahn", "x", "日本語", "internationalisation" * 2, "ñandú"]
    weight = rnd.random((len(words), 3))
    short = language_id.likelihoods(words, table, p), language_id.expectations(words, weight, table, p)
    monkeypatch.setattr(language_id, "WORD", 0)
    long = language_id.likelihoods(words, table, p), language_id.expectations(words, weight, table, p)
    for a, b in zip(short, long, strict=True):
        assert np.allclose(a, b, rtol=1e-9)
    twice = language_id.likelihoods(["ab" * 1500, "ab" * 1499 + "xq"], table, p)
    assert np.isfinite(twice).all() and not np.allclose(twice[0], twice[1])


def test_letters_only():
    assert language_id.words_of("²½ Ⅷ x² a_b 3c ÑÁ l'été") == ["x", "a", "b", "c", "ñá", "l", "été"]
    assert language_id.words_of("²½ Ⅷ _ 12") == []


def test_texts_without_letters(spark):
    rows = [(k, "das haus und der hund" if k % 2 else "the house and the dog") for k in range(20)] + [(90, "²½ Ⅷ"), (91, "⑦ 三")]
    docs = spark.createDataFrame([(i, t, "de" if i % 2 else "en") for i, t in rows], "doc_id long, text string, lang string")
    found = {row.doc_id: row for row in language_id.predicted(docs, language_id.fit(docs.where("doc_id < 90"))).collect()}
    assert (found[90].lang_pred, found[90].score) == ("und", 0.0)
    assert found[91].lang_pred in ("de", "en")
    assert all(found[i].lang_pred == ("de" if i % 2 else "en") for i in range(20))


def test_segments_take_linear_time():
    scores = np.tile([1.0, -0.9], 50_000) + np.arange(100_000) * 1e-7
    for given in (scores, -scores, scores[::-1], np.where(scores > 0, 1.0, -2.0)):
        begin = time.perf_counter()
        toxicity.segments(given)
        assert time.perf_counter() - begin < 2
