"""Token counts, packing and the SentencePiece codec against the libraries."""

import hashlib
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ballstats.llm import packing, sentencepiece_codec, token_counts, tokens
from tests.llm.helpers import ODD, as_rows, documents

TOKENIZER = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))
PIECES = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(sentencepiece_codec.MODEL))
TEXTS = ["don't  stop", "a  b\n\n c", " ", "''''s 've", "ab" * 200, "日本語 текст", "x<|endoftext|>y", "՘ ².  z", "1,000.5%"]


def ids(text):
    return TOKENIZER.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def counts():
    return token_counts.prefix_counts(public_tokenizers.path(tokens.VOCABULARY))


def test_counts_at_every_prefix(counts):
    for text in TEXTS:
        every = counts.indexed(text).every()
        assert every == [len(ids(text[:k])) for k in range(len(text) + 1)]
        for budget in range(8):
            assert counts.indexed(text).fits(budget) == max(k for k, n in enumerate(every) if n <= budget)


def test_borders_are_those_of_the_merges(counts):
    rnd = random.Random(0)
    known = [t for t in rnd.sample(sorted(counts.whole), 800) if counts.merged(t) == [t]]
    for _ in range(4000):
        left, right = rnd.choice(known), rnd.choice(known)
        assert counts.follows(left, right) == (counts.merged(left + right) == [left, right])


def test_token_counts(spark):
    found = token_counts.token_counts(documents(spark, ODD), limit=8)
    want = [(i, len((t or "").encode()), len(ids(t or "")), len(ids(t or "")) > 8) for i, t in ODD]
    assert as_rows(found, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(want, key=repr)


def test_ids_of_every_character_class():
    chars = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}1 {c}.{c}\n" for c in chars[k : k + 50]) for k in range(0, len(chars), 50)]
    got = tokens.vocabulary(public_tokenizers.path(tokens.VOCABULARY)).encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [ids(t) for t in texts]


def test_packing(spark):
    docs = documents(spark, ODD + [(10 + k, "word " * (37 * k % 900)) for k in range(120)])
    rows = packing.packed(docs, capacity=64).collect()
    by_doc = {}
    for row in rows:
        by_doc.setdefault(row.doc_id, []).append(row)
    for doc_id, text in {i: t for i, t in ODD}.items():
        whole = [*ids(text or ""), packing.END_ID]
        copies = sum(i == doc_id for i, _ in ODD)
        got = sorted(by_doc[doc_id], key=lambda r: r.start)
        assert sum(r.length for r in got) == copies * len(whole)
        for r in got:
            part = np.array(whole[r.start : r.start + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part)
            assert r.length == 64 or r.piece == 0
    placed = {}
    for row in rows:
        placed.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for parts in placed.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(row.length for row in rows)
    assert len(placed) <= total / 64 * 1.05 + 4


def test_packing_of_nothing(spark):
    assert packing.packed(documents(spark, [])).count() == 0


def test_best_fit_closes_the_fullest():
    fit = packing.BestFit(10, 2)
    assert [fit.place(n) for n in (6, 7, 8)] == [(0, 0), (1, 0), (2, 0)]  # 2, the fullest, is closed
    assert fit.place(2) == (1, 7) and fit.place(4) == (0, 6) and fit.place(1) == (1, 9)


def test_sentencepiece(spark):
    rows = ODD + [(100 + k, t) for k, t in enumerate(TEXTS)] + [(200, "\x00a"), (201, "<s>a</s> <0x41>"), (202, " ​ a  ")]
    want = []
    for doc_id, text in rows:
        own = PIECES.encode(text or "", add_bos=True, add_eos=True)
        digest = lambda data: hashlib.sha256(data).hexdigest()
        want.append((doc_id, len(own), digest(np.array(own, "<u4").tobytes()), digest(PIECES.decode(own).encode())))
    found = sentencepiece_codec.digests(documents(spark, rows))
    assert as_rows(found, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    whole = sentencepiece_codec.encoded(documents(spark, rows)).collect()
    codec = sentencepiece_codec.codec(public_tokenizers.path(sentencepiece_codec.MODEL))
    assert all(codec.decode(np.frombuffer(row.ids, "<u4").tolist()) == row.decoded for row in whole)


def test_empty_tables(spark):
    empty = documents(spark, [])
    assert token_counts.token_counts(empty).count() == sentencepiece_codec.digests(empty).count() == 0


def test_budgets_of_long_words(counts):
    rnd = random.Random(9)
    word = "".join(rnd.choice("abcdefghijklmnop") for _ in range(300))
    for text in (word, f"x {word} y", "1" * 200, "?!" * 100, f"'{word}'s 12{word}", "é" * 200, " " * 50 + word):
        own = counts.indexed(text)
        every = [len(ids(text[:n])) for n in range(len(text) + 1)]
        assert own.every() == every
        for budget in (0, 1, 5, 40, 150, 10**6):
            assert own.fits(budget) == max(k for k, n in enumerate(every) if n <= budget)
    begin = time.perf_counter()
    long = counts.indexed(f"see {''.join(rnd.choice('abcdefghijklmnop') for _ in range(100_000))} there")
    assert long.own.counts([long.text]) == [len(ids(long.text))]
    assert len(ids(long.text[: long.fits(512)])) <= 512
    assert time.perf_counter() - begin < 20
