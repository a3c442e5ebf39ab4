"""Language identification by unigram pieces, summed over all segmentations.

The pieces of a public vocabulary are fixed. Per language, their probabilities are learned from words:
expected counts of pieces, summed over all ways to cut a word (forward and backward sums), ``ROUNDS``
times, starting from equal probabilities. A character that is no piece has a small fixed probability,
the same in all languages. A word's likelihood is the forward sum over all its segmentations; a text's
is the product over its words, and with equal priors that gives the languages' posteriors. So that
they say something for long texts too, likelihoods are tempered to ``WEIGHT`` words at most.

Learning takes at most ``PER_LANGUAGE`` documents of a language, chosen by a hash of the id, and all of
their words; every document is scored whole. Words are runs of letters (``str.isalpha``) of any length;
those of over ``WORD`` characters are summed one by one, in logarithms.

Edge cases: a null text, or one without a letter (number signs are none), is ``und`` with score 0; so is every text if nothing
could be learned; ties go to the language that comes first by name; documents without ``lang`` or id
are not learned from; repeated rows are all scored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ballstats.llm import common, tokens

PER_LANGUAGE = 500
ROUNDS = 3
WEIGHT = 40.0
#: Longest word, in characters, that is summed together with others.
WORD = 40
#: Words whose likelihoods a worker keeps.
MOST_KEPT = 250_000
_UNKNOWN = 1e-7
_TOGETHER = 1000
_TURN = np.uint64(0x9E3779B97F4A7C15)
_WORDS, _LETTERS = re.compile(r"[^\W\d_]+"), regex.compile(r"\p{L}+")
_BLANK = "▁"


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case."""
    found = _WORDS.findall(text.lower())
    # Signs like a raised 2 or a Roman numeral are word characters to ``re``, but no letters.
    return found if "".join(found).isalpha() else [word for run in found for word in _LETTERS.findall(run)]


def pieces_of(model: str) -> dict[str, int]:
    """The vocabulary's pieces of letters (after the blank), numbered as they come."""
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
    names = (library.id_to_piece(i) for i in range(library.get_piece_size()))
    fit = [p for p in names if p.removeprefix(_BLANK).isalpha() or p == _BLANK]
    return {p: k for k, p in enumerate(dict.fromkeys(p.lower() for p in fit))}


class Pieces:
    """The pieces by length, found in many words at once.

    Substrings of a length are looked up by a hash that runs over the characters of all words; what is
    found is compared with the piece's characters.
    """

    def __init__(self, pieces: dict[str, int]):
        self.longest = max(map(len, pieces), default=1)
        self.of_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for length in sorted({len(p) for p in pieces}):
            own = [p for p in pieces if len(p) == length]
            codes = self._codes(own, length)
            hashes = np.zeros(len(own), np.uint64)
            for k in range(length):
                hashes = hashes * _TURN + codes[:, k]
            order = np.argsort(hashes, kind="stable")
            if (np.diff(hashes[order]) == 0).any():
                raise ValueError("two pieces have one hash")
            self.of_length[length] = hashes[order], codes[order], np.array([pieces[own[k]] for k in order], np.int32)

    @staticmethod
    def _codes(words: list[str], most: int) -> np.ndarray:
        """Code points and one, by (word, place); 1 after a word's end."""
        return np.array(words, f"U{max(most, 1)}").view(np.uint32).reshape(len(words), max(most, 1)).astype(np.uint64) + np.uint64(1)

    def inside(self, spelled: list[str]) -> np.ndarray:
        """Piece numbers by (length, end, word); -1 where there is none."""
        most = max(map(len, spelled), default=0)
        longest = min(self.longest, most)
        at = np.full((longest + 1, most + 1, len(spelled)), -1, np.int32)
        if not most:
            return at
        codes = self._codes(spelled, most)
        running = np.zeros(codes.shape, np.uint64)
        for length in range(1, longest + 1):
            running = running[:, : most - length + 1] * _TURN + codes[:, length - 1 :]
            if length in self.of_length:
                hashes, known, number = self.of_length[length]
                place = np.minimum(np.searchsorted(hashes, running), len(hashes) - 1)
                word, start = np.nonzero(hashes[place] == running)
                piece = place[word, start]
                same = (codes[word[:, None], start[:, None] + np.arange(length)] == known[piece]).all(1)
                at[length, start[same] + length, word[same]] = number[piece[same]]
        return at


class Lattice:
    """Segmentations of many words at once: piece numbers by (length, end, word); -1 where there is none."""

    def __init__(self, words: list[str], pieces: Pieces):
        spelled = [_BLANK + word for word in words]
        self.size = np.array([len(s) for s in spelled], int)
        self.at = pieces.inside(spelled)

    def steps(self, p: np.ndarray, end: int) -> list[tuple[int, np.ndarray]]:
        """For pieces of each length that end here: their probabilities (word, language)."""
        out = []
        for length in range(1, min(len(self.at) - 1, end) + 1):
            k = self.at[length, end]
            if length > 1 and k.max() < 0:
                continue
            value = np.where((k >= 0)[:, None], p[k], _UNKNOWN if length == 1 else 0.0)
            out.append((length, value))
        return out

    def forward(self, p: np.ndarray) -> np.ndarray:
        """Sums over all segmentations of every prefix: (place, word, language)."""
        sums = np.zeros((self.at.shape[1], len(self.size), p.shape[1]))
        sums[0] = 1.0
        for end in range(1, len(sums)):
            for length, value in self.steps(p, end):
                sums[end] += sums[end - length] * value
        return sums

    def likelihood(self, p: np.ndarray) -> np.ndarray:
        """Logarithm of each word's probability in each language."""
        if not len(self.size):
            return np.zeros((0, p.shape[1]))
        sums = self.forward(p)
        return np.log(np.maximum(sums[self.size, np.arange(len(self.size))], 1e-300))

    def expected(self, p: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected counts of pieces (piece, language), words weighted by ``weight`` (word, language)."""
        forward = self.forward(p)
        everyone = np.arange(len(self.size))
        total = np.maximum(forward[self.size, everyone], 1e-300)
        backward = np.zeros_like(forward)
        backward[self.size, everyone] = 1.0
        counts = np.zeros_like(p)
        for end in range(len(forward) - 1, 0, -1):
            for length, value in self.steps(p, end):
                backward[end - length] += backward[end] * value
                k = self.at[length, end]
                share = forward[end - length] * value * backward[end] / total * weight
                np.add.at(counts, k[k >= 0], share[k >= 0])
        return counts


class Long:
    """Segmentations of one long word, by the end of their last piece; sums are kept in logarithms."""

    def __init__(self, word: str, pieces: Pieces):
        spelled = _BLANK + word
        self.ending: list[list[tuple[int, int]]] = [[] for _ in range(len(spelled) + 1)]
        at = pieces.inside([spelled])[:, :, 0]
        for length, end in zip(*np.nonzero(at >= 0), strict=True):
            self.ending[end].append((int(length), int(at[length, end])))

    def steps(self, logs: np.ndarray, end: int) -> list[tuple[int, int, np.ndarray]]:
        """(length, piece, logarithms of its probabilities); -1 for a character that is no piece."""
        found = [(length, k, logs[k]) for length, k in self.ending[end]]
        if all(length > 1 for length, _, _ in found):
            found.append((1, -1, np.full(logs.shape[1], np.log(_UNKNOWN))))
        return found

    def forward(self, logs: np.ndarray) -> np.ndarray:
        sums = np.zeros((len(self.ending), logs.shape[1]))
        for end in range(1, len(sums)):
            sums[end] = np.logaddexp.reduce([sums[end - length] + value for length, _, value in self.steps(logs, end)])
        return sums

    def likelihood(self, p: np.ndarray) -> np.ndarray:
        return self.forward(np.log(p))[-1]

    def expected(self, p: np.ndarray, weight: np.ndarray) -> np.ndarray:
        logs = np.log(p)
        forward, counts = self.forward(logs), np.zeros_like(p)
        backward = np.full_like(forward, -np.inf)
        backward[-1] = 0.0
        for end in range(len(forward) - 1, 0, -1):
            for length, k, value in self.steps(logs, end):
                start = end - length
                backward[start] = np.logaddexp(backward[start], backward[end] + value)
                if k >= 0:
                    counts[k] += np.exp(forward[start] + value + backward[end] - forward[-1]) * weight
        return counts


def likelihoods(words: list[str], pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """Logarithm of each word's probability in each language."""
    out = np.zeros((len(words), p.shape[1]))
    # Words of like length together, so that little of a lattice is empty.
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    short = [i for i in order if len(words[i]) <= WORD]
    for j in range(0, len(short), _TOGETHER):
        some = short[j : j + _TOGETHER]
        out[some] = Lattice([words[i] for i in some], pieces).likelihood(p)
    for i in order[len(short) :]:
        out[i] = Long(words[i], pieces).likelihood(p)
    return out


def expectations(words: list[str], weight: np.ndarray, pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """Expected counts of pieces, words weighted by ``weight`` (word, language)."""
    total = np.zeros_like(p)
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    short = [i for i in order if len(words[i]) <= WORD]
    for j in range(0, len(short), _TOGETHER):
        some = short[j : j + _TOGETHER]
        total += Lattice([words[i] for i in some], pieces).expected(p, weight[some])
    for i in order[len(short) :]:
        total += Long(words[i], pieces).expected(p, weight[i])
    return total


@dataclass
class Model:
    languages: list[str]
    p: np.ndarray  # (piece, language)
    pieces: dict[str, int]

    def __post_init__(self) -> None:
        self.table = Pieces(self.pieces) if self.languages else None
        self.known = tokens.Kept(self._rows, MOST_KEPT)

    def __reduce__(self):
        return Model, (self.languages, self.p, self.pieces)

    def _rows(self, words: list[str]) -> list[np.ndarray]:
        return list(likelihoods(words, self.table, self.p))

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and posterior of each text."""
        if not self.languages:
            return [("und", 0.0)] * len(texts)
        words = [words_of(text) for text in texts]
        out = []
        for own in self.known.of(words):
            if not own:
                out.append(("und", 0.0))
                continue
            total = np.sum(own, axis=0) * min(1.0, WEIGHT / len(own))
            share = np.exp(total - total.max())
            best = int(np.argmax(share))
            out.append((self.languages[best], float(share[best] / share.sum())))
        return out


def _trainable() -> F.Column:
    return F.col("lang").isNotNull() & (common.crc_of_id("doc_id") % 4 != 2)


def fit(docs: DataFrame, model: str = "piece_bpe_32k.model", per_language: int = PER_LANGUAGE, rounds: int = ROUNDS) -> Model:
    """Learns from documents with a language outside the held-out quarter."""
    spark = docs.sparkSession
    pieces = pieces_of(model)
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang")).where(_trainable())
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    few = known.withColumn("rank", rank).where(F.col("rank") <= per_language).select("doc_id", "lang").distinct()
    # At most per_language rows of a language.
    chosen = common.id_and_text(docs).join(F.broadcast(few), "doc_id").select("lang", "text")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            total: dict[tuple[str, str], int] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for word in words_of(text or ""):
                    total[lang, word] = total.get((lang, word), 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.string())]
                + [pa.array(list(total.values()), pa.int64())],
                ["lang", "word", "n"],
            )

    counted = chosen.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    by_word = counted.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("n"))
    training = common.stored(by_word, "language-words")
    languages = sorted(row[0] for row in training.select(F.explode(F.map_keys("n"))).distinct().collect())
    if not languages:
        return Model([], np.zeros((len(pieces), 0)), pieces)
    p, table = np.full((len(pieces), len(languages)), 1.0 / len(pieces)), spark.sparkContext.broadcast(Pieces(pieces))
    for _ in range(rounds):
        spread = spark.sparkContext.broadcast(p)

        def expect(batches: Iterable[pa.RecordBatch], spread=spread) -> Iterable[pa.RecordBatch]:
            total = np.zeros_like(spread.value)
            for batch in batches:
                words = batch.column("word").to_pylist()
                counts = [dict(x) for x in batch.column("n").to_pylist()]
                weight = np.array([[c.get(lang, 0) for lang in languages] for c in counts], float).reshape(-1, len(languages))
                total += expectations(words, weight, table.value, spread.value)
            at = np.flatnonzero(total.sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int64()), pa.array([row.tolist() for row in total[at]], pa.list_(pa.float64()))], ["piece", "n"]
            )

        sums = [F.sum(F.col("n")[k]).alias(f"n{k}") for k in range(len(languages))]
        # One row per piece of the vocabulary at most.
        rows = training.mapInArrow(expect, "piece long, n array<double>").groupBy("piece").agg(*sums).collect()
        n = np.full(p.shape, 0.01)
        for row in rows:
            n[row[0]] += row[1:]
        p = n / n.sum(axis=0)
        spread.destroy()
    table.destroy()
    return Model(languages, p, pieces)


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: the predicted language and its posterior."""
    spread = docs.sparkSession.sparkContext.broadcast(model)

    def run(ids: list, texts: list[str]) -> dict[str, list]:
        found = spread.value.predict(texts)
        return {"doc_id": ids, "held_out": [None] * len(ids), "lang_pred": [x[0] for x in found], "score": [x[1] for x in found]}

    out = common.id_and_text(docs).mapInArrow(common.in_slices(run, _SCHEMA), common.ddl(_SCHEMA))
    return out.withColumn("held_out", F.coalesce(common.crc_of_id("doc_id") % 4 == 2, F.lit(False)))


def kept(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, as they are, whose text has a language, with a posterior of ``least`` or more."""
    spread = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for part in common.parts(batches):
            found = spread.value.predict([text or "" for text in part.column("text").to_pylist()])
            yield part.filter(pa.array([lang != "und" and score >= least for lang, score in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
