"""Toxic passages as maximal-scoring segments of token log-odds.

Learning: words of labelled documents are counted by the documents that hold them, at every level of
a tree: all words, their first letters (``DEPTHS``), the whole word. The share of toxic documents at a
node has a Dirichlet prior of weight ``PRIOR`` around its parent's share, so that a rare word takes its
prefix's log-odds and a frequent one has its own. A word's score is its log-odds against all words less
``DRIFT``, so that ordinary text scores negative.

Scoring: one pass over a text's words finds all maximal segments (no part or extension of which scores
higher). By extreme-value theory the best segment of n words of ordinary text exceeds s with
probability 1 - exp(-K n e^(-lambda s)). Lambda and K are fitted by moments to the best segments of
clean training documents. A segment of significance under ``SIGNIFICANT`` is a toxic passage; the
document's evidence is the sum of its segments' logarithms of significance, and a logistic curve fitted
to training documents turns it into a score from 0 to 1. For both fits each half of the training
documents is scored by the tree of the other half.

The training sample is bounded: at most ``PER_CLASS`` documents of each label, chosen by a hash of the
id, so what is learned and broadcast is bounded too. Every document is scored whole.

Edge cases: a null or empty text, or one without letters, has no words and the lowest score; labels
that are null, other than 0 and 1, or without a document are ignored, repeated ones count once (1, if
they differ); without labels of both kinds every score is 0; repeated rows are all scored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballstats.llm import common

PER_CLASS = 4000
DEPTHS = (1, 2, 3, 4, 5, 6)
PRIOR = 2.0
DRIFT = 1.5
SIGNIFICANT = 0.01
#: A node is kept if so many documents have it; rarer words take their prefix's value.
LEAST_DOCUMENTS = 2
#: Words of longer length are cut for the tree; they keep their prefix's value in any case.
_WORD = re.compile(r"[^\W\d_]+")
_MOST = 60.0


def nodes_of(word: str) -> list[str]:
    """The word's places in the tree, from the root down; a whole word ends in a full stop."""
    return ["", *(word[:n] for n in DEPTHS if n < len(word)), word + "."]


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments as (first, one after the last, score), in linear time.

    Each segment keeps which one before it is the nearest with a lower sum before it: those between
    cannot be joined with any later one either, so that a search jumps over them.
    """
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    at_positive = np.flatnonzero(scores > 0)
    before, after = sums[at_positive].tolist(), sums[at_positive + 1].tolist()
    found: list[tuple[int, int, float, float, int]] = []  # first, end, sum before, sum at the end, nearest lower
    for k, low, high in zip(at_positive.tolist(), before, after, strict=True):
        first, j = k, len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= low:
                j = found[j][4]
            if j < 0 or found[j][3] >= high:
                break
            first, _, low, _, link = found[j]
            del found[j:]
            j = link
        found.append((first, k + 1, low, high, j))
    return [(a, b, y - x) for a, b, x, y, _ in found]


@dataclass
class Model:
    """What is broadcast: scores of nodes, the two numbers of the extreme-value law, the curve."""

    node: dict[str, float]
    lam: float = 1.0
    k: float = 1.0
    slope: float = 1.0
    middle: float = 1.0

    def __post_init__(self) -> None:
        self.seen: dict[str, float] = {}

    def word(self, word: str) -> float:
        """Log-odds of the deepest node of the word that is known, less the drift."""
        found = self.seen.get(word)
        if found is None:
            if len(self.seen) > 200_000:
                self.seen.clear()
            places = nodes_of(word)
            found = self.seen[word] = next(self.node[p] for p in reversed(places) if p in self.node) - DRIFT
        return found

    def passages(self, text: str) -> tuple[list[tuple[int, int, float]], int]:
        """Segments as (first word, one after the last, score), and the number of words."""
        words = _WORD.findall(text.lower())
        if not words:
            return [], 0
        seen = self.seen
        try:
            scores = np.array([seen[w] for w in words])
        except KeyError:
            scores = np.array([self.word(w) for w in words])
        return (segments(scores), len(words)) if scores.max() > 0 else ([], len(words))

    def evidence(self, found: list[tuple[int, int, float]], n: int) -> float:
        """Sum of -log10 of the segments' significance, as far as each is under 1 in 2."""
        total = 0.0
        for _, _, score in found:
            expected = self.k * n * math.exp(-min(self.lam * score, 700.0))
            p = -math.expm1(-expected) or 1e-300
            if p < 0.5:
                total -= math.log10(p)
        return min(total, _MOST)

    def score(self, evidence: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, self.slope * (evidence - self.middle)))))

    def significant(self, found: list[tuple[int, int, float]], n: int) -> list[tuple[int, int, float]]:
        return [x for x in found if -math.expm1(-self.k * n * math.exp(-min(self.lam * x[2], 700.0))) < SIGNIFICANT]


def _fit_tree(counts: Iterable[tuple[str, int, int]]) -> dict[str, float]:
    """Log-odds of nodes against the root, from their (name, toxic, all) document counts."""
    share: dict[str, float] = {}
    by_depth = sorted(counts, key=lambda x: (x[0].endswith("."), len(x[0])))
    for name, toxic, total in by_depth:
        if name == "":
            share[name] = (toxic + 0.5) / (total + 1.0)
            continue
        bare = name.removesuffix(".")
        above = [p for p in nodes_of(bare)[:-1] if p != name and p in share] if name.endswith(".") else [bare[:n] for n in (0, *DEPTHS) if n < len(bare) and bare[:n] in share]
        parent = share[above[-1]]
        share[name] = (toxic + PRIOR * parent) / (total + PRIOR)
    logit = lambda p: math.log(p / (1 - p))
    root = logit(share[""])
    return {name: logit(p) - root for name, p in share.items()}


def _pruned(tree: dict[str, float]) -> dict[str, float]:
    """Without the leaves that say about the same as what stands above them."""
    above = lambda name: next(tree[p] for p in reversed(nodes_of(name[:-1])[:-1]) if p in tree)
    return {name: x for name, x in tree.items() if not name.endswith(".") or abs(x - above(name)) > 0.1}


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and middle of the curve that fits labels ``y`` to evidence ``x`` (Newton steps, small ridge)."""
    a, b = 1.0, -1.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -50, 50)))
        w = p * (1 - p)
        g = np.array([((p - y) * x).sum() + 0.01 * a, (p - y).sum() + 0.01 * b])
        h = np.array([[(w * x * x).sum() + 0.01, (w * x).sum()], [(w * x).sum(), w.sum() + 0.01]])
        step = np.clip(np.linalg.solve(h, g), -0.5, 0.5)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    a = max(a, 0.05)
    return a, -b / a


def sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """Texts and labels of at most ``per_class`` training documents of each label."""
    known = (
        labels.where(F.col("toxic").isin(0, 1) & (common.crc_of_id("doc_id") % 5 != 0))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    # A limit in an order is cut in each task before rows are sent on; a rank per label would gather all of a label's.
    first = lambda toxic: known.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
    few = first(0).union(first(1)).select("doc_id", "toxic")
    # At most 2 * per_class rows of two numbers.
    return common.id_and_text(docs).join(F.broadcast(few), "doc_id").select(
        "text", "toxic", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int").alias("half")
    )


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Learns from rows of ``labels`` outside the held-out fifth only."""
    chosen = common.stored(sample(docs, labels, per_class), "toxicity-sample")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            total: dict[str, list[int]] = {}
            columns = (batch.column(name).to_pylist() for name in ("text", "toxic", "half"))
            for text, toxic, half in zip(*columns, strict=True):
                for name in {node for word in set(_WORD.findall(text.lower())) for node in nodes_of(word)}:
                    own = total.setdefault(name, [0, 0, 0, 0])
                    own[2 * half] += toxic
                    own[2 * half + 1] += 1
            arrays = [pa.array([x[k] for x in total.values()], pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), *arrays], ["node", "t0", "n0", "t1", "n1"])

    counted = (
        chosen.mapInArrow(count, "node string, t0 long, n0 long, t1 long, n1 long")
        .groupBy("node")
        .agg(*(F.sum(c).alias(c) for c in ("t0", "n0", "t1", "n1")))
    )
    enough = (F.col("n0") + F.col("n1") >= LEAST_DOCUMENTS) | (F.col("node") == "")
    nodes = [tuple(row) for row in counted.where(enough).collect()]  # bounded by the sample
    root = next((row for row in nodes if row[0] == ""), None)
    if root is None or not 0 < root[1] + root[3] < root[2] + root[4]:
        return Model({"": 0.0}, slope=1.0, middle=800.0)
    full = Model(_pruned(_fit_tree((name, t0 + t1, n0 + n1) for name, t0, n0, t1, n1 in nodes)))
    # The tree of each half, for the documents of the other.
    halves = [Model(_pruned(_fit_tree((row[0], row[k], row[k + 1]) for row in nodes if row[k + 1] or row[0] == ""))) for k in (3, 1)]
    spread = chosen.sparkSession.sparkContext.broadcast(halves)

    def best(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            texts, half = batch.column("text").to_pylist(), batch.column("half").to_pylist()
            found = [spread.value[h].passages(text) for text, h in zip(texts, half, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array([n for _, n in found], pa.int64())]
                + [pa.array([[s[2] for s in f] for f, _ in found], pa.list_(pa.float64()))],
                ["toxic", "n", "segments"],
            )

    rows = chosen.mapInArrow(best, "toxic int, n long, segments array<double>").collect()  # bounded by the sample
    spread.destroy()
    clean = [(max(row["segments"], default=0.0), row["n"]) for row in rows if row["toxic"] == 0 and row["n"]]
    highest = np.array([x for x, _ in clean] or [0.0])
    # Moments of the extreme-value law: spread pi / (lambda sqrt 6), mean (ln(K n) + 0.5772) / lambda.
    full.lam = float(math.pi / (math.sqrt(6) * max(highest.std(), 0.3)))
    length = np.mean([math.log(n) for _, n in clean]) if clean else 0.0
    full.k = float(math.exp(min(50.0, full.lam * highest.mean() - 0.5772 - length)))
    x = np.array([full.evidence([(0, 0, s) for s in row["segments"]], row["n"]) for row in rows])
    y = np.array([row["toxic"] for row in rows], float)
    slope, middle = _logistic(x, y)
    full.slope, full.middle = float(slope), float(max(middle, 0.05))
    return full


_SCORED = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32()), ("n_passages", pa.int32())]
)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: score, ``predicted`` (1 from 0.5 on), and the number of significant passages."""
    spread = docs.sparkSession.sparkContext.broadcast(model)

    def run(ids: list, texts: list[str]) -> dict[str, list]:
        own = spread.value
        found = [own.passages(text) for text in texts]
        score = [own.score(own.evidence(*x)) for x in found]
        return {
            "doc_id": ids,
            "held_out": [None] * len(ids),
            "score": score,
            "predicted": [int(x >= 0.5) for x in score],
            "n_passages": [len(own.significant(*x)) for x in found],
        }

    out = common.id_and_text(docs).mapInArrow(common.in_slices(run, _SCORED), common.ddl(_SCORED))
    return out.withColumn("held_out", F.coalesce(common.crc_of_id("doc_id") % 5 == 0, F.lit(False)))


def toxicity(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    return scored(docs, fit(docs, labels, per_class))


def kept(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, as they are, whose text is not toxic."""
    spread = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        own = spread.value
        for part in common.parts(batches):
            texts = part.column("text").to_pylist()
            yield part.filter(pa.array([own.score(own.evidence(*own.passages(text or ""))) < 0.5 for text in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
