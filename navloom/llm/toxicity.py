"""Toxic passages by maximum-scoring segments.

Tokens are words and their beginnings. The score of a token is its log-odds between toxic
and other texts, each with a Dirichlet prior in the proportion of the two, taken at the
cautious end of its standard error; a word scores as the best of its tokens. Every word
that does not stand out has one negative score, so that scores fall in clean text. A text's
passages are all its maximal scoring segments, found in one scan. How likely a clean text
holds a passage of some score is an extreme-value law: its decay solves the equation of
the moments of clean word scores, its height is set on the clean texts of the sample; the
chance grows with the length of the text. A text's passages are combined by adding
their evidence above chance, of which the logarithm is taken, and a logistic curve fitted to the sample gives the final score.

Training takes at most ``SAMPLE`` labelled rows; the words of two thirds are counted by
Spark, and the curves are set on the last third, which those words have not seen. Only
words that stand out are broadcast, fewer than the sample has words.

Null and empty texts have no passage. Texts are read whole; repeated rows get equal
results; columns other than the named ones, labels, language, source and id are never
inputs; tables without rows give empty results. Without labels of both classes every text
has the share of label 1 (smoothed) as score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from navloom.llm.common import picked, raw_texts, stored, text_slices
from navloom.llm.labelled import sample

#: Most labelled rows that words and curves are learnt from.
SAMPLE = 10_000
#: Weight of the prior in texts, and standard errors taken off a token's log-odds.
PRIOR, CAUTION = 4.0, 2.0
#: Log-odds from which a token stands out.
STANDS_OUT = 1.0
#: Letters of the beginnings of words.
STEMS = (4, 5, 6, 7)
#: Words whose scores a worker remembers.
REMEMBERED = 200_000
#: Score of a word that does not stand out.
OTHER = -0.5

#: Letters to lower case, ASCII marks and control characters to blanks.
_PLAIN = bytes(
    ord(chr(b).lower()) if chr(b).isalnum() or b > 127 else 32 for b in range(128)
) + bytes(range(128, 256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


def tokens(word: str) -> list[str]:
    """The word, and its beginnings marked by a star."""
    return [word, *(word[:n] + "*" for n in STEMS if len(word) >= n)]


class Scores(dict):
    """Scores of words by the odds of their tokens; zero if none stands out."""

    def __init__(self, odds: dict[str, float]):
        super().__init__()
        self.odds = odds

    def __missing__(self, word: bytes) -> float:
        found = (self.odds.get(t, 0.0) for t in tokens(word.decode("utf-8", "replace")))
        self[word] = score = max(found)
        return score


def segments(at: list[int], scores: list[float], other: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of a sequence as ``(start, end, score)``.

    ``at`` and ``scores`` are the positions with positive scores; all others have the
    score ``other``, below zero. One pass: each positive position opens a segment, which
    takes in an earlier one if that began lower and ended no higher than the new one ends.
    """
    found: list[tuple[int, int, float, float]] = []
    total, before = 0.0, 0
    for position, score in zip(at, scores):
        low = total + other * (position - before)
        high = low + score
        start, end = position, position + 1
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j -= 1
            if j < 0 or found[j][3] >= high:
                break
            start, low = found[j][0], found[j][2]
            del found[j:]
        found.append((start, end, low, high))
        total, before = high if end == position + 1 else total, position + 1
    return [(start, end, high - low) for start, end, low, high in found]


@dataclass
class Model:
    odds: dict[str, float] = field(default_factory=dict)
    decay: float = 1.0
    height: float = 1.0
    curve: tuple[float, float] = (0.0, 0.0)

    def passages(self, text: bytes) -> tuple[list[tuple[int, int, float]], int]:
        scores = self.__dict__.setdefault("_scores", Scores(self.odds))
        if len(scores) > REMEMBERED:
            scores.clear()
        found = [scores[word] for word in words(text)]
        at = [i for i, score in enumerate(found) if score]
        return segments(at, [found[i] for i in at], OTHER), len(found)

    def evidence(self, found: list[tuple[int, int, float]], n: int) -> float:
        """What the passages hold above what chance gives in a text of this length."""
        chance = np.log(self.height * max(1, n))
        return float(np.log1p(sum(max(0.0, self.decay * s - chance) for _, _, s in found)))

    def significant(self, found, n: int, level: float = 0.05) -> list[tuple[int, int, float]]:
        expected = [self.height * max(1, n) * np.exp(-self.decay * s) for _, _, s in found]
        return [p for p, e in zip(found, expected) if -np.expm1(-e) <= level]

    def score(self, evidence: np.ndarray) -> np.ndarray:
        a, b = self.curve
        return 1 / (1 + np.exp(-np.clip(a + b * evidence, -30, 30)))


def _decay(scores: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum(share * exp(decay * score)) = 1."""
    low, high = 0.0, 1e-3
    if not (scores > 0).any():
        return 1.0
    while (shares * np.exp(high * scores)).sum() < 1 and high < 64:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        if (shares * np.exp(middle * scores)).sum() < 1:
            low = middle
        else:
            high = middle
    return (low + high) / 2


def _curve(x: np.ndarray, y: np.ndarray, start: float) -> tuple[float, float]:
    """Logistic regression on one value by Newton steps, held by a weak prior.

    A step that does not lower the loss is halved.
    """
    theta = np.array([start, 0.0])
    design = np.stack([np.ones_like(x), x], 1)

    def loss(theta: np.ndarray) -> float:
        z = design @ theta
        return float((np.logaddexp(0, z) - y * z).sum() + 0.005 * (theta**2).sum())

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        pull = design.T @ (y - p) - 0.01 * theta
        bend = (design * (p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        step = np.linalg.solve(bend, pull)
        while abs(step).max() > 1e-9 and loss(theta + step) > loss(theta):
            step /= 2
        theta = theta + step
        if abs(step).max() < 1e-8:
            break
    return float(theta[0]), float(max(theta[1], 0.0))


def trained(docs: DataFrame, labels: DataFrame, label: str, train: Column, bound: int = SAMPLE) -> Model:
    # Read several times below. Words are learnt from two thirds, the curves from the last.
    everything = stored(sample(docs, labels, label, train, bound), "toxicity-sample")
    rows, rest = everything.where("third > 0"), everything.where("third = 0")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            sets = []
            for text in raw_texts(part.column("text")):
                known = {w.decode("utf-8", "replace") for w in words(text)}
                sets.append(list({token for word in known for token in tokens(word)}))
            arrays = pa.array(sets, pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([part.column("label"), arrays], ["label", "tokens"])

    # Tokens per text, not per place: a text's own repetitions are not evidence of their own.
    sets = rows.mapInArrow(count, "label int, tokens array<string>")
    sums = sets.select("label", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.sum("label").alias("toxic"), F.count("*").alias("all")
    )
    totals = rows.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count("*")).first()
    toxic_rows, n_rows = (float(v) for v in totals)
    share = (toxic_rows + 1) / (n_rows + 2)
    model = Model(curve=(float(np.log(share / (1 - share))), 0.0))
    if not 0 < toxic_rows < n_rows:
        return model
    inside = F.col("toxic") + PRIOR * toxic_rows / n_rows
    outside = F.col("all") - F.col("toxic") + PRIOR * (1 - toxic_rows / n_rows)
    odds = F.log(inside / outside) - float(np.log(toxic_rows / (n_rows - toxic_rows)))
    cautious = odds - F.lit(CAUTION) * F.sqrt(1 / inside + 1 / outside)
    standing = sums.select("token", cautious.alias("odds")).where(F.col("odds") > STANDS_OUT)
    chosen = standing.toArrow().to_pydict()
    model.odds = dict(zip(chosen["token"], chosen["odds"]))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How often each score comes in texts that are not toxic."""
        scores = Scores(shared.value.odds)
        for part in text_slices(batches):
            seen: Counter = Counter()
            for text, label in zip(raw_texts(part.column("text")), part.column("label").to_pylist()):
                if not label:
                    seen.update(round(scores[w], 2) for w in words(text))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.float64()), pa.array(list(seen.values()), pa.int64())],
                ["score", "n"],
            )

    shares = rest.mapInArrow(clean, "score double, n bigint").groupBy("score").agg(F.sum("n").alias("n"))
    shares = shares.toArrow().to_pydict()
    values, counts = np.array(shares["score"]), np.array(shares["n"], float)
    model.decay = _decay(np.where(values > 0, values, OTHER), counts / max(1.0, counts.sum()))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            both = [shared.value.passages(t) for t in raw_texts(part.column("text"))]
            lists = [[s for _, _, s in found] for found, _ in both]
            arrays = pa.array(lists, pa.list_(pa.float64())), pa.array([n for _, n in both], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("label"), *arrays], ["label", "scores", "n"])

    seen = rest.mapInArrow(best, "label int, scores array<double>, n bigint").toArrow().to_pydict()
    # Of an extreme-value law exp(-height * n * exp(-decay * s)), over the clean texts' best.
    powers = [
        n * np.exp(-model.decay * max(s, default=0.0))
        for s, n, l in zip(seen["scores"], seen["n"], seen["label"]) if not l and n
    ]
    model.height = len(powers) / max(1e-9, float(sum(powers)))
    evidence = np.array([
        model.evidence([(0, 0, x) for x in s], n) for s, n in zip(seen["scores"], seen["n"])
    ])
    model.curve = _curve(evidence, np.array(seen["label"], float), model.curve[0])
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` and ``passages``: ``start, end`` in words, and ``score``, of those
    that chance gives in at most one of twenty clean texts of the length."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part in text_slices(batches):
            both = [model.passages(t) for t in raw_texts(part.column("text"))]
            scores = model.score(np.array([model.evidence(*b) for b in both]))
            kept = [[dict(zip(("start", "end", "score"), p)) for p in model.significant(*b)] for b in both]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(scores, pa.float64()), pa.array(kept, spans)],
                ["doc_id", "score", "passages"],
            )

    kind = dict(docs.dtypes)[id_col]
    return picked(docs, doc_id=id_col, text=text_col).mapInArrow(
        work, f"doc_id {kind}, score double, passages array<struct<start:int,end:int,score:double>>"
    )
