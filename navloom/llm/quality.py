"""Quality by a factorisation machine.

A text becomes hashed words and shapes of words, statistics of its structure, and its
length. The machine adds to their linear weights the interaction of every pair, as the
product of two short vectors; the sum over all pairs is half of the square of the sum less
the sum of squares, so a text is scored in time linear in its features. It is trained by
AdaGrad in the driver, on at most ``SAMPLE`` labelled rows. Their features are made in
tasks, at most ``2 * WIDTH`` per text of any length, and only these numbers reach the driver;
scoring is one pass over all rows with the fixed-size model broadcast.

Null and empty texts get the score of a text without words. Texts are read whole; repeated
rows get equal scores; columns other than the named ones, labels, language, source and id
are never inputs; tables without rows give empty results. Without labels of both classes
every score is the share of label 1 (smoothed).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from xxhash import xxh32_intdigest

from navloom.llm.common import give_back, picked, raw_texts, text_slices
from navloom.llm.labelled import ORDER, known_texts

#: Most labelled rows that the machine is trained on.
SAMPLE = 6_000
#: Hashed features, and the length of their vectors.
WIDTH, RANK = 1 << 15, 6
EPOCHS, STEP, DECAY = 12, 0.1, 1e-4

#: Kinds of bytes: lower and upper case letters, digits, blanks, line ends, punctuation, symbols.
_KINDS = np.zeros(256, np.int64)
_KINDS[[b for b in range(256) if chr(b) in "abcdefghijklmnopqrstuvwxyz" or b > 127]] = 1
_KINDS[[b for b in range(256) if chr(b) in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = 2
_KINDS[[b for b in range(256) if chr(b) in "0123456789"]] = 3
_KINDS[[b for b in range(256) if chr(b) in " \t\r\v\f"]] = 4
_KINDS[ord("\n")] = 5
_KINDS[[b for b in range(256) if chr(b) in ".,;:!?'\"-()"]] = 6
N_KINDS = 7
STATISTICS = N_KINDS + 8

_SHAPES = [(re.compile(p), r) for p, r in ((rb"[a-z\x80-\xff]+", b"a"), (rb"[A-Z]+", b"A"), (rb"[0-9]+", b"0"))]


def _shape(word: bytes) -> bytes:
    for pattern, mark in _SHAPES:
        word = pattern.sub(mark, word)
    return word[:8]


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers and values of all features one text after the other, and the texts' bounds.

    The statistics are the first features of every text; words and shapes follow, each
    kind scaled to length one. Words of equal hash are one feature.
    """
    known: dict[bytes, tuple[int, int]] = {}
    numbers, values, bounds, statistics = [], [], [0], []
    room = WIDTH - STATISTICS
    for text in texts:
        words = text.split()
        n, shapes, found = len(words), Counter(), Counter(words)
        hashed = []
        for word, count in found.items():
            both = known.get(word)
            if both is None:
                both = known[word] = (
                    STATISTICS + xxh32_intdigest(word.lower(), 1) % room,
                    STATISTICS + xxh32_intdigest(_shape(word), 2) % room,
                )
            hashed.append(both[0])
            shapes[both[1]] += count
        kinds = np.bincount(_KINDS[np.frombuffer(text, np.uint8)], minlength=N_KINDS)
        size = max(1, len(text))
        common = max(found.values(), default=0)
        statistics.append([
            *(kinds / size),
            1.0,
            np.log1p(len(text)) / 10,
            np.log1p(n) / 10,
            len(found) / max(1, n),
            common / max(1, n),
            sum(map(eq, words, words[1:])) / max(1, n - 1),
            min(1.0, size / max(1, n) / 20),
            min(1.0, kinds[5] / max(1, n) * 10),
        ])
        weights = np.sqrt(np.fromiter(shapes.values(), np.float64, len(shapes)))
        weights /= max(1e-9, float(np.sqrt((weights**2).sum())))
        once, times = np.unique(np.array(hashed, np.int64), return_counts=True)
        numbers += [np.arange(STATISTICS), once, np.fromiter(shapes, np.int64, len(shapes))]
        values += [np.array(statistics[-1]), times / np.sqrt(max(1, len(hashed))), weights]
        bounds.append(bounds[-1] + STATISTICS + len(once) + len(shapes))
    return np.concatenate(numbers), np.concatenate(values), np.array(bounds)


class Machine:
    def __init__(self, base: float) -> None:
        generator = np.random.default_rng(7)
        self.base = base
        self.linear = np.zeros(WIDTH)
        self.vectors = generator.normal(0, 0.05, (WIDTH, RANK))

    def raw(self, numbers: np.ndarray, values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Scores before the logistic, by the sum of squares identity."""
        scaled = self.vectors[numbers] * values[:, None]
        sums = np.add.reduceat(scaled, bounds[:-1])
        squares = np.add.reduceat((scaled**2).sum(1), bounds[:-1])
        linear = np.add.reduceat(self.linear[numbers] * values, bounds[:-1])
        return self.base + linear + 0.5 * ((sums**2).sum(1) - squares)

    def scores(self, numbers, values, bounds) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(numbers, values, bounds), -30, 30)))

    def train(self, numbers: np.ndarray, values: np.ndarray, bounds: np.ndarray, labels: np.ndarray) -> None:
        generator = np.random.default_rng(11)
        past = [np.full(WIDTH, 1e-3), np.full((WIDTH, RANK), 1e-3), 1e-3]
        for _ in range(EPOCHS):
            order = generator.permutation(len(labels))
            for start in range(0, len(order), 64):
                rows = order[start : start + 64]
                sizes = bounds[rows + 1] - bounds[rows]
                ends = np.cumsum(sizes)
                at = np.repeat(bounds[rows] - (ends - sizes), sizes) + np.arange(ends[-1])
                self._step(numbers[at], values[at], np.concatenate([[0], ends]), labels[rows], past)

    def _step(self, numbers, values, bounds, labels, past) -> None:
        error = (self.scores(numbers, values, bounds) - labels) / len(labels)
        spread = np.repeat(error, np.diff(bounds)) * values
        scaled = self.vectors[numbers] * values[:, None]
        sums = np.repeat(np.add.reduceat(scaled, bounds[:-1]), np.diff(bounds), axis=0)
        used, which = np.unique(numbers, return_inverse=True)
        linear = np.bincount(which, spread) + DECAY * self.linear[used]
        pulls = spread[:, None] * (sums - scaled)
        vectors = np.stack([np.bincount(which, pulls[:, f]) for f in range(RANK)], 1)
        vectors += DECAY * self.vectors[used]
        past[0][used] += linear**2
        past[1][used] += vectors**2
        past[2] += error.sum() ** 2
        self.linear[used] -= STEP * linear / np.sqrt(past[0][used])
        self.vectors[used] -= STEP * vectors / np.sqrt(past[1][used])
        self.base -= STEP * error.sum() / np.sqrt(past[2])


def _with_features(texts: DataFrame) -> DataFrame:
    """Rows of ``known_texts`` with ``numbers, values`` instead of the text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            numbers, values, bounds = features(raw_texts(part.column("text")))
            offsets = pa.array(bounds, pa.int32())
            lists = [
                pa.ListArray.from_arrays(offsets, pa.array(numbers, pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(values, pa.float32())),
            ]
            rest = part.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays([*rest.columns, *lists], [*rest.schema.names, "numbers", "values"])

    kind = dict(texts.dtypes)["doc_id"]
    schema = f"id_hash bigint, doc_id {kind}, text_hash bigint, label int, numbers array<int>, values array<float>"
    return texts.mapInArrow(work, schema)


def trained(docs: DataFrame, labels: DataFrame, label: str, train: Column, bound: int = SAMPLE) -> Machine:
    made = _with_features(known_texts(docs, labels, label, train, bound))
    rows = made.orderBy(*ORDER).limit(bound).select("label", "numbers", "values").toArrow().combine_chunks()
    marks = rows.column("label").to_numpy().astype(float) if len(rows) else np.zeros(0)
    share = (marks.sum() + 1) / (len(marks) + 2)
    machine = Machine(float(np.log(share / (1 - share))))
    if 0 < marks.sum() < len(marks):
        numbers, values = (rows.column(c).combine_chunks() for c in ("numbers", "values"))
        bounds = np.concatenate([[0], np.cumsum(numbers.value_lengths().to_numpy())])
        machine.train(numbers.flatten().to_numpy(), values.flatten().to_numpy(), bounds, marks)
    else:
        machine.vectors[:] = 0
    del rows
    give_back()
    return machine


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, score``."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            scores = shared.value.scores(*features(raw_texts(part.column("text"))))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"]
            )

    kind = dict(docs.dtypes)[id_col]
    return picked(docs, doc_id=id_col, text=text_col).mapInArrow(
        work, f"doc_id {kind}, score double"
    )


def accepted(docs: DataFrame, machine: Machine, cut: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is at least ``cut``."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    # Python workers get plain names: others may hold dots or backticks.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = plain.columns[docs.columns.index(text_col)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, text):
            scores = shared.value.scores(*features(raw_texts(part.column(text))))
            yield part.filter(pa.array(scores >= cut))

    return plain.mapInArrow(work, plain.schema).toDF(*docs.columns)
