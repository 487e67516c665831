"""Number of tokens of a piece vocabulary (byte-pair merges over characters).

The merges are compiled into a deterministic transducer whose transitions carry the number
of tokens they emit. No piece of such a vocabulary goes on past the start of a run of
spaces, so there the machine is in its start state whatever came before: the state map of
the stretch between two such places is a constant and a count, and composing the maps of
neighbouring stretches is adding. The counts of all different stretches of a slice are
taken side by side, spread to their places and composed by one prefix scan over the slice;
a text's count is the difference of the scan at its ends.

Characters outside the vocabulary count as their UTF-8 bytes. Null counts as an empty text,
which has no tokens. Texts of any length are read whole. Repeated rows each get their own
count; columns other than the two named ones are not carried along; tables without rows
give empty results.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from navloom.llm.common import picked, raw_texts, text_slices
from navloom.llm.transducer import MergeRules, Transducer

SPACE = "▁"
MANY_SPACES = re.compile("^ |  | $").search
LONE_SPACE = re.compile("(?<=[^ ]) (?=[^ ])")


def read_pieces(path: str) -> dict[str, int]:
    """Pieces of a model file with their merge order.

    Only models that leave the text as it is, but for a space put before it, are read.
    """
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    how, trained = model.normalizer_spec, model.trainer_spec
    plain = how.name == "identity" and not how.precompiled_charsmap
    if not plain or not how.add_dummy_prefix or how.remove_extra_whitespaces:
        raise ValueError("the model changes texts before it splits them")
    if trained.model_type != 2 or not trained.byte_fallback:
        raise ValueError("not a byte-pair model with byte fallback")
    normal = [p for p in model.pieces if p.type == 1]
    if {p.type for p in model.pieces} - {1, 2, 3, 6}:
        raise ValueError("the model has pieces that are matched before the merges")
    if any(SPACE in p.piece.lstrip(SPACE) for p in normal):
        raise ValueError("a piece goes on past a space")
    by_score: dict[float, list[str]] = {}
    for p in normal:
        by_score.setdefault(-p.score, []).append(p.piece)
    ties = [pieces for pieces in by_score.values() if len(pieces) > 1]
    if any(set(piece) != {SPACE} for pieces in ties for piece in pieces):
        raise ValueError("pieces of equal score are merged from left to right")
    # Runs of spaces: merged from the left or shortest first, the result is the same.
    ordered = sorted(normal, key=lambda p: (-p.score, len(p.piece)))
    return {p.piece: i for i, p in enumerate(ordered)}


class Counter:
    """Counts of texts; one per worker process."""

    def __init__(self, order: dict[str, int]):
        numbers = {piece: i for i, piece in enumerate(order)}
        self.machine = Transducer(MergeRules(order), chr, numbers)
        self.known = np.zeros(0x110000, bool)
        self.known[[ord(p) for p in order if len(p) == 1]] = True

    def texts(self, texts: list[str]) -> np.ndarray:
        numbers: dict[str, int] = {}
        index, counts = [], [0]
        for text in texts:
            if text:
                text = text.replace(SPACE, " ")
                words = text.split(" ") if not MANY_SPACES(text) else LONE_SPACE.split(text)
                index.extend([numbers.setdefault(word, len(numbers)) for word in words])
            counts.append(len(index))
        tokens = self.units(list(numbers))
        scan = np.concatenate([[0], np.cumsum(tokens[np.array(index, np.int64)])])
        return np.diff(scan[counts])

    def units(self, units: list[str]) -> np.ndarray:
        """Tokens of each unit with a space put before it."""
        text = " " + " ".join(units) if units else ""
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = np.array([len(unit) + 1 for unit in units], np.int64)
        unit = np.repeat(np.arange(len(units)), sizes)
        codes[codes == ord(" ")] = ord(SPACE)
        known = self.known[codes]
        odd = np.flatnonzero(~known)
        in_bytes = 1 + (codes[odd] > 0x7F) + (codes[odd] > 0x7FF) + (codes[odd] > 0xFFFF)
        total = np.bincount(unit[odd], in_bytes, len(units)).astype(np.int64)
        # Pieces: runs of known characters inside a unit.
        codes, unit, at = codes[known], unit[known], np.flatnonzero(known)
        if len(codes):
            first = np.concatenate([[True], (np.diff(at) > 1) | (np.diff(unit) > 0)])
            begin = np.flatnonzero(first)
            lengths = np.diff(np.concatenate([begin, [len(codes)]]))
            np.add.at(total, unit[begin], self.machine.count_many(codes, lengths))
        return total


_WORKERS: dict = {}


def _counter(packed: bytes) -> Counter:
    key = hash(packed)
    if key not in _WORKERS:
        _WORKERS.clear()
        _WORKERS[key] = Counter(pickle.loads(packed))
    return _WORKERS[key]


def count_tokens(
    docs: DataFrame, order: dict[str, int], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_tokens``."""
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(order))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared.value)
        for part in text_slices(batches):
            raw = raw_texts(part.column("text"))
            tokens = counter.texts([t.decode() for t in raw])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([len(t) for t in raw], pa.int64()),
                    pa.array(tokens, pa.int64()),
                ],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    kind = dict(docs.dtypes)[id_col]
    return picked(docs, doc_id=id_col, text=text_col).mapInArrow(
        work, f"doc_id {kind}, n_bytes bigint, n_tokens bigint"
    )
