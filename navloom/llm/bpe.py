"""Byte-level byte-pair encoding and decoding.

``encode`` splits each text by the vocabulary's pattern and runs every match through the
transducer of the merges (``transducer``); matches met again are looked up. ``decode``
joins the tokens' bytes and passes them through an incremental UTF-8 machine, so it can
work chunk by chunk on streams whose tokens end inside a character.

Null and empty texts have no tokens. Texts of any length are read whole; work and memory
are linear in them. Repeated rows each get their own result. Columns other than the two
named ones are not carried along. Tables without rows give empty results.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from navloom.llm.common import picked, text_slices
from navloom.llm.transducer import MergeRules, Transducer, gathered

#: Bytes of text encoded at once: the numbers of a slice take many times that.
SLICE_BYTES = 1_000_000
#: Tokens decoded at once.
CHUNK = 65_536

TWO_BLANKS = re.compile(r"\s\s|^\s|\s$").search
LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Tokens of a rank file: lines of base64 bytes and a number."""
    pairs = (line.split() for line in content.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


class Utf8Stream:
    """Incremental UTF-8: gives the complete characters, holds back an unfinished one.

    The state is the unfinished sequence, at most three bytes. Malformed bytes become
    U+FFFD, at the end also what is left unfinished.
    """

    def __init__(self) -> None:
        self.held = b""

    @staticmethod
    def _unfinished(data: bytes) -> int:
        """Bytes at the end that begin a character without ending it."""
        for back in range(1, min(4, len(data) + 1)):
            byte = data[-back]
            if byte >= 0xC0:
                whole = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                return back if back < whole else 0
            if byte < 0x80:
                return 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.held + data
        cut = len(data) - self._unfinished(data)
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


def decode_stream(chunks: Iterable[Iterable[int]], tokens: dict[int, bytes]) -> Iterator[str]:
    """Text of token ids that arrive in chunks."""
    stream = Utf8Stream()
    for chunk in chunks:
        yield stream.feed(b"".join(tokens[i] for i in chunk))
    yield stream.finish()


class Encoder:
    """Ids of texts; one per worker process.

    No match of a pattern that gives white space a match of its own, or one space to the
    word after it, goes on past a space between two other characters. So texts are cut
    there first, and each different unit of a slice is split and encoded once.
    """

    def __init__(self, content: bytes, pattern: str):
        ranks = read_ranks(content)
        self.split = regex.compile(pattern).findall
        symbols = [bytes([i]) for i in range(256)]
        self.machine = Transducer(MergeRules(ranks), symbols.__getitem__, ranks)

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text's ids start."""
        numbers: dict[str | tuple, int] = {}
        index, counts = [], [0]
        for text in texts:
            words = text.split(" ") if not TWO_BLANKS(text) else LONE_SPACE.split(text)
            # The first unit has no space before it; the others get theirs back below.
            index.append(numbers.setdefault((words[0],), len(numbers)))
            index.extend([numbers.setdefault(word, len(numbers)) for word in words[1:]])
            counts.append(len(index))
        units = (" " + unit if isinstance(unit, str) else unit[0] for unit in numbers)
        found = [self.split(unit) for unit in units]
        pieces = [piece.encode() for unit in found for piece in unit]
        codes = np.frombuffer(b"".join(pieces), np.uint8)
        sizes = np.array([len(p) for p in pieces], np.int64)
        ids, counted = self.machine.run_many(codes, sizes)
        # Ids per unit, from those per piece; then per text.
        ends = np.concatenate([[0], np.cumsum(counted)])
        bounds = ends[np.cumsum([0, *(len(unit) for unit in found)])]
        index = np.array(index, np.int64)
        ids, ends = gathered(ids, bounds[:-1][index], np.diff(bounds)[index])
        return ids, np.concatenate([[0], ends])[counts]


_WORKERS: dict = {}


def _encoder(content: bytes, pattern: str) -> Encoder:
    key = (hash(content), pattern)
    if key not in _WORKERS:
        _WORKERS.clear()
        _WORKERS[key] = Encoder(content, pattern)
    return _WORKERS[key]


def encode(
    docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and its token ids as array ``ids``."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value, pattern)
        for part in text_slices(batches, most=SLICE_BYTES):
            texts = [t or "" for t in part.column("text").to_pylist()]
            ids, starts = encoder.texts(texts)
            lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["doc_id", "ids"])

    kind = dict(docs.dtypes)[id_col]
    return picked(docs, doc_id=id_col, text=text_col).mapInArrow(
        work, f"doc_id {kind}, ids array<int>"
    )


def decode(encoded: DataFrame, ranks: bytes) -> DataFrame:
    """Adds ``decoded``, the text of ``ids``, to rows of ``doc_id, ids``; null ids: empty.

    Ids that the vocabulary lacks are an error.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = read_ranks(shared.value)
        top = max(vocabulary.values(), default=-1) + 1
        sizes, starts = np.full(top, -1, np.int64), np.zeros(top, np.int64)
        for token, rank in vocabulary.items():
            sizes[rank] = len(token)
        by_rank = sorted(vocabulary, key=vocabulary.__getitem__)
        known = sizes >= 0
        starts[known] = np.cumsum(sizes[known]) - sizes[known]
        flat = np.frombuffer(b"".join(by_rank), np.uint8)
        del vocabulary, by_rank

        def text(ids: np.ndarray) -> str:
            stream, out = Utf8Stream(), []
            for at in range(0, len(ids), CHUNK):
                some = ids[at : at + CHUNK]
                if some.min() < 0 or some.max() >= top or not known[some].all():
                    raise ValueError("a token id is not in the vocabulary")
                out.append(stream.feed(gathered(flat, starts[some], sizes[some])[0].tobytes()))
            out.append(stream.finish())
            return "".join(out)

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                lists = part.column("ids")
                values = lists.flatten().to_numpy(zero_copy_only=False)
                lengths = pc.fill_null(pc.list_value_length(lists), 0)
                ends = np.cumsum(lengths.to_numpy())
                texts = [text(values[b - n : b]) for b, n in zip(ends, lengths.to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), lists, pa.array(texts, pa.string())],
                    ["doc_id", "ids", "decoded"],
                )

    kind = dict(encoded.dtypes)["doc_id"]
    return encoded.select("doc_id", "ids").mapInArrow(
        work, f"doc_id {kind}, ids array<int>, decoded string"
    )
