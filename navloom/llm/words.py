"""Words of many texts at once, from the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from navloom.llm.common import text_slices

#: Kinds of bytes: part of a word, between words, between pieces of text.
WORD, GAP, BREAK = 0, 1, 2
#: A to Z in lower case, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def kinds(gaps: bytes, breaks: bytes = b"") -> np.ndarray:
    """The kind of each byte. All parts of a character beyond ASCII are of one kind."""
    table = np.full(256, WORD, np.uint8)
    table[np.frombuffer(gaps, np.uint8)] = GAP
    table[np.frombuffer(breaks, np.uint8)] = BREAK
    return table


@dataclass
class Words:
    """Words of texts in order: ``code`` is the place of a word in ``vocabulary`` (binary)."""

    vocabulary: pa.Array
    code: np.ndarray
    #: The text of each word, by its place in the column.
    text: np.ndarray
    #: Number of each word's piece; pieces do not cross texts.
    piece: np.ndarray
    #: Place of each text's first word, and the end of the last.
    first: np.ndarray


def split_words(column: pa.Array, table: np.ndarray) -> Words:
    """Lower-cased words of a column of texts, below 2 GiB; null is a text without words."""
    column = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    data = LOWER[data]
    kind = table[data]
    inside = kind == WORD
    # A text starts a word of its own, whatever stands before it in the column.
    starts_text = np.zeros(len(data) + 1, bool)
    starts_text[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | starts_text[1:-1]
    begin = np.flatnonzero(begins)
    # Word bytes alone: the length of a word is the way to the next one's first byte.
    ends = np.append(np.cumsum(inside, dtype=np.int32)[begin] - 1, inside.sum()).astype(np.int64)
    values = pa.py_buffer(np.ascontiguousarray(data[inside]))
    words = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(ends), values])
    coded = words.dictionary_encode()
    text = np.searchsorted(offsets, begin, "right") - 1
    broken = np.cumsum(kind == BREAK, dtype=np.int32)[begin]
    first = np.searchsorted(text, np.arange(len(column) + 1))
    new = np.zeros(len(begin), bool)
    new[1:] = (broken[1:] != broken[:-1]) | (text[1:] != text[:-1])
    return Words(coded.dictionary, coded.indices.to_numpy(), text, np.cumsum(new), first)


def segments(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Batches brought together, and cut, to about so many bytes of text, or one long text."""
    held, total = [], 0
    for part in text_slices(batches, column):
        length = pc.sum(pc.binary_length(part.column(column))).as_py() or 0
        if held and total + length > size:
            yield pa.concat_batches(held)
            held, total = [], 0
        held.append(part)
        total += length
    if held:
        yield pa.concat_batches(held)
