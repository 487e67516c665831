"""Benchmark passages in training texts by a distributed positional inverted index.

The index stores, for each segment of texts (a few megabytes that one task has read), one
list of places per word: the texts and positions where it stands. It is written where the
texts are read and never moves as a whole.

Passages are found by intersecting lists. Each window of test words takes its two rarest words,
by their places in all texts; their lists, each shifted by the word's offset in the item, are
intersected per segment, which leaves the few alignments of an item with a text that can
hold the window. Only for those the lists of the other words are asked, at the one place where
each must stand. Unbroken runs of found words as long as a window are the exact matches.
Windows with a word that no text has are left out at once. :func:`near_matches` asks
instead where the rarest words of an item stand close together in any order.

Texts and items are lower-cased (A to Z) and cut into words of digits, letters and characters
beyond ASCII. Null and empty texts have no words; an item without words is in no text; an item
shorter than a window is one window. Repeated rows of texts each get a row; items that
share an id are one in the results, an id that is null reads as empty. Equal counts of words are
decided by position, which cannot change a result. Columns other than the two named ones are
not carried along. Without texts there are no rows, without items no matches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navloom.llm.common import keyed, picked, stored
from navloom.llm.words import kinds, segments, split_words

#: Bytes other than digits, letters and parts of characters beyond ASCII stand between words.
KINDS = kinds(bytes(b for b in range(128) if not (chr(b).isalnum())))
#: Words of a window.
WINDOW = 10
#: Bytes of texts in a segment of the index.
SEGMENT_BYTES = 6_000_000
#: A place is its text times ``TEXT`` plus its position plus ``SHIFT``: less the offset of a word
#: in its item it still belongs to the same text.
TEXT, SHIFT = 1 << 32, 1 << 30


@dataclass(frozen=True)
class Index:
    """``texts (segment, doc, doc_id, n_words)`` and ``lists (segment, term, n, places)``."""

    texts: DataFrame
    lists: DataFrame


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_bytes: int = SEGMENT_BYTES
) -> Index:
    """The stored index of all words of all texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, part in enumerate(segments(batches, "text", segment_bytes)):
            segment = (task << 32) + number
            words = split_words(part.column("text"), KINDS)
            n = part.num_rows
            entry = {
                "kind": pa.array(["text"] * n),
                "segment": pa.array(np.full(n, segment)),
                "doc": pa.array(np.arange(n)),
                "doc_id": part.column("doc_id"),
                "n": pa.array(np.diff(words.first)),
                "term": pa.nulls(n, pa.binary()),
                "places": pa.nulls(n, pa.binary()),
            }
            yield pa.RecordBatch.from_pydict(entry)
            yield from _lists(words, segment, part.column("doc_id").type)

    chosen = picked(docs, doc_id=id_col, text=text_col)
    kind = dict(chosen.dtypes)["doc_id"]
    schema = f"kind string, segment bigint, doc bigint, doc_id {kind}, n bigint, term binary, places binary"
    table = stored(chosen.mapInArrow(work, schema), "index", partition_by=["kind"])
    texts = table.where("kind = 'text'").select("segment", "doc", "doc_id", F.col("n").alias("n_words"))
    return Index(texts, table.where("kind = 'list'").select("segment", "term", "n", "places"))


def _lists(words, segment: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """A row per word of a segment: its places in ascending order, as gaps."""
    order = np.argsort(words.code, kind="stable")
    at = np.arange(len(order)) - words.first[words.text]
    places = (words.text * TEXT + SHIFT + at)[order]
    n = len(words.vocabulary)
    counts = np.bincount(words.code, minlength=n)
    ends = np.cumsum(counts)
    gaps = np.diff(places, prepend=0)
    gaps[ends - counts] = places[ends - counts]
    offsets = np.concatenate([[0], ends * 8]).astype(np.int64)
    lists = pa.Array.from_buffers(
        pa.large_binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(gaps))]
    )
    for start in range(0, n, 10_000):
        size = min(10_000, n - start)
        yield pa.RecordBatch.from_pydict({
            "kind": pa.array(["list"] * size),
            "segment": pa.array(np.full(size, segment)),
            "doc": pa.nulls(size, pa.int64()),
            "doc_id": pa.nulls(size, id_type),
            "n": pa.array(counts[start : start + size]),
            "term": words.vocabulary.slice(start, size).cast(pa.binary()),
            "places": lists.slice(start, size).cast(pa.binary()),
        })


def _places(gaps: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(gaps, np.int64))


def _items(items: DataFrame, window: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``item, name`` of each item, and ``item, pos, term, window`` of each of its words."""
    rows, row = keyed(picked(items, item_id=id_col, text=text_col), "items")
    named = rows.select(F.col(row).alias("item"), F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in segments(batches, "text", SEGMENT_BYTES):
            words = split_words(part.column("text"), KINDS)
            size = np.minimum(window, np.diff(words.first))[words.text]
            yield pa.RecordBatch.from_pydict({
                "item": part.column("item").take(pa.array(words.text)),
                "pos": pa.array(np.arange(len(words.code)) - words.first[words.text]),
                "term": words.vocabulary.cast(pa.binary()).take(pa.array(words.code)),
                "window": pa.array(size.astype(np.int64)),
            })

    texts = rows.select(F.col(row).alias("item"), "text")
    words = texts.mapInArrow(work, "item bigint, pos bigint, term binary, window bigint")
    return named, stored(words, "item-words")


def _with_counts(index: Index, words: DataFrame) -> DataFrame:
    """The words with ``n``, the number of their places in all texts, null if there is none."""
    known = index.lists.select("term", "n").join(words.select("term").distinct(), "term", "left_semi")
    counts = known.groupBy("term").agg(F.sum("n").alias("n"))
    return stored(words.join(counts, "term", "left"), "item-counts")


def rarest_pairs(counts: np.ndarray, window: int) -> list[tuple[int, int, int, int]]:
    """``first, second, low, high``: the two rarest words of windows, and what those span.

    ``counts`` are those of an item's words in order, 0 for a word that no text has; windows
    with such a word are left out. A window of one word has it twice.
    """
    found: dict[tuple[int, int], list[int]] = {}
    views = np.lib.stride_tricks.sliding_window_view(counts, window)
    for start in np.flatnonzero(views.min(1) > 0):
        order = np.argsort(views[start], kind="stable")
        pair = int(start + order[0]), int(start + order[min(1, window - 1)])
        span = found.setdefault(pair, [int(start), 0])
        span[1] = int(start) + window
    return [(*pair, *span) for pair, span in found.items()]


def _needles(counted: DataFrame) -> DataFrame:
    """``term, uses``: where each word that is one of the rarest is asked for."""

    def work(group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("pos").to_numpy())
        counts = group.column("n").fill_null(0).to_numpy()[order]
        terms = group.column("term").take(pa.array(order))
        pairs = np.array(rarest_pairs(counts, group.column("window")[0].as_py()), np.int64).reshape(-1, 4)
        both = np.concatenate([pairs, pairs[:, [1, 0, 2, 3]]])
        first = np.arange(len(both)) < len(pairs)
        return pa.table({
            "item": pa.array(np.full(len(both), group.column("item")[0].as_py(), np.int64)),
            "term": terms.take(pa.array(both[:, 0])).combine_chunks() if len(both) else pa.array([], pa.binary()),
            "pos": pa.array(both[:, 0]),
            "other": pa.array(both[:, 1]),
            "low": pa.array(both[:, 2]),
            "high": pa.array(both[:, 3]),
            "first": pa.array(first),
        })

    schema = "item bigint, term binary, pos bigint, other bigint, low bigint, high bigint, first boolean"
    needles = counted.groupBy("item").applyInArrow(work, schema)
    use = F.struct("item", "pos", "other", "low", "high", "first")
    return needles.groupBy("term").agg(F.collect_list(use).alias("uses"))


def _aligned(index: Index, needles: DataFrame) -> DataFrame:
    """``segment, item, at, pos``: alignments that have both rarest words of some window, and
    the positions in the item that those windows hold."""

    def work(group: pa.Table) -> pa.Table:
        halves: dict[tuple, list[np.ndarray]] = {}
        spans: dict[tuple[int, int], set[int]] = {}
        for gaps, uses in zip(group.column("places").to_pylist(), group.column("uses").to_pylist()):
            places = _places(gaps)
            for use in uses:
                pair = (use["pos"], use["other"]) if use["first"] else (use["other"], use["pos"])
                key = (use["item"], *pair, use["low"], use["high"])
                halves.setdefault(key, []).append(places - use["pos"])
        for (item, _, _, low, high), lists in halves.items():
            if len(lists) == 2:
                for at in np.intersect1d(*lists, assume_unique=True).tolist():
                    spans.setdefault((item, at), set()).update(range(low, high))
        rows = [(item, at, pos) for (item, at), held in spans.items() for pos in held]
        columns = np.array(rows, np.int64).reshape(-1, 3)
        segment = np.full(len(rows), group.column("segment")[0].as_py(), np.int64)
        return pa.table(dict(zip(("segment", "item", "at", "pos"), map(pa.array, (segment, *columns.T)))))

    asked = index.lists.select("segment", "term", "places").join(needles, "term")
    schema = "segment bigint, item bigint, at bigint, pos bigint"
    return asked.select("segment", "places", "uses").groupBy("segment").applyInArrow(work, schema)


def _found(index: Index, aligned: DataFrame, words: DataFrame) -> DataFrame:
    """The rows of ``aligned`` whose word stands where it must, with ``window``."""
    wanted = aligned.join(words.select("item", "pos", "term", "window"), ["item", "pos"])
    probe = F.struct("item", "at", "pos", "window")
    probes = wanted.groupBy("segment", "term").agg(F.collect_list(probe).alias("probes"))
    lists = index.lists.join(words.select("term").distinct(), "term", "left_semi")
    lists = lists.join(aligned.select("segment").distinct(), "segment", "left_semi")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part = batch.slice(row, 1)
                probes = pa.RecordBatch.from_struct_array(part.column("probes").flatten())
                at, pos = (probes.column(c).to_numpy() for c in ("at", "pos"))
                there = np.isin(at + pos, _places(part.column("places")[0].as_py()))
                segment = pa.array(np.full(len(at), part.column("segment")[0].as_py()))
                columns = [segment, *[probes.column(c) for c in ("item", "at", "pos", "window")]]
                names = ["segment", "item", "at", "pos", "window"]
                yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(there))

    asked = probes.join(lists.select("segment", "term", "places"), ["segment", "term"])
    schema = "segment bigint, item bigint, at bigint, pos bigint, window bigint"
    return asked.select("segment", "probes", "places").mapInArrow(work, schema)


def _runs(found: DataFrame) -> DataFrame:
    """``segment, doc, item, places``: positions in texts that whole windows cover."""

    def work(group: pa.Table) -> pa.Table:
        item, at, pos, window = (group.column(c).to_numpy() for c in ("item", "at", "pos", "window"))
        order = np.lexsort((pos, at, item))
        item, at, pos, window = (x[order] for x in (item, at, pos, window))
        new = np.ones(len(pos), bool)
        new[1:] = (item[1:] != item[:-1]) | (at[1:] != at[:-1]) | (pos[1:] != pos[:-1] + 1)
        run = np.cumsum(new) - 1
        whole = np.bincount(run)[run] >= window
        place = at[whole] + pos[whole]
        rows = np.unique(np.stack([place // TEXT, item[whole], place % TEXT - SHIFT]), axis=1)
        first = np.flatnonzero(np.append(True, (np.diff(rows[:2], axis=1) != 0).any(0))) if rows.size else []
        ends = np.append(first, rows.shape[1]).astype(np.int32)
        heads = rows[:, np.array(first, np.int64)]
        return pa.table({
            "segment": pa.array(np.full(len(first), group.column("segment")[0].as_py(), np.int64)),
            "doc": pa.array(heads[0]),
            "item": pa.array(heads[1]),
            "places": pa.ListArray.from_arrays(pa.array(ends), pa.array(rows[2])),
        })

    schema = "segment bigint, doc bigint, item bigint, places array<bigint>"
    return found.groupBy("segment").applyInArrow(work, schema)


def phrase_matches(
    index: Index, items: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text"
) -> DataFrame:
    """``segment, doc, item, name, places``: a row per text and item that share a window.

    ``places`` are the positions of the text's words inside any occurrence of a window of the
    item; ``name`` is the item's id as text. Join ``index.texts`` for the id of the text.
    """
    named, words = _items(items, window, id_col, text_col)
    needles = stored(_needles(_with_counts(index, words)), "needles")
    aligned = stored(_aligned(index, needles), "alignments")
    return _runs(_found(index, aligned, words)).join(named, "item")


def near_matches(
    index: Index,
    items: DataFrame,
    terms: int = 4,
    span: int = 20,
    id_col: str = "item_id",
    text_col: str = "text",
) -> DataFrame:
    """``segment, doc, item, name, first, last``: stretches of at most ``span`` words of a text that
    hold the ``terms`` rarest different words of an item, in any order.

    Each stretch ends with one of those words and is the shortest that does. Items with a word
    that no text has among their rarest are in no text; items of fewer different words ask
    for all of them.
    """
    named, words = _items(items, 1, id_col, text_col)
    counted = _with_counts(index, words)
    each = counted.groupBy("item", "term").agg(F.coalesce(F.first("n"), F.lit(0)).alias("n"), F.min("pos").alias("pos"))
    # An item is one text: its different words fit in a row.
    ranked = each.groupBy("item").agg(F.slice(F.array_sort(F.collect_list(F.struct("n", "pos", "term"))), 1, terms).alias("asked"))
    wanted = ranked.select("item", F.size("asked").alias("size"), F.explode("asked.term").alias("term"))
    uses = wanted.groupBy("term").agg(F.collect_list(F.struct("item", "size")).alias("uses"))

    def work(group: pa.Table) -> pa.Table:
        lists: dict[tuple[int, int], list[np.ndarray]] = {}
        for gaps, asked in zip(group.column("places").to_pylist(), group.column("uses").to_pylist()):
            places = _places(gaps)
            for use in asked:
                lists.setdefault((use["item"], use["size"]), []).append(places)
        out: list[np.ndarray] = []
        for (item, size), held in lists.items():
            if len(held) == size:
                last = np.unique(np.concatenate(held))
                begin = last.copy()
                for places in held:
                    before = np.searchsorted(places, last, "right") - 1
                    begin = np.minimum(begin, np.where(before < 0, -TEXT, places[before]))
                near = last - begin < span
                out.append(np.stack([last // TEXT, np.full(len(last), item), begin % TEXT - SHIFT, last % TEXT - SHIFT])[:, near])
        rows = np.concatenate([np.zeros((4, 0), np.int64), *out], axis=1)
        segment = np.full(rows.shape[1], group.column("segment")[0].as_py(), np.int64)
        return pa.table(dict(zip(("segment", "doc", "item", "first", "last"), map(pa.array, (segment, *rows)))))

    asked = index.lists.select("segment", "term", "places").join(stored(uses, "near-uses"), "term")
    schema = "segment bigint, doc bigint, item bigint, first bigint, last bigint"
    found = asked.select("segment", "places", "uses").groupBy("segment").applyInArrow(work, schema)
    return found.join(named, "item")


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    doc_id_col: str = "doc_id",
    doc_text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    segment_bytes: int = SEGMENT_BYTES,
) -> DataFrame:
    """One row per text: ``doc_id, n_words, n_hit, items`` (ids in order of their text)."""
    index = build_index(docs, doc_id_col, doc_text_col, segment_bytes)
    found = phrase_matches(index, items, window, item_id_col, item_text_col)
    hit = F.size(F.array_distinct(F.flatten(F.collect_list("places")))).cast("long")
    names = F.array_sort(F.collect_set("name"))
    per_text = found.groupBy("segment", "doc").agg(hit.alias("n_hit"), names.alias("items"))
    return index.texts.join(per_text, ["segment", "doc"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
