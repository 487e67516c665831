"""Repeated passages by suffix arrays.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts earlier, in a row
before or in the same row. Each such string (a window) holds an anchor: the short string of
least hash among those in it, and equal windows hold equal anchors at equal places. So
the map tasks find the anchors of every text, with a digest of the bytes that windows
around the anchor can reach (its context), and rows with equal anchors meet. Of equal
contexts all but the first are repeats as a whole. Where an anchor has several contexts,
the first row of each is compared: what a context shares with no other is cut off its ends,
those that still differ become sequences of blocks of bytes, cut where some of them part,
their suffixes are sorted by grouping (see ``suffix_array``), equal windows are neighbours in
the array, and all but the first go.

An anchor whose contexts are too many for a task is not compared as a whole: the windows
around it are cut in two halves by where they start, those of a half share a longer core,
and rows meet again by that core, until groups are small or hold one window only, where
counting does. Nothing is sampled or capped.

Null and empty texts have nothing to remove. Texts are bytes of UTF-8 and may be of any
length; what is left of one need not be valid UTF-8. Rows are in order of ``doc_id``, null
last, and rows that repeat an id in the order they are read. Columns other than the two
named ones are not carried along; tables without rows give empty results.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from navloom.llm.common import keyed, picked, ranked, raw_texts, stored, text_slices
from navloom.llm.suffix_array import suffix_array

LENGTH, ANCHOR = 100, 32
#: How far before an anchor a window that holds it may start.
REACH = LENGTH - ANCHOR
#: Contexts of one group that a task sorts; larger groups are cut.
MEMBERS = 4_096
#: Bytes of anchors that one reducing group should hold.
BUCKET_BYTES = 4_000_000

_RECORD = np.dtype([("h", "<u8"), ("c", "<u8"), ("d", "<i8"), ("p", "<i4")])
_BYTES = np.random.default_rng(5).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def _hashes(text: np.ndarray) -> np.ndarray:
    """Hash of the ``ANCHOR`` bytes from each place on."""
    h, step = _BYTES[text], 1
    for mix in _MIX:
        h = h[:-step] * mix + (h[step:] ^ (h[step:] >> np.uint64(29)))
        step *= 2
    return h ^ (h >> np.uint64(32))


def _running(values: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` of each stretch of ``width`` values."""
    out, step = values, 1
    while 2 * step <= width:
        out = best(out[:-step], out[step:])
        step *= 2
    rest = width - step
    return best(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(text: bytes, doc: int) -> np.ndarray:
    """Records of the anchors of one text: hash, digest of the context, row, place."""
    n = len(text)
    if n < LENGTH:
        return np.empty(0, _RECORD)
    h = _hashes(np.frombuffer(text, np.uint8))
    least = _running(h, REACH + 1, np.minimum)
    # A place is an anchor if it is the least of some window: the greatest least around it.
    padded = np.concatenate([np.zeros(REACH, np.uint64), least, np.zeros(REACH, np.uint64)])
    at = np.flatnonzero(_running(padded, REACH + 1, np.maximum) == h)
    found = np.empty(len(at), _RECORD)
    found["h"], found["d"], found["p"] = h[at], doc, at
    digest = np.zeros(len(at), np.uint64)
    inner = (at >= REACH) & (at + LENGTH <= n)
    middle = at[inner]
    mixed = np.zeros(len(middle), np.uint64)
    for offset in (-REACH, -REACH + 32, -REACH + 64, 28, 60, LENGTH - ANCHOR):
        mixed = (mixed ^ h[middle + offset]) * np.uint64(0x9FB21C651E98DF25)
        mixed ^= mixed >> np.uint64(35)
    digest[inner] = mixed
    for i in np.flatnonzero(~inner).tolist():
        p = int(at[i])
        start = max(0, p - REACH)
        digest[i] = xxh64_intdigest(text[start : p + LENGTH], p - start + 1)
    found["c"] = digest
    return found


def _bucketed(docs: DataFrame, buckets: int) -> DataFrame:
    """``bucket, records``: the anchors of a slice of texts, packed by hash."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            rows = zip(raw_texts(part.column("text")), part.column("doc").to_pylist())
            found = np.concatenate([anchors(text, doc) for text, doc in rows])
            bucket = (found["h"] % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((found["h"], bucket))
            bucket, found = bucket[order], found[order]
            keys, first = np.unique(bucket, return_index=True)
            ends = [*first[1:], len(found)]
            blobs = [found[a:b].tobytes() for a, b in zip(first, ends)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(blobs, pa.binary())], ["bucket", "records"]
            )

    return docs.mapInArrow(work, "bucket bigint, records binary")


def _met(packed: DataFrame, buckets: int) -> DataFrame:
    """``doc, place, anchor``: repeated contexts without anchor; and, with it, the first
    rows of contexts that share their anchor with others."""

    def reduce(groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        last = None

        def close() -> pa.RecordBatch:
            r = np.concatenate([np.frombuffer(b, _RECORD) for b in held])
            r = r[np.lexsort((r["p"], r["d"], r["c"], r["h"]))]
            new_h = np.concatenate([[True], r["h"][1:] != r["h"][:-1]])
            new_c = new_h | np.concatenate([[True], r["c"][1:] != r["c"][:-1]])
            per_h = np.add.reduceat(new_c, np.flatnonzero(new_h))
            several = per_h[np.cumsum(new_h) - 1] > 1
            keep = ~new_c | several
            anchor = pa.array(r["h"][keep].view(np.int64), mask=~new_c[keep])
            return pa.RecordBatch.from_arrays(
                [pa.array(r["d"][keep]), pa.array(r["p"][keep]), anchor], ["doc", "place", "anchor"]
            )

        for batch in groups:
            for key, blob in zip(batch.column("bucket").to_pylist(), batch.column("records").to_pylist()):
                if key != last and held:
                    yield close()
                    held.clear()
                last = key
                held.append(blob)
        if held:
            yield close()

    laid = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return laid.mapInArrow(reduce, "doc bigint, place int, anchor bigint")


def _contexts(docs: DataFrame, first: DataFrame) -> DataFrame:
    """``doc, at, low, high, core, context``: the bytes of the contexts to be compared.

    ``at`` is where the anchor starts; windows start from ``at + low`` to ``at + high``;
    the context is what they cover, and the core what they have in common.
    """
    wanted = first.groupBy("doc").agg(F.collect_list("place").alias("places"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            docs_, at, cores, contexts = [], [], [], []
            lists = part.column("places").to_pylist()
            for doc, places, text in zip(part.column("doc").to_pylist(), lists, raw_texts(part.column("text"))):
                for p in places:
                    docs_.append(doc)
                    at.append(p)
                    cores.append(text[p : p + ANCHOR])
                    contexts.append(text[max(0, p - REACH) : p + LENGTH])
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs_, pa.int64()), pa.array(at, pa.int32()), pa.array(cores, pa.binary()), pa.array(contexts, pa.binary())],
                ["doc", "at", "core", "context"],
            )

    found = docs.join(wanted, "doc").select("doc", "text", "places").mapInArrow(
        work, "doc bigint, at int, core binary, context binary"
    )
    return found.select("doc", "at", F.lit(-REACH).alias("low"), F.lit(0).alias("high"), "core", "context")


def repeats(
    sides: list[tuple[bytes, bytes]], rows: list[tuple[int, int]], size: int
) -> list[tuple[int, int, int]]:
    """``doc, start, stop``: what of each context is in windows that are not the first of their kind.

    ``sides`` are the bytes before the core, read backwards, and after it; ``rows`` the row of
    each context and the place of its core, which has ``size`` bytes. Contexts differ, and so
    do the rows and places.

    Each context is a sequence of symbols: the core is one, and so is every block of bytes
    between two distances from the core at which some contexts part or end. Windows that end
    inside a block are equal just if they are with the whole of it, so one comparison of blocks
    does for all windows that begin and end in the same two.
    """
    free, n = LENGTH - size, len(sides)
    cuts = [_partings([side[k] for side in sides]) for k in (0, 1)]
    # Symbols fall along a context, so its suffixes are their own Lyndon words from the start
    # and no group has to be parted. Separators are least, and differ: no stretch goes over one.
    core = len(cuts[1]) * n
    numbers = [
        [({}, core + (t + 1) * n if k == 0 else core - (t + 1) * n, a, b) for t, (a, b) in enumerate(zip(c, c[1:]))]
        for k, c in enumerate(cuts)
    ]
    symbols, of, block, after = [], [], [], []
    for number, side in enumerate(sides):
        left, right = (
            [
                base + known.setdefault(bytes_[a:b], len(known))
                for known, base, a, b in numbers[k][: bisect_left(cuts[k], len(bytes_))]
            ]
            for k, bytes_ in enumerate(side)
        )
        left.reverse()
        symbols += left
        symbols.append(core)
        symbols += right
        symbols.append(number)
        of += [number] * (len(left) + len(right) + 2)
        block += range(len(left), -len(right) - 2, -1)
        after.append(len(right))
    # By the first block of a window, how far before the core it starts: per last block, from and to.
    windows: dict[int, dict[int, tuple[int, int]]] = defaultdict(dict)
    for before in range(free + 1):
        first, last = bisect_left(cuts[0], before), bisect_left(cuts[1], free - before)
        windows[first][last] = windows[first].get(last, (before, before))[0], before
    stretch: dict[int, tuple[int, int]] = {}
    runs: dict[tuple[int, int], tuple[list[int], list[int]]] = {}

    def close(first: int, last: int, run: list[int]) -> None:
        low, high = windows[first][last]
        least = min(run, key=rows.__getitem__)
        for number in run:
            if number != least:
                a, b = stretch.get(number, (low, high))
                stretch[number] = min(a, low), max(b, high)

    for at in suffix_array(symbols):
        first, number = block[at], of[at]
        if first < 0:
            continue
        for last in windows[first]:
            if last > after[number]:
                continue
            window = symbols[at : at + first + 1 + last]
            seen, run = runs.get((first, last), (None, None))
            if window == seen:
                run.append(number)
                continue
            if seen:
                close(first, last, run)
            runs[first, last] = window, [number]
    for (first, last), (_, run) in runs.items():
        close(first, last, run)
    # All windows hold the core, so those of a context cover one stretch.
    return [
        (rows[n][0], rows[n][1] - high, rows[n][1] - low + LENGTH) for n, (low, high) in stretch.items()
    ]


def _neighbours(texts: list[bytes]) -> Iterator[tuple[int, int, int]]:
    """Each two neighbours in the order of the texts, and how much their starts have in common."""
    order = sorted(range(len(texts)), key=texts.__getitem__)
    for i, j in zip(order, order[1:]):
        n = min(len(texts[i]), len(texts[j]))
        differ = int.from_bytes(texts[i][:n], "big") ^ int.from_bytes(texts[j][:n], "big")
        yield i, j, n - (differ.bit_length() + 7) // 8


def _longest(texts: list[bytes]) -> list[int]:
    """The longest start each text has in common with another."""
    best = [0] * len(texts)
    for i, j, same in _neighbours(texts):
        best[i], best[j] = max(best[i], same), max(best[j], same)
    return best


def _partings(texts: list[bytes]) -> list[int]:
    """Where any two texts part, or one ends, from 0 on: neighbours show the places of all."""
    return sorted({0, *map(len, texts), *(same for _, _, same in _neighbours(texts))})


def _compare(groups: DataFrame) -> DataFrame:
    """``doc, start, stop``: stretches of bytes that the groups of contexts show to repeat."""

    def sort(held: list[tuple]) -> list[tuple[int, int, int]]:
        size = len(held[0][0])
        lefts = [context[:shift][::-1] for _, _, _, context, shift, _, _ in held]
        rights = [context[shift + size :] for _, _, _, context, shift, _, _ in held]
        first: dict[tuple[bytes, bytes], tuple[int, int]] = {}
        rows = []
        # A window that two contexts share ends where both do: what none shares can go.
        for r, left, right, a, b in zip(held, lefts, rights, _longest(lefts), _longest(rights)):
            if a + size + b >= LENGTH:
                sides, row = (left[:a], right[:b]), (r[5], r[6] + r[4])
                rows.append((sides, row))
                first[sides] = min(first.get(sides, row), row)
        spans = [(doc, at - len(s[0]), at + size + len(s[1])) for s, (doc, at) in rows if (doc, at) > first[s]]
        if len(first) > 1:
            spans += repeats(list(first), list(first.values()), size)
        return spans

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: list[tuple[int, int, int]] = []
        for batch in batches:
            for r in zip(*[batch.column(name).to_pylist() for name in (*key, "context", "shift", "doc", "begin")]):
                if held and r[:3] != held[0][:3]:
                    out += sort(held)
                    held = []
                held.append(r)
            yield _spans(out)
            out = []
        if held:
            yield _spans(sort(held))

    key = ["core", "low", "high"]
    laid = groups.repartition(*key).sortWithinPartitions(*key)
    return laid.mapInArrow(work, "doc bigint, start int, stop int")


def _spans(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    kinds = pa.int64(), pa.int32(), pa.int32()
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc", "start", "stop"]
    )


def _halves(table: DataFrame) -> DataFrame:
    """The rows of large groups, each as the two halves of its windows."""
    middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
    pair = F.explode(
        F.array(
            F.struct(F.col("low").alias("a"), middle.alias("b")),
            F.struct((middle + 1).alias("a"), F.col("high").alias("b")),
        )
    )
    cut = table.select("*", pair.alias("half"))
    # Windows of a half that lie in the text, and what they cover, from the old context.
    start = F.greatest(F.lit(0), F.col("at") + F.col("half.a"))
    end = F.least(F.col("at") + F.col("half.b") + LENGTH, F.col("begin") + F.length("context"))
    core_start, core_end = F.col("at") + F.col("half.b"), F.col("at") + F.col("half.a") + LENGTH
    some = (end - start >= LENGTH) & (core_start >= 0)
    return cut.where(some).select(
        "doc", "at", F.col("half.a").alias("low"), F.col("half.b").alias("high"),
        F.substring("context", core_start - F.col("begin") + 1, core_end - core_start).alias("core"),
        F.substring("context", start - F.col("begin") + 1, end - start).alias("context"),
    )


def _compared(contexts: DataFrame, members: int) -> DataFrame:
    """Repeats among contexts that share a core, however many they are."""
    key, spans, level = ["core", "low", "high"], None, contexts
    begin = F.greatest(F.lit(0), F.col("at") + F.col("low"))
    while True:
        # Of equal contexts the first row stands for all; the others are repeats.
        shift = F.col("at") + F.col("high") - F.col("begin")
        level = level.withColumn("begin", begin).withColumn("shift", shift)
        first = level.groupBy(*key, "context", "shift").agg(
            F.min(F.struct("doc", "begin")).alias("first"), F.count("*").alias("n")
        )
        first = stored(first, "suffix-contexts")
        copies = level.join(first.where("n > 1").drop("n"), [*key, "context", "shift"])
        copies = copies.where(F.struct("doc", "begin") > F.col("first")).select(
            "doc", F.col("begin").alias("start"), (F.col("begin") + F.length("context")).cast("int").alias("stop")
        )
        spans = copies if spans is None else spans.unionByName(copies)
        sizes = first.groupBy(*key).count().where("count > 1")
        joined = first.join(sizes, key).select(*key, "context", "shift", "first.*", "count")
        spans = spans.unionByName(_compare(joined.where(F.col("count") <= members)))
        large = joined.where(F.col("count") > members)
        if not large.limit(1).count():
            return spans
        # Copies are repeats as a whole, so only first rows go on.
        large = large.withColumn("at", F.col("begin") + F.col("shift") - F.col("high"))
        level = stored(_halves(large), "suffix-halves")


def merged_spans(gone: pa.ListArray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and stop of the stretches that the spans of each row cover, in order.

    Spans that overlap or touch are one stretch; none goes beyond the ``sizes`` of the texts.
    """
    counts = pc.fill_null(pc.list_value_length(gone), 0).to_numpy(zero_copy_only=False)
    start, stop = (a.to_numpy(zero_copy_only=False).astype(np.int64) for a in gone.flatten().flatten())
    of = np.repeat(np.arange(len(sizes)), counts)
    # Texts one after the other, each with more room than any text has bytes.
    base = of << 32
    start, stop = base + start, base + np.minimum(stop, sizes[of])
    order = np.argsort(start)
    start, reached = start[order], np.maximum.accumulate(stop[order])
    new = np.concatenate([[True], start[1:] > reached[:-1]])[: len(start)]
    last = np.concatenate([new[1:], [True]])[: len(start)]
    base = base[new]
    return of[new], start[new] - base, reached[last] - base


def _cut(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept`` from the stretches to remove."""
    gone = spans.groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("gone"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            texts = raw_texts(part.column("text"))
            sizes = np.array([len(text) for text in texts], np.int64)
            of, starts, stops = merged_spans(part.column("gone"), sizes)
            removed = np.zeros(len(texts), np.int64)
            np.add.at(removed, of, stops - starts)
            ends = np.searchsorted(of, np.arange(len(texts) + 1))
            kept = []
            bounds, starts_, stops_ = ends.tolist(), starts.tolist(), stops.tolist()
            for text, a, b in zip(texts, bounds, bounds[1:]):
                left = zip([0, *stops_[a:b]], [*starts_[a:b], len(text)])
                kept.append(b"".join([text[i:j] for i, j in left]) if a < b else text)
            spans = pa.StructArray.from_arrays(
                [pa.array(starts, pa.int32()), pa.array(stops, pa.int32())], ["start", "stop"]
            )
            runs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sizes), pa.array(removed), runs, pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "spans", "kept"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.join(gone, "doc", "left").select("doc_id", "text", "gone").mapInArrow(
        work,
        f"doc_id {kind}, n_bytes bigint, n_removed bigint,"
        " spans array<struct<start:int,stop:int>>, kept binary",
    )


def _in_order(docs: DataFrame) -> DataFrame:
    """``doc, doc_id, text``; ``doc`` is different for each row and in the rows' order."""
    n, known, different = docs.agg(
        F.count("*"), F.count("doc_id"), F.count_distinct("doc_id")
    ).first()
    if n == known == different and dict(docs.dtypes)["doc_id"] in ("int", "bigint"):
        return docs.select(F.col("doc_id").cast("bigint").alias("doc"), "doc_id", "text")
    rows, row = keyed(docs, "suffix-rows")
    of = rows.select(F.col(row).alias("of"), "doc_id").withColumn("all", F.lit(1))
    of = ranked(of, "all", [F.asc_nulls_last("doc_id"), "of"], "suffix-order").select("of", "position")
    joined = rows.join(of, rows[row] == of["of"])
    return stored(joined.select(F.col("position").cast("bigint").alias("doc"), "doc_id", "text"), "suffix-docs")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", members: int = MEMBERS
) -> DataFrame:
    """One row per row: ``doc_id, n_bytes, n_removed, spans, kept``."""
    spark = docs.sparkSession
    table = _in_order(picked(docs, doc_id=id_col, text=text_col))
    total = table.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # An anchor comes about every thirty bytes of text.
    buckets = max(parts, total // BUCKET_BYTES + 1)
    met = stored(_met(_bucketed(table.select("doc", "text"), buckets), buckets), "suffix-met")
    # Stored, as they are read twice: without, whole texts move twice for them.
    contexts = stored(_contexts(table, met.where("anchor is not null")), "suffix-compared")
    at = met.where("anchor is null")
    begin = F.greatest(F.lit(0), F.col("place") - REACH)
    whole = at.select("doc", begin.alias("start"), (F.col("place") + LENGTH).cast("int").alias("stop"))
    return _cut(table, whole.unionByName(_compared(contexts, members)))
