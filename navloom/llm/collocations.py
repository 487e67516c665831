"""Phrases that occur together more often than their parts suggest, by Rabin-Karp fingerprints.

Texts of one language are brought together in segments, stored as numbered words. Over the
hashes of a segment's words numpy takes prefix sums of a polynomial in an odd base, modulo
2**64; the fingerprint of any run of words is the difference of two of them, divided by a power of
the base. A segment sends each different fingerprint once, with its count; those of a range
(a bucket) move as one row of packed numbers. A shuffle brings the rows of a bucket together
and numpy adds the counts up. Frequent ones go back to the segments that sent them, which find
their runs again and show the words behind them, some at a time. Phrases are
counted by these words, so different phrases under one fingerprint are told apart, and text
is made for frequent ones only. In a segment equal fingerprints are compared by their words
before they are counted together.

A phrase is frequent only if all its parts are, so lengths go up one by one: of runs of ``n``
words only those send fingerprints whose first and last ``n - 1`` words came back as frequent.

Words are lower-cased (A to Z) and parted by spaces and tabs; phrases do not cross
``.,;:!?`` or line ends, nor texts. Null and empty texts have no words, a null language is
``und``. Repeated rows count each. Columns other than the two named ones are not carried along,
and tables without rows, or without frequent phrases, give empty results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from navloom.llm.common import give_back, picked, stored, text_slices
from navloom.llm.words import Words, kinds, split_words

KINDS = kinds(b" \t", b".,;:!?\n\x0b\x0c\r")
#: Bytes of texts in a segment: larger ones send fewer fingerprints and take more memory.
SEGMENT_BYTES = 12_000_000
#: Base of the polynomials, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

#: A segment is several rows: at place ``at`` a part of its vocabulary, with the words' counts, and
#: one of its words as codes, with a bit for each that begins a piece of text.
SEGMENT = (
    "segment bigint, lang string, at int, words bigint, different bigint, "
    "vocabulary binary, counts binary, codes binary, first binary"
)
#: Words of a row. Parquet, Arrow and shuffles have buffers of about a row or a few, outside the heap.
ROW_WORDS = 100_000
#: Fingerprints of a segment and a bucket, ascending, and how often each occurs: a row for many of them.
PART = "bucket bigint, segment bigint, prints binary, counts binary"
FREQUENT = "segment bigint, size bigint, prints binary"
PHRASE = "lang string, n int, phrase string, count bigint"
#: Phrases of a segment and a bucket, parted by line ends, which no word holds.
SHOWN = "bucket bigint, lang string, n int, phrases string, counts binary"
#: Fingerprints, or phrases, of all segments that a bucket holds on average.
BUCKET = 500_000
#: Phrases of a segment that are written out at once.
AT_ONCE = 100_000
#: Bytes of a batch that a worker returns, about.
BATCH_BYTES = 2_000_000
#: Rows are large: Parquet is to look at its sizes after each of them, not after a hundred.
LARGE_ROWS = {
    "parquet.page.size.row.check.min": "1",
    "parquet.block.size.row.check.min": "1",
    "parquet.block.size": "8000000",
}


def _by_language(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, pa.RecordBatch]]:
    """Texts of one language at a time, about a segment of them."""
    held: dict[str, list[pa.RecordBatch]] = {}
    sizes: dict[str, int] = {}
    for part in text_slices(batches):
        for lang in pc.unique(part.column("lang")).to_pylist():
            own = part.filter(pc.equal(part.column("lang"), lang))
            held.setdefault(lang, []).append(own)
            sizes[lang] = sizes.get(lang, 0) + (pc.sum(pc.binary_length(own.column("text"))).as_py() or 0)
        # The largest go first, so that what is held is bounded whatever the languages are.
        while sum(sizes.values()) > size:
            lang = max(sizes, key=sizes.get)
            yield lang, pa.concat_batches(held.pop(lang))
            del sizes[lang]
    for lang, parts in held.items():
        yield lang, pa.concat_batches(parts)


def _rows(segment: int, lang: str, words: Words) -> Iterator[pa.RecordBatch]:
    rows = -(-len(words.code) // ROW_WORDS)
    new = np.diff(words.piece, prepend=-1) != 0
    counts = np.bincount(words.code, minlength=len(words.vocabulary)).astype(np.int32)
    cuts = lambda size: [size * row // rows for row in range(rows + 1)]
    own, part = cuts(len(words.code)), cuts(len(words.vocabulary))
    for row in range(rows):
        text, code = slice(part[row], part[row + 1]), slice(own[row], own[row + 1])
        yield pa.RecordBatch.from_pydict({
            "segment": pa.array([segment]),
            "lang": pa.array([lang]),
            "at": pa.array([row], pa.int32()),
            "words": pa.array([code.stop - code.start]),
            "different": pa.array([text.stop - text.start]),
            # No word holds a space.
            "vocabulary": pa.array([b" ".join(words.vocabulary[text].to_pylist())], pa.binary()),
            "counts": pa.array([counts[text].tobytes()]),
            "codes": pa.array([words.code[code].astype(np.int32).tobytes()]),
            "first": pa.array([np.packbits(new[code]).tobytes()]),
        })


def _segments(docs: DataFrame, text_col: str, lang_col: str, size: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, (lang, part) in enumerate(_by_language(batches, size)):
            words = split_words(part.column("text"), KINDS)
            if len(words.code):
                yield from _rows((task << 32) + number, lang, words)

    chosen = picked(docs, text=text_col, lang=lang_col)
    chosen = chosen.select("text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    return stored(chosen.mapInArrow(work, SEGMENT), "word-segments", options=LARGE_ROWS)


def fingerprints(hashes: np.ndarray, n: int, bits: int = 64) -> np.ndarray:
    """Of every run of ``n`` words: the sum of each hash times the base to its place in the run."""
    size = len(hashes)
    powers = np.cumprod(np.append(np.uint64(1), np.full(size, BASE, np.uint64)))
    back = np.cumprod(np.append(np.uint64(1), np.full(size, INVERSE, np.uint64)))
    prefix = np.append(np.uint64(0), np.cumsum(hashes * powers[:-1], dtype=np.uint64))
    if n > size:
        return np.zeros(0, np.uint64)
    found = (prefix[n:] - prefix[:-n]) * back[: size - n + 1]
    return found & np.uint64((1 << bits) - 1)


def counted(
    prints: np.ndarray, places: np.ndarray, codes: np.ndarray, n: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different runs among ``places``: their fingerprints, counts and first places.

    Runs of equal fingerprints but other words are kept apart.
    """
    order = np.argsort(prints)
    new = np.diff(prints[order], prepend=~prints[order[:1]]) != 0
    begin = np.flatnonzero(new)
    first = np.minimum.reduceat(places[order], begin)
    leader = first[np.cumsum(new) - 1]
    if any((codes[places[order] + k] != codes[leader + k]).any() for k in range(n)):
        words = [codes[places + k] for k in range(n)]
        order = np.lexsort((places, *words, prints))
        new = np.diff(prints[order], prepend=~prints[order[:1]]) != 0
        for column in words:
            new[1:] |= column[order][1:] != column[order][:-1]
        begin = np.flatnonzero(new)
        first = places[order[begin]]
    return prints[order[begin]], np.diff(np.append(begin, len(order))), first


def _among(prints: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which fingerprints are among the known ones."""
    return pc.is_in(pa.array(prints), pa.array(known)).to_numpy(zero_copy_only=False)


def bucket_of(prints: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    """Buckets are ranges, so ascending fingerprints have ascending buckets."""
    high = prints >> np.uint64(max(0, bits - 32))
    return (high * np.uint64(buckets) >> np.uint64(min(bits, 32))).astype(np.int64)


def _binaries(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Stretches of the values, one after the other, as bytes."""
    ends = np.append(0, np.cumsum(sizes) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])


def _values(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All values of such a column, and how many each row has."""
    column = column.cast(pa.binary())
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1]
    found = np.frombuffer(data[ends[0] : ends[-1]] if data else b"", kind)
    return found, np.diff(ends) // found.itemsize


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))


def _of_language(lang: str, bits: int) -> np.uint64:
    return np.uint64(xxh64_intdigest(lang) & ((1 << bits) - 1))


def _sent(segment: int, prints: np.ndarray, counts: np.ndarray, buckets: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Ascending fingerprints with their counts, a row per bucket, or two where a slice ends."""
    for start in range(0, len(prints), 10 * AT_ONCE):
        own = slice(start, start + 10 * AT_ONCE)
        bucket = bucket_of(prints[own], buckets, bits)
        begin = np.flatnonzero(np.diff(bucket, prepend=-1))
        sizes = np.diff(np.append(begin, len(bucket)))
        yield from _in_batches(pa.RecordBatch.from_pydict({
            "bucket": pa.array(bucket[begin]),
            "segment": pa.array(np.full(len(begin), segment, np.int64)),
            "prints": _binaries(prints[own], sizes),
            "counts": _binaries(counts[own].astype(np.int32), sizes),
        }))


def _in_batches(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    step = max(1, BATCH_BYTES * batch.num_rows // max(1, batch.nbytes))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


class Segment:
    """The words of a stored segment."""

    def __init__(self, rows: pa.Table, bits: int):
        rows = rows.sort_by("at").to_pydict()
        self.key, self.lang, self.bits = rows["segment"][0], rows["lang"][0], bits
        words = [word for part in rows["vocabulary"] for word in part.split()]
        self.vocabulary = pa.array(words, pa.binary())
        self.hashes = _hashes(words)
        self.codes = np.frombuffer(b"".join(rows["codes"]), np.int32)
        new = [np.unpackbits(np.frombuffer(f, np.uint8), count=len(c) // 4) for f, c in zip(rows["first"], rows["codes"])]
        self.piece = np.cumsum(np.concatenate(new), dtype=np.int32)

    def prints(self, n: int) -> np.ndarray:
        """Fingerprints of all runs of ``n`` words, other ones in each language."""
        return fingerprints(self.hashes[self.codes], n, self.bits) ^ _of_language(self.lang, self.bits)

    def _counted(self, n: int, chosen: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Different runs of ``n`` words among the chosen ones, by their fingerprints."""
        prints = self.prints(n)
        open_ = self.piece[: len(prints)] == self.piece[len(self.codes) - len(prints) :]
        places = np.flatnonzero(open_ & chosen(prints))
        return counted(prints[places], places, self.codes, n) if len(places) else (prints[:0], places, places)

    def parts(self, n: int, known: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
        """Runs of ``n`` words; ``known`` are the frequent fingerprints of one word less."""

        def chosen(prints: np.ndarray) -> np.ndarray:
            frequent = _among(self.prints(n - 1), known)
            return frequent[: len(prints)] & frequent[1 : len(prints) + 1]

        prints, counts, _ = self._counted(n, chosen)
        yield from _sent(self.key, prints, counts, buckets, self.bits)

    def phrases(self, n: int, known: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
        """The words behind frequent fingerprints and their counts, by buckets of fingerprints."""
        prints, counts, places = self._counted(n, lambda prints: _among(prints, known))
        bucket = bucket_of(prints, buckets, self.bits)
        for start in range(0, len(prints), AT_ONCE):
            own = slice(start, start + AT_ONCE)
            begin = np.flatnonzero(np.diff(bucket[own], prepend=-1))
            ends = np.append(begin, len(bucket[own]))
            words = [self.vocabulary.take(pa.array(self.codes[places[own] + k])) for k in range(n)]
            text = pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.binary())) if n > 1 else words[0]
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), text.cast(pa.string()))
            yield from _in_batches(pa.RecordBatch.from_pydict({
                "bucket": pa.array(bucket[own][begin]),
                "lang": pa.array([self.lang] * len(begin), pa.string()),
                "n": pa.array(np.full(len(begin), n, np.int32)),
                "phrases": pc.binary_join(lists, "\n"),
                "counts": _binaries(counts[own].astype(np.int64), np.diff(ends)),
            }))


def _frugal(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """Returns the memory of each group: workers live on idle while others sort and join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        give_back()

    return run


def _frequent(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of a bucket, the fingerprints that occur often enough, for each segment that sent them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = [
            (b.column("segment").to_numpy(), *_values(b.column("prints"), np.uint64), _values(b.column("counts"), np.int32)[0])
            for b in batches
        ]
        segment, prints, sizes, counts = map(np.concatenate, zip(*columns))
        columns.clear()
        order = np.argsort(prints)
        begin = np.flatnonzero(np.diff(prints[order], prepend=~prints[order[:1]]))
        often = np.add.reduceat(counts[order], begin, dtype=np.int64) >= least
        kept = np.empty(len(prints), bool)
        kept[order] = np.repeat(often, np.diff(np.append(begin, len(order))))
        size = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[kept], minlength=len(sizes))
        some = size > 0
        yield from _in_batches(pa.RecordBatch.from_pydict({
            "segment": pa.array(segment[some]),
            "size": pa.array(size[some]),
            "prints": _binaries(prints[kept], size[some]),
        }))

    return work


def _merged(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of a bucket, the phrases that occur often enough, told apart by their words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = []
        for batch in batches:
            counts, sizes = _values(batch.column("counts"), np.int64)
            rows = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            phrases = pc.list_flatten(pc.split_pattern(batch.column("phrases"), "\n"))
            tables.append(pa.table({
                "lang": batch.column("lang").take(rows), "n": batch.column("n").take(rows),
                "phrase": phrases, "count": pa.array(counts),
            }))
        sums = pa.concat_tables(tables).group_by(["lang", "n", "phrase"]).aggregate([("count", "sum")])
        sums = sums.filter(pc.greater_equal(sums.column("count_sum"), least))
        sums = sums.select(["lang", "n", "phrase", "count_sum"]).rename_columns(["lang", "n", "phrase", "count"])
        yield from sums.to_batches()

    return work


def _gathered(batches: Iterator[pa.RecordBatch], bits: int) -> tuple[Segment, dict[int, np.ndarray]]:
    """A segment, and by their lengths its frequent fingerprints."""
    rows, found = [], {}
    for batch in batches:
        lengths = batch.column("n").to_numpy()
        for n in np.unique(lengths).tolist():
            own = batch.filter(pa.array(lengths == n))
            if n:
                found.setdefault(n, []).append(_values(own.column("prints"), np.uint64)[0])
            else:
                rows.append(own)
    return Segment(pa.Table.from_batches(rows), bits), {n: np.concatenate(prints) for n, prints in found.items()}


def frequent_phrases(
    docs: DataFrame,
    words: int = 5,
    least: int = 100,
    text_col: str = "text",
    lang_col: str = "lang",
    bits: int = 64,
    segment_bytes: int = SEGMENT_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """``lang, n, phrase, count`` of runs of up to ``words`` words that occur ``least`` times or
    more in a language, and ``lang, words``, the number of all word occurrences.

    Fewer ``bits`` of fingerprints cost time and cannot change the result.
    """
    segments = _segments(docs, text_col, lang_col, segment_bytes)
    totals = segments.groupBy("lang").agg(F.sum("words").alias("words"))
    all_words, all_different = segments.agg(F.sum("words"), F.sum("different")).first()
    if not all_words:
        return docs.sparkSession.createDataFrame([], PHRASE), totals
    in_buckets = lambda sent: -(-sent // BUCKET)

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words, which rows of a segment do not share; rows that come one after the other are sent together."""
        rows = (row for batch in batches for row in batch.to_pylist())
        for (segment, lang), own in groupby(rows, key=lambda row: (row["segment"], row["lang"])):
            found = [(_hashes(row["vocabulary"].split()), np.frombuffer(row["counts"], np.int32)) for row in own]
            hashes, counts = map(np.concatenate, zip(*found))
            prints = (hashes & np.uint64((1 << bits) - 1)) ^ _of_language(lang, bits)
            order = np.argsort(prints)
            yield from _sent(segment, prints[order], counts[order], in_buckets(all_different), bits)

    def step(n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            segment, frequent = _gathered(batches, bits)
            if frequent:
                yield from segment.parts(n, frequent[n - 1], in_buckets(all_words))

        return work

    def with_prints(levels: list[DataFrame]) -> GroupedData:
        """A segment's rows, with length 0, and the rows of its fingerprints."""
        whole = segments.drop("words", "different", "counts").withColumns({"n": F.lit(0), "prints": F.lit(None).cast("binary")})
        own = reduce(DataFrame.unionByName, levels).drop("size")
        return whole.unionByName(own, allowMissingColumns=True).groupBy("segment")

    words_only = segments.select("segment", "lang", "vocabulary", "counts")
    levels: list[DataFrame] = []
    for n in range(1, words + 1):
        parts = with_prints(levels[-1:]).applyInArrow(_frugal(step(n)), PART) if levels else words_only.mapInArrow(_frugal(single), PART)
        # A segment sends a run once, so a bucket has no more of one fingerprint than segments send.
        frequent = parts.groupBy("bucket").applyInArrow(_frugal(_frequent(least)), FREQUENT)
        frequent = stored(frequent.withColumn("n", F.lit(n)), "phrase-prints", options=LARGE_ROWS)
        if frequent.isEmpty():
            break
        levels.append(frequent)
    if not levels:
        return docs.sparkSession.createDataFrame([], PHRASE), totals
    sizes = reduce(DataFrame.unionByName, levels).agg(F.sum("size"))
    buckets = in_buckets(sizes.first()[0])

    def shown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, frequent = _gathered(batches, bits)
        for n, known in sorted(frequent.items()):
            yield from segment.phrases(n, known, buckets)

    # Counted by their words: the sum under a fingerprint may have been that of several phrases.
    packed = with_prints(levels).applyInArrow(_frugal(shown), SHOWN)
    return packed.groupBy("bucket").applyInArrow(_frugal(_merged(least)), PHRASE), totals


def _exact(column: str, digits: int = 17) -> Column:
    return F.col(column).cast(f"decimal({digits},0)")


def collocations(
    docs: DataFrame,
    words: int = 5,
    least: int = 100,
    top: int = 2_000,
    within: int = 100,
    text_col: str = "text",
    lang_col: str = "lang",
    bits: int = 64,
    segment_bytes: int = SEGMENT_BYTES,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language.

    A phrase of ``a`` occurrences, cut into parts of ``l`` and ``r``, has the score
    ``floor(1000 * a * n / (l * r))`` of its lowest cut, the first of equals. Phrases are left
    out that lie in a longer one with at least ``within`` percent of their occurrences.
    """
    counts, totals = frequent_phrases(docs, words, least, text_col, lang_col, bits, segment_bytes)
    counts = stored(counts, "phrase-counts")
    known = counts.select("lang", "phrase", "count")
    split = F.split("phrase", " ", -1)
    several = counts.where("n > 1").select("lang", "phrase", "n", F.col("count").alias("a"), split.alias("w"))
    cuts = several.select("*", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
    joined = lambda start, size: F.array_join(F.slice("w", start, size), " ")
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        joined(F.lit(1), F.col("k")).alias("left"),
        joined(F.col("k") + 1, F.col("n") - F.col("k")).alias("right"),
    )
    part = lambda side, name: known.select("lang", F.col("phrase").alias(side), F.col("count").alias(name))
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    cuts = cuts.join(totals.select("lang", F.col("words").alias("n")), "lang")
    above = _exact("a") * F.lit(1000).cast("decimal(4,0)") * _exact("n")
    scored = cuts.select("*", above.alias("above"), (_exact("l") * _exact("r")).alias("below"))
    scored = scored.withColumn("score", F.expr("above div below"))
    lowest = F.min(F.struct("score", "k", "l", "r", "n")).alias("cut")
    scored = scored.groupBy("lang", "phrase", "a").agg(lowest)
    # A longer phrase holds one of a word more that holds the phrase and is not rarer.
    inside = several.where("n > 2").select(
        "lang", "a", F.explode(F.array(joined(F.lit(1), F.col("n") - 1), joined(F.lit(2), F.col("n") - 1))).alias("phrase")
    )
    longer = inside.groupBy("lang", "phrase").agg((F.max("a") * 100).alias("longer"))
    left = scored.join(longer, ["lang", "phrase"], "left")
    left = left.where(F.col("longer").isNull() | (F.col("longer") < F.col("a") * within))
    best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "cut.l", "cut.r", "cut.n", "cut.score"
    )
