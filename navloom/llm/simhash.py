"""SimHash near duplicates by bit-sliced comparison.

Each text gets a fingerprint of 64 bits: a bit is set if it is set in over half of the
hashes of the text's word shingles. Fingerprints link if they differ in few bits. Two that
differ in at most ``radius`` bits agree in all but ``radius`` of the blocks the bits are
cut into, so those that share the other blocks meet in a bucket, and no link is lost. In a
bucket the bits are stored as planes, one lane per fingerprint; the distances of a
fingerprint to 64 lanes are counted at once by carry-save adders of three bits, and words
of lanes that are all beyond the radius are left before their last plane. A bucket gives
links that join the same fingerprints as all of its close pairs do.

Equal fingerprints are one vertex. Buckets of more than ``CHUNK`` fingerprints are cut into
chunks, and every pair of chunks is compared by a task of its own.

Null and empty texts have no shingle: fingerprint zero, linked like any other. A text of
fewer words than a shingle is one shingle. Texts are read whole, repeated rows each get
their own row; columns other than the two named ones are not carried along; tables without
rows give empty results. Of rows without id, ``component_id`` is the smallest id of the
others in the component, or null.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from navloom.llm.common import join_hot, keyed, picked, quoted, raw_texts, settled, stored, text_slices, unused
from navloom.llm.components import components

BITS = 64
#: Fingerprints of a bucket that are compared by one task.
CHUNK = 2_048
#: Rows a task compares at once.
ROWS = 16_384
#: Fingerprints that may share a bucket on average before buckets get longer keys.
PER_BUCKET = 256


def fingerprint(text: bytes, words: int, seed: int) -> int:
    parts = text.lower().split()
    if not parts:
        return 0
    joined, n = b" ".join(parts), max(1, len(parts) - words + 1)
    sizes = list(map(len, parts))
    starts = [0, *accumulate(size + 1 for size in sizes)]
    ends = [a + s for a, s in zip(starts, sizes)][-n:]
    hashes = map(xxh64_intdigest, [joined[a:b] for a, b in zip(starts, ends)], repeat(seed))
    total = np.zeros(BITS, np.int64)
    hashes = np.fromiter(hashes, np.uint64, n)
    for at in range(0, n, 65_536):
        some = hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(some, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n, bitorder="little").tobytes(), "little")


def fingerprints(
    docs: DataFrame, words: int, seed: int = 42, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id`` and ``print``, the fingerprint as a signed long."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            found = [fingerprint(t, words, seed) for t in raw_texts(part.column("text"))]
            prints = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(prints)], ["doc_id", "print"]
            )

    kind = dict(docs.dtypes)[id_col]
    return picked(docs, doc_id=id_col, text=text_col).mapInArrow(
        work, f"doc_id {kind}, print bigint"
    )


def _keys(vertices: DataFrame, blocks: int, radius: int) -> DataFrame:
    """The vertices with ``n, key``: once for each choice of blocks that may agree."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum((1 << edges[i + 1]) - (1 << edges[i]) for i in chosen)
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        keys.append(F.struct(F.lit(number).alias("n"), F.col("print").bitwiseAND(F.lit(signed)).alias("key")))
    exploded = vertices.select("*", F.explode(F.array(*keys)).alias("bucket"))
    return exploded.select(*vertices.columns, "bucket.n", "bucket.key")


def _in_chunks(table: DataFrame, chunk: int) -> DataFrame:
    """With ``lo, hi``: buckets of two rows or more, large ones as pairs of chunks."""
    sizes = table.groupBy("n", "key").count().where("count > 1")
    joined = table.join(sizes, ["n", "key"])
    chunks = F.ceil(F.col("count") / chunk).cast("int")
    own = F.pmod(F.xxhash64("vertex"), chunks).cast("int")
    other = F.explode(F.sequence(F.lit(0), chunks - 1))
    pairs = joined.select(*table.columns, own.alias("own"), other.alias("other"))
    lo, hi = F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")
    return pairs.select(*table.columns, lo, hi)


def close_masks(prints: np.ndarray, groups: np.ndarray, radius: int):
    """Which fingerprints of the same group are close.

    ``groups`` numbers the groups of the rows, in ascending order. Yields rows, first rows
    of words of 64 lanes, and bits of the lanes that are close to the row.
    """
    first = np.flatnonzero(np.concatenate([[True], np.diff(groups) > 0]))
    size = np.diff(np.concatenate([first, [len(prints)]]))
    words = -(-size // 64)
    word_first = np.repeat(first, words) + 64 * (
        np.arange(words.sum()) - np.repeat(np.cumsum(words) - words, words)
    )
    word_size = np.minimum(64, np.repeat(first + size, words) - word_first)
    lanes = np.minimum(word_first[:, None] + np.arange(64), len(prints) - 1)
    used = np.arange(64) < word_size[:, None]
    as_words = lambda bits: np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]
    planes = [as_words((prints[lanes] >> np.uint64(b)) & np.uint64(1)) for b in range(BITS)]
    used = as_words(used)
    # Each row against every word of its group from its own word on: lanes before it have met it.
    at = np.arange(len(prints)) - np.repeat(first, size)
    begin = np.repeat(np.cumsum(words) - words, size) + at // 64
    n_words = np.repeat(words, size) - at // 64
    for start, stop in _blocks(n_words, 1 << 18):
        count = n_words[start:stop]
        row = np.repeat(np.arange(start, stop), count)
        word = np.repeat(begin[start:stop] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        ones = np.zeros(len(row), np.uint64)
        twos, beyond = ones.copy(), ~used[word]
        if radius >= 4:
            fours = ones.copy()
        for b in range(BITS):
            flip = (prints[row] >> np.uint64(b)) & np.uint64(1)
            differ = planes[b][word] ^ (np.uint64(0) - flip)
            carry = ones & differ
            ones ^= differ
            if radius < 4:
                beyond |= twos & carry
                twos ^= carry
            else:
                more = twos & carry
                twos ^= carry
                beyond |= fours & more
                fours ^= more
            if b % 8 == 7:
                open_ = beyond != np.uint64(0xFFFFFFFFFFFFFFFF)
                if not open_.all():
                    row, word, ones, twos, beyond = (x[open_] for x in (row, word, ones, twos, beyond))
                    if radius >= 4:
                        fours = fours[open_]
        # Counts of 0 to 3 (or 7) are left in the lanes that are not beyond.
        if radius not in (3, 7):
            raise ValueError("the carry-save counters stop beyond 3 or 7 differing bits")
        yield row, word_first[word], ~beyond


def _blocks(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Cuts of a row of sizes into stretches of bounded sums."""
    start, total = 0, 0
    for at, size in enumerate(sizes.tolist()):
        if total and total + size > most:
            yield start, at
            start, total = at, 0
        total += size
    if len(sizes) > start:
        yield start, len(sizes)


def _links(prints: np.ndarray, groups: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows joined to the first row of their part of the group, by all close pairs."""
    label = np.arange(len(prints))

    def root(i: int) -> int:
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for row, lane_first, close in close_masks(prints, groups, radius):
        some = np.flatnonzero(close)
        for at in range(0, len(some), 65_536):
            part = some[at : at + 65_536]
            bits = np.unpackbits(close[part].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            which, lane = np.nonzero(bits)
            a, b = row[part][which], lane_first[part][which] + lane
            while (label[label] != label).any():
                label[:] = label[label]
            a, b = label[a], label[b]
            pairs = np.unique(np.stack([a, b])[:, a != b], axis=1)
            for x, y in pairs.T.tolist():
                x, y = root(x), root(y)
                label[max(x, y)] = min(x, y)
    while (label[label] != label).any():
        label[:] = label[label]
    linked = np.flatnonzero(label != np.arange(len(prints)))
    return linked, label[linked]


def links(vertices: DataFrame, radius: int = 3, chunk: int = CHUNK) -> DataFrame:
    """``a, b``: links that connect the same vertices as all close pairs do.

    ``vertices`` has ``vertex, print``.
    """
    n, blocks = vertices.count(), radius + 1
    # Longer keys for more fingerprints: a choice of speed, every choice finds all pairs.
    while blocks < radius + 4 and n > PER_BUCKET << (BITS * (blocks - radius) // blocks):
        blocks += 1
    spread = _in_chunks(_keys(vertices, blocks, radius), chunk)
    group = ["n", "key", "lo", "hi"]
    spread = spread.repartition(*group).sortWithinPartitions(*group)

    def compare(table: pa.Table) -> pa.RecordBatch:
        keys = [table.column(c).to_numpy() for c in group]
        new = np.zeros(len(table), bool)
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
        prints = table.column("print").to_numpy()
        groups = np.cumsum(new)
        linked, to = _links(prints.view(np.uint64), groups, radius)
        vertex = table.column("vertex").to_numpy()
        arrays = [pa.array(vertex[linked]), pa.array(vertex[to])]
        return pa.RecordBatch.from_arrays(arrays, ["a", "b"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if len(held) < ROWS:
                continue
            # All but the last group are whole.
            last, ends = held.slice(len(held) - 1).select(group).to_pylist()[0], len(held)
            same = np.ones(ends, bool)
            for name, value in last.items():
                same &= held.column(name).to_numpy() == value
            cut = ends - int(same.sum())
            if cut:
                yield compare(held.slice(0, cut).combine_chunks())
                held = held.slice(cut)
        if held is not None and len(held):
            yield compare(held.combine_chunks())

    return spread.mapInArrow(work, "a bigint, b bigint").distinct()


def near_groups(
    docs: DataFrame,
    words: int = 3,
    radius: int = 3,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row: ``doc_id, fingerprint`` (hex) and ``component_id``."""
    rows = stored(fingerprints(docs, words, seed, id_col, text_col), "fingerprints")
    vertices = rows.groupBy("print").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"))
    vertices = stored(vertices, "vertices")
    each = vertices.select(F.col("print").alias("vertex"), "print")
    roots = components(links(each, radius))
    joined = vertices.join(roots, vertices["print"] == roots["vertex"], "left")
    joined = joined.select("print", "least", "rows", F.coalesce("root", "print").alias("root"))
    joined = stored(joined, "rooted")
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("members"))
    of = join_hot(joined, stored(least, "least"), "root", "members").select("print", "component_id", "rows")
    shown = F.lpad(F.lower(F.hex("print")), 16, "0")
    found = join_hot(rows, stored(of, "components"), "print", "rows")
    return found.select("doc_id", shown.alias("fingerprint"), "component_id")


def without_near_copies(
    docs: DataFrame,
    words: int = 3,
    radius: int = 3,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs``, with all their columns, less the near copies of others.

    Near copies are the rows of a component of :func:`near_groups`. Of each component the row
    of least id stays (a null id last, then by the order of reading), so a row that goes is
    linked to the one that stays by close fingerprints, but need not be close to it itself.
    """
    rows, row = keyed(docs, "near-rows")
    each = picked(rows, row=row, id=id_col, text=text_col)
    each = each.select(F.struct(F.isnull("id").alias("none"), "id", "row").alias("doc_id"), "text")
    of_row = unused("gone", rows.columns)

    def copies() -> DataFrame:
        groups = near_groups(each, words, radius, seed)
        return groups.where("doc_id != component_id").select(F.col("doc_id.row").alias(of_row))

    # Hashed, the few that go spare the texts a sort.
    gone = settled(docs.sparkSession, copies, "near-gone").hint("shuffle_hash")
    return rows.join(gone, rows[row] == gone[of_row], "left_anti").select(*quoted(docs.columns))
