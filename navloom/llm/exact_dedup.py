"""Exact duplicates by Grace hashing.

Texts are equal if they are identical once each run of white space is one space. The map
tasks normalise, digest and write all records to the shared folder; copies that a task
finds in a small table of texts it has just seen are written as a reference to the first.
The records are then partitioned by digits of their hash, and buckets whose contents do
not fit a table are partitioned again by the next digits, into spill files in the shared
folder, until every bucket fits or holds one text only. Each bucket goes through an
open-addressing table that compares complete contents.

Null counts as the empty text, and white space alone is one space, another text. Of equal
texts the row with the smallest ``doc_id`` stays, null ids last; of rows that repeat an id
the first one written. Every row gets a result row; texts of any length are compared
whole; columns other than the two named ones are not carried along; tables without rows
give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from navloom.llm.common import picked, raw_texts, stored, text_slices

#: Bytes of different texts that a bucket's table may hold.
BUCKET_BYTES = 48_000_000
#: Bytes of texts a map task remembers to spot copies before they are moved.
COMBINE_BYTES = 8_000_000
#: Buckets made of one that is too large.
FAN_OUT = 16


class Table:
    """Open addressing with linear probing; a slot leads to a text and its number."""

    def __init__(self) -> None:
        self.slots = np.full(1024, -1, np.int64)
        self.hashes: list[int] = []
        self.texts: list[bytes] = []
        self.numbers: list[int] = []

    def _place(self, hashed: int, text: bytes | None) -> tuple[int, int]:
        """The slot where the text is or would be, and its entry or -1."""
        mask = len(self.slots) - 1
        slot = hashed & mask
        while (entry := int(self.slots[slot])) >= 0:
            if text is not None and self.hashes[entry] == hashed and self.texts[entry] == text:
                return slot, entry
            slot = (slot + 1) & mask
        return slot, -1

    def _grow(self) -> None:
        self.slots = np.full(2 * len(self.slots), -1, np.int64)
        for entry, hashed in enumerate(self.hashes):
            self.slots[self._place(hashed, None)[0]] = entry

    def number(self, hashed: int, text: bytes, number: int, add: bool = True) -> int:
        """The number under which an equal text came first; else ``number``, from now on."""
        slot, entry = self._place(hashed, text)
        if entry >= 0:
            return self.numbers[entry]
        if add:
            self.slots[slot] = len(self.texts)
            self.hashes.append(hashed)
            self.texts.append(text)
            self.numbers.append(number)
            if 2 * len(self.texts) > len(self.slots):
                self._grow()
        return number


def normalised(text: bytes) -> bytes:
    """Each run of space and tab to carriage return as one space.

    ``bytes.split`` cuts at just these; it drops them at the ends.
    """
    if not text:
        return text
    words = text.split()
    if not words:
        return b" "
    start, end = text[:1].isspace(), text[-1:].isspace()
    return b" " * start + b" ".join(words) + b" " * end


def _records(docs: DataFrame) -> DataFrame:
    """``row, doc_id, first, digest, hashed, size, text``; text only where first is row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        seen, held = Table(), 0
        for part in text_slices(batches):
            out: list[list] = [[], [], [], [], [], []]
            for text in map(normalised, raw_texts(part.column("text"))):
                digest = hashlib.sha256(text).digest()
                hashed = int.from_bytes(digest[:8], "big") >> 1
                room = held + len(text) <= COMBINE_BYTES
                first = seen.number(hashed, text, row, add=room)
                held += len(text) if room and first == row else 0
                values = row, first, digest.hex(), hashed, len(text), text
                for column, value in zip(out, values):
                    column.append(value if column is not out[5] or first == row else None)
                row += 1
            kinds = pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()
            arrays = [pa.array(values, kind) for values, kind in zip(out, kinds)]
            arrays.insert(1, part.column("doc_id"))
            names = ["row", "doc_id", "first", "digest", "hashed", "size", "text"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(
        work,
        f"row bigint, doc_id {kind}, first bigint, digest string, hashed bigint,"
        " size bigint, text binary",
    )


def _bucketed(records: DataFrame, bucket_bytes: int) -> tuple[DataFrame, int]:
    """The records with a ``bucket`` whose texts fit a table, and the number of buckets."""
    total = records.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    digits, fitting, buckets = max(1, -(-total // bucket_bytes)), None, 0
    rest, used = records.withColumn("bucket", F.lit("")), F.lit(1)
    # A hash of 63 bits has no more digits than this; what is left then is one text.
    for _ in range(16):
        digit = F.expr("hashed").cast("decimal(20,0)") / used
        digit = F.pmod(F.floor(digit), F.lit(digits))
        rest = rest.withColumn("bucket", F.concat_ws("/", "bucket", digit.cast("string")))
        sizes = rest.groupBy("bucket").agg(
            F.sum("size").alias("bytes"), F.min("digest").alias("a"), F.max("digest").alias("b")
        )
        whole = (F.col("bytes") <= 2 * bucket_bytes) | (F.col("a") == F.col("b"))
        sizes = stored(sizes.select("bucket", whole.alias("whole")), "bucket-sizes")
        n, n_whole = sizes.agg(F.count("*"), F.count_if("whole")).first()
        buckets += n_whole
        if n == n_whole:
            done, over = rest, None
        else:
            done = rest.join(sizes.where("whole"), "bucket", "left_semi")
            over = rest.join(sizes.where("not whole"), "bucket", "left_semi")
        fitting = done if fitting is None else fitting.unionByName(done)
        if over is None:
            break
        rest = stored(over, "grace-spill")
        used, digits = used * digits, FAN_OUT
    return fitting, buckets


def _first_of_all(records: DataFrame, bucket_bytes: int) -> DataFrame:
    """``first, of``: each text a task wrote, and the one that stands for all its equals."""
    texts = records.where(F.col("text").isNotNull()).select(
        "row", "digest", "hashed", "size", "text"
    )
    bucketed, buckets = _bucketed(texts, bucket_bytes)
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = bucketed.select("bucket", "hashed", "row", "text")
    laid = laid.repartition(max(parts, buckets), "bucket").sortWithinPartitions("bucket", "row")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, table = None, Table()
        for part in text_slices(batches):
            rows, found = part.column("row").to_pylist(), []
            keys, hashes = part.column("bucket").to_pylist(), part.column("hashed").to_pylist()
            for key, row, hashed, text in zip(keys, rows, hashes, raw_texts(part.column("text"))):
                if key != bucket:
                    bucket, table = key, Table()
                found.append(table.number(hashed, text, row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(found, pa.int64())], ["first", "of"]
            )

    return laid.mapInArrow(work, "first bigint, of bigint")


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """One row per row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Copies are combined per map task, so a text that a third of all rows share is moved
    once per task; sizes and ids of groups are combined the same way.
    """
    records = stored(_records(picked(docs, doc_id=id_col, text=text_col)), "dedup-records")
    of = stored(_first_of_all(records, bucket_bytes), "dedup-groups")
    rows = records.select("row", "doc_id", "first", "digest")
    least = F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "row"))
    local = rows.groupBy("first").agg(least.alias("least"), F.count("*").alias("n"))
    local = local.join(of, "first")
    total = local.groupBy("of").agg(F.min("least").alias("keep"), F.sum("n").alias("group_size"))
    groups = of.join(total, "of").select("first", "keep", "group_size")
    return rows.join(groups, "first").select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
