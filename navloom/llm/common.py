"""Helpers of several operators: picked columns, bounded slices, stored tables, ranks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from navloom.sources.shared import new_folder, remove_folder

#: Bytes of text that a task works on at once.
SLICE_BYTES = 3_000_000
#: Texts that are passed to a Python worker at once.
TEXTS_PER_BATCH = 1_000
#: The white space that separates words: space, and tab to carriage return.
BLANK = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def read_texts(spark: SparkSession, folder: str, table: str = "documents") -> DataFrame:
    """A table of long texts.

    Arrow batches get fewer rows, as each may be large. The files of a job's shuffles go
    with the job: what is read again is stored.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXTS_PER_BATCH))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return read(spark, folder, table)


def picked(table: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under fixed names; others cannot clash with results."""
    return table.select(*[table[old].alias(new) for old, new in zip(quoted(columns.values()), columns)])


def quoted(names: Iterable[str]) -> list[str]:
    """Names as column references, whatever characters they hold."""
    return ["`" + name.replace("`", "``") + "`" for name in names]


def stored(
    table: DataFrame, purpose: str, partition_by: list[str] | None = None, options: dict[str, str] | None = None
) -> DataFrame:
    """The table written to the shared folder and read again: cuts the lineage."""
    spark = table.sparkSession
    folder = new_folder(spark, purpose)
    if _SCOPES:
        _SCOPES[-1].append(folder)
    writer = table.write.mode("overwrite").options(**options or {})
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(folder)
    return spark.read.schema(table.schema).parquet(folder)


#: Folders of tables stored on the way to a result, innermost last.
_SCOPES: list[list[str]] = []


def settled(spark: SparkSession, build: Callable[[], DataFrame], purpose: str) -> DataFrame:
    """The table that ``build`` makes, stored; tables stored on the way to it are removed."""
    scope: list[str] = []
    _SCOPES.append(scope)
    try:
        try:
            table = build()
        finally:
            _SCOPES.pop()
        # The result belongs to the scope around this one.
        return stored(table, purpose)
    finally:
        for folder in scope:
            remove_folder(spark, folder)


def unused(name: str, names: Iterable[str]) -> str:
    """The name, led by underscores until no other has it; Spark's names have no case."""
    taken = {other.lower() for other in names}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def keyed(table: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """The table stored with a number for each row, and the name of that column."""
    name = unused("row", table.columns)
    return stored(table.withColumn(name, F.monotonically_increasing_id()), purpose), name


def join_hot(many: DataFrame, one: DataFrame, key: str, rows: str, hottest: int = 1_000) -> DataFrame:
    """``many`` inner joined to ``one``, its one row per key, with frequent keys kept apart.

    ``rows`` of ``one`` is how many rows of ``many`` have the key. The ``hottest`` keys are
    broadcast, so that their rows stay where they are; the rest, of which none has more than
    that part of all rows, meet by a shuffle.
    """
    hot = F.broadcast(one.orderBy(F.desc(rows), key).limit(hottest))
    keys = hot.select(key)
    others = many.join(keys, key, "left_anti").join(one.join(keys, key, "left_anti"), key)
    return many.join(hot, key).unionByName(others)


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds at most ``most`` bytes, or one long text."""
    try:
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
            start = size = 0
            for at, length in enumerate(lengths.to_pylist()):
                if at > start and size + length > most:
                    yield batch.slice(start, at - start)
                    start, size = at, 0
                size += length
            if batch.num_rows > start:
                yield batch.slice(start)
    finally:
        give_back()


def give_back() -> None:
    """Returns freed memory to the system; workers live on idle after their tasks."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def raw_texts(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes, null as empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def ranked(table: DataFrame, group: str, order: list, purpose: str) -> DataFrame:
    """Adds ``position`` (from 1) of each row in its group, without a task per group.

    The rows are range partitioned on group and order and stored; ranks in a part of the
    range are shifted by the rows of the group in earlier parts. Only one row per part
    and group is summed per group.
    """
    laid = table.repartitionByRange(F.col(group), *order).withColumn(
        "part", F.spark_partition_id()
    )
    laid = stored(laid, purpose)
    sizes = laid.groupBy(group, "part").count()
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        F.col(group).alias("of_group"),
        F.col("part").alias("of_part"),
        F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"),
    )
    inside = Window.partitionBy(group, "part").orderBy(*order)
    numbered = laid.withColumn("inside", F.row_number().over(inside))
    matched = F.col(group).eqNullSafe(F.col("of_group")) & (F.col("part") == F.col("of_part"))
    return (
        numbered.join(sizes, matched)
        .withColumn("position", F.col("before") + F.col("inside"))
        .drop("part", "of_group", "of_part", "before", "inside")
    )
