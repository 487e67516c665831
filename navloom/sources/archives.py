"""Monthly ZIP archives of delimited report files, read in one job over all of them.

The only Python inside a job of this package is here: Spark has no ZIP reader. Spark lists
the archives and hands out their paths; a task opens one archive at a time where it lies
and streams its report file in Arrow batches, so archives may be of any size.
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterable, Iterator
from csv import reader
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyarrow import csv, fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from navloom.fixed_values import MISSING_CELLS, RAW_COLUMNS, REPORT_CHARSET, REPORT_SEPARATOR
from navloom.functions.calendar import label_from_period
from navloom.sources.delimited import require_columns

BLOCK_BYTES = 1 << 20
#: For archives with a row that is longer than a block; no row may be longer than this.
LONG_ROW_BYTES = 4 << 20
ROWS_SCHEMA = ", ".join(["year_month string", *[f"{name} string" for name in RAW_COLUMNS]])
STATUS_SCHEMA = (
    "path string, year_month string, modified timestamp, ok boolean, rows bigint,"
    " error string, state string"
)
CLOSING = "archive bigint, path string, modified timestamp, ok boolean, rows bigint, error string"
STAGED_SCHEMA = f"{CLOSING}, {ROWS_SCHEMA}"
INSPECTED_ARROW = pa.schema(
    [("path", pa.string()), ("ok", pa.bool_()), ("rows", pa.int64()), ("error", pa.string())]
)


def archive_files(spark: SparkSession, source: str) -> DataFrame:
    """Archives below ``source``: ``path``, ``year_month`` from the name, ``modified``, ``bytes``.

    Only the listing is read. Scan tasks get ``spark.sql.files.maxPartitionBytes`` of
    archives, or one larger.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", True)
        .load(source)
    )
    return with_period(files)


def with_period(files: DataFrame) -> DataFrame:
    """Rows of the binary file source with ``year_month`` from the name: ``..._YYYYMM.zip``."""
    period = F.regexp_extract("path", r"(\d{6})\.zip$", 1)
    label = F.when(period != "", label_from_period(period))
    return files.select(
        "path",
        label.alias("year_month"),
        F.col("modificationTime").alias("modified"),
        F.col("length").alias("bytes"),
    )


def archive_status(files: DataFrame) -> DataFrame:
    """One row per archive: readable or why not, and its number of report rows."""
    checked = files.select("path", "year_month", "modified")
    # One Python pass: what it adds comes back beside the columns that it gets.
    schema = "path string, year_month string, modified timestamp, ok boolean, rows bigint, error string"
    return checked.mapInArrow(_inspect, schema)


def newest_sound(status: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """Adds ``state``: ``ok`` for the newest sound archive of each month, ``failed`` for
    unsound ones, and ``superseded`` for the others.

    Newest is by time of modification, then path. ``earlier`` are the archives of former
    runs that months now hold; an archive older than that of its month is superseded too.
    """
    given = status.withColumn("now", F.lit(True))
    if earlier is not None:
        held = earlier.select("path", "year_month", "modified", "ok", F.lit(False).alias("now"))
        given = given.unionByName(held, allowMissingColumns=True)
    # One pass: the status may be a plan that reads all archives.
    newest = Window.partitionBy("year_month").orderBy(F.desc("ok"), F.desc("modified"), F.desc("path"), F.desc("now"))
    placed = given.withColumn("place", F.row_number().over(newest))
    state = F.when(~F.col("ok"), "failed").when(F.col("place") == 1, "ok").otherwise("superseded")
    return placed.withColumn("state", state).filter("now").drop("now", "place")


def archive_rows(files: DataFrame) -> DataFrame:
    """Report rows of all archives as text; an unreadable archive fails the job.

    An archive is read by one task. Its rows are then dealt out by month, large months to
    several tasks.
    """
    rows = files.select("path", "year_month").mapInArrow(_extract, ROWS_SCHEMA)
    return rows.hint("rebalance", "year_month")


def staged_archives(files: DataFrame) -> DataFrame:
    """All archives read once: their report rows, and a closing record for each.

    ``archive`` numbers the archives; closing records alone have ``path``, ``modified``, ``ok``,
    ``rows`` and ``error``. The rows of an archive that breaks off are there up to the break,
    so take those of archives only whose closing record is ``ok``. Nothing is moved: rows
    stay with the task that opened their archive.
    """
    given = files.select("path", "year_month", "modified", F.monotonically_increasing_id().alias("archive"))
    return given.mapInArrow(_read_through, STAGED_SCHEMA)


def closing_records(staged: DataFrame) -> DataFrame:
    """The status of each archive from stored rows of :func:`staged_archives`."""
    return staged.filter("ok is not null").select("archive", "path", "year_month", "modified", "ok", "rows", "error")


def rows_of_chosen(staged: DataFrame, status: DataFrame) -> DataFrame:
    """The report rows of the archives whose state is ``ok`` in ``status``.

    There is one such archive per month at most, so their numbers are broadcast to the scan.
    """
    chosen = closing_records(staged).select("archive", "path")
    chosen = chosen.join(F.broadcast(status.filter("state = 'ok'").select("path")), "path", "left_semi")
    rows = staged.filter("ok is null").join(F.broadcast(chosen.select("archive")), "archive", "left_semi")
    return rows.select("year_month", *RAW_COLUMNS)


def read_archives(spark: SparkSession, source: str) -> tuple[DataFrame, DataFrame]:
    """Rows of the newest sound archive of each month below ``source``, and the status of all.

    Callers that need both should store the status first, see ``plans.ingest``.
    """
    files = archive_files(spark, source)
    status = newest_sound(archive_status(files))
    return archive_rows(readable(files, status)), status


def readable(files: DataFrame, status: DataFrame) -> DataFrame:
    return files.join(status.filter("state = 'ok'").select("path"), "path", "left_semi")


def open_archive(path: str) -> BinaryIO:
    """A seekable file from a path as Spark lists it (``file:/...``, ``hdfs://...``, ...)."""
    if path.startswith("file:"):
        return open("/" + path.removeprefix("file:").lstrip("/"), "rb")
    where, inner = fs.FileSystem.from_uri(quote(path, safe=":/@"))
    return where.open_input_file(inner)


def _batches(file: BinaryIO) -> Iterator[pa.RecordBatch]:
    """Text of the required columns of the first report file in an archive.

    Rows that end early are filled with nulls; rows that are too long are an error. What a
    task holds are some blocks of text, so blocks are small; a file that cannot be read
    in these is read on in larger ones.
    """
    with zipfile.ZipFile(file) as archive:
        members = [name for name in archive.namelist() if name.endswith(".csv")]
        if not members:
            raise ValueError("no CSV file in the archive")
        with archive.open(members[0]) as member:
            header = require_columns(_cells(member.readline().decode(REPORT_CHARSET)))
        passed = {"whole": 0, "short": 0}
        try:
            with archive.open(members[0]) as member:
                yield from _parsed(member, header, BLOCK_BYTES, passed)
        except pa.ArrowInvalid:
            with archive.open(members[0]) as member:
                yield from _parsed(member, header, LONG_ROW_BYTES, passed)


def _parsed(
    member: BinaryIO, header: list[str], block_bytes: int, passed: dict[str, int]
) -> Iterator[pa.RecordBatch]:
    """The rows of a report file but for the first ``passed`` ones, which counts on."""
    skip, short = dict(passed), []

    def on_invalid(row: csv.InvalidRow) -> str:
        if row.actual_columns > row.expected_columns:
            return "error"
        if skip["short"]:
            skip["short"] -= 1
        else:
            short.append(row.text)
        return "skip"

    def filled() -> Iterator[pa.RecordBatch]:
        if short:
            passed["short"] += len(short)
            yield _filled(short, header)
            short.clear()

    batches = csv.open_csv(
        member,
        csv.ReadOptions(use_threads=False, block_size=block_bytes, encoding=REPORT_CHARSET),
        csv.ParseOptions(
            delimiter=REPORT_SEPARATOR,
            newlines_in_values=True,
            invalid_row_handler=on_invalid,
        ),
        csv.ConvertOptions(
            include_columns=RAW_COLUMNS,
            column_types={name: pa.string() for name in RAW_COLUMNS},
            strings_can_be_null=True,
            null_values=MISSING_CELLS,
        ),
    )
    for batch in batches:
        known = min(skip["whole"], batch.num_rows)
        skip["whole"] -= known
        passed["whole"] += batch.num_rows - known
        yield batch.slice(known)
        yield from filled()
    yield from filled()


def _cells(line: str) -> list[str]:
    return next(reader([line], delimiter=REPORT_SEPARATOR), [])


def _filled(lines: list[str], header: list[str]) -> pa.RecordBatch:
    missing = set(MISSING_CELLS)
    rows = [dict(zip(header, _cells(line))) for line in lines]
    columns = [
        pa.array([None if (cell := row.get(name)) in missing else cell for row in rows], pa.string())
        for name in RAW_COLUMNS
    ]
    return pa.RecordBatch.from_arrays(columns, names=RAW_COLUMNS)


def _inspect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for path, month in zip(batch.column("path").to_pylist(), batch.column("year_month").to_pylist()):
            rows, error = 0, None
            try:
                if month is None:
                    raise ValueError("no period YYYYMM in the file name")
                with open_archive(path) as file:
                    rows = sum(part.num_rows for part in _batches(file))
            except Exception as problem:  # any broken archive is a result here
                error = f"{type(problem).__name__}: {problem}"
            found.append({"path": path, "ok": error is None, "rows": rows, "error": error})
        checked = pa.RecordBatch.from_pylist(found, INSPECTED_ARROW)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *checked.columns[1:]],
            names=[*batch.schema.names, *INSPECTED_ARROW.names[1:]],
        )


def _extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, month in zip(batch.column("path").to_pylist(), batch.column("year_month").to_pylist()):
            with open_archive(path) as file:
                for part in _batches(file):
                    label = pa.repeat(pa.scalar(month, pa.string()), part.num_rows)
                    yield pa.RecordBatch.from_arrays(
                        [label, *part.columns], names=["year_month", *RAW_COLUMNS]
                    )


def _read_through(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        stamp = batch.schema.field("modified").type
        names = ["archive", "path", "modified", "ok", "rows", "error", "year_month", *RAW_COLUMNS]
        kinds = [pa.int64(), pa.string(), stamp, pa.bool_(), pa.int64(), *[pa.string()] * (2 + len(RAW_COLUMNS))]
        staged = pa.schema(zip(names, kinds))

        def filled(n: int, **known: pa.Array) -> pa.RecordBatch:
            columns = [known.get(field.name, None) for field in staged]
            columns = [pa.nulls(n, f.type) if c is None else c for c, f in zip(columns, staged)]
            return pa.RecordBatch.from_arrays(columns, schema=staged)

        for at in range(batch.num_rows):
            number, path, month, modified = (
                batch.column(c).slice(at, 1) for c in ("archive", "path", "year_month", "modified")
            )
            rows, error = 0, None
            try:
                if not month[0].is_valid:
                    raise ValueError("no period YYYYMM in the file name")
                with open_archive(path[0].as_py()) as file:
                    for part in _batches(file):
                        rows += part.num_rows
                        same = {"archive": pa.repeat(number[0], part.num_rows), "year_month": pa.repeat(month[0], part.num_rows)}
                        yield filled(part.num_rows, **same, **dict(zip(part.schema.names, part.columns)))
            except Exception as problem:  # any broken archive is a result here
                rows, error = 0, f"{type(problem).__name__}: {problem}"
            yield filled(
                1, archive=number, path=path, year_month=month, modified=modified, ok=pa.array([error is None]),
                rows=pa.array([rows]), error=pa.array([error], pa.string()),
            )
