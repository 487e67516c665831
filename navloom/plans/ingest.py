"""From monthly archives to the raw lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from navloom.operators.staging import coerce_reports
from navloom.sources.archives import (
    STATUS_SCHEMA,
    archive_files,
    closing_records,
    newest_sound,
    rows_of_chosen,
    staged_archives,
)
from navloom.sources.lake import lake_months, write_lake
from navloom.sources.shared import new_folder, remove_folder
from navloom.sources.snapshots import MonthTable


def ingest_archives(
    spark: SparkSession,
    source: str,
    lake: str | MonthTable,
    skip_present: bool = True,
    log: str | None = None,
) -> DataFrame:
    """Bring the archives below ``source`` into ``lake`` and return their status.

    A month has the rows of one archive: the newest sound one. A month already in the lake
    is left as it is, unless ``skip_present`` is off, when it is replaced. Every archive gets
    a status row, stored in ``log`` (default: a new folder): ``ok`` is in the lake now,
    ``present`` was not looked at, ``superseded`` is older than another of its month, and
    ``failed`` could not be read. Broken archives do not stop the others. ``lake`` is the
    folder of a lake or a versioned one, of which readers see all new months at once.
    """
    files = archive_files(spark, source)
    present = None
    if skip_present:
        # Labels are four and two digits, so there are never many of them.
        known = lake.months() if isinstance(lake, MonthTable) else lake_months(spark, lake)
        months = F.broadcast(known)
        present = files.join(months, "year_month", "left_semi")
        files = files.join(months, "year_month", "left_anti")
    return ingest_files(files, lake, log or new_folder(spark, "ingest-status"), present)


def ingest_files(
    files: DataFrame,
    lake: str | MonthTable,
    log: str,
    present: DataFrame | None = None,
    earlier: DataFrame | None = None,
) -> DataFrame:
    """:func:`ingest_archives` for given rows as ``archive_files`` makes them.

    Every archive is opened once: its rows go, typed, to a staging folder, followed by a
    closing record that says whether all of it could be read. From these records the status
    is stored, and the rows of the chosen archives are promoted from staging to the lake, so
    that half a broken archive never reaches it. ``earlier`` is the status of what the
    months of the lake hold.
    """
    spark = files.sparkSession
    staging = new_folder(spark, "ingest-staging")
    try:
        typed = coerce_reports(staged_archives(files))
        typed.write.option("compression", "snappy").parquet(staging)
        staged = spark.read.schema(typed.schema).parquet(staging)
        status = newest_sound(closing_records(staged).drop("archive"), earlier)
        if present is not None:
            status = status.unionByName(
                present.select("path", "year_month", "modified", F.lit("present").alias("state")),
                allowMissingColumns=True,
            )
        status.write.mode("overwrite").parquet(log)
        status = spark.read.schema(STATUS_SCHEMA).parquet(log)
        rows = rows_of_chosen(staged, status)
        if isinstance(lake, MonthTable):
            lake.replace(rows)
        else:
            write_lake(rows, lake)
    finally:
        remove_folder(spark, staging)
    return status


def failed(status: DataFrame) -> DataFrame:
    return status.filter("state = 'failed'").select("path", "year_month", "error")
